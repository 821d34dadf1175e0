"""Hard-negative mining, Merkle manifest, hierarchical packing: brute force on the small table, edge rows."""

import itertools
import math
import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wordloom.llm import common, hard_negatives, length_packing, merkle, queries

SF = "/root/testdata/sf0.001"


def folder(spark):
    return common.run_folder(spark, "test")


# --- hard negatives -------------------------------------------------------------
def brute_negatives(rows, k=5, m=3, every=50):
    rows = [(i, lab, v) for i, lab, v in rows if i is not None and lab is not None and v is not None and None not in v]
    out = []
    for i, lab, a in rows:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), j, other) for j, other, v in rows if j != i]
        for s, j, _ in sorted(x for x in scored if x[2] == lab)[:k]:
            negatives = sorted(x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s)[:m]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(negatives, 1)]
    return sorted(out)


def table_rows(spark, sf):
    out = []
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        lab = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
        out.append((r.vec_id, lab, [math.floor(256 * float(x)) for x in r.embedding]))
    return out


def test_op11_equals_brute_force(spark):
    got = sorted(tuple(r) for r in queries.op11_hard_negative_mining(spark, SF).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got and got == brute_negatives(table_rows(spark, SF))


def mined(spark, rows, **given):
    df = spark.createDataFrame(rows, "vec_id long, label int, v array<bigint>, key string, block int")
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, folder(spark), **given).collect())


@pytest.mark.parametrize("spread", [2, 40, 1 << 40])
def test_hard_negatives_in_many_blocks(spark, spread):
    """Few distinct scores make ties, huge components leave the exact doubles."""
    r = random.Random(spread)
    rows = [(i, r.randrange(3), [r.randint(-spread // 2, spread) if spread < 1000 else r.choice([0, 1, 3 << 19]) for _ in range(6)], "x", 9) for i in range(400)]
    rows += [(400 + i, 1, rows[0][2], "x", 9) for i in range(150)]      # one vector, many times
    assert mined(spark, rows, block=64, chunk=4) == brute_negatives([x[:3] for x in rows])


def test_hard_negatives_edge_rows(spark):
    rows = [(0, 1, [1, 2]), (1, 1, [2, 2]), (2, 0, [1, 1]), (3, None, [9, 9]), (None, 0, [1, 1]), (4, 0, None), (5, 0, [1, None]), (6, 0, []), (7, 0, [5]), (50, 2, [0, 0]), (51, 2, [1, 1]), (52, 0, [0, 0]), (100, 5, [1, 1]), (2, 0, [1, 1])]
    brute = brute_negatives([(i, lab, None if v is None else [*v, 0, 0][:2] if None not in v else v) for i, lab, v in rows])
    assert mined(spark, [(*x, "x", 0) for x in rows]) == brute
    assert any(x[0] == 50 for x in brute)     # zero window: negatives of score 0
    assert mined(spark, []) == []


def test_integer_vectors(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan"), 1.0],), ([float("inf")],), ([None, 1.0],), (None,), ([],)], "e array<float>")
    assert [r.v for r in df.select(hard_negatives.integer_vector("e").alias("v")).collect()] == [[128, -1], None, None, None, None, []]


def test_walk_stops_before_the_end_of_the_lists():
    r = np.random.default_rng(1)
    v = r.integers(0, 1000, (5000, 2)).astype(np.int64)
    lists = hard_negatives.Lists(np.arange(5000), v)
    looked = []
    lists.ids = type("Counted", (np.ndarray,), {"__getitem__": lambda self, k: (looked.append(len(k)) if isinstance(k, np.ndarray) else None, np.ndarray.__getitem__(self, k))[1]})((5000,), np.int64, lists.ids.copy())
    best = lists.search(np.array([3, 2]), -1, [hard_negatives.UNBOUNDED], 5)[0]
    scores = v @ np.array([3, 2])
    assert best == [(int(scores[i]), int(i)) for i in sorted(range(5000), key=lambda i: (-scores[i], i))[:5]]
    assert sum(looked) < 2500


# --- Merkle manifest --------------------------------------------------------------
def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes, fanout=2):
    """(root, per leaf the levels of (left, right) siblings)."""
    paths, at, places = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(at) > 1:
        for leaf, i in enumerate(places):
            low = i // fanout * fanout
            paths[leaf].append((at[low:i], at[i + 1: low + fanout]))
        at = [h(*at[i: i + fanout]) for i in range(0, len(at), fanout)]
        places = [i // fanout for i in places]
    return at[0], paths


def brute_manifest(rows, fanout=2):
    """rows: (doc_id, lang, leaf, check), any order."""
    by_lang = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])):
        by_lang.setdefault(r[1], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = [brute_tree([r[2] for r in by_lang[x]], fanout) for x in langs]
    root, tops = brute_tree([t[0] for t in trees], fanout) if trees else (None, [])
    out = []
    for lang, (subroot, paths), top in zip(langs, trees, tops):
        for (doc_id, _, leaf, check), path in zip(by_lang[lang], paths):
            node = check
            for left, right in path + top:
                node = h(*left, node, *right)
            out.append((doc_id, leaf, subroot, root, h(*[x for left, right in path + top for x in left + right]), node))
    return sorted(out, key=str)


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def test_op12_equals_brute_force(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        bad = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        rows.append((r.doc_id, r.lang, *(h(*map(field, (r.doc_id, r.source, r.lang, n, r.text))) for n in (r.n_chars, r.n_chars + bad))))
    got = queries.op12_merkle_manifest(spark, SF).collect()
    assert sorted([tuple(r)[:6] for r in got], key=str) == brute_manifest(rows)
    assert {r.doc_id for r in got if not r.verified} == {r[0] for r in rows if r[2] != r[3]} != set()


@pytest.mark.parametrize("fanout, depth, n", [(2, 1, 37), (2, 2, 64), (3, 1, 50), (4, 1, 90), (2, 3, 8), (2, 0, 9)])
def test_butterfly_over_many_partitions(spark, fanout, depth, n):
    r = random.Random(n)
    rows = [(r.randrange(n) if r.random() > 0.05 else None, r.choice([None, "a", "a", "a", "", "é", "-", "="]), h(str(r.random()))) for _ in range(n)]
    rows += [(1, "one", h("x"))] + [(7, "a", h("same"))] * 3
    rows = [(*x, x[2] if r.random() < 0.8 else h("tampered")) for x in rows]
    df = spark.createDataFrame(rows, "doc_id long, lang string, digest string, check string").withColumn("g", merkle.group_key(F.col("lang"))).withColumn("n", F.lit(5))
    got = merkle.manifest(df, folder(spark), fanout, depth).collect()
    assert sorted([tuple(x) for x in got], key=str) == brute_manifest(rows, fanout)


def test_manifest_of_nothing_and_of_one_row(spark):
    df = spark.createDataFrame([(None, None, h("x"), h("x"))], "doc_id long, lang string, digest string, check string").withColumn("g", merkle.group_key(F.col("lang")))
    assert [tuple(r) for r in merkle.manifest(df, folder(spark)).collect()] == [(None, h("x"), h("x"), h("x"), h(""), h("x"))]
    assert merkle.manifest(df.where("false"), folder(spark)).collect() == []


def test_leaf_fields(spark):
    df = spark.createDataFrame([(None, "é:1", "")], "a long, b string, c string")
    assert df.select(merkle.leaf(F.col("a"), F.col("b"), F.col("c"))).first()[0] == h("-4:é:10:")


# --- hierarchical packing -----------------------------------------------------------
def whole_text_encoder():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(queries.WORD_FILE))
    t.encode_special_tokens = True
    return t


def ids_of(t, text):
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_word_encoder_equals_whole_text_encoding(monkeypatch):
    monkeypatch.setattr(length_packing, "SEGMENT", 40)
    r = random.Random(4)
    atoms = ["The", "word", " ", "  ", "\n", "\n\n", "\t", "\r", "é", "日本", "\x85", "'s", "'", "12", "!?", "<|endoftext|>", "\x1c", " ", "́", "👍🏽", ".", "İ", "Σ", "I'LL", "\x00"]
    texts = ["".join(r.choices(atoms, k=r.randint(0, 40))) for _ in range(20_000)] + [None, "", " ", "a" * 5000, "word " * 3000]
    t, encoder = whole_text_encoder(), length_packing.Encoder(public_tokenizers.path(queries.WORD_FILE))
    letters = "abzßéÿÀÞ×÷ſıẞµªº"
    texts += ["".join(r.choices(letters + letters.upper() + ",.%*'-_1 ", k=r.randint(1, 20))) for _ in range(20_000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == ids_of(t, text).tobytes(), repr(text)


@pytest.mark.parametrize("tiers", [(2048, 1024, 512, 256), (8, 4), (16,)])
def test_every_token_once_and_no_padding(tiers):
    r = random.Random(tiers[0])
    for lengths in ([], [1], [tiers[0]], [tiers[0] - 1], [3] * 50, *[[r.randint(1, tiers[0]) if r.random() < 0.5 else r.randint(1, 5) for _ in range(r.randint(1, 300))] for _ in range(40)]):
        sequences = length_packing.packed(lengths, tiers)
        held = sorted(p for s in sequences for p in s)
        for i, n in enumerate(lengths):
            spans = [(a, b) for x, a, b in held if x == i]
            assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(spans)) and sum(b for _, b in spans) == n
        sizes = [sum(n for *_, n in s) for s in sequences]
        assert all(x & (x - 1) == 0 and x <= tiers[0] for x in sizes) and sum(sizes) == sum(lengths)
        assert sum(x not in tiers for x in sizes) <= 11      # the end of a bucket only
        # a window is closed with one cut at most, so whole documents stay the rule
        assert len(held) <= len(lengths) + len(sequences) + 11


def test_step_groups_are_balanced():
    r = random.Random(3)
    sequences = length_packing.packed([min(2047, int(r.expovariate(1 / 300)) + 1) for _ in range(4000)])
    of, groups = length_packing.step_groups(sequences, 1 << 14), {}
    for s, key in zip(sequences, of):
        groups.setdefault(key, []).append(s)
    for size in (2048, 1024, 512):
        tokens = [sum(n for s in g for *_, n in s) for (x, _), g in groups.items() if x == size]
        work = [sum(n * n for s in g for *_, n in s) for (x, _), g in groups.items() if x == size]
        assert max(tokens) - min(tokens) <= size and max(tokens) <= (1 << 14)
        assert len(work) < 2 or max(work) - min(work) < 0.2 * max(work) + size * size


def brute_pieces(rows, got):
    """The pieces cover every document's ids, and sequences are gapless."""
    t = whole_text_encoder()
    want = sorted((i is not None, i or 0, len(x), zlib.crc32(x.tobytes())) for i, x in ((i, ids_of(t, text)) for i, text in rows))
    docs = {}
    for p in got:
        docs.setdefault(p.doc_id, []).append(p)
    by_id = {}
    for i, text in rows:
        by_id.setdefault(i, []).append(ids_of(t, text))
    assert len(want) == len(rows) and docs.keys() == by_id.keys()
    for i, ps in docs.items():
        left = sorted(ps, key=lambda p: p.start)
        if len(by_id[i]) == 1:
            ids, at = by_id[i][0], 0
            for p in left:
                assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at: at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
        else:
            assert sum(p.length for p in left) == sum(map(len, by_id[i]))
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append(p)
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0 and {p.tier for p in ps} == {at}


def test_op13_covers_every_token(spark):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    brute_pieces(rows, queries.op13_hierarchical_packing(spark, SF).collect())


def test_op13_edge_rows(spark):
    rows = [(5, "b c"), (None, "a"), (5, "b c"), (2, None), (1, ""), (9, "long word " * 30_000), (8, "x" * 3000)]
    df = spark.createDataFrame([(*x, 7, "y") for x in rows], "doc_id long, text string, row int, ids string")
    path = public_tokenizers.path(queries.WORD_FILE)
    for bucket in (length_packing.BUCKET, 1000):
        got = length_packing.pieces(df, path, bucket=bucket).withColumn("ids_crc32", F.crc32("ids"))
        brute_pieces(rows, got.collect())
    assert length_packing.pieces(df.where("false"), path).collect() == []
    with pytest.raises(ValueError):
        length_packing.pieces(df, path, tiers=(2048, 1000))
