"""Bit packing, WARC salvage, SentencePiece transducer: round trips and damage."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from wordloom.llm import common, packing, queries, transducer, warc

SF = "/root/testdata/sf0.001"


def folder(spark):
    return common.run_folder(spark, "test")


# --- bit packing --------------------------------------------------------------
@pytest.mark.parametrize("vocabulary", [1, 2, 3, 257, 50_257, 65_536, 65_537, 1 << 20, 1 << 32])
def test_pack_round_trip(vocabulary):
    r = np.random.default_rng(vocabulary % 1000)
    width = packing.width_of(vocabulary)
    assert (1 << width) >= vocabulary and (width == 1 or (1 << (width - 1)) < vocabulary)
    for n in (0, 1, 7, 8, 1000):
        ids = r.integers(0, vocabulary, n).astype(np.uint32)
        payload = packing.pack(ids, width)
        assert len(payload) == (n * width + 7) // 8
        assert (packing.unpack(payload, n, width) == ids).all()


@pytest.mark.parametrize("width", [11, 16, 17])
def test_shard_random_access(tmp_path, width):
    r = np.random.default_rng(2)
    docs = [(k if k != 3 else None, r.integers(0, 1 << width, n).astype(np.uint32)) for k, n in enumerate([0, 5, 70_000, 1, 200_000, 3])]
    out = packing.Writer(str(tmp_path / "a.bpk"), width)
    for i, ids in docs:
        out.add(i, ids)
    out.close()
    shard = packing.Shard(str(tmp_path / "a.bpk"))
    rows = np.concatenate(list(shard.documents(rows=2)))
    assert [None if x["null"] else int(x["id"]) for x in rows] == [i for i, _ in docs]
    whole = np.concatenate([x for _, x in docs])
    for x, (_, ids) in zip(rows, docs, strict=True):
        assert (shard.read(int(x["first"]), int(x["count"])) == ids).all()
    for first, n in ((65_535, 2), (0, len(whole)), (131_071, 100_000)):
        assert (shard.read(first, n) == whole[first: first + n]).all()


def whole_text_encoder():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(queries.BPE_FILE))
    t.encode_special_tokens = True
    return t


def test_piecewise_encoding_equals_whole_text_encoding():
    r = random.Random(1)
    atoms = ["the", " ", "  ", "\n", "\n\n", " \n", "\t", "é", "日本", " ", " ", "\x85", "'s", "'", "12", "!?", "<|endoftext|>", "\x1c", "👍🏽", ".", "\r\n", "A b", " x"]
    texts = ["".join(r.choices(atoms, k=r.randint(0, 25))) for _ in range(3000)] + [None, "", "a" * 5000, " " * 300, "word " * 3000]
    encoder = packing.Encoder(public_tokenizers.path(queries.BPE_FILE))
    whole = whole_text_encoder()
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == [*whole.encode(t or "", add_special_tokens=False).ids, packing.END_ID], repr(t)


def test_every_white_space_in_100_000_random_texts():
    """Lone carriage returns after spaces and at the begin included."""
    r = random.Random(11)
    space = [" ", " ", "\n", "\r", "\t", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\r\n", " \r", "\r "]
    words = ["a", "bee", "Word", "x.", "12", "'s", "é", "--"]
    texts = ["a \rb", "one \rtwo three", "\rx", "\r", " \r", "a\r b"] + ["".join(r.choice(space if r.random() < 0.5 else words) for _ in range(r.randint(1, 9))) for _ in range(100_000)]
    encoder, whole = packing.Encoder(public_tokenizers.path(queries.BPE_FILE)), whole_text_encoder()
    for at in range(0, len(texts), 5000):
        part = texts[at: at + 5000]
        for t, ids, e in zip(part, encoder.encode(part), whole.encode_batch(part, add_special_tokens=False), strict=True):
            assert ids.tolist() == [*e.ids, packing.END_ID], repr(t)


def test_texts_of_the_common_alphabet_are_cut_into_the_tokenizers_tokens():
    r = random.Random(21)
    atoms = ["'s", "'", "'ll", "'LL", "''t", "don't", " ", " ", "  ", "\n", "\n\n", " \n", "\n ", "12", "3", "ab", "É", "ß", "ÿ", "Word", ".", "...", "!?", "_", "<|endoftext|>", "$%&", "~", "@a.b"]
    texts = ["".join(r.choices(atoms, k=r.randint(1, 14))) for _ in range(40_000)]
    encoder, whole = packing.Encoder(public_tokenizers.path(queries.BPE_FILE)), whole_text_encoder()
    assert not any(packing._other(t) for t in texts)
    for at in range(0, len(texts), 5000):
        part = texts[at: at + 5000]
        for t, ids, e in zip(part, encoder.encode(part), whole.encode_batch(part, add_special_tokens=False), strict=True):
            assert ids.tolist() == [*e.ids, packing.END_ID], repr(t)


def brute_digests(rows):
    t, start, out = whole_text_encoder(), 0, []
    for doc_id, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_op3_equals_brute_force(spark):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    got = [tuple(x) for x in queries.op3_bit_packing(spark, SF).orderBy("start").collect()]
    assert got == brute_digests(rows)


def test_op3_edge_rows(spark):
    df = spark.createDataFrame([(5, "b", 1), (None, "a", 2), (5, "b", 1), (2, None, 3), (1, "", 4)], "doc_id long, text string, start long")
    path = public_tokenizers.path(queries.BPE_FILE)
    got = [tuple(x) for x in packing.digests(spark, packing.write(df, folder(spark), path, queries.BPE_SIZE)).orderBy("start").collect()]
    assert got == brute_digests([(None, "a"), (1, ""), (2, None), (5, "b"), (5, "b")])
    empty = packing.write(df.where("false"), folder(spark), path, queries.BPE_SIZE)
    assert packing.digests(spark, empty).collect() == []


# --- WARC ---------------------------------------------------------------------
def records_of(path):
    found = list(warc.salvage(str(path)))
    return [(k, warc._page(h.get("warc-record-id")), b) for k, _, _, h, b, _ in found if k == "record"], [(b, e) for k, b, e, *_ in found if k == "gap"]


PAYLOADS = [b"<p>" + bytes([65 + k]) * (300 * k + 1) + b"WARC/1.1\r\nnot a record\r\n" for k in range(6)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_goes_on_after_damage(tmp_path, packed):
    wrap = warc.member if packed else bytes
    parts = [wrap(warc.record(k, f"http://a/{k}", p, None, False)) for k, p in enumerate(PAYLOADS)]
    whole = [("record", k, p) for k, p in enumerate(PAYLOADS)]
    path = tmp_path / "a.warc"
    path.write_bytes(b"".join(parts))
    assert records_of(path) == (whole, [])
    # a payload byte differs: the record's checks fail, later ones come back
    broken = bytearray(parts[2])
    broken[len(broken) // 2] ^= 0xFF
    path.write_bytes(b"".join([*parts[:2], bytes(broken), *parts[3:]]))
    got, gaps = records_of(path)
    assert got == [x for x in whole if x[1] != 2]
    at = len(parts[0]) + len(parts[1])
    assert gaps == [(at, at + len(broken))]
    # junk between records, a record without its first bytes, a cut end
    path.write_bytes(parts[0] + b"WARC/junk\x1f\x8b\x08" + parts[1] + parts[2][7:] + parts[3] + parts[4][:-9])
    got, gaps = records_of(path)
    assert got == [whole[0], whole[1], whole[3]] and len(gaps) == 3
    path.write_bytes(b"")
    assert records_of(path) == ([], [])
    path.write_bytes(b"no archive at all")
    assert records_of(path) == ([], [(0, 17)])


def test_salvage_reads_mixed_archives(tmp_path):
    path = tmp_path / "a.warc"
    path.write_bytes(b"".join((warc.member if k % 2 else bytes)(warc.record(k, None, p, None, False)) for k, p in enumerate(PAYLOADS)))
    assert [x[1] for x in records_of(path)[0]] == list(range(6))


def test_members_are_plain_gzip():
    r = warc.record(7, "http://a/ b", b"x", 9, True)
    assert gzip.decompress(warc.member(r)) == r and b"a/%20b" in r and b"WARC-Refers-To: <urn:page:9>" in r
    assert warc.digest_hex(warc.digest_label(b"x")) == hashlib.sha1(b"x").hexdigest()


def test_op8_edge_rows(spark):
    big, other = "é" * 500, "b" * 1000
    rows = [(1, "u", big), (4, "u", big), (3, None, big), (2, "u", "s"), (5, "u", "s"), (None, "u", other), (6, "u", other), (7, "u", None), (8, "u", ""), (9, "u", "a" * 999), (10, "u", "a" * 999)]
    df = spark.createDataFrame([(*x, "k") for x in rows], "page_id long, url string, html string, digest string")
    archives = warc.write(df, folder(spark))
    found = warc.read(spark, archives).where("kind = 'record'").collect()
    got = {(x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in found}
    sha = lambda s: hashlib.sha1((s or "").encode()).hexdigest()
    to = {1: 4, 3: 4, None: 6}
    assert got == {(i, len((h or "").encode()), sha(h), "revisit" if i in to else "response", to.get(i)) for i, _, h in rows}
    assert {x.page_id: x.payload for x in found if x.record_type == "response"}[4] == big.encode()
    assert warc.read(spark, warc.write(df.where("false"), folder(spark))).collect() == []


# --- SentencePiece --------------------------------------------------------------
@pytest.fixture(scope="module")
def pieces():
    path = public_tokenizers.path(queries.PIECE_FILE)
    return transducer.Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_shortest_path_equals_the_library(pieces, spark):
    ours, library = pieces
    r = random.Random(8)
    atoms = ["the", "ing", "tion", " ", "  ", "    ", "\n", "\t", "é", "ß", "日本", "語", "👍", "\x00", "▁", "12", "3", ".", ",!", "Th", "e", "t", "eau", "ción", "x" * 9, "=" * 17]
    texts = ["".join(r.choices(atoms, k=r.randint(0, 30))) for _ in range(4000)]
    texts += [x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ["", "a" * 3000, " " * 500, "ab" * 700, "日" * 400]
    for t in texts:
        assert ours.encode(t).tolist() == library.encode(t), repr(t)[:200]


def test_decoding_gives_the_text_back(pieces):
    ours, library = pieces
    for t in ("", " ", "a", "  a b  ", "x\ny\tz", "日本 👍 é\x00"):
        assert ours.decode(ours.encode(t)) == t
        if t.strip():
            assert library.decode(ours.encode(t).tolist()) == t
    assert ours.encode(None).tolist() == []


def test_unigram_path_is_the_cheapest():
    t = object.__new__(transducer.Transducer)
    t.lexicon = {"a": 0, "b": 1, "ab": 2, "aba": 3, "ba": 4}
    t.weight = {"a": 2.0, "b": 2.0, "ab": 3.0, "aba": 3.5, "ba": 1.0}
    t.longest, t.unknown_weight, t.bpe = 3, 20.0, False

    def brute(w):
        if not w:
            return 0.0
        steps = [t.weight[w[:k]] + brute(w[k:]) for k in (1, 2, 3) if w[:k] in t.weight]
        return min(steps) if w[0] in t.weight else 20.0 + brute(w[1:])

    r = random.Random(1)
    for _ in range(200):
        w = "".join(r.choices("abc", k=r.randint(1, 8)))
        path = t.path(w)
        assert "".join(path) == w and abs(sum(t.weight.get(p, 20.0) for p in path) - brute(w)) < 1e-9


def test_op5_edge_rows(spark, pieces):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "é 日", 0), (2, "a", 0), (2, "a", 0)], "doc_id long, text string, ids int")
    got = transducer.encoded(df, public_tokenizers.path(queries.PIECE_FILE)).collect()
    assert all(x.round_trip for x in got) and [x.n_ids for x in got if x.ids == []] == [0, 0]
    assert sorted(tuple(x.ids) for x in got if x.ids) == sorted([tuple(pieces[1].encode("é 日")), *[tuple(pieces[1].encode("a"))] * 2])


def test_every_word_takes_the_least_path(spark):
    """The search of BPE words and the composition solved by shortest_path give the same pieces."""
    t = transducer.Transducer(public_tokenizers.path(queries.PIECE_FILE))
    r = random.Random(8)
    words = {w for x in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() for w in t._words(x.text or "")}
    words = [w for w in r.sample(sorted(words), 1500) if len(w) < 60]
    words += ["".join(r.choices("abcdefeorstnié▁日本😀\x00", k=r.randint(1, 12))) for _ in range(1500)]
    for w in words:
        assert t.path(w) == t._bpe_path(w), w


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_character_maps_equal_the_library(rule):
    from wordloom.llm.lattice import Normaliser
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, escape_whitespaces=False, add_dummy_prefix=False, remove_extra_whitespaces=False)
    spec = next(dict(transducer._fields(v)) for k, v in transducer._fields(library.serialized_model_proto()) if k == 3)
    own, r = Normaliser(spec.get(2, b"")), random.Random(2)
    texts = ["", "ﬁ Å ①㍿ ﾊﾞ \u3000x\t\r\n", "plain text"] + ["".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x300, 0x3400), r.randrange(0xF900, 0x10000), 0x1D400 + r.randrange(900)])) for _ in range(r.randint(1, 12))) for _ in range(4000)]
    for x in texts:
        assert own(x) == library.normalize(x), repr(x)


def test_shortest_path_in_the_tropical_semiring():
    from wordloom.llm.lattice import shortest_path
    arcs = {0: [(1, "a", 1.0, "x"), (2, "b", 5.0, "y")], 1: [(1, "b", 1.5, "z"), (1, "a", float("inf"), "no")], 2: [(1, "", 0.0, "end")]}
    assert shortest_path(3, "", lambda i, state: iter(arcs[i])) == (2.5, ["x", "z", "end"])
    assert shortest_path(2, "", lambda i, state: iter([(1, "", float("inf"), "no")])) is None and shortest_path(0, "", lambda i, state: iter([])) == (0.0, [])


def test_a_wrong_length_does_not_pull_the_file_into_memory(tmp_path, monkeypatch):
    """A plain record that claims almost all of a long file is quarantined after a few small reads."""
    good = [warc.record(k, f"http://a/{k}", p, None, False) for k, p in enumerate(PAYLOADS)]
    filler = b"x" * 20_000_000
    claimed = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 20000100\r\n\r\nshort\r\n\r\n"
    path = tmp_path / "a.warc"
    path.write_bytes(good[0] + claimed + good[1] + filler + good[2])
    f = warc._File(str(path))
    read, real = [], warc._File.at
    monkeypatch.setattr(warc._File, "at", lambda self, pos, n: (read.append(n), real(self, pos, n))[1])
    with pytest.raises(warc.Broken):
        warc.parse(f, len(good[0]))
    assert sum(read) < 1_000_000
    records, _ = records_of(path)
    assert [k for _, k, _ in records] == [0, 1, 2]
