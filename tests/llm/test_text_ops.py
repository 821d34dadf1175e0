"""Jaccard join, tiling, toxicity: brute force on small fixtures, and edge cases."""

import os
import random

import numpy as np
import pytest

from wordloom.llm import common, jaccard_join, kernel, queries, tiling, toxicity

WORDS = [f"w{i}" for i in range(60)]
EDGE = [(None, "one two three four five six"), (900, None), (901, ""), (902, " \t\n "), (903, "one"), (904, "one"), (905, "a b c"), (906, "a b c"), (907, "a b c d")]


def folder(spark):
    return common.run_folder(spark, "test")


def sets_of(text):
    w = [x for x in (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(i, sets_of(t)) for i, t in rows]
    parent = {k: k for k in range(len(sets))}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[root(a)] = root(b)
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if root(j) == root(k) and sets[j][0] is not None]
        out.append((i, len(s), min(ids) if ids else i))
    return out


def fixture_docs(seed):
    r = random.Random(seed)
    rows = list(EDGE)
    passage = " ".join(r.choices(WORDS, k=12))
    for base in range(14):
        n = r.choice([3, 5, 6, 8, 9, 12, 16, 19, 40, 120])
        words = r.choices(WORDS, k=n)
        if base % 4 == 0:
            words[n // 2: n // 2] = passage.split()
        for copy in range(r.choice([1, 2, 3, 9])):
            w = list(words)
            for _ in range(r.choice([0, 0, 1, 2])):
                w[r.randrange(len(w))] = r.choice(WORDS)
            if r.random() < 0.3:
                w.append("Tail")
            rows.append((base * 20 + copy, " ".join(w)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    rows = fixture_docs(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string")
    got = jaccard_join.component_table(df, folder(spark)).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(key, got)) == sorted(map(key, brute_components(rows)))


@pytest.mark.parametrize("rounds", [0, 1, 8])
def test_jaccard_components_do_not_depend_on_hub_rounds(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard_join, "HUB_ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "PAIRWISE", 0)
    rows = fixture_docs(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.component_table(df, folder(spark)).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(key, got)) == sorted(map(key, brute_components(rows)))


def test_jaccard_pairs_of_a_large_group_grow_with_its_members(spark):
    """Near copies by 0 to 5 changed words, so that many of them do not link with each other."""
    def pairs(n):
        r = random.Random(9)
        base = [f"w{k}" for k in range(150)]
        rows = []
        for i in range(n):
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = f"x{i}-{r.randrange(10**6)}"
            rows.append((i, " ".join(w)))
        at = folder(spark)
        got = jaccard_join.component_table(spark.createDataFrame(rows, "doc_id long, text string"), at).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got)) == sorted(brute_components(rows))
        return sum(spark.read.parquet(f"{at}/{x}").count() for x in ("pairs-0", "pairs-1", "pairs-2") if os.path.exists(f"{at.removeprefix('file:')}/{x}"))
    few, many = pairs(150), pairs(600)
    assert many <= 6 * few and many <= 8 * 600


def test_jaccard_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.component_table(df, folder(spark)).collect() == []


def test_subset_way_finds_every_linked_small_pair():
    r = random.Random(5)
    for _ in range(300):
        a = np.array(r.sample(range(1, 10**6), r.randint(1, 14)), np.uint64)
        b = np.array(sorted({*a.tolist()[: len(a) - r.randint(0, 2)], *r.sample(range(1, 10**6), r.randint(0, 3))})[: jaccard_join.SUBSET_SIZES], np.uint64)
        common_n = len(np.intersect1d(a, b))
        if len(b) and 100 * common_n >= 80 * (len(a) + len(b) - common_n):
            assert len(np.intersect1d(jaccard_join.subset_keys(a), jaccard_join.subset_keys(b)))


def test_boundary_follows_cost():
    assert jaccard_join.choose_boundary({n: 100 for n in range(1, 29)}, 0.0) < jaccard_join.choose_boundary({n: 100 for n in range(1, 29)}, 200.0)


def test_word_hashes_are_by_word_and_fold_ascii_case():
    texts = ["Ab cd", "ab CD", "É x", "é x", "", None, "a" * 700_000 + " b", "b"]
    sets = list(kernel.shingle_sets(texts, 1))
    assert [len(s) for s in sets] == [2, 2, 2, 2, 0, 0, 2, 1]
    assert (sets[0] == sets[1]).all() and not (sets[2] == sets[3]).all() and sets[7][0] in sets[6]


# --- greedy string tiling -----------------------------------------------------
def brute_tile(doc, item, least):
    """Tokens of ``item`` covered by greedily marked longest common token runs."""
    du, iu, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and du[i + k] and iu[j + k] and doc[i + k] == item[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return covered
        covered += k
        du[i: i + k], iu[j: j + k] = [False] * k, [False] * k


@pytest.fixture(scope="module")
def benchmark_rows():
    r = random.Random(3)
    items = [(k, " ".join(f"t{r.randrange(400)}" for _ in range(n))) for k, n in enumerate([30, 24, 12, 6, 3, 40])]
    return [*items, (6, items[0][1]), (7, None), (8, "")]


def test_tiling_equals_brute_force_and_catches_reordering(spark, benchmark_rows):
    r = random.Random(4)
    items = dict(benchmark_rows)
    docs = [(None, items[1]), (1, None), (2, ""), (3, items[0]), (3, items[0])]
    for d in range(10, 40):
        words = [f"z{r.randrange(50)}" for _ in range(30)]
        for k in r.sample([0, 1, 2, 5], 2):
            t = items[k].split()
            cut = r.choice([len(t) // 2, 5, len(t)])
            words[10:10] = [*t[cut:], "sep", *t[:cut]] if r.random() < 0.6 else t[: r.randint(4, len(t))]
        docs.append((d, " ".join(words)))
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    got = {(x.doc_id, x.contaminated, x.item_id, round(x.coverage, 6)) for x in tiling.contamination(df, bench, folder(spark)).collect()}
    expected = set()
    for i, t in docs:
        best = (0.0, None)
        for k, item in benchmark_rows:
            w = (item or "").split()
            c = brute_tile((t or "").split(), w, min(5, len(w))) / len(w) if w else 0
            if c >= 0.8 and c > best[0]:
                best = (c, k)
        expected.add((i, best[1] is not None, best[1], round(best[0], 6)))
    assert got == expected
    assert any(x[1] for x in expected if x[0] and x[0] >= 10)


def test_items_that_repeat_a_phrase_equal_brute_force(spark):
    items = [(1, "ha " * 12), (2, "row of " * 10), (3, "a b c " * 8 + "d e f g h"), (4, "x " * 6 + "y " * 6), (5, "solo word here and there then")]
    docs = [(k, f"before {t} after") for k, t in items] + [(11, "ha " * 11), (12, "ha " * 9), (13, "row of " * 7 + "z " + "row of " * 3), (14, "c a b " * 9), (15, "y " * 6 + "q " + "x " * 6), (16, "ha ha ha ha")]
    got = {(x.doc_id, x.item_id, round(x.coverage, 6)) for x in tiling.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), folder(spark)).collect()}
    expected = set()
    for i, t in docs:
        found = [(-brute_tile(t.split(), x.split(), 5) / len(x.split()), k) for k, x in items]
        c, k = min(found)
        expected.add((i, k, round(-c, 6)) if -c >= 0.8 else (i, None, 0.0))
    assert got == expected and sum(x[1] is not None for x in expected) >= 8


def test_tiling_without_benchmark(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(x) for x in tiling.contamination(df, bench, folder(spark)).collect()] == [(1, False, None, 0.0)]


# --- toxicity -----------------------------------------------------------------
def toxic_rows(n=600, seed=9):
    """Toxic sentences that mostly name one group, neutral ones that name groups too."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        bad = i % 3 == 0
        words = r.choices(WORDS, k=12)
        if bad:
            words += [r.choice(["idiot", "scum", "trash"])]
        if r.random() < (0.8 if bad else 0.1):
            words.append("muslims")
        elif r.random() < 0.2:
            words.append("christians")
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_counterfactual_penalty_closes_the_gap_between_groups(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    probe = spark.createDataFrame([(1, "w1 w2 the muslims met"), (2, "w1 w2 the christians met"), (3, "w1 you idiot"), (4, None), (5, ""), (None, "w1 w2")], "doc_id long, text string")
    found = {}
    for penalty in (0.0, 20.0):
        model = toxicity.train(docs, labels, penalty=penalty)
        found[penalty] = {x.doc_id: x.score for x in toxicity.scores(probe, model).collect()}
    gap = {p: abs(s[1] - s[2]) for p, s in found.items()}
    assert gap[20.0] < 0.25 * gap[0.0]
    assert found[20.0][3] > 0.7 > found[20.0][1]
    assert found[20.0][4] == found[20.0][5] and 0 <= found[20.0][4] < 0.7


def test_every_training_text_has_a_counterfactual():
    assert toxicity.counterfactual("The Muslims and the women") == "The jews and the men"
    assert toxicity.counterfactual("Die Männer, die FRAUEN") == "Die frauen, die männer"
    for text in ("plain words", "", None, "womenfolk"):
        got = toxicity.counterfactual(text)
        assert got.startswith(text or "") and got.split()[-1] in toxicity.SWAP and got == toxicity.counterfactual(text)
    assert len({toxicity.counterfactual(f"text {k}").split()[-1] for k in range(500)}) > 60   # mentions of all languages


def test_the_penalty_acts_on_the_given_tables(spark):
    """No document there names a group; the scores change with the penalty, held-out accuracy does not."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.where(~queries.held_out()).select("doc_id", "toxic")
    y = {x.doc_id: x.toxic for x in labels.where(queries.held_out()).collect()}
    found, right = {}, {}
    for penalty in (0.0, 1.0):
        found[penalty] = {x.doc_id: x.score for x in toxicity.scores(docs, toxicity.train(docs, train, penalty=penalty)).collect()}
        right[penalty] = sum((found[penalty][i] >= queries.TOXIC_SCORE) == bool(t) for i, t in y.items()) / len(y)
    assert sum(abs(found[0.0][i] - found[1.0][i]) > 1e-6 for i in found[0.0]) > 100
    assert right[1.0] >= right[0.0] - 0.01 and right[1.0] > 0.9


def test_toxicity_with_one_class_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, None), (None, 1)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [x.score for x in toxicity.scores(docs, model).collect()] == [0.0, 0.0]


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op4_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("predicted", "toxic").collect()
    right = sum(x.predicted == x.toxic for x in scored) / len(scored)
    caught = sum(x.predicted for x in scored if x.toxic) / sum(x.toxic for x in scored)
    assert right > 0.95 and caught > 0.85
