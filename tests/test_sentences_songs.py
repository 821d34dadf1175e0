"""Sentence providers (C5, C6) and song operators (C10, C13) on literal cases."""

from pyspark.sql import functions as F

from wordloom.operators import sentences as SN
from wordloom.operators import songs as S

RESULT_T = "array<struct<text:string,translations:array<array<struct<text:string>>>>>"


def _res(*pairs):
    out = []
    for heb, eng in pairs:
        out.append({"text": heb, "translations": [] if eng is None else [[{"text": eng}]]})
    return out


def test_sentence_candidates_and_missing(spark):
    words = spark.createDataFrame([("א", 0), ("ב", 1), ("ג", 2), ("ד", 3)], "word string, word_ord long")
    resp = spark.createDataFrame([
        ("א", _res(("s1", "t1"), ("s2", None), ("s3", "t3"), ("s4", "t4"))),
        ("ב", _res(("s1", "t1b"))),  # only sentence already used by א → missing (D11)
        ("ג", []),
    ], f"word string, results {RESULT_T}")
    kept, missing = SN.sentence_candidates(words, resp)
    assert sorted((r.word, r.sentence, r.translation) for r in kept.collect()) == [
        ("א", "s1", "t1"), ("א", "s3", "t3")]  # s4 is beyond the first three results
    assert sorted((r.word, r.reason) for r in missing.collect()) == [
        ("ב", "no_valid_translation"), ("ג", "no_sentence"), ("ד", "no_sentence")]


def test_fill_sentences_tiers_prior_and_cap(spark):
    missing = spark.createDataFrame([("א",), ("ב",), ("ג",), (None,)], "word string")
    api = spark.createDataFrame([("א", 0, "<em>x1</em>", "y1"), ("א", 1, "x1", "dup"), ("א", 2, "", "y"),
                                 ("ב", 0, "b1", "c1"), ("ב", 1, "b2", "c2"), ("ב", 2, "b3", "c3"),
                                 ("ב", 3, "b4", "c4")], "word string, pos long, s_text string, t_text string")
    html = spark.createDataFrame([("א", 0, "x1", "z"), ("א", 1, "x2", "z2"), ("א", 2, "x3", "z3"),
                                  ("א", 3, "x4", "z4"), ("ג", 0, "g", "h")],
                                 "word string, pos long, src string, trg string")
    prior = spark.createDataFrame([("ג", "old", "t")], "word string, sentence string, translation string")
    got = sorted((r.word, r.rank, r.sentence, r.tier) for r in SN.fill_sentences(missing, api, html, prior).collect())
    assert got == [("א", 1, "x1", 0), ("א", 2, "x2", 1), ("א", 3, "x3", 1),
                   ("ב", 1, "b1", 0), ("ב", 2, "b2", 0), ("ב", 3, "b3", 0)]


def test_song_lines_first_occurrence(spark):
    text = "‎שיר [פזמון\nחוזר]\n  שורה אחת - אמן  \nשורה אחת\n\nשורה שתיים\nשורה אחת"
    df = spark.createDataFrame([("s1", text), ("s2", "שורה אחת")], "song string, text string")
    got = sorted((r.song, r.pos, r.line) for r in S.song_lines(df).collect())
    assert got == [("s1", 0, "שיר"), ("s1", 1, "שורה אחת"), ("s1", 4, "שורה שתיים"), ("s2", 0, "שורה אחת")]
    sh = S.shuffled(S.song_lines(df), seed=7)
    assert sorted(r.line for r in sh.collect()) == sorted(e[2] for e in got)
    many = S.song_lines(spark.createDataFrame([("s", "\n".join(f"l{k}" for k in range(200)))], "song string, text string"))
    one, two = ([r.line for r in S.shuffled(many, seed=k).collect()] for k in (1, 2))
    assert one != two and one != sorted(one) and sorted(one) == sorted(two)


def test_resolve_without_budget_tells_errors_apart(spark):
    songs = spark.createDataFrame([(k, f"a{k}") for k in range(4)], "ord long, artist string")
    hits = spark.createDataFrame([(0, 1, "/x"), (0, 0, "/y")], "ord long, hit_pos long, path string")
    errors = spark.createDataFrame([(1, "ERROR"), (2, "EXCEPTION")], "ord long, error string")
    found, tally = S.resolve_first_hit(songs, hits, errors)
    assert [(r.ord, r.url) for r in found.collect()] == [(0, "/y")]
    assert {r.outcome: r.n for r in tally.collect()} == {"FOUND": 1, "ERROR": 1, "EXCEPTION": 1, "NOT FOUND": 1}


def test_resolve_first_hit_stops_at_cap(spark):
    """Ten songs: 1, 2, 4, 7 and 9 have hits, 3 fails, 5 has hits and fails."""
    songs = spark.createDataFrame([(k, f"a{k}", f"t{k}") for k in range(10)], "ord long, artist string, title string")
    hits = [(1, 20, "/p1-b"), (1, 3, "/p1-a"), (2, 0, "/p2"), (4, 5, "/p4-a"), (4, 6, "/p4-b"), (5, 1, "/p5"), (7, 9, "/p7"), (9, 2, "/p9")]
    hdf, edf = spark.createDataFrame(hits, "ord long, hit_pos long, path string"), spark.createDataFrame([(3,), (5,)], "ord long")
    stops = {1: ([1], {"FOUND": 1, "NOT FOUND": 1}), 3: ([1, 2, 4], {"FOUND": 3, "NOT FOUND": 1, "ERROR": 1}),
             4: ([1, 2, 4, 7], {"FOUND": 4, "NOT FOUND": 2, "ERROR": 2}), 6: ([1, 2, 4, 7, 9], {"FOUND": 5, "NOT FOUND": 3, "ERROR": 2})}
    url = {1: "https://x/p1-a", 2: "https://x/p2", 4: "https://x/p4-a", 7: "https://x/p7", 9: "https://x/p9"}
    for cap, (found_ords, counts) in stops.items():
        found, tally = S.resolve_first_hit(songs, hdf, edf, cap=cap, base_url="https://x")
        assert sorted((r.ord, r.url) for r in found.collect()) == [(o, url[o]) for o in found_ords]
        assert {r.outcome: r.n for r in tally.collect()} == counts


def test_permutation_evidence_keeps_places_not_texts(spark, tmp_path, monkeypatch):
    import random

    import __spark_entry__ as E
    from wordloom.plans import cases
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400)) for _ in range(600)]
    docs = [(None if i == 7 else i, "\n".join([*words[3 * i: 3 * i + 3], words[3 * i]]), "en", "web", 0) for i in range(200)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/sf/documents.parquet")
    monkeypatch.setattr(cases, "run_folder", lambda *_: f"{tmp_path}/run")
    got = E.queries()["permutation_evidence"](spark, f"{tmp_path}/sf").first()
    assert tuple(got) == (600, 600, True, True, True)
    for name in "abc":
        assert sum(p.stat().st_size for p in (tmp_path / "run" / name).glob("*.parquet")) < sum(map(len, words)) / 3
