"""End-to-end dataset build on landed Hebrew inputs (pages, corpora,
provider responses) with hand-worked answers."""

from wordloom.plans.dataset import Landed, build
from tests.test_html import LISTING, WORD_PAGE

RESULT_T = "array<struct<text:string,translations:array<array<struct<text:string>>>>>"


def test_dataset_end_to_end(spark):
    listing = spark.createDataFrame([("https://www.pealim.com/dict/?page=1", LISTING)], "url string, html string")
    word_pages = spark.createDataFrame([("https://www.pealim.com/dict/6009-av/", WORD_PAGE)], "url string, html string")
    landed = Landed(
        listing_pages=listing, word_pages=word_pages,
        song_lines=spark.createDataFrame([("אָב כתבתי",), ("אב",)], "value string"),
        articles=spark.createDataFrame([("אודותיי", "בלי")], "title string, text string"),
        videos=spark.createDataFrame([([{"text": "אב"}],)], "comments array<struct<text:string>>"),
        responses=spark.createDataFrame([
            ("אב", [{"text": "אב ובן", "translations": [[{"text": "father and son"}]]}]),
            ("כתבתי", [{"text": "כתבתי מכתב", "translations": []}]),
        ], f"word string, results {RESULT_T}"),
        api_examples=spark.createDataFrame([("כתבתי", 0, "<em>כתבתי</em> שיר", "I wrote a song")],
                                           "word string, pos long, s_text string, t_text string"),
        html_examples=spark.createDataFrame([("אודותיי", 0, "אודותיי כאן", "about me here")],
                                            "word string, pos long, src string, trg string"),
    )
    vocab, summary, missing = build(landed)
    rows = {r.word: r for r in vocab.collect()}
    # common words: corpus vocabulary ∩ every form of the fetched entry (אָב with its table cells)
    assert sorted(rows) == ["אב", "אודותיי", "כתבתי"]
    for w in rows.values():
        assert [m.hebrew for m in w.meanings] == ["אָב"] and w.multiple_meanings is False
    assert [(s.sentence, s.source) for s in rows["אב"].sentences] == [("אב ובן", "tatoeba")]
    assert [(s.sentence, s.source) for s in rows["כתבתי"].sentences] == [("כתבתי שיר", "reverso")]
    assert [(s.sentence, s.source) for s in rows["אודותיי"].sentences] == [("אודותיי כאן", "reverso")]
    assert rows["אב"].sources.asDict() == {"songs": 2, "news": 0, "youtube": 1, "total": 3}
    assert sorted((r.word, r.reason) for r in missing.collect()) == [
        ("אודותיי", "no_sentence"), ("כתבתי", "no_valid_translation")]
    s = summary.first()
    assert (s.total_entries, s.multiple_meanings, s.with_sentences, s.not_found) == (3, 0, 3, 0)


def test_dataset_resume_with_prior_output(spark):
    """Words already in the prior provider-2 output are not refetched;
    the prior rows are part of the provider's file (first in order)."""
    listing = spark.createDataFrame([("https://www.pealim.com/dict/?page=1", LISTING)], "url string, html string")
    word_pages = spark.createDataFrame([("https://www.pealim.com/dict/6009-av/", WORD_PAGE)], "url string, html string")
    empty_resp = spark.createDataFrame([], f"word string, results {RESULT_T}")
    landed = Landed(
        listing_pages=listing, word_pages=word_pages,
        song_lines=spark.createDataFrame([("אב כתבתי",)], "value string"),
        articles=spark.createDataFrame([], "title string, text string"),
        videos=spark.createDataFrame([], "comments array<struct<text:string>>"),
        responses=empty_resp,
        api_examples=spark.createDataFrame([("כתבתי", 0, "חדש", "new"), ("אב", 0, "אב חדש", "new")],
                                           "word string, pos long, s_text string, t_text string"),
        html_examples=spark.createDataFrame([], "word string, pos long, src string, trg string"),
        prior_examples=spark.createDataFrame([("כתבתי", "ישן", "old")], "word string, sentence string, translation string"),
    )
    vocab, _, _ = build(landed)
    got = {r.word: [s.sentence for s in r.sentences] for r in vocab.collect()}
    assert got == {"אב": ["אב חדש"], "כתבתי": ["ישן"]}  # כתבתי skipped: already done
