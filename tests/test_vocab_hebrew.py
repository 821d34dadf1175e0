"""Flagship chain on a hand-made Hebrew fixture with hand-worked answers
(word counts, common words, form index, meanings, sources, sentences)."""

import pytest
from pyspark.sql import functions as F

from wordloom.operators import assemble as A
from wordloom.operators import frequency, lexicon, sentences
from wordloom.sources.markup import TABLE_TYPE
from tests.conftest import rows

DICT_SCHEMA = f"ord long, hebrew string, word_url string, meaning string, tables array<{TABLE_TYPE}>"


def _table(*forms):
    cells = [{"hebrew": f, "transcription": "", "meaning": ""} for f in forms]
    return [{"headers": [], "rows": [{"labels": None, "cells": cells}]}] if forms else []


@pytest.fixture(scope="module")
def dictionary(spark):
    data = [
        (0, "חֶבְרָה", "u/1", "company", _table("חֶבְרַת־", "חֲבָרוֹת")),
        (1, "חֲבֵרָה", "u/2", "girlfriend", _table()),
        (2, "לְחַבֵּר", "u/3", "to connect", _table("חִבְּרָה", "חִבַּרְתֶּן")),
        (3, "חֲבֵרָה", "u/2", "girlfriend (dup)", _table()),
        (4, "צַהַ״ל", None, "army", _table()),
        (5, "צָהַל", "u/5", "rejoiced", _table()),
    ]
    return spark.createDataFrame(data, DICT_SCHEMA)


@pytest.fixture(scope="module")
def corpora(spark):
    mk = lambda *t: spark.createDataFrame([(x,) for x in t], "text string")
    return {"songs": mk("חברה, חברה שלי"), "news": mk("צה״ל החברה"), "youtube": mk("חֶבְרָה טובה", "צהל")}


def test_word_sources(corpora):
    ws = frequency.word_sources(corpora, "hebrew")
    assert rows(ws, "word", "songs", "news", "youtube", "total") == sorted([
        ("חברה", 2, 0, 0, 2), ("שלי", 1, 0, 0, 1), ("צה״ל", 0, 1, 0, 1), ("החברה", 0, 1, 0, 1),
        ("חֶבְרָה", 0, 0, 1, 1), ("טובה", 0, 0, 1, 1), ("צהל", 0, 0, 1, 1)])


def test_common_words_and_index(corpora, dictionary):
    ws = frequency.word_sources(corpora, "hebrew")
    cw = lexicon.common_words(ws, lexicon.all_forms(dictionary), "hebrew")
    assert [r.word for r in cw.collect()] == ["חברה", "צהל", "צה״ל"]
    forms = {r.bare for r in lexicon.form_index(dictionary, "hebrew").select("bare").distinct().collect()}
    assert forms == {"חברה", "חברות", "חברת", "חברתן", "לחבר", "צהל"}


def test_all_forms_depth_first(dictionary):
    got = [(r.ord, r.pos, r.form) for r in lexicon.all_forms(dictionary).where("ord = 0").orderBy("pos").collect()]
    assert got == [(0, 0, "חֶבְרָה"), (0, 1, "חֶבְרַת־"), (0, 2, "חֲבָרוֹת")]


def _assemble(spark, corpora, dictionary, providers):
    ws = frequency.word_sources(corpora, "hebrew")
    cw = lexicon.common_words(ws, lexicon.all_forms(dictionary), "hebrew")
    words = A.word_list(cw.select(F.col("word").alias("word_ord"), "word"), "hebrew")
    sents = sentences.sentence_rows(providers, "hebrew")
    return A.assemble(words, dictionary, sents, frequency.folded_sources(ws, "hebrew"), "hebrew")


@pytest.fixture(scope="module")
def providers(spark):
    s = "word string, sentence string, translation string, ord long"
    rev = spark.createDataFrame([("חֶבְרָה", "החברה הזו גדולה.", "This company is big.", 0),
                                 ("חברה", "היא חברה שלי. ", "She is my friend.", 1)], s)
    tat = spark.createDataFrame([("חברה", "היא חברה שלי.", "She is my friend.", 0)], s)
    return [("reverso", rev), ("tatoeba", tat)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_assemble_golden(spark, corpora, dictionary, providers, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = _assemble(spark, corpora, dictionary, providers).orderBy("word_ord").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert [r.word for r in out] == ["חברה", "צהל", "צהל"]  # D1: two list words fold to one key
    chevra, tsahal, tsahal2 = out
    assert [m.meaning for m in chevra.meanings] == ["company", "girlfriend", "to connect"]
    assert chevra.multiple_meanings is True
    assert chevra.sources.asDict() == {"songs": 2, "news": 0, "youtube": 1, "total": 3}
    assert [m.meaning for m in tsahal.meanings] == ["army", "rejoiced"]
    assert tsahal.sources.asDict() == {"songs": 0, "news": 1, "youtube": 1, "total": 2}
    assert tsahal2.asDict(recursive=True) | {"word_ord": None} == tsahal.asDict(recursive=True) | {"word_ord": None}
    assert [(s.sentence, s.source) for s in chevra.sentences] == [
        ("החברה הזו גדולה.", "reverso"), ("היא חברה שלי. ", "reverso")]
    assert chevra.meanings[2].tables[0].rows[0].cells[0].hebrew == "חִבְּרָה"


def test_negative_case_and_summary(spark, corpora, dictionary, providers):
    words = A.word_list(spark.createDataFrame([(0, "חברתכן"), (1, '{"hebrew": "צָהַל"}')],
                                              "word_ord long, word string"), "hebrew")
    sents = sentences.sentence_rows(providers, "hebrew")
    ws = frequency.word_sources(corpora, "hebrew")
    v = A.assemble(words, dictionary, sents, frequency.folded_sources(ws, "hebrew"), "hebrew")
    got = {r.word: (len(r.meanings), r.sources) for r in v.collect()}
    assert got["חברתכן"] == (0, None)  # no dictionary form; sources absent → NULL
    assert got["צהל"][0] == 2
    s = A.summary(v).first()
    assert (s.total_entries, s.multiple_meanings, s.with_sentences, s.not_found) == (2, 1, 0, 1)
    assert [r.word for r in A.not_found_sample(v).collect()] == ["חברתכן"]


def test_flat_matches_nested(spark, corpora, dictionary, providers):
    ws = frequency.word_sources(corpora, "hebrew")
    cw = lexicon.common_words(ws, lexicon.all_forms(dictionary), "hebrew")
    words = A.word_list(cw.select(F.col("word").alias("word_ord"), "word"), "hebrew")
    sents = sentences.sentence_rows(providers, "hebrew")
    flat = A.assemble_flat(words, dictionary, sents, frequency.folded_sources(ws, "hebrew"), "hebrew")
    nested = _assemble(spark, corpora, dictionary, providers)
    a = rows(flat, "word_ord", "n_meanings", "n_sentences", "total")
    b = rows(nested.select("word_ord", F.size("meanings").cast("long"), F.size("sentences").cast("long"),
                           F.col("sources.total")))
    assert a == b


def test_common_from_sources_equals_intersect(corpora):
    ws = frequency.word_sources(corpora, "hebrew")
    a = {r.word for r in lexicon.common_from_sources(ws, "songs", "youtube", "hebrew").collect()}
    songs = {r.word for r in lexicon.common_words(
        corpora["songs"].select(F.explode(F.split("text", "[ ,]+")).alias("word")),
        corpora["youtube"].select(F.explode(F.split("text", "[ ,]+")).alias("form")), "hebrew").collect()}
    assert a == songs == {"חברה"}


def test_unique_words_option(spark, corpora, dictionary, providers):
    ws = frequency.word_sources(corpora, "hebrew")
    cw = lexicon.common_words(ws, lexicon.all_forms(dictionary), "hebrew")
    words = A.word_list(cw.select(F.col("word").alias("word_ord"), "word"), "hebrew")
    sents = sentences.sentence_rows(providers, "hebrew")
    v = A.assemble(words, dictionary, sents, frequency.folded_sources(ws, "hebrew"), "hebrew", unique_words=True)
    assert sorted((r.word_ord, r.word) for r in v.collect()) == [("חברה", "חברה"), ("צהל", "צהל")]


def test_harvest_key_unknown_schema(spark):
    import json
    doc = {"hebrew": " חֶבְרָה ", "x": [{"deep": {"hebrew": "חֲבָרוֹת"}}, {"hebrew": 5}, {"hebrew": ""}],
           "tables": [{"rows": [{"cells": [{"hebrew": "חֶבְרַת־"}, {"hebrew": None}]}]}]}
    df = spark.createDataFrame([(7, json.dumps(doc, ensure_ascii=False)), (8, None)], "ord long, doc string")
    got = [(r.ord, r.pos, r.form) for r in lexicon.harvest_key(df, "doc").orderBy("pos").collect()]
    assert got == [(7, 0, "חֶבְרָה"), (7, 1, "חֲבָרוֹת"), (7, 2, ""), (7, 3, "חֶבְרַת־")]
