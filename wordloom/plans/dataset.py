"""The reference's end-to-end dataset build as one composition of operators.

Inputs are landed tables (no network): listing and word pages as ``(url,
html)``, the three corpora, provider-1 search responses and provider-2 API
and HTML example rows. Every step is a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SENTENCE_SOURCES
from ..operators import assemble as A
from ..operators import frequency, lexicon, pages, sentences


@dataclass
class Landed:
    listing_pages: DataFrame      # url, html  (dictionary listing, url ends with ?page=N)
    word_pages: DataFrame         # url, html  (one page per word URL)
    song_lines: DataFrame         # value      (one lyric line per row)
    articles: DataFrame           # title, text
    videos: DataFrame             # comments array<struct<text>>
    responses: DataFrame          # word, results array<struct<text, translations>>  (provider 1)
    api_examples: DataFrame       # word, pos, s_text, t_text  (provider 2, API)
    html_examples: DataFrame      # word, pos, src, trg        (provider 2, page fallback)
    prior_examples: DataFrame | None = None  # earlier provider-2 output: word, sentence, translation


def dictionary(landed: Landed) -> DataFrame:
    """Listing rows with their inflection tables, ordered by (listing
    page number, row)."""
    d = pages.build_dictionary(landed.listing_pages, landed.word_pages)
    page_no = F.regexp_extract("url", r"page=([0-9]+)", 1).try_cast("long")
    return d.withColumn("ord", F.struct(F.coalesce(page_no, F.lit(0)).alias("p"), F.col("row").alias("r")))


def _ord(s, t, p):
    return F.struct(s.cast("string").alias("s"), t.cast("long").alias("t"), p.cast("long").alias("p")).alias("ord")


def build(landed: Landed, prof="hebrew"):
    """C1 → C3 → C5 → C6 → C7 → C8 → C9. Returns ``(vocab, summary, missing)``."""
    dic = dictionary(landed)
    ws = frequency.word_sources(frequency.corpus_texts(landed.song_lines, landed.articles, landed.videos), prof)
    common = lexicon.common_words(ws, lexicon.all_forms(dic), prof)
    words = common.select(F.col("word").alias("word_ord"), "word")

    # provider 1 (C5), then provider 2 fills the words it left missing
    kept, missing = sentences.sentence_candidates(words, landed.responses)
    filled = sentences.fill_sentences(missing, landed.api_examples, landed.html_examples, landed.prior_examples)
    # provider file order as one ordinal shape: prior rows first, then words in
    # list order, each word's rows by (tier, position)
    first, second = SENTENCE_SOURCES
    provider2 = filled.select("word", "sentence", "translation",
                              _ord(F.col("word"), F.col("tier"), F.col("pos")))
    if landed.prior_examples is not None:
        prior = landed.prior_examples.select("word", "sentence", "translation",
                                             _ord(F.lit(""), F.lit(-1), F.lit(None)))
        provider2 = prior.unionByName(provider2)
    provider1 = kept.select("word", "sentence", "translation", _ord(F.col("word_ord"), F.lit(0), F.col("pos")))
    rows = sentences.sentence_rows([(first, provider2), (second, provider1)], prof)

    vocab = A.assemble(A.word_list(words, prof), dic, rows, frequency.folded_sources(ws, prof), prof)
    return vocab, A.summary(vocab), missing
