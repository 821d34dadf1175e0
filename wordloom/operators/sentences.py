"""Example sentences: C5 candidates + coverage, C6 tiered fill, C7 lookup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordering import keep_first, top_k


def sentence_rows(providers: Sequence[tuple[str, DataFrame]], prof="hebrew") -> DataFrame:
    """C7 (U2, W2): union of providers in priority order, keyed by the folded
    word; one row per ``(bare, strip(sentence))`` — the first by provider
    priority, then provider order. The stored sentence keeps its spaces.

    Each provider DataFrame has ``word, sentence, translation, ord``.
    Output: ``bare, prio, ord, sentence, translation, source``."""
    parts = []
    for prio, (name, df) in enumerate(providers):
        parts.append(df.select(
            T.fold(F.coalesce(F.col("word"), F.lit("")), prof).alias("bare"),
            F.lit(prio).alias("prio"), F.col("ord"),
            F.coalesce(F.col("sentence"), F.lit("")).alias("sentence"),
            F.coalesce(F.col("translation"), F.lit("")).alias("translation"),
            F.lit(name).alias("source")))
    u = reduce(DataFrame.unionByName, parts).filter(F.length("bare") > 0)
    u = u.withColumn("skey", T.strip(F.col("sentence")))
    return keep_first(u, ["bare", "skey"], ["prio", "ord"]).drop("skey")


def translation_of(translations) -> F.Column:
    """P3 ``translations[0][0].text`` when the first group is a non-empty list."""
    first = F.try_element_at(translations, F.lit(1))
    return F.try_element_at(first, F.lit(1))["text"]


def sentence_candidates(words: DataFrame, responses: DataFrame, k: int = T.EXAMPLES_PER_WORD):
    """C5 (provider 1). ``words``: ``word, word_ord``; ``responses``: ``word,
    results array<struct<text, translations array<array<struct<text>>>>>``
    (NULL/empty results = no hit). Only the first ``k`` results of a word are
    looked at (slice before the validity check). Returns ``(kept, missing)``
    as :func:`keep_candidates`."""
    r = responses.select("word", F.posexplode(F.slice(F.coalesce("results", F.array()), 1, k)))
    cand = r.select("word", F.col("pos").cast("long"), F.col("col.text").alias("sentence"),
                    translation_of(F.col("col.translations")).alias("translation"))
    return keep_candidates(words, cand)


def keep_candidates(words: DataFrame, cand: DataFrame):
    """C5 core on long-form candidates ``word, pos, sentence, translation``
    (already cut to the first k per word).

    A candidate is valid when sentence and translation are non-empty. A
    sentence already taken by an earlier word (``word_ord``, then ``pos``) is
    skipped (W3: global keep-first, a partial aggregate on the sentence text,
    so a sentence repeated everywhere is reduced map-side). Words with no
    kept sentence are reported with a reason (J11, defect D11 reproduced).
    Returns ``(kept: word, word_ord, pos, sentence, translation,
    missing: word, word_ord, reason)``."""
    c = cand.join(words.select("word", "word_ord"), "word")
    valid = c.filter((F.coalesce(F.col("sentence"), F.lit("")) != "")
                     & (F.coalesce(F.col("translation"), F.lit("")) != ""))
    kept = keep_first(valid.select("sentence", "word_ord", "pos", "word", "translation"),
                      ["sentence"], ["word_ord", "pos"])
    has_results = c.select("word").distinct()
    missing = coverage(words, kept, has_results)
    return kept.select("word", "word_ord", "pos", "sentence", "translation"), missing


def fill_sentences(missing: DataFrame, api: DataFrame, html: DataFrame,
                   prior: DataFrame | None = None, k: int = T.EXAMPLES_PER_WORD):
    """C6 (provider 2, resumable). ``missing``: ``word``; ``api``: ``word, pos,
    s_text, t_text``; ``html``: ``word, pos, src, trg``; ``prior``: earlier
    output ``word, sentence, translation``.

    Words already in ``prior`` are skipped (J4). For each remaining word the
    API rows come first, HTML rows top up; pairs seen before are skipped;
    at most ``k`` per word (counted after cleaning and dedupe). Returns the
    new rows ``word, sentence, translation, tier, pos, rank``."""
    words = missing.filter(F.col("word").isNotNull()).select("word").distinct()  # F9 key present
    if prior is not None:
        words = words.join(prior.select("word").distinct(), "word", "left_anti")
    tiers = [
        api.select("word", "pos", T.strip_em(F.col("s_text")).alias("sentence"),
                   T.strip_em(F.col("t_text")).alias("translation"), F.lit(0).alias("tier")),
        html.select("word", "pos", T.strip_em(F.col("src")).alias("sentence"),
                    T.strip_em(F.col("trg")).alias("translation"), F.lit(1).alias("tier")),
    ]
    c = reduce(DataFrame.unionByName, tiers).filter(
        F.col("sentence").isNotNull() & F.col("translation").isNotNull())
    # the few missing words first: what is not asked for is never shuffled by
    # its text; then a hot word is cut down map-side (partial keep-first, top-k)
    c = c.join(words, "word", "left_semi")
    c = keep_first(c, ["word", "sentence"], ["tier", "pos"])
    if prior is not None:
        c = c.join(prior.select("word", "sentence"), ["word", "sentence"], "left_anti")
    return top_k(c, ["word"], ["tier", "pos"], k)


def coverage(words: DataFrame, kept: DataFrame, has_results: DataFrame) -> DataFrame:
    """Words without a kept sentence and why (no results at all, or no
    valid translation among them)."""
    return (words.join(kept.select("word").distinct(), "word", "left_anti")
            .join(has_results.select("word", F.lit(True).alias("_hit")).distinct(), "word", "left")
            .select(*[c for c in words.columns],
                    F.when(F.col("_hit"), F.lit("no_valid_translation"))
                    .otherwise(F.lit("no_sentence")).alias("reason")))
