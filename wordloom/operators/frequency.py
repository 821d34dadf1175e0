"""C1 word counts per source (A1, A2, U3, P2, T3, F8) and A3 folded sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

SOURCES = ("songs", "news", "youtube")


def news_text(title: Column | str, body: Column | str) -> Column:
    """P2 article text: ``title + " " + text`` with missing parts as ''."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(F.coalesce(c(title), F.lit("")), F.lit(" "), F.coalesce(c(body), F.lit("")))


def word_sources(corpora: dict[str, DataFrame], prof="hebrew", text_col: str = "text",
                 key=None) -> DataFrame:
    """Raw-token counts per source, one column per source plus ``total``.

    ``corpora`` maps each of songs/news/youtube to a DataFrame with a text
    column. Every source contributes a 0/1 indicator per token, so the result
    is one hash aggregate on ``word``: partial sums are taken per map task
    (map-side combine) and only one shuffle on ``word`` happens, whatever the
    skew of individual words. ``key`` (a Column function, e.g.
    ``clean_word``) maps each token before counting; NULL keys are dropped.
    """
    parts = []
    for name in SOURCES:
        df = corpora.get(name)
        if df is None:
            continue
        toks = df.select(F.explode(T.tokens(F.col(text_col), prof)).alias("word"))
        if key is not None:
            toks = toks.select(key(F.col("word")).alias("word")).where(F.col("word").isNotNull())
        parts.append(toks.select("word", *[F.lit(1 if s == name else 0).alias(s) for s in SOURCES]))
    u = reduce(DataFrame.unionByName, parts)
    agg = u.groupBy("word").agg(*[F.sum(s).cast("long").alias(s) for s in SOURCES])
    total = reduce(lambda a, b: a + b, [F.col(s) for s in SOURCES])
    return agg.withColumn("total", total).filter(F.col("total") > 0)


def folded_sources(sources: DataFrame, prof="hebrew") -> DataFrame:
    """A3: re-aggregate counts by the folded key; keys that fold to '' drop."""
    bare = T.fold(F.col("word"), prof)
    return (sources.select(bare.alias("word"), *SOURCES, "total")
            .filter(F.length("word") > 0)
            .groupBy("word")
            .agg(*[F.sum(s).cast("long").alias(s) for s in (*SOURCES, "total")]))


def corpus_texts(song_lines: DataFrame, articles: DataFrame, videos: DataFrame) -> dict[str, DataFrame]:
    """U3 + P2 inputs of :func:`word_sources` from the reference's stores:
    one lyric line per row (``value``), articles (``title`` + ``text``) and
    videos with nested ``comments`` (their ``text``)."""
    return {
        "songs": song_lines.select(F.col("value").alias("text")),
        "news": articles.select(news_text("title", "text").alias("text")),
        "youtube": videos.select(F.explode(F.coalesce("comments", F.array())).alias("c"))
                         .select(F.coalesce(F.col("c.text"), F.lit("")).alias("text")),
    }
