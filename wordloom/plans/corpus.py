"""Driver-table inputs for the vocabulary plans.

The driver tables hold Latin-script prose, so the plans run the Latin script
profile; the same operators run the Hebrew profile on Hebrew inputs.

Role of each table (fixed mapping used by every plan and oracle):
  songs corpus   = documents.text      (ordinal doc_id, line pos)
  news corpus    = benchmark.text
  youtube corpus = conversations.text  (ordinal conv_id, turn, line pos)
  dictionary     = benchmark: one entry per item, base form = first token,
                   inflection cells = all tokens, word_url = 'item/<id>'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SENTENCE_SOURCES
from ..functions import text as T
from ..operators import frequency
from ..sources.tables import table, text_lines_of

PROFILE = "latin"


def documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "text")


def conversations(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


def corpora(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "songs": documents(spark, sf),
        "news": table(spark, sf, "benchmark").select("text"),
        "youtube": conversations(spark, sf),
    }


def word_sources(spark, sf) -> DataFrame:
    return frequency.word_sources(corpora(spark, sf), PROFILE)


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """benchmark items as dictionary entries (``dict_entry`` shape)."""
    b = table(spark, sf, "benchmark").select("item_id", "text")
    toks = T.tokens(F.col("text"), PROFILE)
    cells = F.transform(toks, lambda t: F.struct(t.alias("hebrew"), F.lit("").alias("transcription"),
                                                 F.lit("").alias("meaning")))
    tables = F.array(F.struct(F.array(F.struct(F.lit(None).cast("array<string>").alias("labels"),
                                               cells.alias("cells"))).alias("rows")))
    return b.select(
        F.col("item_id").cast("long").alias("ord"),
        F.coalesce(F.get(toks, 0), F.lit("")).alias("hebrew"),
        F.concat(F.lit("item/"), F.col("item_id").cast("string")).alias("word_url"),
        tables.alias("tables"))


def conversation_lines(spark, sf, conv: DataFrame | None = None) -> DataFrame:
    return text_lines_of(conversations(spark, sf) if conv is None else conv, ["conv_id", "turn", "role"])


def document_lines(spark, sf) -> DataFrame:
    return text_lines_of(documents(spark, sf), ["doc_id", "lang"])


def first_token(line) -> F.Column:
    return F.regexp_extract(line, r"\p{L}+", 0)


def sentence_providers(spark, sf, conv: DataFrame | None = None):
    """Two example-sentence providers: conversation lines (priority 0; of ``conv``
    where given) and document lines (priority 1), keyed by their first token."""
    conv = conversation_lines(spark, sf, conv).select(
        first_token(F.col("line")).alias("word"), F.col("line").alias("sentence"),
        F.col("role").alias("translation"),
        F.struct(F.col("conv_id").alias("a"), F.col("turn").alias("b"), F.col("pos").alias("c")).alias("ord"))
    docs = document_lines(spark, sf).select(
        first_token(F.col("line")).alias("word"), F.col("line").alias("sentence"),
        F.col("lang").alias("translation"),
        F.struct(F.col("doc_id").alias("a"), F.lit(0).cast("long").alias("b"), F.col("pos").alias("c")).alias("ord"))
    return list(zip(SENTENCE_SOURCES, [conv, docs]))
