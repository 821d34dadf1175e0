"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Every stage but the last returns the columns of ``documents``; a stage that
filters keeps all rows its operator does not reject, rows without id or text
included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import common, jaccard_join, pii, queries, tiling, toxicity, transducer


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    scored = toxicity.scores(docs, queries.toxicity_model(spark, sf_dir))
    rejected = scored.where(F.col("score") >= queries.TOXIC_SCORE).select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    groups = jaccard_join.component_table(docs, common.run_folder(spark, "near"))
    gone = groups.where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = tiling.contamination(docs, common.table(spark, sf_dir, "benchmark"), common.run_folder(spark, "leaks"))
    gone = found.where("contaminated and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind; n_chars follows the text."""
    # one pass over the texts, written whole: a filter over the lazy annotation would have every step of it worked out anew.
    # The caller's columns travel in a struct, so that none clashes with those of the operator.
    noted = pii.annotated(docs.select(F.struct("*").alias("row"), "text")).select("row", "base", "cands")
    noted = common.written(noted, common.run_folder(spark, "pii"))
    spanned = noted.select("row", pii.all_spans(pii.trained(noted)).alias("spans"))
    clean = {"text": F.when(F.col("row.text").isNotNull(), pii.redacted(F.col("row.text"), F.col("spans")))}
    if "n_chars" in docs.columns:
        clean["n_chars"] = F.when(F.size("spans") > 0, F.length(clean["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return spanned.select(*(clean.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left."""
    return transducer.encoded(docs, public_tokenizers.path(queries.PIECE_FILE))
