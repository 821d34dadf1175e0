"""A training-corpus pipeline over ``documents``: five stages, each calling one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and the next stage reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import common, stages

STAGES = [
    ("toxicity", stages.toxic),
    ("n-gram Jaccard join", stages.near_duplicates),
    ("benchmark decontamination", stages.decontaminated),
    ("PII", stages.without_personal_data),
    ("SentencePiece encoding and decoding", stages.encoded),
]

# No stage is expressible as one SQL statement; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    folder = common.run_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = common.written(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return docs
