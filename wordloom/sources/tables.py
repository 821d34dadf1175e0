"""S1-S7 scans.

Parquet is the internal format: scans get column pruning and filter push
down from Catalyst. JSON/text inputs are read with explicit schemas and an
ordinal so keep-first semantics never depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions import text as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Declared schemas of the driver tables: reads skip the footer-inference job
# (one Spark job per read otherwise, and a full footer scan on many files).
SCHEMAS = {
    "region": "r_regionkey INT,r_name STRING",
    "nation": "n_nationkey INT,n_name STRING,n_regionkey INT",
    "customer": "c_custkey BIGINT,c_name STRING,c_nationkey INT,c_acctbal DOUBLE,c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT,s_name STRING,s_nationkey INT,s_acctbal DOUBLE",
    "part": "p_partkey BIGINT,p_name STRING,p_brand STRING,p_type STRING,p_size INT,p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT,o_custkey BIGINT,o_orderstatus STRING,o_totalprice DOUBLE,"
              "o_orderdate TIMESTAMP_NTZ,o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT,l_partkey BIGINT,l_suppkey BIGINT,l_linenumber INT,l_quantity DOUBLE,"
                "l_extendedprice DOUBLE,l_discount DOUBLE,l_tax DOUBLE,l_returnflag STRING,l_linestatus STRING,"
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT,ts TIMESTAMP_NTZ,user_id BIGINT,event_type STRING,value DOUBLE,props STRING",
    "documents": "doc_id BIGINT,text STRING,lang STRING,source STRING,n_chars BIGINT",
    "embeddings": "vec_id BIGINT,embedding ARRAY<FLOAT>,label INT",
    "pages": "page_id BIGINT,url STRING,html STRING",
    "benchmark": "item_id BIGINT,text STRING",
    "labels": "doc_id BIGINT,quality INT,toxic INT",
    "conversations": "conv_id BIGINT,turn BIGINT,role STRING,text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (parquet) read with its declared schema."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def json_array(spark: SparkSession, path: str, schema: StructType,
               mode: str = "FAILFAST") -> DataFrame:
    """S1 a JSON array of objects (one file) with its element position as
    ``ord``. The file is read whole (``wholetext``) and parsed with the given
    schema; use for small reference files. ``json_arrays.records`` reads large
    arrays with many tasks."""
    raw = spark.read.text(path, wholetext=True)
    arr = F.from_json(F.col("value"), ArrayType(schema), {"mode": mode})
    return (raw.select(F.posexplode(arr).alias("ord", "r"))
            .select(F.col("ord").cast("long"), "r.*"))


def json_lines(spark: SparkSession, path: str, schema: StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """S1 at scale: JSON lines, schema given (never inferred)."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2 one row per line (``value``)."""
    return spark.read.text(path)


def text_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """S3 one row per file: ``file, value`` (whole text)."""
    return (spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("file"), "value"))


def optional(spark: SparkSession, path: str | None, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """S7 prior output, or an empty frame with the schema when absent."""
    if path:
        try:
            return spark.read.schema(schema).format(fmt).load(path)
        except Exception as e:  # path does not exist yet
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    return spark.createDataFrame([], schema)


def text_lines_of(df: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """T9 split a text column into ``(ids..., pos, line)`` rows (row-local)."""
    return (df.select(*id_cols, F.posexplode(T.split_lines(F.col(text_col))).alias("pos", "line"))
            .withColumn("pos", F.col("pos").cast("long")))


def payload_items(landing: DataFrame, body_schema, path: str, keep: list[str]) -> DataFrame:
    """S6 nested API payload scan (and R3 paged drain: one landing row per
    fetched page, ``page_no`` kept): ``landing`` holds one response body (JSON
    text) per row; the list under ``path`` (e.g. ``items``, ``response.hits``)
    becomes one row per element with its position; a missing list is empty.
    Parsing is row-local with an explicit schema (never inferred)."""
    parsed = landing.select(*keep, F.from_json(F.col("body"), body_schema).alias("_b"))
    arr = F.col("_b")
    for part in path.split("."):
        arr = arr[part]
    return (parsed.select(*keep, F.posexplode(F.coalesce(arr, F.array())).alias("item_pos", "item"))
            .withColumn("item_pos", F.col("item_pos").cast("long")))
