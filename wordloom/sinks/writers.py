"""K1-K6, K8 sinks. Parquet is the internal format; the JSON / text / CSV
writers reproduce the reference's exchange files where a consumer needs
them. All writers are Spark jobs (no driver-side collection)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import filesystem


def write_json(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """K1 JSON lines, UTF-8, non-ASCII kept as is. ``order_by`` (O6): input
    order restored at the sink only (a range-partitioned sort; part files
    are in order)."""
    if order_by:
        df = df.orderBy(order_by)
    df.write.mode("overwrite").option("encoding", "UTF-8").json(path)


def write_lines(df: DataFrame, path: str, col: str = "line") -> None:
    """K2 one text line per row (order = partition order)."""
    df.select(F.col(col).alias("value")).write.mode("overwrite").text(path)


def _field(df: DataFrame, c: str):
    return F.col(c) if c in df.columns else F.lit(None).cast("string")


SQL_FIELDS = ("hebrew", "transcription", "root", "part_of_speech", "meaning", "audio_url", "word_url")


def sql_defaults(df: DataFrame) -> DataFrame:
    """K3 column defaults of the SQL word table: '' everywhere, '-' for root."""
    return df.select(*[T.default(_field(df, c), "-" if c == "root" else "").alias(c) for c in SQL_FIELDS])


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 100) -> None:
    """K3 replace the table and insert every row (batched)."""
    (sql_defaults(df).write.mode("overwrite").option("batchsize", batch_size)
     .jdbc(url, table, properties=properties or {}))


def document(df: DataFrame, with_tables: bool) -> DataFrame:
    """K4 document projection: the listing sink keeps ``audio_url`` and no
    tables; the words sink keeps ``tables`` (default empty) and no audio."""
    if not with_tables:
        return sql_defaults(df)
    tables = F.coalesce(F.col("tables"), F.array()) if "tables" in df.columns else F.array()
    return df.select(*[T.default(_field(df, c), "-" if c == "root" else "").alias(c)
                       for c in SQL_FIELDS if c != "audio_url"], tables.alias("tables"))


def write_batched(df: DataFrame, insert_many: Callable[[list], None], batch_size: int = 100) -> None:
    """K4 batched append: each task sends full batches of ``batch_size`` rows
    and flushes the remainder when its partition ends. ``insert_many`` must
    be idempotent per batch (e.g. keyed upsert) so task retries are safe."""
    def part(rows: Iterable):
        buf = []
        for r in rows:
            buf.append(r.asDict(recursive=True))
            if len(buf) >= batch_size:
                insert_many(buf)
                buf = []
        if buf:
            insert_many(buf)
    df.foreachPartition(part)


def write_csv(df: DataFrame, path: str) -> bool:
    """K5 spreadsheet export as CSV with header, skipped when empty."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_song_files(files: DataFrame, path: str, order: str = "ord") -> None:
    """K6 one text file per song, named ``file_name``; of several songs with
    one name the last by ``order`` (where that column exists) stays. Each task
    writes its own files whole, so a repeated task writes the same bytes again."""
    cols = ["file_name", "body", *([order] if order in files.columns else [])]
    last = (files.select(F.col("file_name"), F.struct(*reversed(cols[1:])).alias("s"))
            .groupBy("file_name").agg(F.max("s").alias("s")).select("file_name", "s.body"))
    fs, root = filesystem(path)
    fs.create_dir(root)

    def part(rows: Iterable) -> None:
        out, folder = filesystem(path)
        for r in rows:
            with out.open_output_stream(f"{folder}/{r.file_name}") as f:
                f.write(r.body.encode("utf-8"))
    last.foreachPartition(part)
