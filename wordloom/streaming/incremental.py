"""C14 incremental refresh and R1-R6 as batch and Structured Streaming jobs.

State lives in tables (parquet), never in driver memory. A streaming run
uses a checkpoint under the shared ``spark.checkpoint.dir`` folder, so a
restarted or partially failed run resumes exactly where it stopped.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators.ordering import keep_first
from ..sinks.merge import upsert
from .versions import Versions, newest


def entity_state(events: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """R2 batch form: per entity first/last seen day, latest value and count
    (one partial + final aggregate). Events sharing the latest timestamp are
    ordered by value, so the result is deterministic under retries."""
    return events.groupBy(key).agg(
        F.min(F.to_date(ts)).alias("first_seen"), F.max(F.to_date(ts)).alias("last_seen"),
        F.max_by(value, F.struct(ts, value)).alias("last_value"), F.count("*").alias("n_events"))


def video_fields(payload: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of raw video payloads (``id``, ``snippet``, ``statistics`` structs): counts that are absent
    are "0", the day is the first ten characters of the publication time."""
    stat = lambda c: T.default(F.col(f"statistics.{c}"), "0").cast("long")
    return payload.select(
        *keep, F.col("id").alias("video_id"), F.col("snippet.title").alias("title"), F.col("snippet.channelTitle").alias("channel"),
        T.date_cut(F.col("snippet.publishedAt")).alias("published_at"), stat("viewCount").alias("views"), stat("likeCount").alias("likes"),
        stat("commentCount").alias("comment_count"))


def comment_fields(payload: DataFrame, keep: tuple[str, ...] = ("video_id", "ord")) -> DataFrame:
    """Columns of raw comment payloads (``snippet.topLevelComment``)."""
    top = F.col("snippet.topLevelComment")
    return payload.select(
        *keep, top["id"].alias("id"), top["snippet"]["authorDisplayName"].alias("author"), top["snippet"]["textDisplay"].alias("text"),
        top["snippet"]["likeCount"].cast("long").alias("likes"), T.date_cut(top["snippet"]["publishedAt"]).alias("published_at"))


def refresh_videos(state: DataFrame, today: DataFrame, run_date: str, prof="hebrew") -> DataFrame:
    """C14 J6 + F1: trending videos whose title or channel has the script are
    merged into the state. New → inserted with first_seen = last_seen =
    run_date; known → views, likes, last_seen refreshed (title, channel,
    comment_count keep old values, D10); not trending today → unchanged."""
    vids = today.where(T.has_script(F.col("title"), prof) | T.has_script(F.col("channel"), prof))
    d = F.lit(run_date).cast("date")
    upd = vids.withColumn("first_seen", d).withColumn("last_seen", d)
    return upsert(state, upd, "video_id", replace=["views", "likes"],
                  overrides={"last_seen": (d, d), "first_seen": (F.col("t_first_seen"), d)})


def new_comments(known: DataFrame, fetched: DataFrame, videos: DataFrame) -> DataFrame:
    """Fetched comments of today's videos not seen before, also
    across pages of the same run (first occurrence kept)."""
    f = fetched.join(videos.select("video_id"), "video_id", "left_semi").where(F.col("id").isNotNull())
    f = keep_first(f, ["video_id", "id"], ["ord"])
    return f.join(known.select("video_id", "id"), ["video_id", "id"], "left_anti")


def dedupe_stream(spark: SparkSession, source: str, schema: StructType, keys: list[str],
                  sink: str, checkpoint: str, fmt: str = "parquet", watermark: tuple[str, str] | None = None):
    """R1 streaming dedupe: every key is emitted once across all runs (state
    kept in the checkpoint). With ``watermark=(col, delay)`` state is bounded
    via ``dropDuplicatesWithinWatermark`` (an extension, not in the
    reference). Runs all available input and stops (``availableNow``)."""
    s = spark.readStream.schema(schema).format(fmt).load(source)
    if watermark:
        s = s.withWatermark(*watermark).dropDuplicatesWithinWatermark(keys)
    else:
        s = s.dropDuplicates(keys)
    with _rocksdb(spark):
        q = (s.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return spark.read.parquet(sink)


@contextmanager
def _rocksdb(spark: SparkSession):
    """The state of a query that starts here is kept on disk (RocksDB), unless the session names a store of its own: a
    state that grows with all ids ever seen does not fit the heap."""
    key, default = "spark.sql.streaming.stateStore.providerClass", "HDFSBackedStateStoreProvider"
    given = spark.conf.get(key)
    if not given.endswith(default):
        yield
        return
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, given)


def state_upsert_stream(spark: SparkSession, source: str, schema: StructType, key: str, ts: str,
                        value: str, state_dir: str, checkpoint: str, fmt: str = "parquet", max_files: int | None = None):
    """R2/R4/K8 streaming entity state: a keyed aggregate in the state store
    (``entity_state``), of which every micro-batch adds the entities it changed
    to a compacted state table (``Versions``), once per batch number however
    often the batch is replayed. What is read follows the size of the state,
    not the number of runs.
    A batch commits whole or not at all, so a stop mid-run (quota) keeps every
    finished batch (R5). Returns the newest version of each entity."""
    s = spark.readStream.schema(schema).format(fmt)
    s = (s.option("maxFilesPerTrigger", max_files) if max_files else s).load(source)
    state = entity_state(s, key, ts, value)
    versions = Versions(spark, state_dir, state.schema, newest([key]))
    q = (state.writeStream.outputMode("update").foreachBatch(versions.add).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return versions.read()


def load_state(rows: DataFrame, key: str, ord_col: str = "ord") -> DataFrame:
    """Loading a state file keyed by ``key`` keeps the *last* row per key
    while the key keeps the position of its *first* occurrence (dict
    semantics). Two aggregates in one pass: ``max(struct(ord, *))`` and
    ``min(ord)``."""
    rest = [c for c in rows.columns if c not in (key, ord_col)]
    agg = rows.groupBy(key).agg(F.max(F.struct(ord_col, *rest)).alias("_last"), F.min(ord_col).alias("_pos"))
    return agg.select(key, F.col("_pos").alias(ord_col), *[F.col(f"_last.{c}").alias(c) for c in rest])


def refresh_comments(videos_state: DataFrame, comments_state: DataFrame, trending: DataFrame,
                     fetched: DataFrame, run_date: str, prof="hebrew"):
    """C14 one daily run: F1 filter, J6 video merge, J5/R1 new comments only,
    U4 append. Returns ``(videos, comments, totals)`` where ``totals`` is the
    A11 one-row summary (new comments, tracked videos)."""
    videos = refresh_videos(videos_state, trending, run_date, prof)
    today = videos.where(F.col("action") != "keep").select("video_id")
    new = new_comments(comments_state, fetched, today)
    comments = comments_state.unionByName(new.select(*comments_state.columns))
    n_new = new.agg(F.count("*").alias("new_comments"))
    n_videos = videos.agg(F.count("*").alias("videos_tracked"))
    totals = n_new.select("new_comments", n_videos.scalar().alias("videos_tracked"))
    return videos.drop("action"), comments, totals
