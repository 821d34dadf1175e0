"""C14 daily refresh as a stream over landed API pages.

Each landed row is one response: the trending entry of a video (page 0) or a
page of its comments (from 1 on), with its HTTP status. A run reads what is new
in the landing folder; every micro-batch

* sends rows that cannot be read (broken JSON, no video id, a status that is no
  answer) to a dead-letter table,
* processes the runs' videos in their listed order up to the first page that
  met the quota: that video keeps its refreshed fields but gets no comments,
  its pages and all later videos stay pending with their status,
* merges the trending entries into the tracked videos, appends the comments
  that neither the state nor an earlier row of the batch knows, and adds their
  token counts to the counts of all runs.

A pending page is processed once a later delivery holds the same page with an
answer. All state is kept by batch number (``Versions``), and everything that a
batch adds follows from the state before it, so a batch that is replayed after
a stop completes what is missing and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import frequency
from ..operators.ordering import keep_first
from ..session import filesystem
from ..sinks.merge import upsert
from .incremental import comment_fields, video_fields
from .versions import SEQ, Versions, newest, summed

LANDING = "run_date date, ord long, video_id string, page_no int, status int, body string"
VIDEO = "id string, snippet struct<title:string,channelTitle:string,publishedAt:string>, statistics struct<viewCount:string,likeCount:string,commentCount:string>, _broken string"
COMMENTS = ("items array<struct<snippet:struct<topLevelComment:struct<id:string,snippet:struct<authorDisplayName:string,textDisplay:string,likeCount:long,publishedAt:string>>>>>, "
                              "error struct<errors:array<struct<reason:string>>>, _broken string")
OK, REFUSED, QUOTA = 200, 403, "quotaExceeded"

VIDEO_STATE = "video_id string, title string, channel string, published_at date, views long, likes long, comment_count long, first_seen date, last_seen date"
COMMENT_STATE = "video_id string, id string, author string, text string, likes long, published_at date"
PENDING = "run_date date, ord long, video_id string, page_no int, status int, body string, open boolean"
COUNTS = "word string, songs long, news long, youtube long, total long"
PAGE = ["run_date", "video_id", "page_no"]


def names(schema: str) -> list[str]:
    """Column names of a flat schema."""
    return [field.split()[0] for field in schema.split(", ")]


class Refresh:
    """State of the daily refresh under ``root``; ``prof`` is the script that a tracked video's title or channel has."""

    def __init__(self, spark: SparkSession, root: str, prof: str = "hebrew", token_prof: str | None = None):
        self.spark, self.root, self.prof, self.token_prof = spark, root.rstrip("/"), prof, token_prof or prof
        self.videos = Versions(spark, f"{self.root}/videos", VIDEO_STATE, newest(["video_id"]))
        self.comments = Versions(spark, f"{self.root}/comments", COMMENT_STATE, newest(["video_id", "id"]))
        self.pending = Versions(spark, f"{self.root}/pending", PENDING, newest(PAGE))
        self.counts = Versions(spark, f"{self.root}/counts", COUNTS, summed(["word"]))

    # --- one micro-batch --------------------------------------------------------------
    def batch(self, delivered: DataFrame, batch: int) -> None:
        work = f"{self.root}/work/{batch}"
        waiting = self.pending.read().where("open").drop("open")
        # a page that was delivered again replaces the one that waits
        named = F.col("run_date").isNotNull() & F.col("video_id").isNotNull() & F.col("page_no").isNotNull()
        pages = delivered.select(*names(LANDING), F.lit(1).alias("fresh")).where(named).unionByName(waiting.withColumn("fresh", F.lit(0)))
        pages = pages.withColumn("answered", F.coalesce(F.col("status") == OK, F.lit(False)))
        pages = keep_first(pages, PAGE, ["fresh", "answered", "status", "ord", "body"], last=True).drop("fresh", "answered")
        pages = pages.withColumns({"v": F.when(F.col("page_no") == 0, F.from_json("body", VIDEO, {"columnNameOfCorruptRecord": "_broken"})),
                                   "c": F.when(F.col("page_no") > 0, F.from_json("body", COMMENTS, {"columnNameOfCorruptRecord": "_broken"}))})
        quota = F.exists(F.coalesce("c.error.errors", F.array()), lambda e: e["reason"] == QUOTA) & (F.col("status") == REFUSED)
        why = (F.when(F.coalesce(quota, F.lit(False)), None)
               .when(F.coalesce(F.col("status") != OK, F.lit(True)), F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("none"))))
               .when(F.col("body").isNull() | F.coalesce("v._broken", "c._broken").isNotNull(), "broken body"))
        pages = _written(pages.withColumns({"quota": F.coalesce(quota, F.lit(False)), "why": why}), f"{work}/pages")
        nameless = delivered.select(*names(LANDING)).where(~named).withColumn("why", F.lit("no key"))
        _write(pages.where("why is not null").select(*names(LANDING), "why").unionByName(nameless), f"{self.root}/dead/batch={batch}")

        # per run the place of the first page that met the quota
        stop = pages.where("quota").groupBy("run_date").agg(F.min("ord").alias("stop"))
        left = pages.where("why is null").join(stop, "run_date", "left")
        held = left.where("ord > stop or (ord = stop and page_no > 0)")
        taken = left.where("stop is null or ord < stop or (ord = stop and page_no = 0)")
        # pages of a video whose trending entry waits as well wait with it; the entry of an earlier delivery is tracked already
        entries = taken.where("page_no = 0").select("run_date", "ord", F.struct("v.*").alias("v"))
        today = self._videos_of(entries)
        tracked = self.videos.read().select("video_id", "title", "channel").unionByName(today.select("video_id", "title", "channel"))
        tracked = tracked.where(T.has_script(F.col("title"), self.prof) | T.has_script(F.col("channel"), self.prof)).select("video_id").distinct()

        items = (taken.where("page_no > 0").select("run_date", "video_id", "page_no", F.posexplode("c.items").alias("pos", "item"))
                 .select("video_id", F.struct("run_date", "page_no", "pos").alias("ord"), F.col("item.snippet").alias("snippet")))
        fetched = comment_fields(items, keep=("video_id", "ord")).where("id is not null").join(tracked, "video_id", "left_semi")
        first = keep_first(fetched, ["video_id", "id"], ["ord"]).drop("ord")
        known = self._comments_before(batch)
        new = _written(first.join(known, ["video_id", "id"], "left_anti"), f"{work}/new")

        self.videos.add(self._merged(today), batch)
        self.comments.add(new, batch)
        self.counts.add(frequency.word_sources({"youtube": new}, self.token_prof), batch)
        totals = new.agg(F.count("*").alias("new_comments")).select(F.lit(batch).cast("long").alias("run"), "new_comments", F.lit(self.videos.read().count()).alias("videos_tracked"))
        _write(totals, f"{self.root}/totals/batch={batch}")
        # last, so that a replay finds what waited before the batch
        waits = held.select(*names(LANDING), F.lit(True).alias("open"))
        done = waiting.join(held.select(*PAGE), PAGE, "left_anti").select(*names(LANDING), F.lit(False).alias("open"))
        self.pending.add(waits.unionByName(done), batch)

    def _comments_before(self, batch: int) -> DataFrame:
        """Ids that earlier batches appended; a comment is appended once, so it keeps its batch."""
        return self.comments._rows(self.comments.manifest()[1]).where(F.col(SEQ) < batch).select("video_id", "id")

    def _videos_of(self, entries: DataFrame) -> DataFrame:
        """One row per video of the script: fields of its first day in the batch, counts of its last."""
        flat = video_fields(entries.select("run_date", "v.*"), keep=("run_date",))
        flat = flat.where(T.has_script(F.col("title"), self.prof) | T.has_script(F.col("channel"), self.prof)).where("video_id is not null")
        early = [c for c in flat.columns if c not in ("run_date", "video_id", "views", "likes")]
        one = flat.groupBy("video_id").agg(F.min(F.struct("run_date", *early)).alias("a"), F.max(F.struct("run_date", "views", "likes")).alias("b"))
        return one.select("video_id", *[F.col(f"a.{c}").alias(c) for c in early], "b.views", "b.likes", F.col("a.run_date").alias("first_seen"), F.col("b.run_date").alias("last_seen"))

    def _merged(self, today: DataFrame) -> DataFrame:
        """The tracked videos that the batch changes."""
        known = self.videos.read().join(today.select("video_id"), "video_id", "left_semi")
        late = F.col("u_last_seen")
        return upsert(known, today.select(*names(VIDEO_STATE)), "video_id", replace=["views", "likes"],
                      overrides={"last_seen": (late, late), "first_seen": (F.col("t_first_seen"), F.col("u_first_seen"))}).drop("action")

    # --- runs --------------------------------------------------------------------------
    def run(self, landing: str) -> None:
        """Processes everything that landed since the last run, and stops."""
        stream = self.spark.readStream.schema(LANDING).parquet(landing)
        (stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", f"{self.root}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())

    def totals(self) -> DataFrame:
        """Per run the new comments and the videos tracked after it."""
        return _read(self.spark, f"{self.root}/totals", "run long, new_comments long, videos_tracked long")

    def dead_letters(self) -> DataFrame:
        return _read(self.spark, f"{self.root}/dead", "run_date date, ord long, video_id string, page_no int, status int, body string, why string")


def daily(refresh: Refresh, landing: str, others: DataFrame, dictionary: DataFrame, sentences: Callable[[], DataFrame], prof: str) -> DataFrame:
    """R6 refresh, counts, dataset: runs the refresh and assembles the vocabulary from its counts and those of the
    ``others`` corpora (rows of ``word_sources``). Only the new comments are tokenised. ``sentences`` gives the example
    rows once the refresh is done."""
    from ..operators import assemble, lexicon
    refresh.run(landing)
    both = others.select(*names(COUNTS)).unionByName(refresh.counts.read())
    counts = both.groupBy("word").agg(*[F.sum(c).cast("long").alias(c) for c in (*frequency.SOURCES, "total")])
    words = lexicon.common_with_sources(counts, "songs", "youtube", prof).withColumnRenamed("word", "word_ord")
    return assemble.assemble_flat(words, dictionary, sentences(), None, prof)


def _write(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").parquet(folder)


def _written(df: DataFrame, folder: str) -> DataFrame:
    _write(df, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    fs, path = filesystem(folder)
    if not fs.get_file_info(path).is_file and fs.get_file_info(path).type.name == "NotFound":
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema + ", batch long").parquet(folder).drop("batch")
