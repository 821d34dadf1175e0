"""Queries of the daily run: landed pages, refresh, incremental counts, dataset.

Conversations play the API: a conversation is a video, its turns are the
comments, two a page. Every run lands whole pages of JSON text; three runs
together deliver every turn of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import frequency
from ..session import run_folder
from ..sources.tables import table
from ..streaming.incremental import state_upsert_stream
from ..streaming.refresh import COUNTS, LANDING, Refresh, daily, names
from ..streaming.versions import Versions, summed
from . import corpus as C
from .catalog import SQL_VOCAB, SQL_WORD_SOURCES, register

PER_PAGE = 2
# letters of titles that are projected onto the Hebrew block, so that some titles have the script and others not
RARE, PROJECTED = "ñß", "אב"
DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")
BROKEN, FAILED = '{"items": [', "server error"


def landed(spark: SparkSession, sf: str, run: int) -> DataFrame:
    """Pages of one run.

    Run 0 lists the lower two thirds of the videos, with the comments of
    users; a row without video id comes too. Run 1 lists the upper two thirds
    with all comments, each twice, and meets the quota at the first page of
    the middle video. Run 2 lists all videos, brings that page again, and has a
    broken page and a failed one.
    """
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").where("conv_id is not null and turn is not null")
    most = F.lit(conv.agg(F.max("conv_id")).first()[0])
    middle = F.lit(conv.where(2 * F.col("conv_id") >= most).agg(F.min("conv_id")).first()[0])
    listed = {0: 3 * F.col("conv_id") <= 2 * most, 1: 3 * F.col("conv_id") >= most, 2: F.lit(True)}[run]
    day = F.lit(DAYS[run]).cast("date")
    per_video = conv.groupBy("conv_id").agg(F.min_by("text", "turn").alias("title"), F.count("*").alias("n")).where(listed)
    count = lambda c: c.cast("string")
    entry = F.struct(F.col("conv_id").cast("string").alias("id"),
                     F.struct(F.translate("title", RARE, PROJECTED).alias("title"), F.lit("channel").alias("channelTitle"), F.lit("2023-12-31T08:00:00Z").alias("publishedAt")).alias("snippet"),
                     F.struct(count(F.col("n") + 1000 * run).alias("viewCount"), count(F.col("n")).alias("likeCount"), count(F.col("n") + run).alias("commentCount")).alias("statistics"))
    row = lambda page, status, body: [day.alias("run_date"), F.col("conv_id").alias("ord"), F.col("conv_id").cast("string").alias("video_id"),
                                      page.cast("int").alias("page_no"), status.cast("int").alias("status"), body.alias("body")]
    out = per_video.select(*row(F.lit(0), F.lit(200), F.to_json(entry)))

    shown = conv.where(listed & (F.col("role") == "user")) if run == 0 else conv.where(listed)
    item = F.struct(F.struct(F.struct(
        F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.struct(F.col("role").alias("authorDisplayName"), F.col("text").alias("textDisplay"), F.col("turn").alias("likeCount"), F.lit("2024-01-01T00:00:00Z").alias("publishedAt")).alias("snippet")
    ).alias("topLevelComment")).alias("snippet"))
    page_no = 1 + F.floor(F.col("turn") / PER_PAGE)
    pages = shown.groupBy("conv_id", page_no.alias("page")).agg(F.array_sort(F.collect_list(item)).alias("items"))   # PER_PAGE turns
    items = F.col("items") if run != 1 else F.concat("items", "items")
    body = F.to_json(F.struct(items.alias("items")))
    first_page = pages.where(F.col("conv_id") == middle).agg(F.min("page")).first()[0] if run else None
    if run == 1:
        refused = (F.col("conv_id") == middle) & (F.col("page") == first_page)
        quota = F.lit('{"error": {"errors": [{"reason": "quotaExceeded"}]}}')
        out = out.unionByName(pages.select(*row(F.col("page"), F.when(refused, 403).otherwise(200), F.when(refused, quota).otherwise(body))))
    else:
        out = out.unionByName(pages.select(*row(F.col("page"), F.lit(200), body)))
    one = per_video.where(F.col("conv_id") == middle)
    if run == 0:
        out = out.unionByName(one.select(*row(F.lit(1), F.lit(200), F.lit("{}"))).withColumn("video_id", F.lit(None).cast("string")))
    if run == 2:
        again = pages.where((F.col("conv_id") == middle) & (F.col("page") == first_page)).select(*row(F.col("page"), F.lit(200), body))
        out = out.unionByName(again.withColumn("run_date", F.lit(DAYS[1]).cast("date")))
        out = out.unionByName(one.select(*row(F.lit(99), F.lit(200), F.lit(BROKEN)))).unionByName(one.select(*row(F.lit(98), F.lit(500), F.lit(FAILED))))
    return out.select(*names(LANDING))


SQL_VIDEOS = f"""
m AS (SELECT max(conv_id) AS m FROM conversations),
s AS (SELECT m, (SELECT min(conv_id) FROM conversations WHERE 2 * conv_id >= m) AS stop FROM m),
v AS (SELECT t.*, s.m, s.stop FROM (SELECT conv_id, arg_min(text, turn) AS title, count(*) AS n FROM conversations GROUP BY 1) t, s WHERE regexp_matches(title, '[{RARE}]'))
"""


@register("daily_refresh", f"""
WITH {SQL_VIDEOS},
c AS (SELECT conv_id, CASE WHEN role = 'user' AND 3 * conv_id <= 2 * m THEN 0 WHEN 3 * conv_id >= m AND conv_id < stop THEN 1 ELSE 2 END AS r
      FROM (SELECT DISTINCT c.conv_id, c.turn, c.role, v.m, v.stop FROM conversations c JOIN v USING (conv_id))),
k AS (SELECT conv_id, count(*) AS n FROM c GROUP BY 1)
SELECT 'video' AS kind, v.conv_id::VARCHAR AS id, (v.n + 2000)::BIGINT AS a, (v.n + CASE WHEN 3 * v.conv_id <= 2 * m THEN 0 ELSE 1 END)::BIGINT AS b, k.n::BIGINT AS n,
       (CASE WHEN 3 * v.conv_id <= 2 * m THEN '{DAYS[0]}' ELSE '{DAYS[1]}' END)::DATE AS first_seen, '{DAYS[2]}'::DATE AS last_seen, NULL::VARCHAR AS note
FROM v JOIN k USING (conv_id)
UNION ALL
SELECT 'run', r::VARCHAR, (SELECT count(*) FROM c WHERE c.r = x.r)::BIGINT, (SELECT count(*) FROM v WHERE x.r = 2 OR 3 * conv_id <= 2 * m)::BIGINT, 0, NULL, NULL, NULL FROM range(3) AS x(r)
UNION ALL
SELECT 'dead letter', CASE WHEN p > 1 THEN stop::VARCHAR END, p::BIGINT, u::BIGINT, 0, NULL, NULL, w FROM s, (VALUES (1, 200, 'no key'), (99, 200, 'broken body'), (98, 500, 'status 500')) AS x(p, u, w)
""")
def q_daily_refresh(spark, sf):
    """Three runs over landed pages. Known, new and repeated comments, videos
    that stay, come and go, a quota stop whose pages wait for the next run, rows that cannot be read, a replayed batch."""
    root = run_folder(spark, "daily_refresh")
    refresh = Refresh(spark, f"{root}/state", "hebrew", C.PROFILE)
    for run in range(len(DAYS)):
        landed(spark, sf, run).write.mode("append").parquet(f"{root}/landing")
        refresh.run(f"{root}/landing")
    refresh.batch(landed(spark, sf, 2), 2)
    per_video = refresh.comments.read().groupBy("video_id").agg(F.count("*").alias("n"))
    none, no_note = F.lit(None).cast("date"), F.lit(None).cast("string")
    videos = refresh.videos.read().join(per_video, "video_id", "left").select(
        F.lit("video").alias("kind"), F.col("video_id").alias("id"), F.col("views").alias("a"), F.col("comment_count").alias("b"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), "first_seen", "last_seen", no_note.alias("note"))
    zero = F.lit(0).cast("long")
    totals = refresh.totals().select(F.lit("run"), F.col("run").cast("string"), "new_comments", "videos_tracked", zero, none, none, no_note)
    dead = refresh.dead_letters().select(F.lit("dead letter"), "video_id", F.col("page_no").cast("long"), F.col("status").cast("long"), zero, none, none, "why")
    return videos.union(totals).union(dead)


@register("incremental_counts", SQL_WORD_SOURCES)
def q_incremental_counts(spark, sf):
    """Counts of three deliveries added up as deltas, one of them replayed; equal to the counts of everything at once."""
    counts = Versions(spark, run_folder(spark, "counts"), COUNTS, summed(["word"]))
    parts = C.corpora(spark, sf)
    docs, news, conv = parts["songs"], parts["news"], parts["youtube"]
    late, reply = F.coalesce(F.col("lang") == "en", F.lit(False)), F.coalesce(F.col("role") == "assistant", F.lit(False))
    for batch, given in enumerate(({"songs": docs.where(~late), "news": news}, {"songs": docs.where(late), "youtube": conv.where(~reply)}, {"youtube": conv.where(reply)})):
        delta = frequency.word_sources(given, C.PROFILE)
        counts.add(delta, batch)
        if batch == 1:
            counts.add(delta, batch)
    return counts.read()


@register("daily_dataset", f"""
WITH {SQL_VIDEOS}, comments AS (SELECT c.* FROM conversations c JOIN v USING (conv_id))
SELECT * FROM ({SQL_VOCAB.replace("conversations", "comments")})
""")
def q_daily_dataset(spark, sf):
    """Refresh, counts and dataset as one daily function, run three times; the last result equals a
    recomputation over all tracked comments."""
    root = run_folder(spark, "daily_dataset")
    refresh = Refresh(spark, f"{root}/state", "hebrew", C.PROFILE)
    others = frequency.word_sources({k: v for k, v in C.corpora(spark, sf).items() if k != "youtube"}, C.PROFILE)
    out = None
    for run in range(len(DAYS)):
        landed(spark, sf, run).write.mode("append").parquet(f"{root}/landing")
        out = daily(refresh, f"{root}/landing", others, C.dictionary(spark, sf), lambda: comment_sentences(spark, sf, refresh), C.PROFILE)
    return out.drop("word_ord")


def comment_sentences(spark, sf, refresh: Refresh) -> DataFrame:
    from ..operators import sentences
    at = F.split("id", ":")
    conv = refresh.comments.read().select(at[0].cast("long").alias("conv_id"), at[1].cast("long").alias("turn"), F.col("author").alias("role"), "text")
    return sentences.sentence_rows(C.sentence_providers(spark, sf, conv), C.PROFILE)


@register("state_compaction", """
SELECT user_id::BIGINT AS user_id, min(ts::DATE) AS first_seen, max(ts::DATE) AS last_seen, arg_max(value, ts) AS last_value, count(*)::BIGINT AS n_events
FROM events GROUP BY 1
""")
def q_state_compaction(spark, sf):
    """K8 R2: nine micro-batches over a landing folder, their state segments merged level by level."""
    root = run_folder(spark, "compaction")
    ev = table(spark, sf, "events").select(F.col("user_id").cast("long"), "ts", "value")
    ev.repartitionByRange(9, "ts").write.parquet(f"{root}/landing")
    st = state_upsert_stream(spark, f"{root}/landing", ev.schema, "user_id", "ts", "value", f"{root}/state", f"{root}/ckpt", max_files=1)
    return st.select("user_id", "first_seen", "last_seen", "last_value", F.col("n_events").cast("long"))
