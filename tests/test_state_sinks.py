"""Incremental refresh, streaming restart and sinks."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from wordloom.sinks import writers as W
from wordloom.sinks.merge import upsert
from wordloom.streaming import incremental as I

VIDEO = ("video_id string, title string, channel string, published_at date, views long, likes long, "
         "comment_count long, first_seen date, last_seen date")


def test_refresh_videos_policy(spark):
    d1, d2 = dt.date(2026, 3, 1), dt.date(2026, 3, 2)
    state = spark.createDataFrame([("v1", "ישן", "c", d1, 10, 1, 5, d1, d1),
                                   ("v2", "old", "ערוץ", d1, 20, 2, 6, d1, d1)], VIDEO)
    today = spark.createDataFrame([("v1", "חדש", "c2", d1, 11, 3, 99, None, None),
                                   ("v3", "new שיר", "c", d2, 1, 0, 0, None, None),
                                   ("v4", "english only", "chan", d2, 1, 0, 0, None, None)], VIDEO)
    out = {r.video_id: r for r in I.refresh_videos(state, today, "2026-03-02").collect()}
    assert set(out) == {"v1", "v2", "v3"}  # v4 filtered out (no script in title or channel)
    v1 = out["v1"]
    assert (v1.title, v1.views, v1.likes, v1.comment_count, v1.first_seen, v1.last_seen, v1.action) == (
        "ישן", 11, 3, 5, d1, d2, "update")
    assert (out["v2"].views, out["v2"].last_seen, out["v2"].action) == (20, d1, "keep")
    assert (out["v3"].first_seen, out["v3"].last_seen, out["v3"].action) == (d2, d2, "insert")


def test_new_comments_dedupe(spark):
    known = spark.createDataFrame([("v1", "c1")], "video_id string, id string")
    fetched = spark.createDataFrame([("v1", "c1", 0, "a"), ("v1", "c2", 1, "b"), ("v1", "c2", 2, "b2"),
                                     ("v2", "c1", 3, "x"), ("v9", "c5", 4, "y"), ("v1", None, 5, "z")],
                                    "video_id string, id string, ord long, text string")
    vids = spark.createDataFrame([("v1",), ("v2",)], "video_id string")
    got = sorted((r.video_id, r.id, r.text) for r in I.new_comments(known, fetched, vids).collect())
    assert got == [("v1", "c2", "b"), ("v2", "c1", "x")]


def test_upsert_keeps_flag(spark):
    t = spark.createDataFrame([("a", True, "d1"), ("b", False, "d2")], "word string, multiple_meanings boolean, data string")
    u = spark.createDataFrame([("a", False, "n1"), ("c", True, "n3")], "word string, multiple_meanings boolean, data string")
    got = sorted(tuple(r) for r in upsert(t, u, "word", replace=["data"]).collect())
    assert got == [("a", True, "n1", "update"), ("b", False, "d2", "keep"), ("c", True, "n3", "insert")]


def test_upsert_takes_the_last_of_repeated_keys(spark):
    t = spark.createDataFrame([("a", True, "d1")], "word string, flag boolean, data string")
    u = spark.createDataFrame([("a", False, "n1", 1), ("a", False, "n2", 2), ("c", True, "n4", 9), ("c", True, "n3", 3)], "word string, flag boolean, data string, ord long")
    got = sorted(tuple(r) for r in upsert(t, u, "word", replace=["data"], order="ord").collect())
    assert got == [("a", True, "n2", "update"), ("c", True, "n4", "insert")]


def test_video_and_comment_payloads(spark):
    body = '{"id": "v1", "snippet": {"title": "t", "channelTitle": "c", "publishedAt": "2026-03-01T10:00:00Z"}, "statistics": {"viewCount": "7"}}'
    schema = "id string, snippet struct<title:string,channelTitle:string,publishedAt:string>, statistics struct<viewCount:string,likeCount:string,commentCount:string>"
    raw = spark.createDataFrame([(body,)], "b string").select(F.from_json("b", schema).alias("p")).select("p.*")
    assert tuple(I.video_fields(raw).first()) == ("v1", "t", "c", dt.date(2026, 3, 1), 7, 0, 0)
    top = "struct<id:string,snippet:struct<authorDisplayName:string,textDisplay:string,likeCount:int,publishedAt:string>>"
    c = spark.createDataFrame([("v1", 0, (("c1", ("me", "hi", 3, "2026-03-02T00:00:00Z")),))], f"video_id string, ord long, snippet struct<topLevelComment:{top}>")
    assert tuple(I.comment_fields(c).first()) == ("v1", 0, "c1", "me", "hi", 3, dt.date(2026, 3, 2))


def test_dedupe_stream_restart(spark):
    base = tempfile.mkdtemp(prefix="wl-stream-")
    schema = "event_id long, v string"
    spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], schema).write.parquet(f"{base}/in/b1")
    first = I.dedupe_stream(spark, f"{base}/in/*", spark.createDataFrame([], schema).schema,
                            ["event_id"], f"{base}/out", f"{base}/ck")
    assert sorted(r.event_id for r in first.collect()) == [1, 2]
    # second delivery replays id 2 and adds id 3; restart on the same checkpoint
    spark.createDataFrame([(2, "b"), (3, "c")], schema).write.parquet(f"{base}/in/b2")
    again = I.dedupe_stream(spark, f"{base}/in/*", spark.createDataFrame([], schema).schema,
                            ["event_id"], f"{base}/out", f"{base}/ck")
    assert sorted(r.event_id for r in again.collect()) == [1, 2, 3]


def test_state_upsert_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="wl-state-")
    schema = "user_id long, ts timestamp, value double"
    rows1 = [(1, dt.datetime(2024, 1, 1, 1), 1.0), (1, dt.datetime(2024, 1, 3), 3.0), (2, dt.datetime(2024, 1, 2), 5.0)]
    rows2 = [(1, dt.datetime(2024, 1, 2), 2.0), (2, dt.datetime(2024, 1, 9), 9.0), (3, dt.datetime(2024, 1, 4), 4.0)]
    spark.createDataFrame(rows1, schema).write.parquet(f"{base}/in/d1")
    st_schema = spark.createDataFrame([], schema).schema
    I.state_upsert_stream(spark, f"{base}/in/*", st_schema, "user_id", "ts", "value", f"{base}/state", f"{base}/ck")
    spark.createDataFrame(rows2, schema).write.parquet(f"{base}/in/d2")
    st = I.state_upsert_stream(spark, f"{base}/in/*", st_schema, "user_id", "ts", "value",
                               f"{base}/state", f"{base}/ck")
    batch = I.entity_state(spark.createDataFrame(rows1 + rows2, schema), "user_id", "ts", "value")
    cols = ["user_id", "first_seen", "last_seen", "last_value", "n_events"]
    assert sorted(tuple(r) for r in st.select(*cols).collect()) == sorted(tuple(r) for r in batch.select(*cols).collect())


def test_sql_defaults_and_documents(spark):
    df = spark.createDataFrame([(None, None, None)], "hebrew string, root string, tables array<string>")
    assert tuple(W.sql_defaults(df).first()) == ("", "", "-", "", "", "", "")
    doc = W.document(spark.createDataFrame([("x",)], "hebrew string"), with_tables=True).first()
    assert doc.asDict() == {"hebrew": "x", "transcription": "", "root": "-", "part_of_speech": "",
                            "meaning": "", "word_url": "", "tables": []}


def test_batched_writer_flushes(spark):
    import json
    import os
    out = tempfile.mkdtemp(prefix="wl-batch-")

    def insert_many(batch):
        with open(os.path.join(out, f"{os.getpid()}-{id(batch)}-{len(os.listdir(out))}.json"), "w") as f:
            json.dump(batch, f)

    df = spark.range(0, 5, numPartitions=1).withColumn("hebrew", F.col("id").cast("string"))
    W.write_batched(df, insert_many, batch_size=2)
    sizes = sorted(len(json.load(open(os.path.join(out, p)))) for p in os.listdir(out))
    assert sizes == [1, 2, 2]


def test_csv_skipped_when_empty(spark):
    out = tempfile.mkdtemp(prefix="wl-csv-")
    assert W.write_csv(spark.createDataFrame([], "a string"), f"{out}/x") is False
    assert W.write_csv(spark.createDataFrame([("1",)], "a string"), f"{out}/y") is True


def test_load_state_keeps_last_at_first_position(spark):
    rows = spark.createDataFrame([(0, "v1", "a"), (1, "v2", "b"), (2, "v1", "c"), (3, "v3", "d"), (4, "v2", "e")],
                                 "ord long, video_id string, title string")
    got = sorted((r.ord, r.video_id, r.title) for r in I.load_state(rows, "video_id").collect())
    d = {}
    for o, k, t in sorted(rows.collect()):
        d[k] = (o, t) if k not in d else (d[k][0], t)  # dict: last value, first position
    assert got == sorted((o, k, t) for k, (o, t) in d.items())


def test_refresh_comments_totals(spark):
    d1 = dt.date(2026, 3, 1)
    state = spark.createDataFrame([("v1", "ישן", "c", d1, 10, 1, 5, d1, d1)], VIDEO)
    today = spark.createDataFrame([("v1", "ישן", "c", d1, 12, 1, 5, None, None),
                                   ("v2", "שיר", "c", d1, 1, 0, 0, None, None)], VIDEO)
    known = spark.createDataFrame([("v1", "c1", "a", "t", 0, d1)],
                                  "video_id string, id string, author string, text string, likes long, published_at date")
    fetched = spark.createDataFrame([("v1", "c1", "a", "t", 0, d1, 0), ("v1", "c2", "b", "u", 1, d1, 1),
                                     ("v2", "c9", "x", "y", 2, d1, 2)],
                                    "video_id string, id string, author string, text string, likes long, "
                                    "published_at date, ord long")
    videos, comments, totals = I.refresh_comments(state, known, today, fetched, "2026-03-02")
    t = totals.first()
    assert (t.new_comments, t.videos_tracked) == (2, 2)
    assert sorted(r.id for r in comments.collect()) == ["c1", "c2", "c9"]
    assert {r.video_id: r.views for r in videos.collect()} == {"v1": 12, "v2": 1}


def test_payload_items(spark):
    from wordloom.sources.tables import payload_items
    landing = spark.createDataFrame([("w1", 1, '{"results": [{"text": "a"}, {"text": "b"}]}'),
                                     ("w2", 1, '{"other": 1}'), ("w3", 1, '{"response": {"hits": []}}')],
                                    "word string, page_no int, body string")
    got = sorted((r.word, r.item_pos, r.item.text) for r in
                 payload_items(landing, "results array<struct<text:string>>", "results", ["word"]).collect())
    assert got == [("w1", 0, "a"), ("w1", 1, "b")]
    hits = payload_items(landing, "response struct<hits:array<struct<result:struct<path:string>>>>",
                         "response.hits", ["word"])
    assert hits.count() == 0


def test_corpus_texts_and_song_lyrics(spark):
    from wordloom.operators import frequency, pages
    lines = spark.createDataFrame([("שיר אחד",)], "value string")
    arts = spark.createDataFrame([("כותרת", "גוף"), (None, "רק")], "title string, text string")
    vids = spark.createDataFrame([("v", [{"text": "תגובה"}, {"text": None}])],
                                 "video_id string, comments array<struct<text:string>>")
    ws = frequency.word_sources(frequency.corpus_texts(lines, arts, vids), "hebrew")
    got = {r.word: (r.songs, r.news, r.youtube) for r in ws.collect()}
    assert got == {"שיר": (1, 0, 0), "אחד": (1, 0, 0), "כותרת": (0, 1, 0), "גוף": (0, 1, 0), "רק": (0, 1, 0),
                   "תגובה": (0, 0, 1)}
    pg = spark.createDataFrame([("https://l/1", '<div data-lyrics-container="true">שורה</div>'),
                                ("https://l/2", '<div data-lyrics-container="true">אחרת</div>')],
                               "url string, html string")
    songs = spark.createDataFrame([("https://l/1", "A/B", "T?"), ("https://l/9", "x", "y")],
                                  "url string, artist string, title string")
    f = pages.song_lyrics(pg, songs).collect()
    assert [(r.file_name, r.body) for r in f] == [("AB - T.txt", "T? - A/B\n\nשורה")]


def test_dedupe_stream_within_watermark(spark):
    base = tempfile.mkdtemp(prefix="wl-wm-")
    schema = "event_id long, ts timestamp"
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t), (1, t + dt.timedelta(minutes=1)), (2, t)], schema).write.parquet(f"{base}/in/a")
    out = I.dedupe_stream(spark, f"{base}/in/*", spark.createDataFrame([], schema).schema, ["event_id"],
                          f"{base}/out", f"{base}/ck", watermark=("ts", "1 hour"))
    assert sorted(r.event_id for r in out.collect()) == [1, 2]
