"""Compacted state and the daily refresh: merges, stops, replays, failed pages."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from wordloom.session import run_folder
from wordloom.streaming.refresh import COUNTS, LANDING, Refresh, names
from wordloom.streaming.versions import Versions, newest, summed, _spans, _with

KV = "k string, v long"


def kv(spark, rows):
    return spark.createDataFrame(rows, KV)


def state(df):
    return sorted(map(tuple, df.collect()))


def test_state_stays_small_however_many_batches(spark):
    s = Versions(spark, run_folder(spark, "test"), KV, newest(["k"]), fanout=3)
    want = {}
    rows_read = []
    for b in range(20):
        changes = {f"k{(b * 7 + j) % 11}": b * 10 + j for j in range(4)}
        want |= changes
        assert s.add(kv(spark, list(changes.items())), b)
        _, segments, batches = s.manifest()
        rows_read.append(sum(x.rows for x in segments))
        assert batches == [0, b] and all(sum(x.level == n for x in segments) < 3 for n in {x.level for x in segments})
    assert state(s.read()) == sorted(want.items())
    # eleven keys on at most two segments of each of a few levels
    assert max(rows_read) <= 2 * 4 + 2 * 11 * 3
    assert s.clean() > 0 and s.clean() == 0 and state(s.read()) == sorted(want.items())


def test_a_replayed_batch_changes_nothing_and_counts_add_up(spark):
    s = Versions(spark, run_folder(spark, "test"), KV, summed(["k"]), fanout=2)
    for b in range(5):
        assert s.add(kv(spark, [("a", 1), ("a", 1), (f"b{b}", 5)]), b)
        assert not s.add(kv(spark, [("a", 100)]), b)
    assert state(s.read()) == [("a", 10), *((f"b{b}", 5) for b in range(5))]


@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_a_crash_before_the_switch_loses_nothing(spark, monkeypatch, step):
    s = Versions(spark, run_folder(spark, "test"), KV, newest(["k"]), fanout=2)
    for b in range(3):
        s.add(kv(spark, [("a", b), (f"k{b}", b)]), b)
    before = state(s.read())
    real, calls = getattr(Versions, step), []

    def broken(self, *args):
        calls.append(args)
        if step == "_commit" or len(calls) > 1:   # after the new segment, in the compaction
            raise OSError("executor lost")
        return real(self, *args)

    monkeypatch.setattr(Versions, step, broken)
    with pytest.raises(OSError):
        s.add(kv(spark, [("a", 9)]), 3)
    monkeypatch.setattr(Versions, step, real)
    assert state(s.read()) == before
    assert s.add(kv(spark, [("a", 9)]), 3) and dict(state(s.read()))["a"] == 9
    assert s.clean() > 0 and dict(state(s.read()))["a"] == 9


def test_an_empty_state_and_an_empty_batch(spark):
    s = Versions(spark, run_folder(spark, "test"), KV, newest(["k"]))
    assert s.read().collect() == [] and s.clean() == 0
    assert s.add(kv(spark, []), 0) and not s.add(kv(spark, [("a", 1)]), 0)
    assert s.read().collect() == [] and s.manifest()[1] == []


def test_ranges_of_batches():
    flat = []
    for b in (0, 1, 5, 3, 4, 9):
        flat = _with(flat, b)
    assert flat == [0, 1, 3, 5, 9, 9] and [b for b in range(11) if b in _spans(flat)] == [0, 1, 3, 4, 5, 9]


# --- refresh ----------------------------------------------------------------------
DAY = [dt.date(2024, 1, 1 + k) for k in range(4)]


def entry(day, ord_, vid, title="שיר", views="1", comments="0", channel="c"):
    return (DAY[day], ord_, vid, 0, 200, json.dumps({"id": vid, "snippet": {"title": title, "channelTitle": channel, "publishedAt": "2023-05-06T07:08:09Z"},
                                                      "statistics": {"viewCount": views, "commentCount": comments}}))


def page(day, ord_, vid, no, *ids, status=200):
    items = [{"snippet": {"topLevelComment": {"id": i, "snippet": {"authorDisplayName": "x", "textDisplay": f"מילה {i}", "likeCount": 3, "publishedAt": "2024-01-01T00:00:00Z"}}}} for i in ids]
    return (DAY[day], ord_, vid, no, status, json.dumps({"items": items, "nextPageToken": "t"}))


def quota(day, ord_, vid, no):
    return (DAY[day], ord_, vid, no, 403, json.dumps({"error": {"errors": [{"reason": "quotaExceeded"}]}}))


def landing(spark, rows):
    return spark.createDataFrame(rows, LANDING)


@pytest.fixture
def refresh(spark):
    return Refresh(spark, run_folder(spark, "test"))


def videos(r):
    return {x.video_id: x for x in r.videos.read().collect()}


def comments(r):
    return sorted((x.video_id, x.id) for x in r.comments.read().collect())


def counted(r):
    return r.counts.read().agg(F.sum("youtube")).first()[0] or 0


def test_new_known_and_absent_videos(spark, refresh):
    refresh.batch(landing(spark, [entry(0, 0, "a", views="5", comments="7"), entry(0, 1, "b"), entry(0, 2, "latin", title="latin"), entry(0, 3, "ch", title="x", channel="ערוץ")]), 0)
    assert set(videos(refresh)) == {"a", "b", "ch"}
    refresh.batch(landing(spark, [entry(1, 0, "a", title="שם אחר", views="6", comments="9"), entry(1, 1, "n")]), 1)
    v = videos(refresh)
    assert (v["a"].title, v["a"].views, v["a"].likes, v["a"].comment_count, v["a"].first_seen, v["a"].last_seen) == ("שיר", 6, 0, 7, DAY[0], DAY[1])
    assert (v["b"].last_seen, v["n"].first_seen, v["a"].published_at) == (DAY[0], DAY[1], dt.date(2023, 5, 6))
    assert sorted(map(tuple, refresh.totals().collect())) == [(0, 0, 3), (1, 0, 4)]


def test_comments_are_appended_once(spark, refresh):
    refresh.batch(landing(spark, [entry(0, 0, "a"), page(0, 0, "a", 1, "1", "2", "1"), page(0, 0, "a", 2, "2", "3"), entry(0, 1, "latin", title="x"), page(0, 1, "latin", 1, "9"), page(0, 5, "nobody", 1, "8")]), 0)
    assert comments(refresh) == [("a", "1"), ("a", "2"), ("a", "3")]
    refresh.batch(landing(spark, [entry(1, 0, "a"), page(1, 0, "a", 1, "3", "4"), entry(1, 1, "b"), page(1, 1, "b", 1, "1")]), 1)
    assert comments(refresh) == [("a", "1"), ("a", "2"), ("a", "3"), ("a", "4"), ("b", "1")]
    assert sorted(map(tuple, refresh.totals().collect())) == [(0, 3, 1), (1, 2, 2)]
    assert counted(refresh) == 5   # one word of the script in each


def test_quota_keeps_finished_videos_and_retries_the_rest(spark, refresh):
    run = [entry(0, 0, "a"), page(0, 0, "a", 1, "1"), entry(0, 1, "b", views="3"), page(0, 1, "b", 1, "2"), quota(0, 1, "b", 2), entry(0, 2, "c"), page(0, 2, "c", 1, "4")]
    refresh.batch(landing(spark, run), 0)
    assert comments(refresh) == [("a", "1")] and set(videos(refresh)) == {"a", "b"}
    waiting = sorted((x.video_id, x.page_no, x.status) for x in refresh.pending.read().where("open").collect())
    assert waiting == [("b", 1, 200), ("b", 2, 403), ("c", 0, 200), ("c", 1, 200)]
    # a run without an answer for that page leaves everything waiting, its own videos go on
    refresh.batch(landing(spark, [entry(1, 0, "d"), page(1, 0, "d", 1, "7")]), 1)
    assert comments(refresh) == [("a", "1"), ("d", "7")] and refresh.pending.read().where("open").count() == 4
    refresh.batch(landing(spark, [page(0, 1, "b", 2, "3", "2")]), 2)
    assert comments(refresh) == [("a", "1"), ("b", "2"), ("b", "3"), ("c", "4"), ("d", "7")]
    assert refresh.pending.read().where("open").count() == 0 and videos(refresh)["c"].first_seen == DAY[0]
    assert sorted(map(tuple, refresh.totals().collect())) == [(0, 1, 2), (1, 1, 3), (2, 3, 4)]


def test_rows_that_cannot_be_read_are_kept_apart(spark, refresh):
    refresh.batch(landing(spark, [entry(0, 0, "a"), page(0, 0, "a", 1, "1"), (DAY[0], 0, "a", 2, 200, '{"items": ['), (DAY[0], 0, "a", 3, 500, "x"), (DAY[0], 0, "a", 4, 200, None), (DAY[0], 0, "a", 5, None, "{}"),
                                  (DAY[0], 0, None, 1, 200, "{}"), (None, 0, "a", 1, 200, "{}"), (DAY[0], 0, "a", 6, 200, "{}"), (DAY[0], 1, "b", 0, 403, "{}")]), 0)
    assert comments(refresh) == [("a", "1")]
    assert sorted((x.page_no, x.why) for x in refresh.dead_letters().collect()) == [(0, "status 403"), (1, "no key"), (1, "no key"), (2, "broken body"), (3, "status 500"), (4, "broken body"), (5, "status none")]


@pytest.mark.parametrize("where", ["comments", "counts", "pending"])
def test_a_batch_that_was_cut_off_is_completed_by_its_replay(spark, refresh, monkeypatch, where):
    refresh.batch(landing(spark, [entry(0, 0, "a"), page(0, 0, "a", 1, "1"), quota(0, 1, "b", 1), entry(0, 1, "b")]), 0)
    second = landing(spark, [entry(1, 0, "a"), page(1, 0, "a", 1, "1", "2"), page(0, 1, "b", 1, "5")])
    table, real = getattr(refresh, where), Versions.add

    def cut_off(self, changes, batch):
        if self is table:
            raise OSError("driver lost")
        return real(self, changes, batch)

    monkeypatch.setattr(Versions, "add", cut_off)
    with pytest.raises(OSError):
        refresh.batch(second, 1)
    monkeypatch.setattr(Versions, "add", real)
    for _ in range(2):
        refresh.batch(second, 1)
        assert comments(refresh) == [("a", "1"), ("a", "2"), ("b", "5")] and counted(refresh) == 3
        assert sorted(map(tuple, refresh.totals().collect())) == [(0, 1, 2), (1, 2, 2)] and refresh.pending.read().where("open").count() == 0


def test_runs_over_a_landing_folder_resume(spark, refresh):
    at = f"{refresh.root}/landing"
    for day in range(3):
        landing(spark, [entry(day, 0, "a", views=str(day)), page(day, 0, "a", 1, *map(str, range(day + 1)))]).write.mode("append").parquet(at)
        again = Refresh(spark, refresh.root)   # a new process on the same folders
        again.run(at)
        again.run(at)
        assert comments(again) == [("a", str(k)) for k in range(day + 1)] and videos(again)["a"].views == day
    assert sorted(map(tuple, refresh.totals().collect())) == [(0, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert names(COUNTS) == ["word", "songs", "news", "youtube", "total"] and os.path.basename(at) == "landing"
