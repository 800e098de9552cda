"""Streams by event time against batch results: late posts, repeats, cursors."""

import datetime as dt
import json
import time

import pytest
from helpers import rows
from pyspark.sql import functions as F

from postlark import schemas
from postlark.operators.paging import parse_pages, search_page_cursor
from postlark.streaming import cursors, event_time
from postlark.streaming.landing import feed_stream


def line(number, when, text="x"):
    return json.dumps({"data": {"id": str(number), "created_at": when, "text": text}})


def add(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(text + "\n" for text in lines))


def posts(spark, folder):
    return event_time.timed(feed_stream(spark, str(folder), schemas.STREAM_POST))


def run(stream, tmp_path):
    event_time.append(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / "out"))


def test_days_close_behind_the_watermark(spark, tmp_path):
    feed = tmp_path / "feed"
    first = [line(n, f"2021-04-0{1 + n % 3}T0{n % 8}:00:00.000Z") for n in range(12)]
    first += [line(90, "soon"), line(91, None), line(92, "2021-04-01T23:59:59Z", None)]
    add(feed, "a", first)
    counted = run(event_time.daily_counts(posts(spark, feed), "1 day"), tmp_path)
    # The latest time is 3 April, 05:00, so the watermark is in 2 April and 1 April is closed.
    assert rows(counted) == [(dt.date(2021, 4, 1), 4)]
    late = [line(20, "2021-04-01T12:00:00Z"), line(21, "2021-04-02T12:00:00Z")]
    add(feed, "b", [*late, line(22, "2021-04-06T01:00:00Z")])
    counted = run(event_time.daily_counts(posts(spark, feed), "1 day"), tmp_path)
    assert sorted(rows(counted)) == [
        (dt.date(2021, 4, 1), 4), (dt.date(2021, 4, 2), 5), (dt.date(2021, 4, 3), 4)
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_days_are_those_of_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = ["2021-04-01T23:59:59.999Z", "2021-04-02T00:00:00Z", "2021-04-02T01:00:00+02:00"]
        made = spark.createDataFrame([(json.loads(line(1, t))["data"],) for t in times],
                                     "data STRUCT<id: STRING, created_at: STRING, text: STRING>")
        counted = event_time.daily_counts(event_time.timed(made))
        assert sorted(rows(counted)) == [(dt.date(2021, 4, 1), 2), (dt.date(2021, 4, 2), 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_repeats_over_a_restart(spark, tmp_path):
    feed = tmp_path / "feed"
    times = [f"2021-04-01T00:{n:02}:00Z" for n in range(10)]
    add(feed, "a", [line(n, t) for n, t in enumerate(times)] + [line(3, times[3]), line(77, None)])
    run(event_time.distinct_posts(posts(spark, feed), "1 hour"), tmp_path)
    again = [line(n, times[n]) for n in range(5, 10)] + [line(77, None), line(11, times[9])]
    add(feed, "b", again + ["{broken"])
    found = run(event_time.distinct_posts(posts(spark, feed), "1 hour"), tmp_path)
    ids = sorted(row.id or "" for row in found.select("data.id").collect())
    # A post without a time is no known repeat, nor is a broken line.
    assert ids == sorted([*map(str, range(10)), "11", "77", "77", ""])


def page(key, oldest, hit=True):
    data = [{"id": str(oldest)}] if hit else None
    return json.dumps({"username": key, "data": data, "meta": {"oldest_id": str(oldest)}})


BATCHES = [
    [page("a", 9_007_199_254_740_993), page("b", 5), page(None, 4)],
    [page("a", 9_007_199_254_740_992), page("c", 1, hit=False), page("b", 7), page("b", 6)],
    [page("c", 3), page("c", 8)],
]


def test_cursors_equal_the_batch_query_after_each_batch(spark, tmp_path):
    feed, target = tmp_path / "feed", str(tmp_path / "out")
    schema = f"username STRING, {schemas.CURSOR_PAGE}"
    for n, lines in enumerate(BATCHES):
        add(feed, f"f{n}", lines)
        stream = parse_pages(feed_stream(spark, str(feed)), schema)
        changes = cursors.cursor_changes(stream)
        cursors.follow(changes, target, str(tmp_path / "check")).awaitTermination()
        written = spark.read.schema(changes.schema).parquet(f"{target}/batch=*")
        so_far = parse_pages(spark.read.text(str(feed)), schema)
        expected = search_page_cursor(so_far.withColumn("username", F.coalesce("username", F.lit(""))))
        assert sorted(rows(cursors.latest(written))) == sorted(rows(expected))
    changed = spark.read.parquet(f"{target}/batch=*").where("NOT stalled")
    assert changed.count() == sum(len({json.loads(p)["username"] for p in b}) for b in BATCHES)


def test_stalled_keys_are_told(spark, tmp_path):
    feed, target = tmp_path / "feed", str(tmp_path / "out")
    schema = f"username STRING, {schemas.CURSOR_PAGE}"
    for n, lines in enumerate(BATCHES[:2]):
        add(feed, f"f{n}", lines)
        stream = parse_pages(feed_stream(spark, str(feed)), schema)
        changes = cursors.cursor_changes(stream, stall_seconds=0.5)
        cursors.follow(changes, target, str(tmp_path / "check")).awaitTermination()
        time.sleep(1)
    stalled = spark.read.parquet(f"{target}/batch=*").where("stalled")
    assert "" in {row.username for row in stalled.collect()}
