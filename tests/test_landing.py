import json
import os
import time
from types import SimpleNamespace

import pytest
from helpers import frame, post, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postlark import schemas, session
from postlark.operators import paging, tags
from postlark.sources import readers, writers
from postlark.streaming.landing import feed_stream, land, stream_land

PAGES = [
    ("k1", {"data": [post("9"), post("8")], "meta": {"newest_id": "9", "oldest_id": "8"}}),
    ("k1", {"data": [post("11"), post("10")], "meta": {"newest_id": "11", "oldest_id": "10"}}),
    ("k1", {"meta": {"result_count": 0}}),
    ("k2", {"data": None, "meta": None}),
    ("k3", {"data": [post("5", text='say "oldest_id":"1"')], "meta": {"oldest_id": "5"}}),
]


def lines(spark):
    text = [(key, json.dumps(page, separators=(",", ":"))) for key, page in PAGES]
    return spark.createDataFrame(text, "username STRING, value STRING")


def write_lines(path, documents):
    path.mkdir(exist_ok=True)
    name = f"part-{len(list(path.iterdir()))}.json"
    (path / name).write_text("".join(json.dumps(d) + "\n" for d in documents))
    return str(path)


def test_cursor_compares_ids_as_numbers(spark):
    expected = {("k1", 2, "8"), ("k2", 0, None), ("k3", 1, "5")}
    parsed = paging.parse_pages(lines(spark))
    assert set(rows(paging.search_page_cursor(parsed))) == expected
    assert set(rows(paging.search_page_cursor_by_pattern(lines(spark)))) == expected


def test_pages_take_their_key_from_the_path(spark, tmp_path):
    for user in ("ann", "bob"):
        write_lines(tmp_path / f"user={user}", [{"data": [post()]}])
    pages = readers.read_search_pages(spark, str(tmp_path / "user=*"), "json")
    keyed = paging.key_pages_by_path(pages, "user=([^/]+)/")
    assert sorted(row.username for row in keyed.collect()) == ["ann", "bob"]


def test_pages_to_posts_feed_the_stream_operators(spark):
    posts = [post("1", tags=["a", "b"]), post("2", tags=["b", "b"])]
    pages = frame(spark, schemas.SEARCH_PAGE, [{"data": posts}, {"data": None}])
    shaped = paging.stream_shape(paging.pages_to_posts(pages))
    assert rows(tags.multi_tag_counts(shaped)) == [("b", 3), ("a", 1)]


def test_page_conversion(spark, tmp_path):
    source = write_lines(tmp_path / "pages", [page for _, page in PAGES])
    target = str(tmp_path / "posts")
    writers.pages_to_parquet(spark, source, target, schemas.SEARCH_PAGE)
    stored = spark.read.parquet(target)
    assert stored.columns == ["col", schemas.LINE, schemas.CORRUPT_RECORD]
    ids = sorted(int(row.id) for row in stored.select("col.id").collect())
    assert ids == [5, 8, 9, 10, 11]
    with pytest.raises(AnalysisException):
        writers.pages_to_parquet(spark, source, target, schemas.SEARCH_PAGE)
    writers.pages_to_parquet(spark, source, target, schemas.SEARCH_PAGE, mode="overwrite")
    assert spark.read.parquet(target).count() == 5


def test_conversions_lose_nothing(spark, tmp_path):
    """Fields outside the schema and broken lines are in what is written."""
    extra = {**post("1", tags=["a"]), "edit_controls": {"edits": 5}, "conversation_id": "77"}
    folder = tmp_path / "feed"
    source = write_lines(folder, [{"data": extra, "includes": {"users": [1]}}, {"data": post("2")}])
    (folder / "broken.json").write_text('{"data": {"id": "3"\n\n')
    target = str(tmp_path / "documents")
    writers.json_to_parquet(spark, source, target, schemas.STREAM_POST)
    stored = spark.read.parquet(target)
    assert stored.count() == 3
    broken = stored.filter(F.col(schemas.CORRUPT_RECORD).isNotNull())
    assert [row[schemas.LINE] for row in broken.collect()] == ['{"data": {"id": "3"']
    (first,) = stored.filter("data.id = '1'").collect()
    assert first.data.conversation_id == "77"
    assert json.loads(first[schemas.LINE])["data"]["edit_controls"] == {"edits": 5}
    assert json.loads(first[schemas.LINE])["includes"] == {"users": [1]}
    expected = spark.read.schema(schemas.STREAM_POST).json(f"{source}/part-0.json")
    assert expected.subtract(stored.select("data")).count() == 0


def test_page_expansion_loses_nothing(spark, tmp_path):
    extra = {**post("1"), "note_tweet": {"text": "long"}}
    folder = tmp_path / "pages"
    source = write_lines(folder, [{"data": [extra, post("2")]}, {"meta": {"result_count": 0}}])
    (folder / "broken.json").write_text('{"data": [{"id": "3"\n')
    target = str(tmp_path / "posts")
    writers.pages_to_parquet(spark, source, target, schemas.SEARCH_PAGE)
    found = {row.col.id if row.col else None: row for row in spark.read.parquet(target).collect()}
    assert set(found) == {"1", "2", None}
    assert json.loads(found["1"][schemas.LINE])["note_tweet"] == {"text": "long"}
    assert found[None][schemas.CORRUPT_RECORD] == '{"data": [{"id": "3"'


def test_old_files_that_arrive_late_are_landed(spark, tmp_path):
    folder = tmp_path / "feed"
    target, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    source = write_lines(folder, [{"data": post("1")}])
    stream_land(spark, source, target, checkpoint, schemas.STREAM_POST)
    write_lines(folder, [{"data": post("2")}])
    ten_days_ago = time.time() - 10 * 86_400
    os.utime(folder / "part-1.json", (ten_days_ago, ten_days_ago))
    write_lines(folder, [{"data": post("3")}])
    stream_land(spark, source, target, checkpoint, schemas.STREAM_POST)
    landed = spark.read.parquet(target).select("data.id").collect()
    assert sorted(row.id for row in landed) == ["1", "2", "3"]


def test_stream_landing_continues_behind_its_checkpoint(spark, tmp_path):
    folder = tmp_path / "feed"
    target, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    source = write_lines(folder, [{"data": post(str(n))} for n in range(25)])

    def landed():
        stream_land(
            spark, source, target, checkpoint, schemas.STREAM_POST, records_per_file=10,
            files_per_trigger=1,
        )
        return spark.read.parquet(target)

    assert landed().count() == 25
    files = landed().select(F.input_file_name().alias("file")).groupBy("file").count()
    assert sorted(count for _, count in rows(files)) == [5, 10, 10]
    write_lines(folder, [{"data": post(str(n))} for n in range(25, 32)])
    assert sorted(int(r.id) for r in landed().select("data.id").collect()) == list(range(32))


def test_stream_landing_keeps_broken_lines_and_running(spark, tmp_path):
    folder = tmp_path / "feed"
    source = write_lines(folder, [{"data": post("1")}])
    (folder / "broken.json").write_text("{broken\n")
    target, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    query = land(
        feed_stream(spark, source, schemas.STREAM_POST), target, checkpoint, interval="1 second"
    )
    try:
        query.processAllAvailable()
        write_lines(folder, [{"data": post("2")}])
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    landed = spark.read.parquet(target)
    assert landed.count() == 3
    broken = landed.filter(F.col(schemas.CORRUPT_RECORD).isNotNull())
    assert [row[schemas.CORRUPT_RECORD] for row in broken.collect()] == ["{broken"]


def test_stream_landing_of_raw_lines(spark, tmp_path):
    source = write_lines(tmp_path / "feed", [{"n": n} for n in range(5)])
    target = str(tmp_path / "landed")
    stream_land(spark, source, target, str(tmp_path / "checkpoint"), fmt="text")
    assert spark.read.text(target).count() == 5


def test_csv_report(spark, tmp_path):
    report = spark.range(100).repartition(4).orderBy(F.desc("id"))
    top, full = str(tmp_path / "top"), str(tmp_path / "full")
    writers.write_report_csv(report, top, top=3)
    (part,) = (tmp_path / "top").glob("part-*.csv")
    assert part.read_text() == "99\n98\n97\n"
    writers.write_report_csv(report, full)
    assert spark.read.csv(full).count() == 100
    with pytest.raises(AnalysisException):
        writers.write_report_csv(report, full)


def test_lexicon(spark, tmp_path):
    (tmp_path / "good").write_text("good\nenvious\n\nnaïve\n", encoding="utf-8")
    (tmp_path / "bad").write_text("bad\nenvious\n", encoding="utf-8")
    lexicon = readers.read_lexicon(spark, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert dict(rows(lexicon)) == {"good": 1, "envious": 1, "naïve": 1, "bad": -1}


def session_stand_in(**conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default))
    )


def test_scratch_uses_the_folder_the_session_names():
    named = session_stand_in(**{session.CHECKPOINT_CONF: "/shared/folder/"})
    first, second = (session.scratch_dir(named, "pages") for _ in range(2))
    assert first != second and first.startswith("/shared/folder/postlark/pages-")


def test_scratch_falls_back_on_the_default_file_system():
    path = session.scratch_dir(session_stand_in(), "pages")
    assert path.startswith(f"{session.DEFAULT_SCRATCH}/postlark/pages-")


def test_scratch_folders_can_be_removed(spark, tmp_path):
    path = str(tmp_path / "gone")
    spark.range(3).write.parquet(path)
    session.remove(spark, path)
    assert not (tmp_path / "gone").exists()
