import csv
import json

import pytest
from helpers import plan, post, stream, topic

from postlark import jobs
from postlark.schemas import CORRUPT_RECORD, LINE

def report(folder):
    found = []
    for part in sorted(folder.glob("part-*.csv")):
        with open(part, encoding="utf-8") as lines:
            found += list(csv.reader(lines))
    return found


@pytest.fixture
def posts(spark, tmp_path):
    path = str(tmp_path / "posts")
    made = [
        post(str(n), text="good day #TBT", author="a", tags=["x", "y"], topics=[topic()])
        for n in range(4)
    ]
    stream(spark, made).write.parquet(path)
    return path


def test_tags(posts, tmp_path):
    (tmp_path / "plus").write_text("day\n")
    (tmp_path / "minus").write_text("good\n")
    lists = ["--positive", str(tmp_path / "plus"), "--negative", str(tmp_path / "minus")]
    jobs.main(["--out", str(tmp_path / "out"), "tags", posts, "--min-count", "3", *lists])
    assert report(tmp_path / "out/avg_length") == [["x", "2.0"], ["y", "2.0"]]
    assert report(tmp_path / "out/sentiment_best") == [["x", "0.0"], ["y", "0.0"]]
    assert report(tmp_path / "out/multi_tag") == [["x", "4"], ["y", "4"]]
    assert report(tmp_path / "out/popular_account_tags") == [["x", "16"], ["y", "16"]]


def test_one_word_list_alone_is_refused(posts, tmp_path):
    (tmp_path / "plus").write_text("day\n")
    with pytest.raises(ValueError):
        jobs.main(["tags", posts, "--positive", str(tmp_path / "plus")])


def test_cursors_by_path(spark, tmp_path):
    for user in ("ann", "bob"):
        (tmp_path / f"user={user}").mkdir()
        page = {"data": [post("7")], "meta": {"oldest_id": "7"}}
        (tmp_path / f"user={user}/page.json").write_text(json.dumps(page) + "\n")
    source, out = f"{tmp_path}/user=*", str(tmp_path / "out")
    jobs.main(["--out", out, "cursors", source, "--key-pattern", "user=([^/]+)/"])
    assert sorted(report(tmp_path / "out/cursors")) == [["ann", "1", "7"], ["bob", "1", "7"]]


def test_topics_and_days(posts, tmp_path, capsys):
    jobs.main(["--out", str(tmp_path / "out"), "topics", posts])
    assert report(tmp_path / "out/topics") == [["D: E", "1.2", "4"]]
    assert report(tmp_path / "out/lang_shares") == [["D: E", "1.2", "4", "en", "4", "1.0"]]
    jobs.main(["days", f"thursday={posts}"])
    assert "|thursday|#TBT   |4    |" in capsys.readouterr().out


def test_pages(spark, tmp_path):
    page = {"username": "u", "data": [post("7", topics=[topic()])], "meta": {"oldest_id": "7"}}
    (tmp_path / "pages.json").write_text(json.dumps(page) + "\n")
    source, out = str(tmp_path / "pages.json"), str(tmp_path / "out")
    jobs.main(["--out", out, "cursors", source])
    assert report(tmp_path / "out/cursors") == [["u", "1", "7"]]
    jobs.main(["--out", out, "contexts", source, "--format", "json"])
    assert report(tmp_path / "out/context_lang_percent") == [["E (E)", "1", "en", "100.0"]]
    jobs.main(["convert", source, str(tmp_path / "whole"), "--documents", "search"])
    jobs.main(["convert", source, str(tmp_path / "each"), "--documents", "search", "--expand"])
    whole = spark.read.parquet(str(tmp_path / "whole"))
    assert whole.columns == ["data", "meta", CORRUPT_RECORD, LINE]
    assert whole.filter(whole[CORRUPT_RECORD].isNull()).count() == whole.count() == 1
    assert spark.read.parquet(str(tmp_path / "each")).columns == ["col", LINE, CORRUPT_RECORD]


def test_land(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed/a.json").write_text(json.dumps({"data": post("1")}) + "\n")
    paths = [str(tmp_path / name) for name in ("feed", "landed", "checkpoint")]
    jobs.main(["land", *paths])
    assert spark.read.parquet(paths[1]).count() == 1


def test_users(spark, tmp_path):
    account = {"name": "U", "username": "u", "public_metrics": {"followers_count": 2_000_000}}
    (tmp_path / "profiles.json").write_text(json.dumps({"data": [account]}) + "\n")
    page = {"username": "u", "data": [post(metrics=(3000, 0, 0, 1000)), post()]}
    (tmp_path / "timelines.json").write_text(json.dumps(page) + "\n")
    inputs = [str(tmp_path / name) for name in ("profiles.json", "timelines.json")]
    jobs.main(["--out", str(tmp_path / "out"), "users", *inputs])
    assert report(tmp_path / "out/avg_engagement") == [["U", "2.0", "1.0"]]
    # The reports sort one stored table: none of them reads the timelines again.
    args = jobs.parser().parse_args(["users", *inputs])
    for figures, _ in jobs.user_reports(spark, args).values():
        assert "FileScan parquet" in plan(figures) and "FileScan json" not in plan(figures)
    assert report(tmp_path / "out/total_engagement") == [["U", "4.0", "2.0"]]
    profile = ["U", "2.0", "2.0", "1.0", "75.0", "0.0", "25.0", "0.0"]
    assert report(tmp_path / "out/engagement_profile") == [profile]
