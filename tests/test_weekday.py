import pytest
from helpers import post, rows, stream
from pyspark.sql import functions as F

from postlark.operators import weekday
from postlark.sources import readers, writers


def captures(spark):
    days = {
        "wednesday": ["#WednesdayWisdom a  a", "#wednesday", "x\ny #Thursday", None, "   "],
        "thursday": ["#TBT #ThrowbackThursday #ThrowbackThursdays #tbt", "#TBT #Thursday1"],
        "saturday": ["#Caturday #caturday #Saturday", ""],
    }
    frames = [
        stream(spark, [post(text=text) for text in texts]).withColumn("day", F.lit(day))
        for day, texts in days.items()
    ]
    return frames[0].union(frames[1]).union(frames[2])


def test_post_counts_ignore_missing_texts(spark):
    expected = {("wednesday", 4), ("thursday", 2), ("saturday", 2)}
    assert set(rows(weekday.day_post_count(captures(spark)))) == expected


def test_word_counts(spark):
    counts = rows(weekday.day_word_counts(captures(spark)))
    assert counts[0] == ("thursday", "#TBT", 2, 100.0)
    assert ("wednesday", "a", 2, 50.0) in counts
    assert ("wednesday", "", 1, 25.0) in counts
    assert ("wednesday", "x\ny", 1, 25.0) in counts
    assert ("saturday", "", 1, 50.0) in counts
    assert not [row for row in counts if row[1] is None]


def test_share_of_posts_can_exceed_the_whole(spark):
    posts = stream(spark, [post(text="a a a")]).withColumn("day", F.lit("friday"))
    assert rows(weekday.day_word_counts(posts)) == [("friday", "a", 3, 300.0)]


@pytest.mark.parametrize("form", [weekday.day_tag_matches, weekday.day_tag_matches_sql])
def test_matches(spark, form):
    assert rows(form(captures(spark))) == [
        ("thursday", "#TBT", 2),
        ("saturday", "#Caturday", 1),
        ("saturday", "#Saturday", 1),
        ("thursday", "#ThrowbackThursday", 1),
        ("thursday", "#Thursday1", 1),
        ("wednesday", "#WednesdayWisdom", 1),
        ("wednesday", "#wednesday", 1),
    ]


def test_posts_without_a_day_stay(spark):
    posts = stream(spark, [post(text="a b"), post(text="a")])
    posts = posts.withColumn("day", F.lit(None).cast("string")).union(captures(spark))
    assert (None, 2) in rows(weekday.day_post_count(posts))
    counts = rows(weekday.day_word_counts(posts))
    assert (None, "a", 2, 100.0) in counts and (None, "b", 1, 50.0) in counts
    assert ("thursday", "#TBT", 2, 100.0) in counts


def test_captures_per_folder_and_per_partition(spark, tmp_path):
    posts = captures(spark)
    paths = {}
    for day in ("wednesday", "thursday", "saturday"):
        paths[day] = str(tmp_path / day)
        writers.write_parquet(posts.filter(F.col("day") == day).drop("day"), paths[day])
    writers.write_daily_captures(posts, str(tmp_path / "all"))
    expected = set(rows(weekday.day_word_counts(posts)))
    folders = readers.read_daily_captures(spark, paths)
    assert set(rows(weekday.day_word_counts(folders))) == expected
    partitioned = spark.read.parquet(str(tmp_path / "all"))
    assert set(rows(weekday.day_word_counts(partitioned))) == expected
