import os
import random
import re

import pytest
from helpers import plan, post, rows, stream
from pyspark.sql import functions as F

from postlark.operators import tags
from postlark.operators.joins import hot_key_join
from postlark.sources import readers
from postlark.sources.lexicon import DEFAULT_LEXICON, NEGATIVE_WORDS, POSITIVE_WORDS


def test_base_keeps_empty_tags_and_null_text(spark):
    posts = stream(
        spark,
        [
            post(text="a", tags=["t", "t"]),
            post(text="b", tags=[]),
            post(text=None, tags=["t"]),
            post(text="c", tags=None),
            post(text="d", lang="fr", tags=["t"]),
            post(text="e", lang=None, tags=["t"]),
        ],
    )
    expected = [("a", ["t", "t"]), ("b", []), (None, ["t"])]
    assert rows(tags.hashtag_base(posts)) == expected


def base(spark, uses):
    return spark.createDataFrame(
        [(text, hashtags) for text, hashtags in uses], "text STRING, hashtag ARRAY<STRING>"
    )


def test_frequency_threshold_is_strict(spark):
    df = base(spark, [("x", ["a", "a"])] * 50 + [("x", ["b"])] * 101)
    assert rows(tags.frequent_tags(df)) == [("b", 101)]
    assert set(rows(tags.frequent_tags(df, 99))) == {("a", 100), ("b", 101)}


def test_counts_add_up_to_the_exploded_rows(spark):
    df = base(spark, [("x", ["a", "b"]), ("y", []), ("z", None), ("w", ["a", "a", None])])
    counted = tags.frequent_tags(df, 0).agg(F.sum("count")).first()[0]
    assert counted == df.select(F.explode("hashtag")).count() == 5


def test_average_length(spark):
    df = base(
        spark,
        [("a b c", ["t"]), ("a @b", ["t"]), (None, ["t"]), ("a", ["u"]), ("a b", ["v", "v", "v"])],
    )
    assert rows(tags.avg_length_by_tag(df, 2)) == [("t", 2.0), ("v", 2.0)]
    assert rows(tags.avg_length_by_tag(df, 0))[-1] == ("u", 1.0)


def test_average_length_equals_the_join_form(spark):
    rng = random.Random(7)
    words = ["one", "two", "#three", "@four", ""]
    uses = [
        (
            " ".join(rng.choices(words, k=rng.randint(0, 9))),
            rng.choices(["a", "b", "c", None], k=rng.randint(0, 3)),
        )
        for _ in range(200)
    ]
    df = base(spark, uses)
    lengths = df.select(
        tags.content_word_count(F.col("text")).alias("length"), F.explode("hashtag").alias("tag")
    )
    frequent = tags.frequent_tags(df, 60)
    joined = (
        frequent.join(lengths, frequent.hashtag2 == lengths.tag)
        .groupBy("tag")
        .agg(F.round(F.avg("length"), 2))
    )
    assert set(rows(joined)) == set(rows(tags.avg_length_by_tag(df, 60)))


def test_sentiment(spark):
    lexicon = {"good": 1, "bad": -1}
    df = base(
        spark, [("Good good", ["a"]), ("bad", ["a", "b"]), (None, ["b", "c"]), ("meh", ["d"])]
    )
    assert rows(tags.tag_sentiment(df, lexicon)) == [
        ("a", 0.5),
        ("d", 0.0),
        ("b", -1.0),
        ("c", None),
    ]
    ascending = rows(tags.tag_sentiment(df, lexicon, descending=False))
    assert ascending == [("c", None), ("b", -1.0), ("d", 0.0), ("a", 0.5)]


def test_long_word_lists_are_joined_with_the_same_result(spark):
    rng = random.Random(3)
    words = [*POSITIVE_WORDS, *NEGATIVE_WORDS, "the", "a.b", "GOOD!", ""]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(150)]
    df = base(spark, [(text, ["t"]) for text in [*texts, *texts[:40], None, "", "   "]])
    lexicon = spark.createDataFrame(list(DEFAULT_LEXICON.items()), "word STRING, polarity INT")
    inline = tags.rate_text(df, DEFAULT_LEXICON)
    joined = tags.rate_text(df, lexicon)
    assert joined.columns == inline.columns
    key = str
    assert sorted(rows(inline), key=key) == sorted(rows(joined), key=key)


def test_weights_and_repeated_words_rate_alike(spark):
    texts = ["good bad", "good good odd", "both", "none", "", None]
    df = base(spark, [(text, ["t"]) for text in texts])
    listed = [("good", 3), ("good", 1), ("bad", -7), ("odd", 0), ("both", -1), ("both", 2)]
    lexicon = spark.createDataFrame([*listed, (None, 1)], "word STRING, polarity INT")
    inline = tags.rate_text(df, {"good": 3, "bad": -7, "odd": 0, "both": 2})
    expected = {"good bad": 0, "good good odd": 2, "both": 1, "none": 0, "": 0, None: None}
    assert {row.text: row.rating for row in inline.collect()} == expected
    assert {row.text: row.rating for row in tags.rate_text(df, lexicon).collect()} == expected


def test_a_common_word_is_spread_over_tasks(spark):
    texts = [f"the {n}" for n in range(2000)]
    df = base(spark, [(text, ["t"]) for text in texts])
    lexicon = spark.createDataFrame([("the", 1), ("7", -1)], "word STRING, polarity INT")
    uses = df.select(F.sha2("text", 256).alias("_digest"), F.explode(F.split("text", " ")).alias("word"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hot_key_join(uses, lexicon, "word", 100)
        sizes = joined.filter("word = 'the'").groupBy(F.spark_partition_id().alias("p")).count()
        counts = [count for _, count in rows(sizes)]
        assert sum(counts) == 2000 and max(counts) < 1000
        rated = tags.rate_text(df, lexicon)
        assert "SortMergeJoin [word" in plan(rated)
        assert rated.agg(F.sum("rating")).first()[0] == 1999
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_best_and_worst_are_opposite_orders(spark):
    df = base(spark, [("good", ["b"]), ("good", ["a"]), ("bad", ["c"]), ("good bad bad bad", ["d"])])
    lexicon = {"good": 1, "bad": -1}
    best = rows(tags.tag_sentiment(df, lexicon))
    worst = rows(tags.tag_sentiment(df, lexicon, descending=False))
    assert best == [("a", 1.0), ("b", 1.0), ("c", -1.0), ("d", -2.0)]
    assert worst == [("d", -2.0), ("c", -1.0), ("a", 1.0), ("b", 1.0)]


STORED = os.environ.get("STORED_RESULTS")
DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


@pytest.mark.skipif(not STORED, reason="STORED_RESULTS names no folder")
def test_stored_word_lists_rate_like_a_plain_loop(spark):
    paths = [f"{STORED}/{name}-words" for name in ("positive", "negative")]
    good, bad = (set(open(path, encoding="utf-8").read().split("\n")) - {""} for path in paths)
    assert (len(good), len(bad), len(good & bad)) == (2006, 4783, 3)

    def rate(text):
        kept = (re.sub("[.|,;?+!]", "", word) for word in re.split(" +", text.lower()))
        return sum(1 if word in good else -1 if word in bad else 0 for word in kept)

    texts = [row.text for row in spark.read.parquet(DOCUMENTS).select("text").collect()]
    rng = random.Random(5)
    listed = sorted(good | bad)
    texts += [" ".join(rng.choices([*listed, "and,", "x!"], k=30)) for _ in range(100)]
    df = base(spark, [(text, ["t"]) for text in texts])
    rated = tags.rate_text(df, readers.read_lexicon(spark, *paths))
    assert [(row.text, row.rating) for row in rated.collect()] == [(t, rate(t)) for t in texts]


def test_default_lists_do_not_overlap():
    assert not set(POSITIVE_WORDS) & set(NEGATIVE_WORDS)
    assert len(DEFAULT_LEXICON) == len(POSITIVE_WORDS) + len(NEGATIVE_WORDS)


def test_multi_tag_counts(spark):
    posts = stream(
        spark,
        [
            post("1", tags=["a", "b"]),
            post("2", tags=["a"]),
            post("3", tags=["c", "c"]),
            post("4", tags=["d"]),
            post("4", tags=["e"]),
            post("5", tags=[]),
            post("5", tags=["f"]),
            post(None, tags=["g", "h"]),
            post("6", lang="fr", tags=["i", "j"]),
            post("7", tags=None),
        ],
    )
    expected = [("c", 2), ("a", 1), ("b", 1), ("d", 1), ("e", 1)]
    assert rows(tags.multi_tag_counts(posts)) == expected


def test_multi_tag_counts_equal_the_join_form(spark):
    rng = random.Random(11)
    posts = stream(
        spark,
        [
            post(
                # A third of the posts share one id.
                "hot" if rng.random() < 0.33 else str(rng.randint(0, 150)),
                tags=rng.choices(["a", "b", "c", "d", None], k=rng.choice([0, 1, 1, 2, 3])),
            )
            for _ in range(300)
        ],
    )
    tagged = posts.select(
        F.col("data.id").alias("id"), F.explode("data.entities.hashtags.tag").alias("tags")
    )
    per_id = tagged.groupBy("id").count().filter("count >= 2").drop("count")
    joined = tagged.join(per_id, "id").groupBy("tags").count()
    assert set(rows(joined)) == set(rows(tags.multi_tag_counts(posts)))


@pytest.fixture
def ranked(spark):
    return stream(
        spark,
        [
            post("1", author="star", metrics=(90, 0, 0, 0), tags=["a"]),
            post("2", author="star", metrics=(80, 0, 0, 0), tags=["a", "b"]),
            post("3", author="mid", metrics=(70, 0, 0, 0), tags=["c"]),
            post("4", author="low", metrics=(1, 0, 0, 0), tags=["d"]),
            post("5", author="star", lang="fr", metrics=(99, 0, 0, 0), tags=["e"]),
            post("6", author=None, metrics=(95, 0, 0, 0), tags=["f"]),
            post("7", author="mid", metrics=(0, 0, 0, 0), tags=None),
        ],
    )


def test_popular_accounts_count_once_per_leading_post(ranked):
    assert rows(tags.popular_account_tags(ranked, top_n=4)) == [("a", 4), ("b", 2), ("c", 1)]


def test_popular_accounts_can_be_distinct(ranked):
    result = rows(tags.popular_account_tags(ranked, top_n=4, distinct_authors=True))
    assert result == [("a", 2), ("b", 1), ("c", 1)]
