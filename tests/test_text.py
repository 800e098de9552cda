import itertools
import re

import pytest
from pyspark.sql import functions as F

from postlark.functions import text as T

SPLITS = [
    # text, words between space runs, words between single spaces
    (" a", ["", "a"], ["", "a"]),
    ("a  b", ["a", "b"], ["a", "", "b"]),
    ("a ", ["a"], ["a"]),
    ("a   ", ["a"], ["a"]),
    ("   ", [], []),
    ("", [""], [""]),
    ("a\nb c", ["a\nb", "c"], ["a\nb", "c"]),
    ("a \n", ["a", "\n"], ["a", "\n"]),
    ("  \n", ["", "\n"], ["", "", "\n"]),
    (None, None, None),
]


def java_split(text, separator):
    """Split that keeps empty words except those at the end, as the JVM does."""
    found = re.split(separator, text)
    if len(found) == 1:
        return found
    while found and found[-1] == "":
        found.pop()
    return found


def test_words_of_every_short_text(spark):
    texts = ["".join(t) for n in range(6) for t in itertools.product(" a\n@", repeat=n)]
    df = spark.createDataFrame([(text,) for text in texts], "text STRING").select(
        "text",
        T.words(F.col("text")).alias("runs"),
        T.words(F.col("text"), T.ONE_SPACE).alias("singles"),
        T.content_word_count(F.col("text")).alias("length"),
    )
    for row in df.collect():
        runs = java_split(row.text, " +")
        assert row.runs == runs
        assert row.singles == java_split(row.text, " ")
        assert row.length == sum("@" not in word for word in runs)


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text STRING").select(column).first()[0]


@pytest.mark.parametrize("text, runs, singles", SPLITS)
def test_words(spark, text, runs, singles):
    assert one(spark, text, T.words(F.col("text"))) == runs
    assert one(spark, text, T.words(F.col("text"), T.ONE_SPACE)) == singles


def test_word_counts_skip_mentions_and_tags(spark):
    cases = {"hi @x #y you": 2, "a#b c": 1, "": 1, "   ": 0, " a": 2}
    for text, expected in cases.items():
        assert one(spark, text, T.content_word_count(F.col("text"))) == expected
    assert one(spark, None, T.content_word_count(F.col("text"))) is None


def test_strip_punctuation(spark):
    assert one(spark, "a.b|c,d;e?f+g!h", T.strip_punctuation(F.col("text"))) == "abcdefgh"
    kept = "#a @b :c - 'd' \"e\"\n"
    assert one(spark, kept, T.strip_punctuation(F.col("text"))) == kept


@pytest.mark.parametrize(
    "text, rating",
    [
        ("GOOD!!! day", 1),
        ("go.od", 1),
        ("#good", 0),
        ("good bad bad", -1),
        ("envious", 1),
        ("good\nbad", 0),
        ("a+", 0),
        ("! good !", 1),
        ("", 0),
        ("   ", 0),
        (None, None),
    ],
)
def test_word_list_rating(spark, text, rating):
    words = spark.createDataFrame([(text,)], "text STRING").select(
        T.rating_words(F.col("text")).alias("words")
    )
    column = T.word_list_rating("words", ["good", "envious", "a+"], ["bad", "envious"])
    assert words.select(column).first()[0] == rating


def test_word_lists_are_literals(spark):
    words = spark.createDataFrame([(["it's", "a\\b", "%", "x"],)], "words ARRAY<STRING>")
    for listed, rating in ((["it's"], 1), (["a\\b", "%"], 2), (["a_b", "'"], 0), ([], 0)):
        assert words.select(T.word_list_rating("words", listed, [])).first()[0] == rating
        assert words.select(T.word_list_rating("words", [], listed)).first()[0] == -rating


def test_starts_with_any_takes_patterns_literally(spark):
    column = T.starts_with_any(F.col("text"), ["#Day", "50%"], ["#TBT"])
    expected = {"#Day": True, "#Daylight": True, "#day": False, "#TBT": True, "#TBTx": False}
    expected |= {"50%off": True, "505": False}
    for text, hit in expected.items():
        assert one(spark, text, column) is hit
