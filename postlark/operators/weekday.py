"""Post, word and tag counts per daily capture.

Inputs are posts in the stream shape with a ``day`` column (see ``read_daily_captures``).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.functions.text import ONE_SPACE, starts_with_any, words

# The tags each day is searched for, as (prefixes, exact words).
DAY_PATTERNS: dict[str, tuple[list[str], list[str]]] = {
    "wednesday": (["#Wednesday", "#wednesday"], []),
    "thursday": (["#Thursday", "#thursday"], ["#TBT", "#ThrowbackThursday"]),
    "friday": (["#Friday", "#friday"], []),
    "saturday": (["#Saturday", "#saturday", "#Caturday"], []),
    "sunday": (["#Sunday", "#sunday"], []),
}


def _texts(posts: DataFrame) -> DataFrame:
    """Day and text of the posts with a text."""
    return posts.filter(F.col("data.text").isNotNull()).select(
        "day", F.col("data.text").alias("text")
    )


def day_post_count(posts: DataFrame) -> DataFrame:
    """``day``, ``tweet_count``: posts with a text."""
    return _texts(posts).groupBy("day").agg(F.count("*").alias("tweet_count"))


def day_words(posts: DataFrame) -> DataFrame:
    """``day``, ``word``: one row per word between single spaces."""
    return _texts(posts).select(
        "day", F.explode(words(F.col("text"), ONE_SPACE)).alias("word")
    )


def day_word_counts(posts: DataFrame) -> DataFrame:
    """``day``, ``word``, ``count`` and ``(% format)``: count in percent of the day's posts.

    Each post adds one NULL word, so the aggregate that counts the words also counts the
    posts: the text is read and shuffled once and the post counts reuse that shuffle. A post
    without a day belongs to the day NULL, as in ``day_post_count``. ``uses`` keeps the NULL
    word apart after the aggregate, where no filter can move below it.
    """
    return word_counts_of(word_states(posts))


def word_states(posts: DataFrame) -> DataFrame:
    """``day``, ``word``, ``count``, ``uses``: sums of a day's posts, which can be added up.

    The NULL word has the number of posts.
    """
    with_marker = F.array_append(words(F.col("text"), ONE_SPACE), F.lit(None).cast("string"))
    return (
        _texts(posts)
        .select("day", F.explode(with_marker).alias("word"))
        .groupBy("day", "word")
        .agg(F.count("*").alias("count"), F.count("word").alias("uses"))
    )


def merged_states(states: DataFrame) -> DataFrame:
    """The sums of several captures of a day as one."""
    return states.groupBy("day", "word").agg(
        F.sum("count").alias("count"), F.sum("uses").alias("uses")
    )


def post_count_of(states: DataFrame) -> DataFrame:
    """``day_post_count`` from the sums of ``word_states``, one row a day and word."""
    marked = states.filter(F.col("word").isNull())
    return marked.groupBy("day").agg(F.sum("count").alias("tweet_count"))


def word_counts_of(states: DataFrame) -> DataFrame:
    """``day_word_counts`` from the sums of ``word_states``, one row a day and word."""
    posts_per_day = states.groupBy(F.col("day").alias("_day")).agg(
        F.max(F.when(F.col("uses") == 0, F.col("count"))).alias("posts")
    )
    return (
        states.join(posts_per_day, F.col("day").eqNullSafe(F.col("_day")))
        .filter(F.col("uses") > 0)
        .select("day", "word", "count", (F.col("count") * 100 / F.col("posts")).alias("(% format)"))
        .orderBy(F.desc("count"), "day", "word")
    )


def _matches(patterns: dict[str, tuple[list[str], list[str]]]) -> Column:
    tests = [
        (F.col("day") == day) & starts_with_any(F.col("word"), prefixes, exact)
        for day, (prefixes, exact) in patterns.items()
    ]
    return reduce(or_, tests)


def day_tag_matches(
    posts: DataFrame, patterns: dict[str, tuple[list[str], list[str]]] = DAY_PATTERNS
) -> DataFrame:
    """``day``, ``hashtag``, ``count`` of the words that match the day's patterns."""
    return (
        day_words(posts)
        .filter(_matches(patterns))
        .groupBy("day", F.col("word").alias("hashtag"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "day", "hashtag")
    )


def day_tag_matches_sql(
    posts: DataFrame, patterns: dict[str, tuple[list[str], list[str]]] = DAY_PATTERNS
) -> DataFrame:
    """``day_tag_matches`` as a parameterised SQL query over the words."""
    tests, args = [], {}
    for number, (day, (prefixes, exact)) in enumerate(patterns.items()):
        args[f"day{number}"] = day
        options = []
        for kind, values in (("prefix", prefixes), ("exact", exact)):
            for position, value in enumerate(values):
                name = f"{kind}{number}_{position}"
                args[name] = value
                test = f"startswith(word, :{name})" if kind == "prefix" else f"word = :{name}"
                options.append(test)
        tests.append(f"(day = :day{number} AND ({' OR '.join(options)}))")
    query = f"""
        SELECT day, word AS hashtag, count(*) AS count
        FROM {{words}}
        WHERE {' OR '.join(tests)}
        GROUP BY day, word
        ORDER BY count DESC, day, hashtag
    """
    return posts.sparkSession.sql(query, args=args, words=day_words(posts))


def day_tag_matches_indexed(posts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``day_tag_matches`` with a table of patterns of any length: ``day``, ``pattern``, ``exact``.

    A word is looked up by its beginnings of the lengths that the day's prefixes have, and as a
    whole, so a join on equal keys takes the place of a test for each pattern, and the plan does not
    grow with the table. Words are counted first, so each one is looked up once a day. A word that
    matches several patterns counts once.
    """
    length = F.when(F.col("exact"), F.lit(-1)).otherwise(F.length("pattern"))
    keys = (
        patterns.filter("day IS NOT NULL AND pattern IS NOT NULL AND exact IS NOT NULL")
        .select("day", length.alias("length"), F.col("pattern").alias("start"))
        .distinct()
    )
    # As many lengths as a pattern has characters at most.
    lengths = keys.groupBy("day").agg(F.collect_set("length").alias("lengths"))
    counts = day_words(posts).groupBy("day", "word").agg(F.count("*").alias("count"))
    fitting = F.filter("lengths", lambda n: n <= F.length("word"))
    probes = counts.join(lengths, "day").select(
        "day", "word", "count", F.explode(fitting).alias("length")
    )
    start = F.when(F.col("length") < 0, F.col("word")).otherwise(
        F.substring(F.col("word"), F.lit(1), F.col("length"))
    )
    return (
        probes.withColumn("start", start)
        .join(keys, ["day", "length", "start"], "left_semi")
        .groupBy("day", F.col("word").alias("hashtag"))
        .agg(F.max("count").alias("count"))
        .orderBy(F.desc("count"), "day", "hashtag")
    )
