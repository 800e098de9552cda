"""The given tables in the shapes the operators read.

Every shape is built row by row, without a join, group or sort, and takes the whole table
and the whole text. Callers name the post fields they need: a nested value that is computed
here cannot be pruned like a nested field of a file, and the scan should read no more
columns than the query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A tag is a capitalised word of at least six ASCII letters, anywhere in the text.
TAG_PATTERN = "[A-Z][a-z]{5,}"

DAYS = ["wednesday", "thursday", "friday", "saturday", "sunday"]

# The tables have no weekday tags; each day is searched for these words instead.
WORD_PATTERNS: dict[str, tuple[list[str], list[str]]] = {
    "wednesday": (["The", "the"], []),
    "thursday": (["Of", "of"], ["Is", "And"]),
    "friday": (["In", "in"], []),
    "saturday": (["To", "to", "License"], []),
    "sunday": (["An", "an"], []),
}


# The columns used of each table. Declared, so that no job has to read a footer first.
SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, l_linestatus STRING"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
    ),
    "customer": "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _metrics(likes: Column, quotes: Column, replies: Column, retweets: Column) -> Column:
    return F.struct(
        likes.alias("like_count"),
        quotes.alias("quote_count"),
        replies.alias("reply_count"),
        retweets.alias("retweet_count"),
    )


def _topic(domain_id: Column, domain: Column, entity_id: Column, entity: Column) -> Column:
    description = F.lit("by table")
    none = F.lit(None).cast("string")
    return F.struct(
        F.struct(
            domain_id.alias("id"), domain.alias("name"), description.alias("description")
        ).alias("domain"),
        F.struct(entity_id.alias("id"), entity.alias("name"), none.alias("description")).alias(
            "entity"
        ),
    )


def _named_topic(domain: str, entity: Column) -> Column:
    return F.struct(
        F.struct(F.lit(domain).alias("name")).alias("domain"),
        F.struct(entity.alias("name")).alias("entity"),
    )


def stream_posts(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """``documents`` as stream posts: ``data`` with the named fields, and ``day``."""
    found = F.regexp_extract_all("text", F.lit(TAG_PATTERN), F.lit(0))
    tags = F.coalesce(found, F.array().cast("array<string>"))
    source, chars = F.col("source"), F.col("n_chars")
    hashtags = F.transform(tags, lambda tag: F.struct(tag.alias("tag")))
    topics = F.transform(
        tags, lambda tag: _topic(source, F.concat(F.lit("Source "), source), F.lower(tag), tag)
    )
    metrics = _metrics(chars % 1000, chars % 7, chars % 31, chars % 101)
    known = {
        "id": F.col("doc_id").cast("string"),
        "text": F.col("text"),
        "lang": F.col("lang"),
        "author_id": source,
        "entities": F.struct(hashtags.alias("hashtags")),
        "public_metrics": metrics,
        "context_annotations": topics,
    }
    data = F.struct(*[known[name].alias(name) for name in fields or known])
    day = F.get(F.array(*[F.lit(name) for name in DAYS]), (F.col("doc_id") % 5).cast("int"))
    docs = table(spark, sf_dir, "documents")
    return docs.select(data.alias("data"), day.alias("day"))


def long_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns for each day: three to five first letters, or whole words, of one text in three."""
    docs = table(spark, sf_dir, "documents").where("doc_id % 3 = 0")
    day = F.get(F.array(*[F.lit(name) for name in DAYS]), (F.col("doc_id") % 5).cast("int"))
    words = docs.select(day.alias("day"), F.explode(F.split("text", " ")).alias("word"))
    length = F.length("word") % 3 + 3
    exact = F.length("word") % 2 == 0
    start = F.substring(F.col("word"), F.lit(1), length)
    return (
        words.where(F.length("word") >= 6)
        .select("day", F.when(exact, F.col("word")).otherwise(start).alias("pattern"),
                exact.alias("exact"))
        .distinct()
    )


def search_pages(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """``lineitem`` as search pages of two posts: an order post and a delivery post."""
    lines = table(spark, sf_dir, "lineitem")
    quantity, number = F.col("l_quantity").cast("bigint"), F.col("l_linenumber").cast("bigint")
    part_range = (F.col("l_partkey") % 40).cast("string")
    supplier = F.col("l_suppkey").cast("string")
    part_topic = _named_topic("Part range", F.concat(F.lit("Range "), part_range))
    supplier_topic = _named_topic("Supplier", F.concat(F.lit("Supplier "), supplier))
    order = {
        "lang": F.concat(F.lit("q"), quantity.cast("string")),
        "public_metrics": _metrics(
            F.floor("l_extendedprice"), number, quantity, F.col("l_partkey") % 97
        ),
        "context_annotations": F.array(part_topic, supplier_topic),
    }
    delivery = {
        "lang": F.lower(F.concat("l_returnflag", "l_linestatus")),
        "public_metrics": _metrics(
            quantity, F.lit(0).cast("bigint"), number, F.col("l_suppkey") % 13
        ),
        "context_annotations": F.array(supplier_topic),
    }
    posts = [
        F.struct(*[post[name].alias(name) for name in fields or post])
        for post in (order, delivery)
    ]
    return lines.select(F.array(*posts).alias("data"))


def timeline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as timeline pages of two posts; an error event is a page without posts."""
    value, event = F.col("value"), F.col("event_id")
    post = _metrics(F.floor(value * 100), event % 7, event % 31, F.floor(value))
    reply = _metrics(F.floor(value), F.lit(0).cast("bigint"), event % 5, event % 101)
    posts = F.array(*[F.struct(metrics.alias("public_metrics")) for metrics in (post, reply)])
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("username"),
        F.when(F.col("event_type") != "error", posts).alias("data"),
    )


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as profile pages of one account."""
    followers = F.floor(F.abs("c_acctbal") * 1000) + 1
    account = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_custkey").cast("string").alias("username"),
        F.struct(followers.alias("followers_count")).alias("public_metrics"),
    )
    return table(spark, sf_dir, "customer").select(F.array(account).alias("data"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as the text of landed pages, keyed by conversation.

    Each turn is a page of one post; a system turn is a page without posts.
    """
    turn_id = (F.col("conv_id") * 100 + F.col("turn")).cast("string")
    post = F.struct(turn_id.alias("id"), "text", F.col("role").alias("author_id"))
    page = F.struct(
        F.when(F.col("role") != "system", F.array(post)).alias("data"),
        F.struct(turn_id.alias("newest_id"), turn_id.alias("oldest_id")).alias("meta"),
    )
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("username"), F.to_json(page).alias("value")
    )


def timed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as lines of a feed: a post each, written at the time of the event.

    ``number`` is that of the event.
    """
    written = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    post = F.struct(
        F.col("event_id").cast("string").alias("id"),
        written.alias("created_at"),
        F.col("event_type").alias("text"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("number"), F.to_json(F.struct(post.alias("data"))).alias("value")
    )


def _broken(key: Column, prefix: str) -> Column:
    """A line that ends in the middle of its JSON."""
    return F.concat(F.lit(prefix), key.cast("string"))


def feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as lines of a feed: a post each, with a field ``batch`` that no schema names.

    Every hundredth document is followed by a broken line.
    """
    posts = stream_posts(spark, sf_dir).select("data")
    number = F.col("data.id").cast("bigint")
    batch = F.concat(F.lit("b"), (number % 9).cast("string"))
    whole = F.to_json(F.struct(F.col("data").withField("batch", batch).alias("data")))
    cut = F.when(number % 100 == 0, _broken(number, '{"data": {"id": "'))
    return posts.select(F.explode(F.filter(F.array(whole, cut), lambda x: x.isNotNull())))


def landed_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as page text with a field ``batch`` in each post.

    Each system turn is followed by a broken line.
    """
    turn_id = F.col("conv_id") * 100 + F.col("turn")
    batch = F.concat(F.lit("b"), (turn_id % 9).cast("string")).alias("batch")
    author = F.col("role").alias("author_id")
    post = F.struct(turn_id.cast("string").alias("id"), "text", author, batch)
    page = F.to_json(F.struct(F.when(F.col("role") != "system", F.array(post)).alias("data")))
    cut = F.when(F.col("role") == "system", _broken(turn_id, '{"data": [{"id": "'))
    lines = F.filter(F.array(page, cut), lambda x: x.isNotNull())
    return table(spark, sf_dir, "conversations").select(F.explode(lines))
