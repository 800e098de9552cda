"""Languages and interactions per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlark.functions.measures import percent, ratio, topic_label, total
from postlark.operators.paging import page_fields

def _top(df: DataFrame, k: int | None) -> DataFrame:
    return df if k is None else df.limit(k)


def _topic_rows(posts: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One row per (post, annotation), with the named fields only.

    The fields are picked from the array before it is expanded, so that the scan reads them
    and no others.
    """
    parts = {
        f"{part}_{short}": F.col(f"data.context_annotations.{part}.{field}")
        for part in ("domain", "entity")
        for short, field in fields.items()
    }
    annotated = posts.filter(F.col("data.context_annotations").isNotNull()).select(
        F.col("data.lang").alias("language"),
        F.inline(F.arrays_zip(*parts.values())).alias(*parts),
    )
    return annotated.select(
        "*",
        F.concat("domain_id", F.lit("."), "entity_id").alias("full_id"),
        topic_label(F.col("domain_name"), F.col("entity_name"), "domain").alias("context"),
    )


def lang_topic_rows(posts: DataFrame) -> DataFrame:
    """One row per (post, annotation) with the topic's fields, id and label."""
    return _topic_rows(posts, {"desc": "description", "name": "name", "id": "id"})


def _topic_keys(posts: DataFrame) -> DataFrame:
    """The topic rows without the descriptions, which no ranking needs."""
    return _topic_rows(posts, {"name": "name", "id": "id"})


def lang_topic_ranking(posts: DataFrame) -> DataFrame:
    """``language``, ``context``, ``full_id``, ``count``, most frequent first."""
    return (
        _topic_keys(posts)
        .groupBy("language", "context", "full_id")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "language", "context", "full_id")
    )


def topic_ranking(posts: DataFrame, top: int | None = 20) -> DataFrame:
    """``context_topic``, ``full_id_topic``, ``topicCount``, most frequent first."""
    ranked = (
        _topic_keys(posts)
        .groupBy(F.col("context").alias("context_topic"), F.col("full_id").alias("full_id_topic"))
        .agg(F.count("*").alias("topicCount"))
        .orderBy(F.desc("topicCount"), "context_topic", "full_id_topic")
    )
    return _top(ranked, top)


def lang_share_top_topics(posts: DataFrame, topics: int = 10, languages: int = 10) -> DataFrame:
    """For each leading topic, its languages with the largest share of the topic.

    Topic totals are rolled up from the language counts, so the posts are read once and both
    sides reuse one shuffle. For that reuse, both sides drop rows without a topic id through
    the aggregate ``known``: a NULL filter would be pushed below one of them. A topic without
    an id keeps its place among the leading ones. The window sees the leading topics only.
    """
    counts = (
        _topic_keys(posts)
        .groupBy("language", "context", "full_id")
        .agg(F.count("*").alias("count"), F.count("full_id").alias("known"))
    )
    leading = (
        counts.groupBy(
            F.col("context").alias("context_topic"), F.col("full_id").alias("full_id_topic")
        )
        .agg(F.sum("count").alias("topicCount"), F.sum("known").alias("topicKnown"))
        .orderBy(F.desc("topicCount"), "context_topic", "full_id_topic")
        .limit(topics)
        .filter(F.col("topicKnown") > 0)
    )
    shares = (
        counts.filter(F.col("known") > 0)
        .join(leading, F.col("full_id").eqNullSafe(F.col("full_id_topic")))
        .withColumn("proportion", ratio(F.col("count"), F.col("topicCount")))
    )
    by_topic = Window.partitionBy("context_topic", "full_id_topic").orderBy(
        F.desc("proportion"), "language", "context"
    )
    return (
        shares.withColumn("rank", F.row_number().over(by_topic))
        .filter(F.col("rank") <= languages)
        .select("context_topic", "full_id_topic", "topicCount", "language", "count", "proportion")
        .orderBy(
            F.desc("topicCount"), "context_topic", "full_id_topic", F.desc("proportion"), "language"
        )
    )


def context_rows(
    pages: DataFrame, label_style: str = "legacy", with_metrics: bool = True
) -> DataFrame:
    """One row per (post, annotation) of search pages: ``context``, ``lang`` and metrics."""
    fields = ["lang", "context_annotations"] + ["public_metrics"] * with_metrics
    posts = page_fields(pages, *fields)
    annotated = posts.withColumn("topic", F.explode("context_annotations"))
    metrics = ("like", "quote", "reply", "retweet") if with_metrics else ()
    return annotated.select(
        topic_label(
            F.col("topic.domain.name"), F.col("topic.entity.name"), label_style
        ).alias("context"),
        "lang",
        *[F.col(f"public_metrics.{name}_count").alias(name) for name in metrics],
    )


def context_lang_percent(
    pages: DataFrame,
    min_percent: float = 1.0,
    top: int | None = 50,
    label_style: str = "legacy",
) -> DataFrame:
    """``context``, ``topic_count``, ``lang``, ``percent`` above ``min_percent``.

    The topic total is a window over the language counts: one row per language code and
    topic reaches a task, however many posts a topic has.
    """
    counts = (
        context_rows(pages, label_style, with_metrics=False)
        .filter(F.col("context").isNotNull())
        .groupBy("context", "lang")
        .agg(F.count("*").alias("count"))
    )
    topic_count = F.sum("count").over(Window.partitionBy("context"))
    shares = (
        counts.withColumn("topic_count", topic_count)
        .withColumn("percent", percent(F.col("count"), F.col("topic_count"), 2))
        .select("context", "topic_count", "lang", "percent")
        .filter(F.col("percent") > min_percent)
        .orderBy(F.desc("topic_count"), F.desc("percent"), "context", "lang")
    )
    return _top(shares, top)


def _interaction_sums(pages: DataFrame, label_style: str) -> DataFrame:
    sums = context_rows(pages, label_style).groupBy("context", "lang").agg(
        F.sum("like").alias("likes"),
        F.sum("quote").alias("quotes"),
        F.sum("reply").alias("replies"),
        F.sum("retweet").alias("retweets"),
    )
    parts = [F.col(name) for name in ("likes", "quotes", "retweets", "replies")]
    return sums.withColumn("interactions", total(*parts))


def context_lang_interactions(
    pages: DataFrame, top: int | None = 50, label_style: str = "legacy"
) -> DataFrame:
    """``context``, ``lang``, ``interactions``, largest first; NULL contexts stay."""
    ranked = (
        _interaction_sums(pages, label_style)
        .select("context", "lang", "interactions")
        .orderBy(F.desc("interactions"), "context", "lang")
    )
    return _top(ranked, top)


def context_interaction_breakdown(
    pages: DataFrame, top: int | None = 50, label_style: str = "legacy"
) -> DataFrame:
    """The interactions with the share of each kind in percent."""
    whole = F.col("interactions")
    ranked = (
        _interaction_sums(pages, label_style)
        .select(
            "context",
            "lang",
            "interactions",
            percent(F.col("likes"), whole, 2).alias("like_percent"),
            percent(F.col("quotes"), whole, 2).alias("quote_percent"),
            percent(F.col("replies"), whole, 2).alias("reply_percent"),
            percent(F.col("retweets"), whole, 2).alias("retweet_percent"),
        )
        .orderBy(F.desc("interactions"), "context", "lang")
    )
    return _top(ranked, top)
