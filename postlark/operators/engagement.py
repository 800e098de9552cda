"""Engagement of accounts, from profile pages and timeline pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.functions.measures import percent, ratio, total
from postlark.operators.joins import hot_key_join
from postlark.operators.paging import page_fields

METRICS = {
    "Likes": "like_count",
    "Quotes": "quote_count",
    "Retweets": "retweet_count",
    "Replies": "reply_count",
}


def popular_users_metrics(posts: DataFrame) -> DataFrame:
    """Sums of likes, quotes, replies and retweets by ``user``, most quoted first."""
    metrics = posts.filter(F.col("data.public_metrics").isNotNull()).select(
        F.col("data.author_id").alias("user"),
        F.col("data.public_metrics.like_count").alias("likes"),
        F.col("data.public_metrics.quote_count").alias("quotes"),
        F.col("data.public_metrics.reply_count").alias("replies"),
        F.col("data.public_metrics.retweet_count").alias("retweets"),
    )
    return (
        metrics.groupBy("user")
        .agg(*[F.sum(c).alias(f"sum({c})") for c in ("likes", "quotes", "replies", "retweets")])
        .orderBy(F.desc("sum(quotes)"), "user")
    )


def user_profiles(profile_pages: DataFrame) -> DataFrame:
    """``name``, ``username`` and unrounded ``Followers_Millions`` of each account."""
    accounts = page_fields(profile_pages, "name", "username", "public_metrics.followers_count")
    return accounts.select(
        "name",
        "username",
        (F.col("followers_count") / 1_000_000).alias("Followers_Millions"),
    )


def _profile_lookup(profiles: DataFrame, ignore_case: bool) -> DataFrame:
    key = F.lower("username") if ignore_case else F.col("username")
    return profiles.select(
        key.alias("_user"),
        F.col("username").alias("username"),
        F.col("name").alias("Name"),
        F.round("Followers_Millions", 2).alias("Followers_Millions"),
    )


def _timeline(timeline_pages: DataFrame, ignore_case: bool) -> DataFrame:
    """The pages' account and the metrics of their posts; texts are neither read nor moved."""
    key = F.lower("username") if ignore_case else F.col("username")
    return timeline_pages.select(
        key.alias("_user"), F.col("data.public_metrics").alias("_metrics")
    ).filter(F.col("_user").isNotNull())


def _post_metrics(timeline: DataFrame, *keys: str) -> DataFrame:
    posts = timeline.select(*keys, F.inline("_metrics"))
    return posts.select(*keys, *[F.col(field).alias(name) for name, field in METRICS.items()])


def post_metrics_by_user(
    profiles: DataFrame,
    timeline_pages: DataFrame,
    ignore_case: bool = False,
    rows_per_share: int | None = None,
) -> DataFrame:
    """One row per timeline post with its account and metrics.

    Accounts without posts drop out, and so do names that differ in case unless
    ``ignore_case`` is set. Whole pages are joined and then expanded. Adaptive execution splits
    an account with very many pages; with ``rows_per_share`` such accounts are cut by number.
    """
    lookup = _profile_lookup(profiles, ignore_case)
    timeline = _timeline(timeline_pages, ignore_case)
    if rows_per_share is None:
        joined = timeline.join(lookup, "_user")
    else:
        joined = hot_key_join(timeline, lookup, "_user", rows_per_share)
    return _post_metrics(joined, "Name", "username", "Followers_Millions")


def user_engagement(
    profiles: DataFrame, timeline_pages: DataFrame, ignore_case: bool = False
) -> DataFrame:
    """Engagement totals, means, shares and per-follower rates by account.

    Posts are summed per account before the join, so an account with very many posts is one
    row when it meets its profile. The per-follower rates divide figures that are already
    rounded.
    """
    whole = total(*[F.col(name) for name in METRICS])
    per_user = (
        _post_metrics(_timeline(timeline_pages, ignore_case), "_user")
        .groupBy("_user")
        .agg(
            *[F.sum(name).alias(name) for name in METRICS],
            F.sum(whole).alias("total"),
            F.count(whole).alias("posts"),
        )
    )
    sums = (
        per_user.join(_profile_lookup(profiles, ignore_case), "_user")
        .groupBy("Name", "Followers_Millions")
        .agg(*[F.sum(name).alias(name) for name in (*METRICS, "total", "posts")])
    )
    mean = ratio(F.col("total"), F.col("posts"))
    shares = {
        "Like_Percent": "Likes",
        "Quote_Percent": "Quotes",
        "Retweet_Percent": "Retweets",
        "Reply_Percent": "Replies",
    }
    rounded = sums.select(
        "Name",
        "Followers_Millions",
        F.round(F.col("total") / 1000, 1).alias("Total_Engagement_Thousands"),
        F.round(mean / 1000, 1).alias("Average_Engagement_Thousands"),
        *[percent(F.col(c), F.col("total"), 1).alias(name) for name, c in shares.items()],
    )
    return rounded.withColumns(
        {
            f"{kind}_Engagement_Per_Thous_Followers": F.round(
                ratio(F.col(f"{kind}_Engagement_Thousands"), F.col("Followers_Millions")), 2
            )
            for kind in ("Total", "Average")
        }
    )


def _rank(engagement: DataFrame, kind: str, order: str) -> DataFrame:
    return engagement.select(
        "Name", f"{kind}_Engagement_Thousands", f"{kind}_Engagement_Per_Thous_Followers"
    ).orderBy(F.desc(order), "Name")


def avg_engagement_rank(engagement: DataFrame) -> DataFrame:
    """Accounts by mean engagement per post."""
    return _rank(engagement, "Average", "Average_Engagement_Thousands")


def avg_engagement_per_follower_rank(engagement: DataFrame) -> DataFrame:
    """Accounts by mean engagement per thousand followers."""
    return _rank(engagement, "Average", "Average_Engagement_Per_Thous_Followers")


def total_engagement_rank(engagement: DataFrame) -> DataFrame:
    """Accounts by total engagement."""
    return _rank(engagement, "Total", "Total_Engagement_Thousands")


def total_engagement_per_follower_rank(engagement: DataFrame) -> DataFrame:
    """Accounts by total engagement per thousand followers."""
    return _rank(engagement, "Total", "Total_Engagement_Per_Thous_Followers")


def engagement_profile(engagement: DataFrame) -> DataFrame:
    """Followers, per-follower rates and shares, most followed account first."""
    return engagement.select(
        "Name",
        "Followers_Millions",
        "Total_Engagement_Per_Thous_Followers",
        "Average_Engagement_Per_Thous_Followers",
        "Like_Percent",
        "Quote_Percent",
        "Retweet_Percent",
        "Reply_Percent",
    ).orderBy(F.desc("Followers_Millions"), "Name")
