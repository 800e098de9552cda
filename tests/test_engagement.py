import csv
import os

import pytest
from helpers import frame, post, rows, stream

from postlark import schemas
from postlark.operators import engagement
from postlark.sources import readers

STORED = os.environ.get("STORED_RESULTS")


def profiles(spark, *accounts):
    documents = [
        {
            "data": [
                {"name": name, "username": user, "public_metrics": {"followers_count": followers}}
            ]
        }
        for name, user, followers in accounts
    ]
    return engagement.user_profiles(frame(spark, schemas.PROFILE_PAGE, documents))


def timelines(spark, pages):
    documents = [
        {"username": user, "meta": {"result_count": 0}}
        | ({} if metrics is None else {"data": [post(metrics=m) for m in metrics]})
        for user, metrics in pages
    ]
    return frame(spark, schemas.TIMELINE_PAGE, documents)


@pytest.fixture
def accounts(spark):
    return profiles(
        spark,
        ("Ann", "ann", 2_004_999),
        ("Bob", "Bob", 1_000_000),
        ("Cat", "cat", 0),
        ("Dan", "dan", 5_000_000),
        ("Eve", "eve", 3_000_000),
    )


@pytest.fixture
def pages(spark):
    return timelines(
        spark,
        [
            ("ann", [(700, 100, 100, 100), (1000, 0, 0, 0)]),
            ("ann", [(1000, 0, 0, 0)]),
            ("bob", [(5, 5, 5, 5)]),
            ("cat", [(1000, 0, 0, 0)]),
            ("dan", None),
            ("eve", [(0, 0, 0, 0)]),
        ],
    )


def test_profiles(accounts):
    assert rows(accounts)[0] == ("Ann", "ann", 2.004999)


def test_post_metrics(accounts, pages):
    result = engagement.post_metrics_by_user(accounts, pages)
    assert result.columns == [
        "Name", "username", "Followers_Millions", "Likes", "Quotes", "Retweets", "Replies",
    ]
    assert sorted(rows(result)) == [
        ("Ann", "ann", 2.0, 700, 100, 100, 100),
        ("Ann", "ann", 2.0, 1000, 0, 0, 0),
        ("Ann", "ann", 2.0, 1000, 0, 0, 0),
        ("Cat", "cat", 0.0, 1000, 0, 0, 0),
        ("Eve", "eve", 3.0, 0, 0, 0, 0),
    ]
    spread = engagement.post_metrics_by_user(accounts, pages, rows_per_share=1)
    assert sorted(rows(spread)) == sorted(rows(result))


def test_names_can_be_matched_without_case(accounts, pages):
    result = engagement.post_metrics_by_user(accounts, pages, ignore_case=True)
    assert ("Bob", "Bob", 1.0, 5, 5, 5, 5) in rows(result)
    names = [row.Name for row in engagement.user_engagement(accounts, pages, True).collect()]
    assert sorted(names) == ["Ann", "Bob", "Cat", "Eve"]


def test_engagement(accounts, pages):
    result = engagement.user_engagement(accounts, pages)
    by_name = {row.Name: row.asDict() for row in result.collect()}
    assert by_name["Ann"] == {
        "Name": "Ann",
        "Followers_Millions": 2.0,
        "Total_Engagement_Thousands": 3.0,
        "Average_Engagement_Thousands": 1.0,
        "Like_Percent": 90.0,
        "Quote_Percent": 3.3,
        "Retweet_Percent": 3.3,
        "Reply_Percent": 3.3,
        "Total_Engagement_Per_Thous_Followers": 1.5,
        "Average_Engagement_Per_Thous_Followers": 0.5,
    }
    assert by_name["Cat"]["Total_Engagement_Per_Thous_Followers"] is None
    assert by_name["Eve"]["Like_Percent"] is None
    assert sorted(by_name) == ["Ann", "Cat", "Eve"]


def test_repeated_profiles_repeat_the_posts(spark, pages):
    twice = profiles(spark, ("Ann", "ann", 2_000_000), ("Ann", "ann", 2_000_000))
    row = engagement.user_engagement(twice, pages).first()
    assert (row.Total_Engagement_Thousands, row.Average_Engagement_Thousands) == (6.0, 1.0)


def test_missing_metric_is_left_out_of_the_totals(spark):
    accounts = profiles(spark, ("Ann", "ann", 1_000_000))
    pages = timelines(spark, [("ann", [(1000, None, 0, 0), (3000, 0, 0, 0)])])
    row = engagement.user_engagement(accounts, pages).first()
    assert (row.Total_Engagement_Thousands, row.Average_Engagement_Thousands) == (3.0, 3.0)
    assert row.Like_Percent == 133.3


def test_popular_users(spark):
    posts = [
        post(author="a", metrics=(1, 2, 3, 4)),
        post(author="a", lang="fr", metrics=(1, 2, 3, 4)),
        post(author="b", metrics=(0, 9, 0, None)),
    ]
    result = engagement.popular_users_metrics(stream(spark, posts))
    assert result.columns == ["user", "sum(likes)", "sum(quotes)", "sum(replies)", "sum(retweets)"]
    assert rows(result) == [("b", 0, 9, 0, None), ("a", 2, 4, 6, 8)]


@pytest.fixture
def stored(spark):
    """Pages and results of an earlier system: ``profiles``, ``timelines`` and three CSV files."""
    if not STORED:
        pytest.skip("STORED_RESULTS names no folder")
    accounts = engagement.user_profiles(readers.read_profile_pages(spark, f"{STORED}/profiles"))
    return accounts, readers.read_timeline_pages(spark, f"{STORED}/timelines")


@pytest.mark.parametrize(
    "name, ranking",
    [
        ("average", engagement.avg_engagement_rank),
        ("total", engagement.total_engagement_rank),
        ("profile", engagement.engagement_profile),
    ],
)
def test_stored_results(stored, name, ranking):
    with open(f"{STORED}/{name}.csv", encoding="utf-8") as lines:
        expected = [(row[0], *map(float, row[1:])) for row in csv.reader(lines)]
    assert len(expected) == 18
    assert rows(ranking(engagement.user_engagement(*stored))) == expected


def test_stored_posts(stored):
    assert stored[0].count() == 20
    assert engagement.post_metrics_by_user(*stored).count() == 510
    assert engagement.post_metrics_by_user(*stored, ignore_case=True).count() == 527


def test_the_five_rankings_differ_and_break_ties_by_name(spark):
    accounts = profiles(
        spark,
        ("A", "a", 1_000_000),
        ("B", "b", 4_000_000),
        ("C", "c", 2_000_000),
        ("D", "d", 2_000_000),
        ("E", "e", 20_000_000),
    )
    kilo = lambda n: (n * 1000, 0, 0, 0)
    pages = timelines(
        spark,
        [
            ("a", [kilo(2), kilo(2), kilo(2)]),
            ("b", [kilo(40)]),
            ("c", [kilo(9)] * 10),
            ("d", [kilo(9)] * 10),
            ("e", [kilo(60), kilo(10)]),
        ],
    )
    figures = engagement.user_engagement(accounts, pages)
    orders = {
        "avg_engagement_rank": "BECDA",
        "avg_engagement_per_follower_rank": "BCDAE",
        "total_engagement_rank": "CDEBA",
        "total_engagement_per_follower_rank": "CDBAE",
        "engagement_profile": "EBCDA",
    }
    for name, expected in orders.items():
        ranked = getattr(engagement, name)(figures)
        assert "".join(row.Name for row in ranked.collect()) == expected, name
