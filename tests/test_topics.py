import pytest
from helpers import frame, post, rows, stream, topic

from postlark import schemas
from postlark.operators import topics


@pytest.fixture
def posts(spark):
    sports = topic("Sport", "Ball", "1", "10")
    music = topic("Music", "Song", "2", "20")
    nameless = topic("Music", None, "2", None)
    made = (
        [post(lang="en", topics=[sports])] * 3
        + [post(lang="fr", topics=[sports, music])]
        + [post(lang="de", topics=[nameless])] * 6
        + [post(lang="en", topics=None), post(lang="en", topics=[])]
    )
    return stream(spark, made)


def test_rows(posts):
    topic_rows = topics.lang_topic_rows(posts)
    assert topic_rows.columns == [
        "language", "domain_desc", "domain_name", "domain_id", "entity_desc", "entity_name",
        "entity_id", "full_id", "context",
    ]
    expected = ("fr", "about", "Music", "2", None, "Song", "20", "2.20", "Music: Song")
    assert expected in rows(topic_rows)
    assert ("de", "about", "Music", "2", None, None, None, None, None) in rows(topic_rows)
    assert topic_rows.count() == 11


def test_rankings(posts):
    assert rows(topics.lang_topic_ranking(posts)) == [
        ("de", None, None, 6),
        ("en", "Sport: Ball", "1.10", 3),
        ("fr", "Music: Song", "2.20", 1),
        ("fr", "Sport: Ball", "1.10", 1),
    ]
    ranking = [(None, None, 6), ("Sport: Ball", "1.10", 4), ("Music: Song", "2.20", 1)]
    assert rows(topics.topic_ranking(posts)) == ranking
    assert rows(topics.topic_ranking(posts, top=1)) == ranking[:1]


def test_language_shares_of_leading_topics(posts):
    shares = rows(topics.lang_share_top_topics(posts, topics=2))
    # The topic without an id takes the first place but has no rows.
    assert shares == [
        ("Sport: Ball", "1.10", 4, "en", 3, 0.75),
        ("Sport: Ball", "1.10", 4, "fr", 1, 0.25),
    ]
    assert len(rows(topics.lang_share_top_topics(posts, topics=3, languages=1))) == 2


def pages(spark):
    hot = topic("One", "Hot")
    same_entity = topic("Two", "Hot")
    nameless = topic("Two", None)
    posts = [post(lang="en", metrics=(1, 2, 3, 4), topics=[hot])] * 99
    posts += [post(lang="fr", metrics=(5, 0, 0, 0), topics=[same_entity])]
    posts += [post(lang="en", metrics=(1, 0, 0, 0), topics=[nameless]), post(topics=None)]
    zero = post(lang="de", metrics=(0, 0, 0, 0), topics=[topic("Two", "Cold")])
    documents = [
        {"data": posts[:40], "meta": {}},
        {"data": posts[40:]},
        {"data": None, "meta": None},
        {"meta": {"result_count": 0}},
        {"data": [zero]},
    ]
    return frame(spark, schemas.SEARCH_PAGE, documents)


def test_language_percent(spark):
    both = rows(topics.context_lang_percent(pages(spark), min_percent=0.5))
    assert both == [
        ("Hot (Hot)", 100, "en", 99.0),
        ("Hot (Hot)", 100, "fr", 1.0),
        ("Cold (Cold)", 1, "de", 100.0),
    ]
    # One percent exactly is not above one percent.
    assert ("Hot (Hot)", 100, "fr", 1.0) not in rows(topics.context_lang_percent(pages(spark)))
    labelled = rows(topics.context_lang_percent(pages(spark), label_style="domain"))
    assert ("One: Hot", 99, "en", 100.0) in labelled
    assert len(rows(topics.context_lang_percent(pages(spark), top=1))) == 1


def test_percent_sums_stay_below_the_whole(spark):
    shares = topics.context_lang_percent(pages(spark), min_percent=0.0, top=None)
    for _, total in rows(shares.groupBy("context").sum("percent")):
        assert total <= 100.1


def test_interactions_keep_contexts_without_a_name(spark):
    assert rows(topics.context_lang_interactions(pages(spark))) == [
        ("Hot (Hot)", "en", 990),
        ("Hot (Hot)", "fr", 5),
        (None, "en", 1),
        ("Cold (Cold)", "de", 0),
    ]


def test_breakdown(spark):
    result = rows(topics.context_interaction_breakdown(pages(spark)))
    assert result[0] == ("Hot (Hot)", "en", 990, 10.0, 20.0, 30.0, 40.0)
    assert result[-1] == ("Cold (Cold)", "de", 0, None, None, None, None)


def test_unknown_label_style(spark):
    with pytest.raises(ValueError):
        topics.context_rows(pages(spark), "other")
