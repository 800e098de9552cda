"""The plans that the operators promise."""

import pytest
from helpers import frame, plan, post, stream, topic
from pyspark.sql import functions as F

from postlark import schemas
from postlark.operators import engagement, tags, topics, weekday
from postlark.plans.queries import QUERIES
from postlark.sources import readers

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    posts = [post(str(n), "a b", tags=["a"], topics=[topic()]) for n in range(20)]
    stream(spark, posts).write.parquet(f"{folder}/stream")
    pages = [{"username": "u", "data": posts, "meta": {}}]
    frame(spark, schemas.TIMELINE_PAGE, pages).write.parquet(f"{folder}/pages")
    return str(folder)


def scan(df):
    (line,) = {line.strip() for line in plan(df).splitlines() if "FileScan parquet" in line}
    return line


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_and_nested_fields_reach_the_scan(spark, files, whole_plans):
    posts = readers.read_stream_posts(spark, f"{files}/stream")
    line = scan(tags.frequent_tags(tags.hashtag_base(posts)))
    assert "EqualTo(data.lang,en)" in line
    entities = "entities:struct<hashtags:array<struct<tag:string>>>"
    assert f"ReadSchema: struct<data:struct<lang:string,{entities}>>" in line


def test_popular_users_read_metrics_only(spark, files, whole_plans):
    posts = readers.read_stream_posts(spark, f"{files}/stream")
    line = scan(engagement.popular_users_metrics(posts))
    assert "text" not in line.split("ReadSchema")[1] and "entities" not in line


def test_pages_are_pruned_before_they_are_expanded(spark, files, whole_plans):
    pages = readers.read_search_pages(spark, f"{files}/pages")
    read = scan(topics.context_lang_percent(pages)).split("ReadSchema")[1]
    assert "lang:string" in read and "context_annotations" in read
    assert "text:string" not in read and "public_metrics" not in read
    topic_pages = readers.read_search_pages(spark, f"{files}/pages", schema=schemas.TOPIC_PAGE)
    assert "description" not in scan(topics.context_lang_percent(topic_pages))
    timelines = readers.read_timeline_pages(spark, f"{files}/pages", "parquet")
    per_user = engagement._post_metrics(engagement._timeline(timelines, False), "_user")
    read = scan(per_user).split("ReadSchema")[1]
    assert "public_metrics" in read and "text:string" not in read


def test_rankings_leave_descriptions_unread(spark, files, whole_plans):
    posts = readers.read_stream_posts(spark, f"{files}/stream")
    read = scan(topics.lang_topic_ranking(posts)).split("ReadSchema")[1]
    assert "entity:struct<id:string,name:string>" in read
    assert "description" not in read and "text:string" not in read


def test_timeline_join_moves_metrics_only(spark, files, whole_plans):
    pages = readers.read_timeline_pages(spark, f"{files}/pages", "parquet")
    columns = "name STRING, username STRING, Followers_Millions DOUBLE"
    profiles = spark.createDataFrame([("n", "u", 1.0)], columns)
    text = plan(engagement.post_metrics_by_user(profiles, pages))
    reads = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert reads and not [line for line in reads if "text:string" in line]


def test_reports_take_their_top_rows_without_a_full_sort(spark, files):
    pages = readers.read_search_pages(spark, f"{files}/pages")
    for report in (topics.context_lang_percent(pages), topics.context_lang_interactions(pages)):
        assert "TakeOrderedAndProject(limit=50" in plan(report)


def test_word_counts_read_the_text_once(spark, files):
    posts = readers.read_stream_posts(spark, f"{files}/stream").withColumn("day", F.lit("friday"))
    counts = weekday.day_word_counts(posts)
    counts.collect()
    final = plan(counts).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_leading_topics_read_the_posts_once(spark, files):
    posts = readers.read_stream_posts(spark, f"{files}/stream")
    shares = topics.lang_share_top_topics(posts)
    shares.collect()
    final = plan(shares).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert operator not in text
    assert "REPARTITION_BY_NUM" not in text
