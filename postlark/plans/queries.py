"""The named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark import schemas
from postlark.functions import sql
from postlark.operators import engagement, heavy, paging, tags, topics, weekday
from postlark.plans import tables
from postlark.session import remove, scratch_dir
from postlark.sources import bucketed, discovery, readers, writers
from postlark.sources.day_store import DayStore
from postlark.sources.lexicon import DEFAULT_LEXICON, NEGATIVE_WORDS, POSITIVE_WORDS
from postlark.streaming import cursors, event_time, top_k
from postlark.streaming.landing import feed_stream, stream_land
from postlark.streaming.rotation import Rotation, rotate

Query = Callable[[SparkSession, str], DataFrame]

# The tables are small next to a feed capture; a tag counts as frequent above this.
MIN_TAG_COUNT = 5


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.hashtag_base(tables.stream_posts(spark, sf_dir, "lang", "text", "entities"))


def hashtag_base(spark, sf_dir):
    return _base(spark, sf_dir).withColumn("hashtag", F.array_join("hashtag", " "))


def frequent_tags(spark, sf_dir):
    return tags.frequent_tags(_base(spark, sf_dir), MIN_TAG_COUNT)


def avg_tweet_length_by_tag(spark, sf_dir):
    return tags.avg_length_by_tag(_base(spark, sf_dir), MIN_TAG_COUNT)


def frequent_tags_sketched(spark, sf_dir):
    """Candidates from bucket counts, then exact counts of these."""
    uses = _base(spark, sf_dir).select(F.explode("hashtag").alias("hashtag2"))
    return heavy.frequent_values(uses, "hashtag2", MIN_TAG_COUNT)


def avg_tweet_length_by_tag_sql(spark, sf_dir):
    """``avg_tweet_length_by_tag`` in SQL alone, with the functions for words and tags."""
    sql.register(spark)
    posts = tables.stream_posts(spark, sf_dir, "lang", "text", "entities")
    query = """
        WITH tagged AS (
            SELECT content_words(data.text) AS length, data.entities.hashtags.tag AS tags
            FROM {posts} WHERE data.lang = :lang AND data.entities.hashtags IS NOT NULL),
        means AS (
            SELECT tag AS hashtag, avg(length) AS mean
            FROM tagged, LATERAL tags_of(tags)
            WHERE tag IS NOT NULL GROUP BY tag HAVING count(*) > :min_count)
        SELECT hashtag, round(mean, 2) AS avgLength FROM means ORDER BY mean DESC, hashtag"""
    return spark.sql(query, args={"lang": "en", "min_count": MIN_TAG_COUNT}, posts=posts)


def tag_sentiment_sql(spark, sf_dir):
    """``tag_sentiment_desc`` in SQL alone."""
    sql.register(spark)
    posts = tables.stream_posts(spark, sf_dir, "lang", "text", "entities")
    query = """
        WITH tagged AS (
            SELECT list_rating(rating_words(data.text), :positive, :negative) AS rating,
                   data.entities.hashtags.tag AS tags
            FROM {posts} WHERE data.lang = 'en' AND data.entities.hashtags IS NOT NULL),
        means AS (
            SELECT tag AS hashtag, avg(rating) AS mean
            FROM tagged, LATERAL tags_of(tags) GROUP BY tag)
        SELECT hashtag, round(mean, 2) AS rating FROM means ORDER BY mean DESC, hashtag"""
    listed = {
        name: F.array(*map(F.lit, words))
        for name, words in (("positive", POSITIVE_WORDS), ("negative", NEGATIVE_WORDS))
    }
    return spark.sql(query, args=listed, posts=posts)


def tag_sentiment_desc(spark, sf_dir):
    return tags.tag_sentiment(_base(spark, sf_dir), DEFAULT_LEXICON)


def tag_sentiment_asc(spark, sf_dir):
    return tags.tag_sentiment(_base(spark, sf_dir), DEFAULT_LEXICON, descending=False)


def tag_sentiment_joined(spark, sf_dir):
    """The way long word lists take: the list is joined instead of held in the plan."""
    listed = ", ".join(f"('{word}', {polarity})" for word, polarity in DEFAULT_LEXICON.items())
    words = spark.sql(f"SELECT * FROM VALUES {listed} AS lexicon(word, polarity)")
    return tags.tag_sentiment(_base(spark, sf_dir), words)


def tag_sentiment_from_files(spark, sf_dir):
    """Write the word lists as files, a word a line, and rate with what is read back."""
    lists = {}
    for name, listed in (("positive", POSITIVE_WORDS), ("negative", NEGATIVE_WORDS)):
        values = ", ".join(f"('{word}')" for word in listed)
        lists[name] = scratch_dir(spark, name)
        spark.sql(f"SELECT * FROM VALUES {values} AS words(word)").write.text(lists[name])
    lexicon = readers.read_lexicon(spark, lists["positive"], lists["negative"])
    return tags.tag_sentiment(_base(spark, sf_dir), lexicon, descending=False)


def multi_tag_counts(spark, sf_dir):
    return tags.multi_tag_counts(tables.stream_posts(spark, sf_dir, "id", "lang", "entities"))


def _ranked_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("id", "lang", "author_id", "entities", "public_metrics")
    return tables.stream_posts(spark, sf_dir, *fields)


def popular_account_tags(spark, sf_dir):
    return tags.popular_account_tags(_ranked_posts(spark, sf_dir))


def popular_account_tags_distinct(spark, sf_dir):
    return tags.popular_account_tags(_ranked_posts(spark, sf_dir), distinct_authors=True)


def _annotated_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stream_posts(spark, sf_dir, "lang", "context_annotations")


def lang_topic_rows(spark, sf_dir):
    return topics.lang_topic_rows(_annotated_posts(spark, sf_dir))


def lang_topic_ranking(spark, sf_dir):
    return topics.lang_topic_ranking(_annotated_posts(spark, sf_dir))


def topic_ranking_top(spark, sf_dir):
    return topics.topic_ranking(_annotated_posts(spark, sf_dir))


def topic_ranking(spark, sf_dir):
    return topics.topic_ranking(_annotated_posts(spark, sf_dir), top=None)


def lang_share_top_topics(spark, sf_dir):
    return topics.lang_share_top_topics(_annotated_posts(spark, sf_dir))


def _annotated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.search_pages(spark, sf_dir, "lang", "context_annotations")


def context_lang_percent(spark, sf_dir):
    return topics.context_lang_percent(_annotated_pages(spark, sf_dir))


def context_lang_percent_all(spark, sf_dir):
    return topics.context_lang_percent(
        _annotated_pages(spark, sf_dir), top=None, label_style="domain"
    )


def context_lang_interactions(spark, sf_dir):
    return topics.context_lang_interactions(tables.search_pages(spark, sf_dir))


def context_lang_interactions_all(spark, sf_dir):
    return topics.context_lang_interactions(
        tables.search_pages(spark, sf_dir), top=None, label_style="domain"
    )


def context_interaction_breakdown(spark, sf_dir):
    return topics.context_interaction_breakdown(tables.search_pages(spark, sf_dir), top=None)


def popular_users_metrics(spark, sf_dir):
    return engagement.popular_users_metrics(
        tables.stream_posts(spark, sf_dir, "author_id", "public_metrics")
    )


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagement.user_profiles(tables.profile_pages(spark, sf_dir))


def user_profiles(spark, sf_dir):
    return _profiles(spark, sf_dir)


def tweet_metrics_by_user(spark, sf_dir):
    return engagement.post_metrics_by_user(
        _profiles(spark, sf_dir), tables.timeline_pages(spark, sf_dir)
    )


def tweet_metrics_by_user_salted(spark, sf_dir):
    """With so few rows per share that many accounts are hot keys."""
    return engagement.post_metrics_by_user(
        _profiles(spark, sf_dir), tables.timeline_pages(spark, sf_dir), rows_per_share=50
    )


def user_engagement(spark, sf_dir):
    return engagement.user_engagement(
        _profiles(spark, sf_dir), tables.timeline_pages(spark, sf_dir)
    )


def avg_engagement_rank(spark, sf_dir):
    return engagement.avg_engagement_rank(user_engagement(spark, sf_dir))


def avg_engagement_per_follower_rank(spark, sf_dir):
    return engagement.avg_engagement_per_follower_rank(user_engagement(spark, sf_dir))


def total_engagement_rank(spark, sf_dir):
    return engagement.total_engagement_rank(user_engagement(spark, sf_dir))


def total_engagement_per_follower_rank(spark, sf_dir):
    return engagement.total_engagement_per_follower_rank(user_engagement(spark, sf_dir))


def engagement_profile(spark, sf_dir):
    return engagement.engagement_profile(user_engagement(spark, sf_dir))


def _day_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stream_posts(spark, sf_dir, "text")


def day_tweet_count(spark, sf_dir):
    return weekday.day_post_count(_day_posts(spark, sf_dir))


def day_word_counts(spark, sf_dir):
    return weekday.day_word_counts(_day_posts(spark, sf_dir))


def day_word_counts_sql(spark, sf_dir):
    """``day_word_counts`` in SQL alone."""
    sql.register(spark)
    query = """
        WITH texts AS (SELECT day, data.text AS text FROM {posts} WHERE data.text IS NOT NULL),
        per_day AS (SELECT day, count(*) AS posts FROM texts GROUP BY day),
        counts AS (SELECT day, word, count(*) AS count
                   FROM texts, LATERAL words_of(text) GROUP BY day, word)
        SELECT counts.day, word, count, count * 100 / posts AS `(% format)`
        FROM counts JOIN per_day ON counts.day <=> per_day.day
        ORDER BY count DESC, counts.day, word"""
    return spark.sql(query, posts=_day_posts(spark, sf_dir))


def day_tag_matches(spark, sf_dir):
    return weekday.day_tag_matches_sql(_day_posts(spark, sf_dir), tables.WORD_PATTERNS)


def day_tag_matches_frame(spark, sf_dir):
    return weekday.day_tag_matches(_day_posts(spark, sf_dir), tables.WORD_PATTERNS)


def search_page_cursor(spark, sf_dir):
    pages = paging.parse_pages(tables.page_lines(spark, sf_dir), schemas.CURSOR_PAGE)
    return paging.search_page_cursor(pages)


def search_page_cursor_by_pattern(spark, sf_dir):
    return paging.search_page_cursor_by_pattern(tables.page_lines(spark, sf_dir))


def search_page_cursor_by_path(spark, sf_dir):
    """Land the page text in a folder for each of 16 keys and take the key from the path."""
    source = scratch_dir(spark, "keyed-pages")
    key = (F.col("username").cast("bigint") % 16).cast("string").alias("key")
    lines = tables.page_lines(spark, sf_dir).select("value", key)
    lines.write.partitionBy("key").text(source)
    pages = readers.read_search_pages(spark, f"{source}/key=*", "json", schemas.CURSOR_PAGE)
    return paging.search_page_cursor(paging.key_pages_by_path(pages, "/key=([^/]+)/"))


def pages_to_tweets(spark, sf_dir):
    """Land page text, some of it broken, convert it to one post per row and read that back."""
    source, target = scratch_dir(spark, "pages"), scratch_dir(spark, "posts")
    tables.landed_page_text(spark, sf_dir).write.text(source)
    writers.pages_to_parquet(spark, source, target, schemas.SEARCH_PAGE)
    remove(spark, source)
    return spark.read.parquet(target).select(
        "col.id",
        "col.author_id",
        "col.text",
        F.get_json_object(schemas.LINE, "$.batch").alias("batch"),
        F.col(schemas.CORRUPT_RECORD).alias("broken"),
    )


def _flat(posts: DataFrame, batch: Column | None = None) -> DataFrame:
    """Posts in a flat form; ``batch`` is in the line unless a schema has named it."""
    if batch is None:
        batch = F.get_json_object(schemas.LINE, "$.data.batch")
    return posts.select(
        "data.id",
        "data.lang",
        "data.text",
        F.array_join("data.entities.hashtags.tag", " ").alias("tags"),
        F.col("data.public_metrics.like_count").alias("likes"),
        F.array_size("data.context_annotations").cast("bigint").alias("topics"),
        batch.alias("batch"),
        F.col(schemas.CORRUPT_RECORD).alias("broken"),
    )


def _landed_feed(spark: SparkSession, sf_dir: str) -> str:
    """Posts as JSON lines with a field that no schema names, and some broken lines."""
    feed = scratch_dir(spark, "feed")
    tables.feed_text(spark, sf_dir).write.text(feed)
    return feed


def json_to_parquet(spark, sf_dir):
    """Land posts as JSON, convert the documents to Parquet and read that back."""
    source, target = _landed_feed(spark, sf_dir), scratch_dir(spark, "documents")
    writers.json_to_parquet(spark, source, target, schemas.STREAM_POST)
    remove(spark, source)
    return _flat(spark.read.parquet(target))


def stream_landing(spark, sf_dir):
    """Land posts as JSON, stream the files to Parquet and read that back."""
    target, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "landing-checkpoint")
    source = _landed_feed(spark, sf_dir)
    stream_land(spark, source, target, checkpoint, schemas.STREAM_POST)
    remove(spark, source)
    return _flat(spark.read.parquet(target))


def feed_fields(spark, sf_dir):
    """The fields of landed posts, their types and counts, found without a schema."""
    return discovery.field_counts(tables.feed_text(spark, sf_dir).toDF("value"))


def json_to_parquet_discovered(spark, sf_dir):
    """Land posts as JSON, find their schema, convert with it and read that back."""
    source, target = _landed_feed(spark, sf_dir), scratch_dir(spark, "documents")
    writers.json_to_parquet(spark, source, target, discovery.read_schema(spark, source))
    remove(spark, source)
    return _flat(spark.read.parquet(target), F.col("data.batch"))


def _rotated(spark: SparkSession, sf_dir: str) -> Rotation:
    """Land the feed in three runs, in files of 100 lines; the first one has 99."""
    feed, target = scratch_dir(spark, "feed"), scratch_dir(spark, "rotated")
    checkpoint = scratch_dir(spark, "rotation-checkpoint")
    rotation = Rotation(spark, target, checkpoint, lines_per_file=100, first_file_lines=99)
    lines = tables.feed_text(spark, sf_dir).toDF("value")
    for run in range(3):
        own = lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == run)
        own.write.mode("append").text(feed)
        rotate(feed_stream(spark, feed), rotation, checkpoint).awaitTermination()
    rotation.close()
    remove(spark, feed)
    return rotation


def stream_rotate(spark, sf_dir):
    """``file``, ``lines``: how long the files of a rotated feed are."""
    return _rotated(spark, sf_dir).files().groupBy("file").agg(F.count("*").alias("lines"))


def stream_rotate_posts(spark, sf_dir):
    """The posts in the files of a rotated feed."""
    lines = _rotated(spark, sf_dir).files().select("value")
    return _flat(readers.parse_documents(lines, schemas.STREAM_POST))


# A post whose number is divisible by this comes late, or a second time.
EVERY = 50


def _timed_feed(spark: SparkSession, feed: str) -> DataFrame:
    return event_time.timed(feed_stream(spark, feed, schemas.STREAM_POST))


def stream_daily_counts(spark, sf_dir):
    """``day``, ``tweet_count`` of closed days: posts in two runs, and those that come late."""
    feed, target = scratch_dir(spark, "feed"), scratch_dir(spark, "days")
    checkpoint = scratch_dir(spark, "days-checkpoint")
    posts = tables.timed_posts(spark, sf_dir)
    late = F.col("number") % EVERY == 0
    for run in (~late, late):
        posts.where(run).select("value").write.mode("append").text(feed)
        counts = event_time.daily_counts(_timed_feed(spark, feed))
        event_time.append(counts, target, checkpoint).awaitTermination()
    remove(spark, feed)
    days = spark.read.schema(counts.schema).parquet(target)
    return days.select(F.col("day").cast("string").alias("day"), "tweet_count")


def stream_distinct_posts(spark, sf_dir):
    """Posts of a feed that sends some of them again, at once and after a restart."""
    feed, target = scratch_dir(spark, "feed"), scratch_dir(spark, "distinct")
    checkpoint = scratch_dir(spark, "distinct-checkpoint")
    posts = tables.timed_posts(spark, sf_dir)
    again = posts.where(F.col("number") % EVERY == 0)
    for run in (posts.unionByName(again), again):
        run.select("value").write.mode("append").text(feed)
        once = event_time.distinct_posts(_timed_feed(spark, feed), delay="60 days")
        event_time.append(once, target, checkpoint).awaitTermination()
    remove(spark, feed)
    return spark.read.schema(once.schema).parquet(target).select(
        "data.id", F.col("data.text").alias("text")
    )


def search_page_cursor_stream(spark, sf_dir):
    """Cursors kept as state while the pages of a key arrive in two runs."""
    feed, target = scratch_dir(spark, "feed"), scratch_dir(spark, "cursors")
    checkpoint = scratch_dir(spark, "cursor-checkpoint")
    pages = tables.page_lines(spark, sf_dir)
    keyed = F.to_json(F.struct("username", "value"))
    for run in range(2):
        own = pages.where(F.pmod(F.xxhash64("value"), F.lit(2)) == run)
        own.select(keyed.alias("value")).write.mode("append").text(feed)
        landed = feed_stream(spark, feed, "username STRING, value STRING")
        parsed = paging.parse_pages(landed.select("username", "value"), schemas.CURSOR_PAGE)
        changes = cursors.cursor_changes(parsed)
        cursors.follow(changes, target, checkpoint).awaitTermination()
    remove(spark, feed)
    return cursors.latest(spark.read.schema(changes.schema).parquet(f"{target}/batch=*"))


def _stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of each day, stored day by day; the first capture of one day was not whole."""
    store = DayStore(spark, scratch_dir(spark, "days"), weekday.word_states)
    posts = _day_posts(spark, sf_dir)
    part = posts.where((F.col("day") == tables.DAYS[2]) & (F.length("data.text") % 2 == 0))
    store.put(tables.DAYS[2], part)
    for day in tables.DAYS:
        store.put(day, posts.where(F.col("day") == day))
    return store.read()


def day_tweet_count_stored(spark, sf_dir):
    return weekday.post_count_of(_stored_days(spark, sf_dir))


def day_word_counts_stored(spark, sf_dir):
    return weekday.word_counts_of(_stored_days(spark, sf_dir))


def day_tag_matches_indexed(spark, sf_dir):
    """Tens of thousands of patterns: beginnings and words of some texts of the same tables."""
    return weekday.day_tag_matches_indexed(
        _day_posts(spark, sf_dir), tables.long_patterns(spark, sf_dir)
    )


def popular_account_tags_stream(spark, sf_dir):
    """The leading posts from a feed that arrives in three runs, then the tags of their authors."""
    feed, checkpoint = scratch_dir(spark, "feed"), scratch_dir(spark, "top-checkpoint")
    top = top_k.RunningTop(spark, scratch_dir(spark, "top"))
    lines = tables.feed_text(spark, sf_dir).toDF("value")
    for run in range(3):
        own = lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == run)
        own.write.mode("append").text(feed)
        posts = feed_stream(spark, feed, schemas.STREAM_POST)
        top_k.follow(posts, top, checkpoint).awaitTermination()
    remove(spark, feed)
    return tags.popular_account_tags(_ranked_posts(spark, sf_dir), leading=top.posts())


def _bucketed(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    return bucketed.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, "username", 8)


def user_engagement_bucketed(spark, sf_dir):
    """Profiles and timelines dealt by account once; neither the sums nor the join move them."""
    return engagement.user_engagement(
        _bucketed(_profiles(spark, sf_dir), "bucketed-profiles"),
        _bucketed(tables.timeline_pages(spark, sf_dir), "bucketed-timelines"),
    )


def tweet_metrics_by_user_bucketed(spark, sf_dir):
    return engagement.post_metrics_by_user(
        _bucketed(_profiles(spark, sf_dir), "bucketed-profiles"),
        _bucketed(tables.timeline_pages(spark, sf_dir), "bucketed-timelines"),
    )


def report_csv(spark, sf_dir):
    """Write the language shares as a single headerless CSV file and read that back."""
    target = scratch_dir(spark, "report")
    report = context_lang_percent(spark, sf_dir)
    writers.write_report_csv(report, target, top=50)
    return spark.read.schema(report.schema).csv(target)


QUERIES: dict[str, Query] = {
    "hashtag_base": hashtag_base,
    "frequent_tags": frequent_tags,
    "avg_tweet_length_by_tag": avg_tweet_length_by_tag,
    "tag_sentiment_desc": tag_sentiment_desc,
    "tag_sentiment_asc": tag_sentiment_asc,
    "tag_sentiment_joined": tag_sentiment_joined,
    "tag_sentiment_from_files": tag_sentiment_from_files,
    "lang_topic_rows": lang_topic_rows,
    "lang_topic_ranking": lang_topic_ranking,
    "topic_ranking_top": topic_ranking_top,
    "topic_ranking": topic_ranking,
    "lang_share_top_topics": lang_share_top_topics,
    "popular_users_metrics": popular_users_metrics,
    "multi_tag_counts": multi_tag_counts,
    "popular_account_tags": popular_account_tags,
    "popular_account_tags_distinct": popular_account_tags_distinct,
    "context_lang_percent": context_lang_percent,
    "context_lang_percent_all": context_lang_percent_all,
    "context_lang_interactions": context_lang_interactions,
    "context_lang_interactions_all": context_lang_interactions_all,
    "context_interaction_breakdown": context_interaction_breakdown,
    "user_profiles": user_profiles,
    "tweet_metrics_by_user": tweet_metrics_by_user,
    "tweet_metrics_by_user_salted": tweet_metrics_by_user_salted,
    "user_engagement": user_engagement,
    "avg_engagement_rank": avg_engagement_rank,
    "avg_engagement_per_follower_rank": avg_engagement_per_follower_rank,
    "total_engagement_rank": total_engagement_rank,
    "total_engagement_per_follower_rank": total_engagement_per_follower_rank,
    "engagement_profile": engagement_profile,
    "day_tweet_count": day_tweet_count,
    "day_word_counts": day_word_counts,
    "day_tag_matches": day_tag_matches,
    "day_tag_matches_frame": day_tag_matches_frame,
    "search_page_cursor": search_page_cursor,
    "search_page_cursor_by_pattern": search_page_cursor_by_pattern,
    "search_page_cursor_by_path": search_page_cursor_by_path,
    "pages_to_tweets": pages_to_tweets,
    "json_to_parquet": json_to_parquet,
    "stream_land": stream_landing,
    "report_csv": report_csv,
    "frequent_tags_sketched": frequent_tags_sketched,
    "avg_tweet_length_by_tag_sql": avg_tweet_length_by_tag_sql,
    "tag_sentiment_sql": tag_sentiment_sql,
    "day_word_counts_sql": day_word_counts_sql,
    "day_tweet_count_stored": day_tweet_count_stored,
    "day_word_counts_stored": day_word_counts_stored,
    "day_tag_matches_indexed": day_tag_matches_indexed,
    "popular_account_tags_stream": popular_account_tags_stream,
    "user_engagement_bucketed": user_engagement_bucketed,
    "tweet_metrics_by_user_bucketed": tweet_metrics_by_user_bucketed,
    "feed_fields": feed_fields,
    "json_to_parquet_discovered": json_to_parquet_discovered,
    "stream_rotate": stream_rotate,
    "stream_rotate_posts": stream_rotate_posts,
    "stream_daily_counts": stream_daily_counts,
    "stream_distinct_posts": stream_distinct_posts,
    "search_page_cursor_stream": search_page_cursor_stream,
}
