"""Command-line jobs over landed files: ``spark-submit`` or ``python -m postlark.jobs``.

Each report is written below ``--out``, or shown when no output folder is given.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from postlark import schemas
from postlark.operators import engagement, tags, topics, weekday
from postlark.operators.paging import key_pages_by_path, parse_pages, search_page_cursor
from postlark.session import stored
from postlark.sources import readers, writers
from postlark.sources.lexicon import DEFAULT_LEXICON
from postlark.streaming.landing import MAX_FILE_AGE, stream_land

Reports = dict[str, tuple[DataFrame, int | None]]

DOCUMENT_SCHEMAS = {
    "posts": schemas.STREAM_POST,
    "search": schemas.SEARCH_PAGE,
    "timelines": schemas.TIMELINE_PAGE,
    "profiles": schemas.PROFILE_PAGE,
}


def tag_reports(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """Text length, sentiment, co-use and popular-account tags of stream posts."""
    posts = readers.read_stream_posts(spark, args.posts)
    base = tags.hashtag_base(posts, args.lang)
    if bool(args.positive) != bool(args.negative):
        raise ValueError("--positive and --negative go together")
    lexicon = DEFAULT_LEXICON
    if args.positive:
        lexicon = readers.read_lexicon(spark, args.positive, args.negative)
    # The texts are rated once, and both rankings sort what is stored.
    means = stored(tags.mean_ratings(base, lexicon), "tag-ratings")
    return {
        "avg_length": (tags.avg_length_by_tag(base, args.min_count), None),
        "sentiment_best": (tags.ranked_ratings(means), None),
        "sentiment_worst": (tags.ranked_ratings(means, descending=False), None),
        "multi_tag": (tags.multi_tag_counts(posts, args.lang), None),
        "popular_account_tags": (tags.popular_account_tags(posts, args.lang, args.top_n), None),
    }


def topic_reports(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """Languages by topic and engagement by author of stream posts."""
    posts = readers.read_stream_posts(spark, args.posts)
    return {
        "lang_topics": (topics.lang_topic_ranking(posts), None),
        "topics": (topics.topic_ranking(posts), 20),
        "lang_shares": (topics.lang_share_top_topics(posts), None),
        "popular_users": (engagement.popular_users_metrics(posts), None),
    }


def context_reports(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """Language shares and interactions per context of search pages."""
    pages = readers.read_search_pages(spark, args.pages, args.format, schemas.TOPIC_PAGE)
    return {
        "context_lang_percent": (topics.context_lang_percent(pages), 50),
        "context_lang_interactions": (topics.context_lang_interactions(pages), 50),
    }


def user_reports(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """Engagement of the accounts in profile and timeline pages."""
    profiles = engagement.user_profiles(readers.read_profile_pages(spark, args.profiles))
    pages = readers.read_timeline_pages(spark, args.timelines)
    # The timelines are read once, and the five rankings sort what is stored.
    figures = stored(engagement.user_engagement(profiles, pages, args.ignore_case), "engagement")
    reports = {
        "avg_engagement": engagement.avg_engagement_rank,
        "avg_engagement_per_follower": engagement.avg_engagement_per_follower_rank,
        "total_engagement": engagement.total_engagement_rank,
        "total_engagement_per_follower": engagement.total_engagement_per_follower_rank,
        "engagement_profile": engagement.engagement_profile,
    }
    return {name: (report(figures), None) for name, report in reports.items()}


def day_reports(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """Posts, words and tags per daily capture, given as ``day=path``."""
    paths = dict(capture.split("=", 1) for capture in args.captures)
    posts = readers.read_daily_captures(spark, paths)
    return {
        "posts": (weekday.day_post_count(posts), None),
        "words": (weekday.day_word_counts(posts), None),
        "tags": (weekday.day_tag_matches_sql(posts), None),
    }


def cursors(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """Hits and continuation id per request key of landed page text."""
    if args.key_pattern:
        found = readers.read_search_pages(spark, args.pages, "json", schemas.CURSOR_PAGE)
        pages = key_pages_by_path(found, args.key_pattern)
    else:
        lines = readers.read_page_lines(spark, args.pages)
        pages = parse_pages(lines, f"username STRING, {schemas.CURSOR_PAGE}")
    return {"cursors": (search_page_cursor(pages), None)}


def convert(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """JSON documents to Parquet, whole or one row per page element."""
    job = writers.pages_to_parquet if args.expand else writers.json_to_parquet
    job(spark, args.source, args.target, DOCUMENT_SCHEMAS[args.documents], args.mode)
    return {}


def land(spark: SparkSession, args: argparse.Namespace) -> Reports:
    """Feed files to Parquet, continuing behind the checkpoint."""
    paths = (args.source, args.target, args.checkpoint)
    age = args.max_file_age
    stream_land(spark, *paths, schemas.STREAM_POST, interval=args.interval, max_file_age=age)
    return {}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="postlark.jobs", description=__doc__)
    top.add_argument("--out", help="folder for the reports, one CSV folder each")
    top.add_argument("--mode", default="errorifexists", help="save mode")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *paths):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(path)
        return sub

    sub = job("tags", tag_reports, "posts")
    sub.add_argument("--lang", default="en")
    sub.add_argument("--min-count", type=int, default=100)
    sub.add_argument("--top-n", type=int, default=200)
    sub.add_argument("--positive", help="word list")
    sub.add_argument("--negative", help="word list")
    job("topics", topic_reports, "posts")
    sub = job("contexts", context_reports, "pages")
    sub.add_argument("--format", default="parquet", choices=["parquet", "json"])
    sub = job("users", user_reports, "profiles", "timelines")
    sub.add_argument("--ignore-case", action="store_true")
    sub = job("days", day_reports)
    sub.add_argument("captures", nargs="+", metavar="day=path")
    sub = job("cursors", cursors, "pages")
    sub.add_argument("--key-pattern", help="regular expression: its group is the key in the path")
    sub = job("convert", convert, "source", "target")
    sub.add_argument("--documents", default="posts", choices=sorted(DOCUMENT_SCHEMAS))
    sub.add_argument("--expand", action="store_true", help="one row per element of data")
    sub = job("land", land, "source", "target", "checkpoint")
    sub.add_argument("--interval", help="keep running and look for files this often")
    sub.add_argument("--max-file-age", default=MAX_FILE_AGE, help="older files are not landed")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("postlark").getOrCreate()
    for name, (report, top) in args.run(spark, args).items():
        if args.out:
            writers.write_report_csv(report, f"{args.out.rstrip('/')}/{name}", top, args.mode)
        else:
            print(name)
            report.show(truncate=False)


if __name__ == "__main__":
    main()
