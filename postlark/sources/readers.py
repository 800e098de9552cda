"""Readers with declared schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.schemas import (
    CORRUPT_RECORD,
    LINE,
    PROFILE_PAGE,
    SEARCH_PAGE,
    STREAM_POST,
    TIMELINE_PAGE,
    keeping_corrupt,
)


def parse_documents(lines: DataFrame, schema: str) -> DataFrame:
    """JSON text in ``value`` as columns, without loss.

    The line itself stays in ``_line``, with whatever fields the schema does not name, and a
    line that is not valid JSON is a row with its text in ``_corrupt_record`` as well. Empty
    lines are no documents.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}
    page = F.from_json("value", keeping_corrupt(schema), options)
    filled = lines.filter(F.trim("value") != "")
    return filled.select(page.alias("page"), F.col("value").alias(LINE)).select("page.*", LINE)


def read_documents(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines from a file or folder as columns, without loss; see ``parse_documents``."""
    return parse_documents(spark.read.text(path), schema)


def read_stream_posts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Posts in the stream shape."""
    return spark.read.schema(STREAM_POST).format(fmt).load(path)


def read_search_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str = SEARCH_PAGE
) -> DataFrame:
    """Search pages, one row per page; ``TOPIC_PAGE`` is enough for the topic reports."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_timeline_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Timeline pages with the account name they were requested for."""
    return spark.read.schema(TIMELINE_PAGE).format(fmt).load(path)


def read_profile_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Profile pages, one row per lookup."""
    return spark.read.schema(PROFILE_PAGE).format(fmt).load(path)


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Page text in ``value``, not parsed yet."""
    return spark.read.text(path)


def read_daily_captures(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Stream posts of several daily captures, told apart by the column ``day``."""
    captures = [
        read_stream_posts(spark, path).withColumn("day", F.lit(day)) for day, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, captures)


def read_lexicon(spark: SparkSession, positive_path: str, negative_path: str) -> DataFrame:
    """``word``, ``polarity`` from two word lists; a word in both lists is positive."""
    lists = [
        spark.read.text(path).select(
            F.col("value").alias("word"), F.lit(polarity).alias("polarity")
        )
        for path, polarity in ((positive_path, 1), (negative_path, -1))
    ]
    merged = lists[0].union(lists[1]).filter(F.col("word") != "")
    return merged.groupBy("word").agg(F.max("polarity").alias("polarity"))
