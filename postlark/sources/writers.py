"""Writers with an explicit save mode, and the JSON to Parquet conversion jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlark.operators.paging import page_elements
from postlark.sources.readers import read_documents


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet files in the partitioning of ``df``."""
    df.write.mode(mode).parquet(path)


def write_daily_captures(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Posts in one folder per ``day``, so that a day's query reads that folder only."""
    posts.write.mode(mode).partitionBy("day").parquet(path)


def write_report_csv(
    report: DataFrame, path: str, top: int | None = None, mode: str = "errorifexists"
) -> None:
    """Headerless CSV. A report limited to its ``top`` rows goes into a single file.

    Without a limit each task writes its own file, numbered in the order of the report.
    """
    out = report if top is None else report.limit(top).coalesce(1)
    out.write.mode(mode).csv(path)


def json_to_parquet(
    spark: SparkSession, source: str, target: str, schema: str, mode: str = "errorifexists"
) -> None:
    """Convert whole JSON documents, one row per document, with the line of each.

    Broken lines and fields outside the schema are kept; see ``readers.parse_documents``.
    """
    write_parquet(read_documents(spark, source, schema), target, mode)


def pages_to_parquet(
    spark: SparkSession, source: str, target: str, schema: str, mode: str = "errorifexists"
) -> None:
    """Convert JSON pages, one row per element of ``data`` in the column ``col``.

    ``_line`` has the JSON text of the element, with all its fields. A broken line is a row
    without an element. A page without elements has no row.
    """
    write_parquet(page_elements(read_documents(spark, source, schema)), target, mode)
