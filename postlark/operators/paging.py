"""Landed API pages: parsing, request keys, cursors and expansion to posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.schemas import CORRUPT_RECORD, LINE, SEARCH_PAGE


def parse_pages(lines: DataFrame, schema: str = SEARCH_PAGE) -> DataFrame:
    """Parse the JSON text in ``value`` into the page's columns; other columns stay."""
    others = [name for name in lines.columns if name != "value"]
    return lines.select(*others, F.from_json("value", schema).alias("page")).select(
        *others, "page.*"
    )


def key_pages_by_path(pages: DataFrame, pattern: str, name: str = "username") -> DataFrame:
    """Add the request key found in the path of the file a page was landed in."""
    return pages.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def search_page_cursor(pages: DataFrame, key: str = "username") -> DataFrame:
    """Per request key: the number of ``hits`` and the id to continue before, ``until_id``.

    A page with posts is a hit. Paging runs backwards, so the last page holds the smallest
    id; ids are compared as numbers.
    """
    hit = F.col("data").isNotNull()
    oldest = F.when(hit, F.col("meta.oldest_id").try_cast("bigint"))
    return pages.groupBy(key).agg(
        F.count_if(hit).alias("hits"), F.min(oldest).cast("string").alias("until_id")
    )


def search_page_cursor_by_pattern(lines: DataFrame, key: str = "username") -> DataFrame:
    """``search_page_cursor`` from the page text alone, without parsing the posts."""
    hit = F.col("value").contains('"data":[')
    oldest = F.regexp_extract("value", r'.*oldest_id":"(\d+).*', 1)
    known = F.when(hit, oldest.try_cast("bigint"))
    return lines.groupBy(key).agg(
        F.count_if(hit).alias("hits"), F.min(known).cast("string").alias("until_id")
    )


def page_fields(pages: DataFrame, *fields: str) -> DataFrame:
    """One row per element of ``data``, with the named fields as columns.

    The fields are picked from the array before it is expanded, so that the scan reads them
    and no others; after an ``explode`` of whole elements it would read them entirely.
    """
    return pages.select(F.inline(F.arrays_zip(*[F.col(f"data.{name}") for name in fields])))


def pages_to_posts(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of ``data``, in the struct column ``col``."""
    return pages.select(*keep, F.explode("data").alias("col"))


def page_elements(documents: DataFrame) -> DataFrame:
    """The elements of parsed pages without loss: ``col``, ``_line`` and ``_corrupt_record``.

    ``_line`` is the JSON text of the element. A line that is not valid JSON stays as a row
    without an element.
    """
    texts = F.from_json(LINE, "data ARRAY<STRING>")["data"]
    none = F.lit(None).cast(documents.schema["data"].dataType.elementType)
    broken = F.array(F.struct(none.alias("data"), F.col(LINE).alias("_texts")))
    elements = F.when(F.col(CORRUPT_RECORD).isNotNull(), broken).otherwise(
        F.arrays_zip("data", "_texts")
    )
    rows = documents.withColumn("_texts", texts).select(F.inline(elements), CORRUPT_RECORD)
    return rows.select(F.col("data").alias("col"), F.col("_texts").alias(LINE), CORRUPT_RECORD)


def stream_shape(posts: DataFrame) -> DataFrame:
    """Expanded posts in the stream shape, so that the tag and topic operators take them."""
    return posts.withColumnRenamed("col", "data")
