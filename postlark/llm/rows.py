"""Rows as single values, so that an operator's own columns cannot clash with theirs; small batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def whole_row(df: DataFrame) -> Column:
    """All columns of a row in one struct."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def with_text(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` from ``_row``, with the text ``_new`` and its number of characters.

    ``n_chars`` is counted anew where the text changed, if there is such a column.
    """
    same = F.col("_row.text").eqNullSafe(F.col("_new"))
    new = {"text": F.col("_new")}
    if "n_chars" in like.columns:
        old = F.col("_row.n_chars")
        kind = like.schema["n_chars"].dataType
        new["n_chars"] = F.when(same, old).otherwise(F.length("_new").cast(kind))
    return rows.select(
        *[new.get(name, F.col("_row")[name]).alias(name) for name in like.columns]
    )


def release() -> None:
    """Give back the memory that a worker has freed, before it waits for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """What runs inside hands texts to Python a few at a time, so that a batch takes little room."""
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)
