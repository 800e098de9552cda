"""Frequent values by a sketch first: most values are rare, and their counts need not be shuffled.

Values are hashed into a fixed number of buckets, and a bucket's count is never less than that of any
value in it. Buckets add up over files and days, so their counts may be stored and merged. Only values
in buckets above the threshold are counted themselves, so the result is exact. The sketch pays while
the threshold is above the mean count of a bucket; below it no bucket can be left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 20


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def bucket_counts(values: DataFrame, column: str, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: at most ``buckets`` rows, added up in each task first."""
    return values.groupBy(_bucket(F.col(column), buckets).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def merged_buckets(*sketches: DataFrame) -> DataFrame:
    """Bucket counts of several files or days as those of all of them."""
    every = sketches[0]
    for sketch in sketches[1:]:
        every = every.unionByName(sketch)
    return every.groupBy("bucket").agg(F.sum("n").alias("n"))


def frequent_values(
    values: DataFrame,
    column: str,
    min_count: int,
    sketch: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``column``, ``count`` of the values that occur more than ``min_count`` times.

    ``sketch`` may hold the bucket counts of all values; otherwise they are counted here.
    """
    sketch = bucket_counts(values, column, buckets) if sketch is None else sketch
    # At most ``buckets`` numbers.
    heavy = F.broadcast(sketch.filter(F.col("n") > min_count).select("bucket"))
    return (
        values.select(column, _bucket(F.col(column), buckets).alias("bucket"))
        .join(heavy, "bucket", "left_semi")
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .filter(F.col("count") > min_count)
    )
