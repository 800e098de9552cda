"""Tables dealt and sorted by a key when they are written, for joins and sums that repeat.

Each join or sum by that key then reads matching buckets side by side: the facts are shuffled once,
when they are written, and by no query after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def write_bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int = BUCKETS, mode: str = "errorifexists"
) -> DataFrame:
    """Write ``df`` as the table ``name`` in ``path``, in buckets sorted by ``key``, and read it.

    Tables that are to be joined need the same number of buckets: about as many as a reader has
    cores, and enough that one fits into a task. Rows are dealt by the key before they are written,
    so that a bucket is one file.
    """
    writer = df.repartition(buckets, key).write.mode(mode).option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def drop(spark: SparkSession, name: str) -> None:
    """Forget a table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
