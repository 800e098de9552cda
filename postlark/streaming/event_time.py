"""Posts by the time they were written: daily counts of a stream, late posts, and repeats.

Days are those of UTC. A post without a time that can be read belongs to no day; ``timed`` keeps it,
with NULL, and the stateful operators leave it out.

The rule for late posts is that of a watermark: it trails the latest time seen in earlier batches by
``delay``, and a day that ended at or before it is closed. Posts of closed days that arrive are late
and count no more; posts of other days count, however old they are.

State is kept on the executors' disks by RocksDB and in the checkpoint, in as many parts as there are
shuffle partitions at the first start.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DELAY = "2 days"

_PROVIDER = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


@contextmanager
def set_while(spark: SparkSession, *settings: tuple[str, str]) -> Iterator[None]:
    """Session settings for what starts inside."""
    before = [(name, spark.conf.get(name, None)) for name, _ in settings]
    for name, value in settings:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before:
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, beyond the memory of an executor."""
    with set_while(spark, _PROVIDER):
        yield


def timed(posts: DataFrame) -> DataFrame:
    """Posts with ``event_time`` from ``data.created_at``, such as 2021-04-01T12:30:00.000Z."""
    return posts.withColumn("event_time", F.col("data.created_at").try_cast("timestamp"))


def day_of(time: Column) -> Column:
    """The day of a time in UTC, whatever the session's time zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86_400).cast("int"))


def daily_counts(posts: DataFrame, delay: str = DELAY) -> DataFrame:
    """``day``, ``tweet_count`` of timed posts with a text; a stream gives closed days only."""
    written = posts.where(F.col("event_time").isNotNull() & F.col("data.text").isNotNull())
    days = written.withWatermark("event_time", delay).groupBy(F.window("event_time", "1 day"))
    return days.agg(F.count("*").alias("tweet_count")).select(
        day_of(F.col("window.start")).alias("day"), "tweet_count"
    )


def distinct_posts(posts: DataFrame, delay: str = DELAY, key: str = "data.id") -> DataFrame:
    """Timed posts without repeats: the first of an id, and no other of it within ``delay``.

    A feed that reconnects sends posts again soon after; ids are kept that long and then forgotten.
    Posts without a time or an id pass, as nothing tells whether they are repeats.
    """
    keyed = posts.withColumn("_key", F.col(key))
    known = F.col("event_time").isNotNull() & F.col("_key").isNotNull()
    once = (
        keyed.where(known)
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["_key"])
    )
    return once.unionByName(keyed.where(~known)).drop("_key")


def append(
    stream: DataFrame, target: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start appending finished rows to Parquet files; see ``landing.land`` for the interval."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    with rocksdb_state(stream.sparkSession):
        return writer.trigger(**trigger).start(target)
