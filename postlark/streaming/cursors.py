"""Cursors of request keys as the state of a stream of pages.

The batch query ``paging.search_page_cursor`` reads all pages again to say where to go on. Here
each key has its number of hits and its smallest id as state, a page changes that of its key alone,
and each batch gives the cursors that changed. A timer of the key tells when no page has come for a
while: the key is stalled, and its request may be sent again.

State is two numbers a key, in RocksDB; pages are added up in the task that keeps their key. A batch
of a key costs a few calls of the state, so rows go to the task and back in batches of many keys.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from postlark.streaming.event_time import rocksdb_state, set_while

STALL = 15 * 60

_STATE = "hits BIGINT, until_id BIGINT"
_CURSOR = "{key} STRING, hits BIGINT, until_id STRING, stalled BOOLEAN"


class _Cursor(StatefulProcessor):
    def __init__(self, key: str, stall_seconds: float):
        self.key, self.stall = key, int(stall_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", _STATE)
        self.row = Row(self.key, "hits", "until_id", "stalled")

    def _row(self, key, hits, until, stalled: bool) -> Row:
        return self.row(key[0], hits, None if until is None else str(until), stalled)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.cursor.get()
        hits, until = before or (0, None)
        for page in rows:
            hits += page["hit"]
            if page["oldest"] is not None:
                own = int(page["oldest"])
                until = own if until is None else min(until, own)
        self.cursor.update((hits, until))
        # Only a key that has been seen before has a timer.
        if before is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stall)
        yield self._row(key, hits, until, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        hits, until = self.cursor.get()
        yield self._row(key, hits, until, True)

    def close(self) -> None:
        pass


def cursor_changes(
    pages: DataFrame, key: str = "username", stall_seconds: float = STALL
) -> DataFrame:
    """``key``, ``hits``, ``until_id``, ``stalled``: the cursors that each batch of pages changes.

    Pages without a key share the state of the empty key. See ``paging.search_page_cursor``.
    """
    hit = F.col("data").isNotNull()
    oldest = F.when(hit, F.col("meta.oldest_id").try_cast("bigint"))
    own = pages.select(
        F.coalesce(key, F.lit("")).alias(key),
        hit.cast("int").alias("hit"),
        oldest.alias("oldest"),
    )
    return own.groupBy(key).transformWithState(
        _Cursor(key, stall_seconds), _CURSOR.format(key=key), "Update", "ProcessingTime"
    )


def latest(changes: DataFrame, key: str = "username") -> DataFrame:
    """``key``, ``hits``, ``until_id`` as the batch query gives them, from all changes so far."""
    newest = changes.groupBy(key).agg(
        F.max("hits").alias("hits"), F.min(F.col("until_id").cast("decimal(20,0)")).alias("until_id")
    )
    return newest.withColumn("until_id", F.col("until_id").cast("string"))


def follow(
    changes: DataFrame, target: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start writing the changes of each batch to a folder ``batch=<id>`` of its own.

    A repeated batch replaces its folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    writer = (
        changes.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    spark = changes.sparkSession
    with rocksdb_state(spark):
        if interval is not None:
            return writer.trigger(processingTime=interval).start()
        # With timers about, a query would go on looking at them and never end by itself. Those that
        # are due are seen by the next start that finds pages.
        with set_while(spark, ("spark.sql.streaming.noDataMicroBatches.enabled", "false")):
            return writer.trigger(availableNow=True).start()
