"""Rotation of a feed into files of a set number of lines, whatever batches they arrive in.

Lines are numbered in the order in which they are read, so the file of a line follows from its
number, and a batch of any size is cut in parallel: every file is written by one task and holds at most
``lines_per_file`` lines. Lines of the last file, while it is not full, wait in a table beside the
checkpoint and are taken up by the next batch.

The table of a batch is also its commit. A batch that is repeated after its commit does nothing; one
that failed before starts again from the table of the batch before and overwrites the files it had
begun. Older tables are deleted, so the state is one table of less than a file's lines, however many
files have landed. See ``landing.feed_stream`` for the names of source files that Spark keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from postlark.session import discard, folders, stored
from postlark.streaming.commits import BatchTable
from postlark.streaming.landing import RECORDS_PER_FILE

_OPEN = "number BIGINT, value STRING"
# A task numbers its rows in the lower bits of ``monotonically_increasing_id``.
_TASK_BITS = 33


class Rotation:
    """Files of lines in ``target``, one folder ``file=<number>`` each, from number 0 on."""

    def __init__(
        self,
        spark: SparkSession,
        target: str,
        checkpoint: str,
        lines_per_file: int = RECORDS_PER_FILE,
        first_file_lines: int | None = None,
    ):
        """The first file may have fewer lines than the others, as a feed that counts from one has."""
        if not 0 < (first_file_lines or lines_per_file) <= lines_per_file:
            raise ValueError("a file has at least one line, and the first not more than others")
        self.spark = spark
        self.target = target
        # The waiting lines, and a row without text that has the number of the last line.
        self.open = BatchTable(spark, f"{checkpoint.rstrip('/')}/rotation", _OPEN)
        self.lines_per_file = lines_per_file
        self.skipped = lines_per_file - (first_file_lines or lines_per_file)

    def _file(self, number: Column) -> Column:
        return F.call_function("div", number - 1 + self.skipped, F.lit(self.lines_per_file))

    def open_lines(self) -> DataFrame:
        """``number``, ``value`` of the lines that wait for their file to fill."""
        return self.open.read().where("value IS NOT NULL")

    def files(self) -> DataFrame:
        """``file``, ``value`` of the lines in full files."""
        if not folders(self.spark, self.target):
            return self.spark.createDataFrame([], "value STRING, file BIGINT").select("file", "value")
        found = self.spark.read.schema("value STRING, file BIGINT").text(self.target)
        return found.select("file", "value")

    def add(self, lines: DataFrame, batch: int) -> None:
        """Land the lines in ``value`` of one batch."""
        if self.open.done(batch):
            return
        waiting = self.open.read()
        last = waiting.agg(F.max("number")).first()[0] or 0
        new = stored(
            lines.where(F.col("value").isNotNull()).select(
                "value", F.monotonically_increasing_id().alias("id")
            ),
            "rotation",
        )
        task = F.shiftright("id", _TASK_BITS).alias("task")
        # One row for each task that read lines.
        sizes = new.groupBy(task).agg(F.count("*").alias("size"))
        before_task = F.sum("size").over(Window.orderBy("task")) - F.col("size") + last
        starts = F.broadcast(sizes.select("task", before_task.alias("start")))
        place = F.col("id").bitwiseAND(F.lit((1 << _TASK_BITS) - 1)) + 1
        numbered = (
            new.select("value", "id", task)
            .join(starts, "task")
            .select((F.col("start") + place).alias("number"), "value")
        )
        every = waiting.where("value IS NOT NULL").unionByName(numbered)
        last += sizes.agg(F.sum("size")).first()[0] or 0
        full = (last + self.skipped) // self.lines_per_file
        placed = every.withColumn("file", self._file(F.col("number")))
        self._write(placed.where(F.col("file") < full))
        left = placed.where(F.col("file") >= full).select("number", "value")
        end = self.spark.createDataFrame([(last, None)], T._parse_datatype_string(_OPEN))
        self.open.replace(left.unionByName(end), batch)
        discard(new)

    def _write(self, placed: DataFrame) -> None:
        """Whole files, each by one task; files of an attempt that failed are replaced."""
        (
            placed.repartition("file")
            .sortWithinPartitions("file", "number")
            .select("file", "value")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("file")
            .text(self.target)
        )

    def close(self) -> None:
        """Land the waiting lines as a last, shorter file, when the feed has ended."""
        lines = self.open_lines().withColumn("file", self._file(F.col("number")))
        self._write(lines)


def rotate(
    stream: DataFrame, rotation: Rotation, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start landing a stream of lines in ``value``; see ``landing.land`` for the interval."""
    writer = stream.writeStream.foreachBatch(rotation.add).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()
