"""A small table that each batch of a stream replaces, once however often the batch is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlark.session import exists, folders, remove


class BatchTable:
    """The table lies in a folder of its batch, and its success marker is the batch's commit.

    A batch that failed before has not changed the table of the batch before, from which its next
    attempt starts. Older tables are deleted, so there is one of them, or two for a moment.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.schema = schema

    def path(self, batch: int) -> str:
        return f"{self.folder}/batch={batch}"

    def committed(self) -> int | None:
        """The last batch that is done."""
        ids = [int(name.partition("=")[2]) for name in folders(self.spark, self.folder)]
        return max((i for i in ids if exists(self.spark, f"{self.path(i)}/_SUCCESS")), default=None)

    def done(self, batch: int) -> bool:
        before = self.committed()
        return before is not None and batch <= before

    def read(self) -> DataFrame:
        """The table as the last batch left it; empty before the first."""
        before = self.committed()
        if before is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path(before))

    def replace(self, table: DataFrame, batch: int) -> None:
        """Commit a batch with its table, which may read the one before."""
        before = self.committed()
        table.write.mode("overwrite").parquet(self.path(batch))
        if before is not None:
            remove(self.spark, self.path(before))
