"""Aggregate states by day, so that a new or corrected day never reads the others again.

Each day's capture is summed up once, by functions such as ``weekday.word_states``, and its sums are
stored. A manifest, one row a day, says where the sums of each day are; it is written anew under the
next number when a day comes in, so a reader sees the old state or the new one. Results are merged
from the sums on reading.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.session import folders, remove
from postlark.streaming.commits import BatchTable

_MANIFEST = "day STRING, path STRING"


class DayStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        summarise: Callable[[DataFrame], DataFrame],
    ):
        """``summarise`` turns posts with a ``day`` into sums with the same ``day``."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.summarise = summarise
        self.manifest = BatchTable(spark, f"{self.root}/manifest", _MANIFEST)

    def paths(self) -> dict[str, str]:
        """The folder of each day's sums."""
        return {row.day: row.path for row in self.manifest.read().collect()}

    def put(self, day: str, posts: DataFrame) -> None:
        """Store a day's capture, in place of an earlier one of that day."""
        if day is None:
            raise ValueError("a capture has a day")
        path = f"{self.root}/days/{uuid.uuid4().hex}"
        self.summarise(posts.withColumn("day", F.lit(day))).write.parquet(path)
        known = self.paths()
        replaced = known.get(day)
        rows = [*{**known, day: path}.items()]
        number = self.manifest.committed()
        # One row a day, in one file.
        table = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        self.manifest.replace(table, 0 if number is None else number + 1)
        if replaced:
            remove(self.spark, replaced)

    def read(self) -> DataFrame | None:
        """The sums of all days; None before the first."""
        parts = [self.spark.read.parquet(path) for path in self.paths().values()]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def clean(self) -> int:
        """Delete sums that no day refers to, as a failed writer leaves them; how many there were."""
        used = {path.rsplit("/", 1)[1] for path in self.paths().values()}
        left = [name for name in folders(self.spark, f"{self.root}/days") if name not in used]
        for name in left:
            remove(self.spark, f"{self.root}/days/{name}")
        return len(left)
