"""Session settings and tables in the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Used where that setting is empty, as in tests. Without a scheme Spark places it on the session's
# default file system, which all executors share.
DEFAULT_SCRATCH = "/tmp/postlark-scratch"

# Adaptive execution sizes reducers from the measured map output and splits skewed join
# partitions; the library leaves partition counts to it.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = 8, app: str = "postlark", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in ADAPTIVE_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``, else on the default file system."""
    shared = spark.conf.get(CHECKPOINT_CONF, None) or DEFAULT_SCRATCH
    return f"{shared.rstrip('/')}/postlark/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    This cuts the lineage: a lost executor costs the tasks it was running, not what came before.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more, and old shuffle files."""
    for table in tables:
        remove(table.sparkSession, table.scratch_path)
    if tables:
        drop_shuffles(tables[0].sparkSession)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished queries deleted.

    Spark drops them when the driver's JVM collects garbage, which may take long on a quiet driver.
    """
    spark.sparkContext._jvm.System.gc()


def _located(spark: SparkSession, path: str):
    """A path and the file system it lies on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, on whatever file system it lies."""
    target, system = _located(spark, path)
    system.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _located(spark, path)
    return system.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    target, system = _located(spark, path)
    if not system.exists(target):
        return []
    found = [entry for entry in system.listStatus(target) if entry.isDirectory()]
    names = [entry.getPath().getName() for entry in found]
    return [name for name in names if not name.startswith(("_", "."))]
