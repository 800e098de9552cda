"""Landing of a growing folder of feed files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postlark.sources.readers import parse_documents

RECORDS_PER_FILE = 100_000

# A file is landed however much older it is than the newest one. The checkpoint keeps the names
# of files this long, so a feed that removes its old files may set less.
MAX_FILE_AGE = "36500d"


def feed_stream(
    spark: SparkSession,
    source: str,
    schema: str | None = None,
    files_per_trigger: int = 1_000,
    max_file_age: str = MAX_FILE_AGE,
    archive: str | None = None,
) -> DataFrame:
    """Feed files as a stream of raw lines in ``value``, or of documents parsed with ``schema``.

    Parsed documents keep their line, see ``readers.parse_documents``.

    With an ``archive`` folder, files move there once a later batch has landed. Together with a
    short ``max_file_age`` the checkpoint then keeps the names of few files: older names are
    forgotten, and their files are gone from the source. A file that arrives with an older date than
    that is not landed, and as only landed files move, it is still there.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.option("maxFileAge", max_file_age).text(source)
    return lines if schema is None else parse_documents(lines, schema)


def land(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    records_per_file: int = RECORDS_PER_FILE,
    interval: str | None = None,
) -> StreamingQuery:
    """Start landing a stream in files of limited length.

    Without an ``interval`` the query lands what has arrived and stops by itself; with one,
    such as ``"1 minute"``, it keeps looking for new files. The checkpoint remembers the
    files already landed: a restart, also after a failure, continues behind them, and the
    sink's log keeps a repeated batch from landing twice.
    """
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", records_per_file)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start(target)
    return writer.trigger(processingTime=interval).start(target)


def stream_land(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str | None = None,
    fmt: str = "parquet",
    records_per_file: int = RECORDS_PER_FILE,
    files_per_trigger: int = 1_000,
    interval: str | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> None:
    """Land the files of a feed folder and wait until the query ends."""
    stream = feed_stream(spark, source, schema, files_per_trigger, max_file_age)
    land(stream, target, checkpoint, fmt, records_per_file, interval).awaitTermination()
