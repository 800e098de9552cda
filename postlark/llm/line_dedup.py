"""Line dedup: passages of three or more lines stay where they first occur.

Every three consecutive lines of a text form a window, and windows overlap. A window that occurs
more than once in the corpus stays at its first occurrence; the lines of every later occurrence
are removed. Overlapping later occurrences merge, so a passage goes as one piece.

Occurrences are ordered by id (null last), then by a hash of the text, then by line number. Lines
are split at line feeds and compared as they are. Windows are compared by 128 hash bits.

Plan: windows are counted with map-side combining, so a very common one is one row of each task;
the repeated windows are stored, and occurrences are joined with them by hash, where adaptive
execution may split a hot window. Hits are turned into the gaps to keep, text by text, by one
window over (id, text hash) and meet their text in one join.

Edge cases: a null text stays null; a text of fewer than three lines has no window; a window of
three lines without a non-blank character is left alone. Rows with equal id and text count as one
text and are treated alike. An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlark.llm.rows import whole_row, with_text
from postlark.session import stored

WINDOW = 3

_SALT = "second"


def _lines(text_col: str = "text") -> Column:
    return F.split(F.col(text_col), "\n", -1)


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``_id``, ``_text`` (a hash of it), ``_at`` and two hashes of every window of lines."""
    lines = docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"), _lines().alias("_lines")
    ).where(F.size("_lines") >= size)

    def hashed(at: Column) -> Column:
        own = [F.get("_lines", at + i) for i in range(size)]
        joined = F.concat_ws("\n", *own)
        return F.when(
            joined.rlike(r"\S"),
            F.struct(
                at.alias("at"),
                F.xxhash64(*own).alias("h1"),
                F.xxhash64(F.lit(_SALT), *own).alias("h2"),
            ),
        )

    last = F.size("_lines") - size
    found = lines.select(
        "_id", "_text", F.explode(F.transform(F.sequence(F.lit(0), last), hashed)).alias("w")
    )
    return found.where("w IS NOT NULL").select(
        "_id", "_text", F.col("w.at").alias("_at"), F.col("w.h1").alias("_h1"), "w.h2"
    ).withColumnRenamed("h2", "_h2")


def _order() -> Column:
    """What orders occurrences."""
    return F.struct(
        F.col("_id").isNull().alias("a"),
        F.col("_id").alias("b"),
        F.col("_text").alias("c"),
        F.col("_at").alias("d"),
    )


def later_occurrences(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``_id``, ``_text`` and ``_at`` of each window that occurred before."""
    found = windows(docs, size)
    repeated = stored(
        found.groupBy("_h1", "_h2")
        .agg(F.min(_order()).alias("_first"), F.max(_order()).alias("_last"))
        .where("_first <> _last")
        .drop("_last"),
        "repeated-lines",
    )
    hits = found.join(repeated, ["_h1", "_h2"]).where(_order() != F.col("_first"))
    return hits.select("_id", "_text", "_at")


def dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every row, as the struct ``_row``, with ``_kept``: its lines that stay, and ``_n_lines``."""
    own_text = Window.partitionBy("_id", "_text").orderBy("_at")
    before = F.coalesce(F.lag("_at").over(own_text) + size, F.lit(0))
    gaps = (
        later_occurrences(docs, size)
        .distinct()
        .withColumn("_from", before)
        .groupBy("_id", "_text")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("_at") > F.col("_from"),
                        F.struct("_from", (F.col("_at") - F.col("_from")).alias("_size")),
                    )
                )
            ).alias("_gaps"),
            (F.max("_at") + size).alias("_end"),
        )
    )
    # The row is kept as one value, whatever its columns are called.
    keyed = docs.select(
        whole_row(docs).alias("_row"),
        F.col("doc_id").alias("_own_id"),
        F.col("text").alias("_own_text"),
        F.xxhash64("text").alias("_hash"),
    )
    same = F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text"))
    lines = _lines("_own_text")
    pieces = F.flatten(
        F.transform("_gaps", lambda g: F.slice(lines, g["_from"] + 1, g["_size"]))
    )
    rest = F.slice(lines, F.col("_end") + 1, F.greatest(F.size(lines) - F.col("_end"), F.lit(0)))
    kept = F.when(F.col("_end").isNull(), lines).otherwise(F.concat(pieces, rest))
    return keyed.join(gaps, same, "left").select(
        "_row", kept.alias("_kept"), F.size(lines).cast("bigint").alias("_n_lines")
    )


def deduplicated(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents with what stays of their text; a text of which nothing stays goes."""
    changed = F.coalesce(F.size("_kept") < F.col("_n_lines"), F.lit(False))
    kept = F.array_join("_kept", "\n")
    text = F.when(changed, kept).otherwise(F.col("_row.text"))
    found = dedup(docs, size).where(~(changed & (F.size("_kept") == 0)))
    return with_text(found.select(F.col("_row"), text.alias("_new")), docs)


def digest(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Id, lines, removed lines, and a hash of the text that stays."""
    kept = F.coalesce(F.array_join("_kept", "\n"), F.lit(""))
    has_text = F.col("_row.text").isNotNull()
    n_lines = F.when(has_text, F.col("_n_lines")).otherwise(0)
    n_kept = F.when(has_text, F.size("_kept")).otherwise(0)
    return dedup(docs.select("doc_id", "text"), size).select(
        "_row.doc_id",
        n_lines.cast("bigint").alias("n_lines"),
        (n_lines - n_kept).cast("bigint").alias("n_removed"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )
