"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that the sketch of key frequencies tracks. Each key with more than a four thousandth of all
# rows is surely among them.
TRACKED = 1 << 14

# Largest number of hot keys. Rows of one share grow with the input beyond it, so that fewer
# keys than this can have more rows than a share.
MAX_HOT_KEYS = 10_000

# Rows of one key that a single task should receive.
ROWS_PER_SHARE = 1_000_000


def hot_key_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    rows_per_share: int = ROWS_PER_SHARE,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join on ``key`` that spreads each hot key of ``facts`` over several tasks.

    A key with more than ``rows_per_share`` rows is cut into as many shares as its row count
    asks for, and the lookup rows of that key alone are repeated once per share. How often keys
    occur is read from one sketch, which each task makes of its own rows, so no count of all keys
    is shuffled. An estimate that is off makes shares larger or smaller and changes no result. A
    share has at least one ``MAX_HOT_KEYS``-th of all rows, so fewer keys than that can be hot
    and their list may be broadcast. The lookup has no hint, Spark picks its strategy by size.

    Adaptive execution splits skewed sort-merge joins by itself; this is for joins that it cannot
    split, and for keys that are known to be hot.

    The share of a row depends on its content and its input partition, so a repeated task
    sends every row to the same share again, and copies of one row still spread out.
    """
    sketch = F.call_function("approx_top_k_accumulate", F.col(key), F.lit(TRACKED))
    found = facts.agg(F.count("*").alias("_every"), sketch.alias("_sketch")).select(
        "_every",
        F.inline(F.call_function("approx_top_k_estimate", F.col("_sketch"), F.lit(MAX_HOT_KEYS))),
    )
    share_rows = F.greatest(F.lit(rows_per_share), F.ceil(F.col("_every") / MAX_HOT_KEYS))
    hot = F.broadcast(
        found.filter((F.col("count") > share_rows) & F.col("item").isNotNull()).select(
            F.col("item").alias(key), F.ceil(F.col("count") / share_rows).cast("int").alias("_shares")
        )
    )
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(name) for name in facts.columns])
    share = F.when(F.col("_shares") > 1, F.pmod(row_hash, F.col("_shares"))).otherwise(0)
    spread_facts = (
        facts.join(hot, key, "left").withColumn("_share", share.cast("int")).drop("_shares")
    )
    last_share = F.coalesce(F.col("_shares"), F.lit(1)) - 1
    spread_lookup = (
        lookup.join(hot, key, "left")
        .withColumn("_share", F.explode(F.sequence(F.lit(0), last_share)))
        .drop("_shares")
    )
    return spread_facts.join(spread_lookup, [key, "_share"], how).drop("_share")
