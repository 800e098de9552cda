from helpers import plan, rows
from pyspark.sql import functions as F

from postlark.operators import joins
from postlark.operators.joins import hot_key_join


def facts(spark):
    # One key holds most rows, and a third of all rows are copies of one row.
    return spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, "hot")
        .when(F.col("id") % 10 < 9, F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("value"),
    )


def lookup(spark):
    keys = ["hot", "hot", *[f"k{n}" for n in range(40)], "unused"]
    return spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "key STRING, number INT")


def test_equals_the_plain_join(spark):
    left, right = facts(spark), lookup(spark)
    for rows_per_share in (100, 10_000):
        spread = hot_key_join(left, right, "key", rows_per_share)
        assert spread.columns == ["key", "value", "number"]
        assert sorted(rows(spread)) == sorted(rows(left.join(right, "key")))


def test_left_join_keeps_every_fact(spark):
    left, right = facts(spark), lookup(spark)
    for rows_per_share in (100, 10_000):
        spread = hot_key_join(left, right, "key", rows_per_share, how="left")
        expected = rows(left.join(right, "key", "left"))
        assert sorted(rows(spread), key=str) == sorted(expected, key=str)


def test_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hot_key_join(facts(spark), lookup(spark), "key", 100)
        assert "SortMergeJoin [key" in plan(joined) and "_share" in plan(joined)
        sizes = (
            joined.filter("key = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
        )
        counts = [count for _, count in rows(sizes)]
        assert len(counts) > 4 and max(counts) < sum(counts) / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_many_hot_keys_get_larger_shares(spark, monkeypatch):
    # With room for two hot keys, a share has half of all rows, so only the hot one is cut.
    monkeypatch.setattr(joins, "MAX_HOT_KEYS", 2)
    left, right = facts(spark), lookup(spark)
    spread = hot_key_join(left, right, "key", 10, how="left")
    expected = rows(left.join(right, "key", "left"))
    assert sorted(rows(spread), key=str) == sorted(expected, key=str)
