import pytest
from pyspark.sql import functions as F

from millrace.operators.skew import FINENESS, heavy_keys, match_skewed


@pytest.fixture
def uneven(spark):
    # A third of the rows has one key, a tenth another, and some have none.
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).when(F.col("id") % 25 == 2, None).otherwise(F.col("id") % 5000 + 100)
    return spark.range(60_000).select("id", key.alias("k"), F.lit("x").alias("c"))


def test_heavy_keys_are_found_and_light_ones_are_not(spark, uneven):
    parts = 8
    found = {r["hash"]: r["pieces"] for r in heavy_keys(uneven, ["k"], parts).collect()}
    counts = {r["k"]: r["count"] for r in uneven.groupBy("k").count().collect()}
    over = {k for k, n in counts.items() if n * FINENESS * parts > 60_000}
    assert over == {7, 8, None} and len(found) == len(over)
    assert sorted(found.values()) == sorted(-(-counts[k] * FINENESS * parts // 60_000) for k in over)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_equals_a_plain_one(spark, uneven, how):
    right = spark.range(0, 5200, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.union(spark.sql("select cast(null as long), -1L")).union(spark.sql("select 7L, 1L"))
    named = right.withColumnRenamed("k", "r")
    plain = uneven.join(named, uneven["k"].eqNullSafe(named["r"]), how).drop("r")
    got = match_skewed(uneven, right, ["k"], how)
    assert got.columns == plain.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, plain.collect())))
    with pytest.raises(ValueError):
        match_skewed(uneven, right, ["k"], "full")


def test_no_task_holds_the_hot_key(spark, uneven):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        right = spark.range(5200).select(F.col("id").alias("k"), F.lit(1).alias("w"))
        joined = match_skewed(uneven, right, ["k"]).withColumn("task", F.spark_partition_id())
        sizes = sorted(r["count"] for r in joined.groupBy("task").count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 16 and sum(sizes) == 60_000
    assert sizes[-1] <= 2 * sizes[8]
