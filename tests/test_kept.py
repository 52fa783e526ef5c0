import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators.digests import KeptDigests, add_digests, differing_buckets, digests, reconcile_rows
from millrace.operators.reports import totals_report
from millrace.plans.planning import planning_spine
from millrace.operators.reshape import months_from
from millrace.sources.bucketed import join_by_leading_key, star_chain, write_bucketed
from millrace.sources.kept_totals import KeptTotals


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


SIDE = "k long, n string, v double"


def test_reconcile_rows_finds_what_two_joins_find(spark):
    rng = random.Random(1)
    a = [(rng.choice([None, *range(300)]), rng.choice(["x", None]), float(rng.randrange(3))) for _ in range(400)]
    b = [r if rng.random() < 0.9 else (r[0], "y", r[2]) for r in a if rng.random() < 0.95] + [(1000, "x", 1.0), (None, "z", None)]
    left, right = spark.createDataFrame(a, SIDE), spark.createDataFrame(b, SIDE).select("v", "k", "n")
    by_key = lambda side: {k: sorted(map(repr, (r for r in side if r[0] == k))) for k in {r[0] for r in side}}
    one, two = by_key(a), by_key(b)
    want = {k: "only_right" if k not in one else "only_left" if k not in two else "changed" for k in {*one, *two} if one.get(k) != two.get(k)}
    for buckets in (1, 64, 1 << 16):
        assert {r["k"]: r["state"] for r in reconcile_rows(left, right, ["k"], buckets=buckets).collect()} == want
    assert reconcile_rows(left, left, ["k"]).count() == 0


def test_digests_add_up_and_lead_to_the_buckets_that_differ(spark, tmp_path):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("v"))
    whole = digests(df, ["id"], 4096)
    parts = [digests(df.filter(F.col("id") % 3 == i), ["id"], 4096) for i in range(3)]
    assert rows(add_digests(*parts).select("bucket", "rows", "total")) == rows(whole)
    changed = df.withColumn("v", F.when(F.col("id").isin(5, 700), 99).otherwise(F.col("v")))
    found = differing_buckets(whole, digests(changed, ["id"], 4096))
    assert 1 <= found.count() <= 2
    # Rows brought together follow the buckets that differ, not the tables.
    got = reconcile_rows(df, changed, ["id"], differing=found, buckets=4096)
    assert rows(got) == rows(spark.createDataFrame([(5, "changed"), (700, "changed")], "id long, state string"))
    trees = [KeptDigests(spark, str(tmp_path / name)) for name in "ab"]
    for tree, side in zip(trees, (df, changed)):
        tree.write(digests(side, ["id"], 4096))
    below = trees[0].differing(trees[1])
    assert rows(below) == rows(found) and trees[0].differing(trees[0]).count() == 0
    assert "PartitionFilters: [node" in plan_of(below).replace("isnotnull(", "[")  # other nodes are not opened


@pytest.fixture
def lines(spark):
    return spark.range(4000).select(
        F.concat(F.lit("b"), (F.col("id") % 5).cast("string")).alias("brand"),
        (F.col("id") % 3).cast("string").alias("kind"),
        F.expr("date_add(date'2024-01-01', cast(id % 150 as int))").alias("day"),
        (F.col("id") * 1.25).cast("decimal(18,2)").alias("v"),
        F.col("id"),
    )


def test_kept_totals_equal_a_full_run_and_touch_their_months(spark, tmp_path, lines):
    by = ["brand", "kind"]
    kept = KeptTotals(spark, str(tmp_path / "t"), by, "day", "v")
    first, late = lines.filter("id % 10 <> 0"), lines.filter("id % 10 = 0 and month(day) in (2, 4)")
    kept.add(first, load="a")
    files = {r["file"] for r in kept.table.manifest().collect()}
    assert kept.add(late, load="b") == [date(2024, 2, 1), date(2024, 4, 1)]
    assert kept.add(late, load="b") == []
    after = {r["file"] for r in kept.table.manifest().collect()}
    assert all("2024-02-01" in f or "2024-04-01" in f for f in files - after) and files & after
    gone = first.filter("month(day) = 3 and brand = 'b1'").union(late.filter("id % 20 = 0"))
    kept.add(lines.filter("id < 0"), withdrawn=gone, load="c")
    remain = first.union(late).join(gone.select("id"), "id", "left_anti").select(*lines.columns)
    assert rows(kept.report(date(2024, 1, 1), 5)) == rows(totals_report(remain, by, "day", "v", date(2024, 1, 1), 5))
    read = kept.table.read().filter("month in (date'2024-03-01')")
    assert len([f for f in read.inputFiles() if "/data/" in f]) <= len(after)


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.requireAllClusterKeysForCoPartition")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_chain_of_21_bucketed_measures_has_no_shuffle(spark, no_broadcast):
    items = spark.range(300).withColumnRenamed("id", "item")
    spine = write_bucketed(items, ["item"], 4)
    plain = [items.filter(F.col("item") % (i + 2) == 0).select("item", (F.col("item") * i).alias(f"m{i}")) for i in range(21)]
    got = star_chain(spine, [write_bucketed(m, ["item"], 4) for m in plain], ["item"])
    plan = plan_of(got)
    assert "Exchange" not in plan and len(re.findall("SortMergeJoin", plan)) == 21
    want = items
    for m in plain:
        want = want.join(m, "item", "left")
    assert rows(got) == rows(want)


def test_planning_spine_keeps_to_the_buckets(spark, no_broadcast):
    join_by_leading_key(spark)
    items = spark.range(50).select(F.col("id").cast("string").alias("item"), F.lit(5).alias("max_stock"))
    months = months_from(date(2024, 1, 1), 3)
    ordered = items.select("item", F.explode(F.array(*map(F.lit, months))).alias("month"), F.lit(1.0).alias("ordered"))
    measures = [(ordered, ["item", "month"]), (items.select("item", F.lit("s").alias("supplier")), ["item"])]
    bucketed = [(write_bucketed(df, ["item"], 4), keys) for df, keys in measures]
    got = planning_spine(write_bucketed(items, ["item"], 4), months, bucketed)
    assert "Exchange" not in plan_of(got)
    assert rows(got) == rows(planning_spine(items, months, measures))
