import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import columns as C
from millrace.operators import filters as FL
from millrace.operators import joins as J
from millrace.operators import reshape as R
from millrace.operators import sets as S
from millrace.operators import snapshots as SN
from millrace.operators import windows as W


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def series(spark):
    """Short keys, a null key, and one key that holds most of the rows; values with nulls and repeats."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        at = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(60 * 24 * 20))
        data.append((i, key, at, rng.choice([None, 0, 1, 2, 2, 5, 9])))
    return spark.createDataFrame(data, "id int, k string, at timestamp, v int")


@pytest.mark.parametrize("n", [1, 3])
def test_sliced_lag_and_lead_equal_plain_windows(series, n):
    order = ["at", "id"]
    for fn in (W.with_lag, W.with_lead):
        plain = fn(series, ["k"], order, "v", "o", n=n)
        assert rows(fn(series, ["k"], order, "v", "o", n=n, slice_by=F.to_date("at"))) == rows(plain)
        assert rows(fn(series, ["k"], order, "v", "o", n=n, slice_by=F.date_trunc("hour", "at"))) == rows(plain)


def test_sliced_running_sum_and_step_equal_plain_windows(series):
    order = ["at", "id"]
    for slice_by in (F.to_date("at"), F.date_trunc("hour", "at")):
        assert rows(W.running_sum(series, ["k"], order, "v", "o", slice_by=slice_by)) == rows(W.running_sum(series, ["k"], order, "v", "o"))
        assert rows(W.with_step(series, ["k"], order, slice_by=slice_by)) == rows(W.with_step(series, ["k"], order).withColumn("step", F.col("step").cast("bigint")))


def test_growth_is_null_at_zero_and_at_the_end(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 0.0), (3, 5.0)], "m int, x double").withColumn("k", F.lit("k"))
    assert [r["growth"] for r in W.growth(df, ["k"], ["m"], "x").orderBy("m").collect()] == [1.0, None, None]


def test_exact_median_equals_the_built_in(series, spark):
    expected = rows(series.groupBy("k").agg(F.median("v").alias("median")).filter("median is not null"))
    assert rows(A.exact_median(series, ["k"], "v")) == expected
    # A bracket as wide or as narrow as can be must not change the result.
    assert rows(A.exact_median(series, ["k"], "v", accuracy=5)) == expected
    rng = random.Random(3)
    wide = spark.createDataFrame([(i % 2, rng.lognormvariate(0, 4)) for i in range(5000)], "k int, v double")
    assert rows(A.exact_median(wide, ["k"], "v", accuracy=100)) == rows(wide.groupBy("k").agg(F.median("v")))


def test_spread_stats_of_one_row(spark):
    df = spark.createDataFrame([("a", 3.0)], "k string, v double")
    got = A.spread_stats(df, ["k"], "v").first()
    assert (got["sd_samp"], got["sd_pop"], got["var_samp"], got["median"]) == (None, 0.0, None, 3.0)


def test_latest_by_key_is_unique_and_idempotent(series):
    order = ["at", "id"]
    once = SN.latest_by_key(series, ["k"], order)
    assert once.count() == series.select("k").distinct().count()
    assert rows(SN.latest_by_key(once, ["k"], order)) == rows(once)


def test_snapshots_keep_ties_and_null_groups(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(data, "g string, t int, v string")
    assert rows(SN.snapshot_per_group(df, ["g"], "t").select("v")) == [("n",), ("y",), ("z",)]
    assert rows(SN.snapshot_per_group(df, ["g"], "t", "min").select("v")) == [("m",), ("x",)]
    with pytest.raises(ValueError):
        SN.snapshot_per_group(df, ["g"], "t", "mean")


def test_two_stage_snapshot(spark):
    days = [date(2024, 1, 5), date(2024, 2, 3), date(2024, 2, 3), date(2024, 2, 20)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert rows(SN.snapshot_two_stage(df, "d")) == [(date(2024, 2, 3),)] * 2
    assert rows(SN.snapshot_two_stage(df, "d", pick="max")) == [(date(2024, 2, 20),)]


def test_top_n(series):
    top = SN.top_n(series, ["k"], ["at", "id"], 2)
    assert {r["count"] for r in top.groupBy("k").count().collect()} == {2}


def test_unpivot_and_pivot_are_inverse(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, 20.0, 5.0)], "id int, a double, b double")
    long = R.unpivot(df, ["id"], ["a", "b"], "n", "v")
    assert long.count() == 4
    assert rows(R.pivot(long, ["id"], "n", ["a", "b"], F.sum("v"))) == rows(df)


def test_measure_reshape_equals_unpivot_join_pivot(spark, series):
    df = series.withColumns({"w": F.col("v") * 2, "p": F.col("v").cast("double")})
    tags = {"v": {"unit": "P", "kind": "A"}, "w": {"unit": "P", "kind": "A"}, "p": {"unit": "M", "kind": "B"}}
    naive = df.select("k", *[F.col(m).cast("double").alias(m) for m in tags]).unpivot(["k"], list(tags), "m", "x")
    table = spark.createDataFrame([(m, t["unit"], t["kind"]) for m, t in tags.items()], "m string, unit string, kind string")
    joined = naive.join(table, "m")
    expected = joined.groupBy("k", "unit").pivot("kind", ["A", "B"]).agg(F.sum("x"))
    assert rows(R.measure_reshape(df, ["k"], tags, "kind").select("k", "unit", "A", "B")) == rows(expected)
    mean = joined.groupBy("k", "unit").pivot("kind", ["A", "B"]).agg(F.avg("x"))
    got = R.measure_reshape(df, ["k"], tags, "kind", averaged=["v", "w", "p"]).select("k", "unit", "A", "B")
    assert rows(got) == rows(mean)


def test_month_ladder_fills_missing_months(spark):
    df = spark.createDataFrame([("a", date(2023, 12, 5), 2.0), ("a", date(2024, 3, 1), 9.0), ("b", date(2024, 2, 29), 1.0)], "k string, d date, v double")
    out = R.month_ladder(df, ["k"], "d", "v", " U", date(2023, 12, 15), 3)
    assert out.columns == ["k", "2023-12 U", "2024-01 U", "2024-02 U"]
    assert rows(out) == [("a", 2.0, 0.0, 0.0), ("b", 0.0, 0.0, 1.0)]


def test_month_spine(spark):
    months = [r["month"] for r in R.month_spine(spark, date(2023, 11, 30), 3).collect()]
    assert months == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1)]


def test_null_keys_in_group_statistics(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "k string, v int")
    out = A.with_group_stat(df, ["k"], F.sum("v").alias("s"))
    assert rows(out) == sorted([(None, 1, 4), (None, 3, 4), ("a", 5, 5)], key=repr)


def test_split_conditions_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "USD", 5.0), (None, "%", 2.0), ("a", None, 1.0)], "k string, unit string, value double")
    out = {r["k"]: (r["currency"], r["amount"], r["percent"]) for r in J.split_conditions(df, ["k"], "unit", "value").collect()}
    assert out == {None: ("USD", 5.0, 2.0), "a": (None, 1.0, None)}


def test_append_missing_and_reconcile(spark):
    base = spark.createDataFrame([(1, "x")], "k int, a string")
    other = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(J.append_missing(base, other, ["k"])) == [(1, "x"), (2, None)]
    a, b = J.reconcile(base, other, ["k"])
    assert (rows(a), rows(b)) == ([], [(2,)])


def test_exclude_ids_keeps_rows_without_id(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(J.exclude_ids(df, "k", df.filter("k = 1"))) == [(2,), (None,)]


def test_cross_spine_expands_in_place(spark):
    out = J.cross_spine(spark.range(2), [date(2024, 1, 1), date(2024, 2, 1)], {"c": ["p", "q", "r"]})
    assert out.count() == 12 and out.distinct().count() == 12


def test_replace_slice_treats_null_as_outside(spark):
    old = spark.createDataFrame([(1, "o"), (5, "o"), (None, "o")], "m int, v string")
    new = spark.createDataFrame([(2, "n"), (6, "n")], "m int, v string")
    assert rows(S.replace_slice(old, new, F.col("m") >= 5)) == sorted([(1, "o"), (None, "o"), (6, "n")], key=repr)


def test_open_items_on_blank_and_null_flags(spark):
    data = [(1, None, ""), (2, " ", None), (3, "L", ""), (4, "", "X"), (5, "", " ")]
    df = spark.createDataFrame(data, "id int, d string, c string")
    assert rows(FL.open_items(df, "d", "c").select("id")) == [(1,), (2,), (5,)]


def test_last_months_includes_the_day(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 23),), (datetime(2024, 4, 1),), (datetime(2024, 2, 28),)], "t timestamp")
    assert FL.last_months(df, "t", 1, date(2024, 3, 31)).count() == 1


def test_upper_all_leaves_numbers(spark):
    out = C.upper_all(spark.createDataFrame([("a", 1)], "s string, n int"))
    assert out.dtypes == [("s", "string"), ("n", "int")] and rows(out) == [("A", 1)]


def test_cast_columns_ignores_absent_columns(spark):
    df = spark.createDataFrame([("1", "2024-01-01")], "a string, b string")
    assert C.cast_columns(df, ["a", "zz"], ["b"]).dtypes == [("a", "double"), ("b", "date")]


def test_drop_empty(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 2)], "a int, b int")
    assert FL.drop_empty(df).count() == 2 and FL.drop_empty(df, "any").count() == 1


def test_distinct_rows_needs_an_order(series):
    with pytest.raises(ValueError):
        A.distinct_rows(series, ["k"])


def test_attainment_of_sums(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 2.0), ("b", 1.0, 0.0)], "k string, n double, d double")
    assert {r["k"]: r["attainment"] for r in A.attainment(df, ["k"], "n", "d").collect()} == {"a": 75.0, "b": None}


def test_with_partition_stat_first_by_order(series):
    out = W.with_partition_stat(series, ["k"], F.min_by("v", F.struct("at", "id")).alias("f"))
    w = Window.partitionBy("k").orderBy("at", "id")
    assert rows(out.select("id", "f")) == rows(series.select("id", F.first("v").over(w).alias("f")))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_one(series, how):
    right = series.filter("v > 1 or k is null").groupBy("k").agg(F.max("v").alias("top")).filter("k is null or k <> 'b'")
    assert rows(J.match(series, right, ["k"], how, salts=5)) == rows(J.match(series, right, ["k"], how))
    with pytest.raises(ValueError):
        J.match(series, right, ["k"], "full", salts=2)


def test_calendar_snapshot_equals_the_general_one(series):
    days = series.withColumn("day", F.to_date("at")).withColumn("month", F.date_trunc("week", "at"))
    general = SN.snapshot_per_group(days, ["month"], "day")
    assert rows(SN.snapshot_per_group(days, ["month"], "day", calendar_groups=True)) == rows(general)
