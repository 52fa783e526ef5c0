"""Ordered window operators on raw rows, cut into slices so that no key is held by one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.base import money, number, query, round6, table
from millrace.functions import month_start, period
from millrace.operators.windows import (
    fill_constant,
    growth,
    running_sum,
    with_lag,
    with_lead,
    with_partition_stat,
    with_step,
)

def _day():
    return F.to_date("ts")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")


@query(
    "win_lag",
    """select event_id, lag(value) over w as previous, lag(value, 3) over w as third_last from events
    window w as (partition by user_id order by ts, event_id)""",
)
def win_lag(spark, sf_dir):
    e = with_lag(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", "previous", slice_by=_day())
    out = with_lag(e, ["user_id"], ["ts", "event_id"], "value", "third_last", n=3, slice_by=_day())
    return out.select("event_id", "previous", "third_last")


@query(
    "win_lead_growth",
    """select event_id, lead(value) over w as following, round((value - lead(value) over w) / nullif(value, 0), 6) as growth
    from events window w as (partition by user_id order by ts, event_id)""",
)
def win_lead_growth(spark, sf_dir):
    e = with_lead(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", "following", slice_by=_day())
    out = growth(e, ["user_id"], ["ts", "event_id"], "value", slice_by=_day())
    return out.select("event_id", "following", round6("growth").alias("growth"))


@query(
    "win_running_sum",
    """select event_id, cast(sum(cast(value as decimal(18,2))) over (partition by user_id order by ts, event_id
    rows between unbounded preceding and current row) as double) as total from events""",
)
def win_running_sum(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("value", money("value"))
    out = running_sum(e, ["user_id"], ["ts", "event_id"], "value", "total", slice_by=_day())
    return out.select("event_id", number("total").alias("total"))


@query(
    "win_running_sum_months",
    """select item, month, cast(sum(q) over (partition by item order by month rows between unbounded preceding and current row) as double) as total
    from (select l_partkey as item, strftime(l_shipdate, '%Y-%m') as month, sum(cast(l_quantity as decimal(18,2))) as q
      from lineitem group by 1, 2)""",
)
def win_running_sum_months(spark, sf_dir):
    months = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").alias("item"), period("l_shipdate").alias("month")
    ).agg(F.sum(money("l_quantity")).alias("q"))
    # One row per item and month: short groups, so a plain window.
    return running_sum(months, ["item"], ["month"], "q", "total").select("item", "month", number("total").alias("total"))


@query(
    "win_partition_stats",
    """select l_orderkey, l_linenumber, l_suppkey, l_quantity, max(l_quantity) over w as top,
    round(cast(sum(cast(l_quantity as decimal(18,2))) over w as double) / count(*) over w, 6) as mean,
    first_value(l_extendedprice) over (partition by l_suppkey order by l_shipdate, l_extendedprice) as first_price
    from lineitem window w as (partition by l_suppkey)""",
)
def win_partition_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    out = with_partition_stat(
        rows, ["l_suppkey"],
        F.max("l_quantity").alias("top"),
        round6(number(F.sum(money("l_quantity"))) / F.count("*")).alias("mean"),
        F.min_by("l_extendedprice", F.struct("l_shipdate", "l_extendedprice")).alias("first_price"),
    )
    return out.drop("l_extendedprice", "l_shipdate")


@query(
    "win_global_fill",
    """select month, n, (select count(*) from orders where strftime(o_orderdate, '%Y-%m') = '1998-06') as june,
    cast(sum(n) over (order by month) as bigint) as running
    from (select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders group by 1)""",
)
def win_global_fill(spark, sf_dir):
    months = table(spark, sf_dir, "orders").groupBy(period("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    marked = months.withColumn("june", F.when(F.col("month") == "1998-06", F.col("n")))
    # A dozen rows per year: the running total is cut by year all the same.
    keyed = fill_constant(marked, ["june"]).withColumn("all", F.lit(1))
    return running_sum(keyed, ["all"], ["month"], "n", "running", slice_by=F.substring("month", 1, 4)).drop("all")


@query(
    "win_step_index",
    """select event_id, row_number() over (partition by user_id order by ts, event_id) as step from events""",
)
def win_step_index(spark, sf_dir):
    out = with_step(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], slice_by=_day())
    return out.select("event_id", "step")


@query(
    "win_lag_months",
    """select c_custkey, month, n, lag(n) over (partition by c_custkey order by month) as previous from (
      select o_custkey as c_custkey, date_trunc('month', o_orderdate)::date as month, count(*) as n from orders group by 1, 2)""",
)
def win_lag_months(spark, sf_dir):
    months = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey"), month_start("o_orderdate").alias("month")
    ).agg(F.count("*").alias("n"))
    return with_lag(months, ["c_custkey"], ["month"], "n", "previous")
