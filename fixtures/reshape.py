"""Unpivot, pivot, measure reshape and ladders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fixtures.base import money, number, query, table
from millrace.functions import period
from millrace.operators.reshape import (
    measure_reshape,
    month_ladder,
    month_spine,
    pivot,
    unpivot,
    with_amounts,
)


@query(
    "rsh_unpivot",
    """select l_orderkey, l_linenumber, measure, value from (
      select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount from lineitem)
    unpivot include nulls (value for measure in (l_quantity, l_extendedprice, l_discount))""",
)
def rsh_unpivot(spark, sf_dir):
    return unpivot(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_quantity", "l_extendedprice", "l_discount"], "measure", "value",
    )


@query(
    "rsh_stack",
    """select l_suppkey, 'THOUSANDS' as unit, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / 1000 as quantity from lineitem group by 1
    union all select l_suppkey, 'PIECES', cast(sum(cast(l_quantity as decimal(18,2))) as double) from lineitem group by 1""",
)
def rsh_stack(spark, sf_dir):
    sums = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        (number(F.sum(money("l_extendedprice"))) / 1000).alias("THOUSANDS"),
        number(F.sum(money("l_quantity"))).alias("PIECES"),
    )
    return unpivot(sums, ["l_suppkey"], ["THOUSANDS", "PIECES"], "unit", "quantity")


@query(
    "rsh_pivot",
    """select l_suppkey, cast(sum(q) filter (l_returnflag = 'A') as double) as "A_qty", count(*) filter (l_returnflag = 'A') as "A_n",
    cast(sum(q) filter (l_returnflag = 'N') as double) as "N_qty", count(*) filter (l_returnflag = 'N') as "N_n"
    from (select *, cast(l_quantity as decimal(18,2)) as q from lineitem) group by 1""",
)
def rsh_pivot(spark, sf_dir):
    qty = number(F.sum(money("l_quantity"))).alias("qty")
    return pivot(
        table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag", ["A", "N"], qty, F.count(F.lit(1)).alias("n")
    ).na.fill(0, ["A_n", "N_n"])


MEASURES2 = {
    "ordered": {"kind": "ORDERED", "unit": "PIECES"},
    "delivered": {"kind": "DELIVERED", "unit": "PIECES"},
    "order_value": {"kind": "ORDERED", "unit": "AMOUNT"},
    "delivered_value": {"kind": "DELIVERED", "unit": "AMOUNT"},
}


@query(
    "rsh_measure_2attr",
    """with g as (select l_suppkey, sum(q) as o, sum(case when l_linestatus = 'F' then q else 0 end) as d, sum(v) as ov,
      sum(case when l_linestatus = 'F' then v else 0 end) as dv
      from (select *, cast(l_quantity as decimal(18,2)) as q, cast(l_extendedprice as decimal(18,2)) as v from lineitem) group by 1)
    select l_suppkey, 'ORDERED' as kind, cast(o as double) as "PIECES", cast(ov as double) as "AMOUNT" from g
    union all select l_suppkey, 'DELIVERED', cast(d as double), cast(dv as double) from g""",
)
def rsh_measure_2attr(spark, sf_dir):
    done = F.col("l_linestatus") == "F"
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        money("l_quantity").alias("ordered"),
        F.when(done, money("l_quantity")).otherwise(0).alias("delivered"),
        money("l_extendedprice").alias("order_value"),
        F.when(done, money("l_extendedprice")).otherwise(0).alias("delivered_value"),
    )
    return measure_reshape(rows, ["l_suppkey"], MEASURES2, "unit")


@query(
    "rsh_measure_3attr",
    """with g as (select o_custkey, sum(v) as v, sum(case when o_orderstatus = 'O' then v else 0 end) as b, count(*) as n,
      avg(case when o_orderstatus = 'F' then v end) as p
      from (select *, cast(o_totalprice as decimal(18,2)) as v from orders) group by 1)
    select o_custkey, 'SALES' as kind, 'USD' as currency, cast(n as double) as "PIECES", cast(v as double) as "AMOUNT" from g
    union all select o_custkey, 'BACKLOG', 'USD', null, cast(b as double) from g
    union all select o_custkey, 'BACKLOG', 'MXN', null, cast(b * 2 as double) from g""",
)
def rsh_measure_3attr(spark, sf_dir):
    is_open = F.col("o_orderstatus") == "O"
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.lit(1).alias("n"),
        money("o_totalprice").alias("value"),
        F.when(is_open, money("o_totalprice")).otherwise(0).alias("backlog"),
        F.when(is_open, money("o_totalprice") * 2).otherwise(0).alias("backlog_local"),
    )
    measures = {
        "n": {"kind": "SALES", "currency": "USD", "unit": "PIECES"},
        "value": {"kind": "SALES", "currency": "USD", "unit": "AMOUNT"},
        "backlog": {"kind": "BACKLOG", "currency": "USD", "unit": "AMOUNT"},
        "backlog_local": {"kind": "BACKLOG", "currency": "MXN", "unit": "AMOUNT"},
    }
    return measure_reshape(rows, ["o_custkey"], measures, "unit")


@query(
    "rsh_month_ladder",
    """select o_custkey, """
    + ", ".join(
        f"""cast(coalesce(sum(cast(o_totalprice as decimal(18,2))) filter (strftime(o_orderdate, '%Y-%m') = '{m}'), 0) as double) as "{m} $ ACTUAL" """
        for m in ("1998-01", "1998-02", "1998-03", "1998-04", "1998-05", "1998-06")
    )
    + "from orders where strftime(o_orderdate, '%Y-%m') between '1998-01' and '1998-06' group by 1",
)
def rsh_month_ladder(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("v", money("o_totalprice"))
    out = month_ladder(o, ["o_custkey"], "o_orderdate", "v", " $ ACTUAL", date(1998, 1, 1), 6)
    return out.select("o_custkey", *[number(F.col(f"`{c}`")).alias(c) for c in out.columns[1:]])


@query(
    "rsh_month_spine",
    """select m::date as month, count(o_orderkey) as n
    from generate_series(timestamp '1998-01-01', timestamp '2000-08-01', interval 1 month) t(m)
    left join orders on date_trunc('month', o_orderdate) = m group by 1""",
)
def rsh_month_spine(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.trunc(F.to_date("o_orderdate"), "month").alias("month"), "o_orderkey")
    months = month_spine(spark, date(1998, 1, 15), 32)
    return months.join(o, "month", "left").groupBy("month").agg(F.count("o_orderkey").alias("n"))


@query(
    "rsh_dual_unit",
    """with g as (select l_partkey, strftime(l_shipdate, '%Y-%m') as month, cast(sum(l_quantity) as double) as stock,
      cast(sum(case when l_linestatus = 'O' then l_quantity else 0 end) as double) as backlog, p_retailprice as price
      from lineitem join part on p_partkey = l_partkey group by 1, 2, 5)
    select l_partkey, month, 'PIECES' as concept, stock, backlog from g
    union all select l_partkey, month, 'AMOUNT', stock * price, backlog * price from g""",
)
def rsh_dual_unit(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    backlog = F.when(F.col("l_linestatus") == "O", money("l_quantity")).otherwise(0)
    rows = table(spark, sf_dir, "lineitem").groupBy("l_partkey", period("l_shipdate").alias("month")).agg(
        F.sum(money("l_quantity")).alias("stock"), F.sum(backlog).alias("backlog")
    )
    priced = rows.join(p, "l_partkey")
    return with_amounts(priced, ["stock", "backlog"], F.col("p_retailprice")).drop("p_retailprice")
