"""Aggregations and totals reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.base import money, number, query, round6, table
from fixtures.joins import LINE_ORDER, LINE_ORDER_SQL
from millrace.functions import period
from millrace.operators.aggregates import (
    agg_by_kind as by_kind,
)
from millrace.operators.aggregates import (
    attainment,
    distinct_rows,
    duplicate_keys,
    spread_stats,
    sum_all,
    sum_by_sets,
    total,
    two_level,
    unit_price,
    with_group_median,
)
from millrace.operators.reports import quarter_means, totals_report


@query(
    "agg_basic",
    """select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as decimal(18,2))) as double) as qty,
    min(l_extendedprice) as low, max(l_extendedprice) as high, count(*) as n,
    round(cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*), 6) as mean_discount,
    arg_min(l_orderkey, struct_pack(a := l_shipdate, b := l_orderkey)) as first_order
    from lineitem group by 1, 2""",
)
def agg_basic(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        number(F.sum(money("l_quantity"))).alias("qty"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
        F.count("*").alias("n"),
        round6(number(F.sum(money("l_discount"))) / F.count("*")).alias("mean_discount"),
        F.min_by("l_orderkey", F.struct("l_shipdate", "l_orderkey")).alias("first_order"),
    )


@query(
    "agg_stats",
    """select l_partkey, round(stddev_samp(l_quantity), 6) as sd_samp, round(stddev_pop(l_quantity), 6) as sd_pop,
    round(var_samp(l_quantity), 6) as var_samp, median(l_quantity) as median from lineitem group by 1""",
)
def agg_stats(spark, sf_dir):
    stats = spread_stats(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_quantity")
    return stats.withColumns({c: round6(c) for c in ("sd_samp", "sd_pop", "var_samp")})


@query(
    "agg_expr_keys",
    """select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, o_orderpriority,
    count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as amount from orders group by 1, 2, 3""",
)
def agg_expr_keys(spark, sf_dir):
    keys = [F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderpriority"]
    return table(spark, sf_dir, "orders").groupBy(*keys).agg(
        F.count("*").alias("n"), number(F.sum(money("o_totalprice"))).alias("amount")
    )


@query(
    "agg_all_numeric",
    """select l_suppkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as amount,
    cast(sum(cast(l_tax as decimal(18,2))) as double) as tax from lineitem group by 1""",
)
def agg_all_numeric(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", money("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("amount"), money("l_tax").alias("tax"),
    )
    out = sum_all(rows, ["l_suppkey"])
    return out.withColumns({c: number(c) for c in ("quantity", "amount", "tax")})


@query(
    "agg_conditional",
    """select l_suppkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity,
    avg(l_quantity) as rate from lineitem group by 1""",
)
def agg_conditional(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", money("l_quantity").alias("quantity"), F.col("l_quantity").alias("rate")
    )
    out = by_kind(rows, ["l_suppkey"], ["quantity"], ["rate"])
    return out.select("l_suppkey", number("quantity").alias("quantity"), "rate")


@query(
    "agg_by_bucket_sets",
    """select l_partkey, cast(coalesce(sum(q) filter (l_returnflag = 'A'), 0) as double) as accepted,
    cast(coalesce(sum(q) filter (l_returnflag in ('A', 'N') and l_linestatus = 'O'), 0) as double) as open_kept,
    cast(coalesce(sum(q) filter (l_returnflag in ('A', 'N', 'R')), 0) as double) as everything
    from (select *, cast(l_quantity as decimal(18,2)) as q from lineitem) group by 1""",
)
def agg_by_bucket_sets(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("q", money("l_quantity"))
    flag = F.col("l_returnflag")
    sets = {
        "accepted": flag == "A",
        "open_kept": flag.isin("A", "N") & (F.col("l_linestatus") == "O"),
        "everything": flag.isin("A", "N", "R"),
    }
    return sum_by_sets(rows, ["l_partkey"], "q", sets).withColumns({c: number(c) for c in sets})


@query(
    "agg_two_level",
    """select item, round(avg(t), 6) as mean, round(var_samp(t), 6) as variance, count(*) as months from (
      select l_partkey as item, strftime(l_shipdate, '%Y-%m') as month, sum(l_quantity) as t from lineitem group by 1, 2)
    group by 1""",
)
def agg_two_level(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item"), period("l_shipdate").alias("month"), "l_quantity"
    )
    out = two_level(
        rows, ["item", "month"], ["item"], "l_quantity", {"mean": "avg", "variance": "var_samp", "months": "count"}
    )
    return out.withColumns({c: round6(c) for c in ("mean", "variance")})


@query(
    "agg_distinct",
    f"""select l_orderkey, l_linenumber, l_partkey, cast(null as varchar) as flag from lineitem
      qualify row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) = 1
    union all select distinct null, null, l_partkey, l_returnflag from lineitem""",
)
def agg_distinct(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    first = distinct_rows(rows, ["l_orderkey", "l_linenumber"], LINE_ORDER).select("l_orderkey", "l_linenumber", "l_partkey")
    pairs = distinct_rows(rows.select("l_partkey", F.col("l_returnflag").alias("flag")))
    return first.unionByName(pairs, allowMissingColumns=True)


@query(
    "agg_join_back",
    """select p_partkey, p_brand, p_retailprice, m as brand_median from part
    join (select p_brand as b, median(p_retailprice) as m from part group by 1) on b = p_brand""",
)
def agg_join_back(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    return with_group_median(p, ["p_brand"], "p_retailprice", "brand_median")


@query(
    "agg_median_global",
    """select l_returnflag, round(median(l_extendedprice), 6) as median from lineitem group by 1""",
)
def agg_median_global(spark, sf_dir):
    from millrace.operators.aggregates import exact_median

    out = exact_median(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return out.withColumn("median", round6("median"))


@query(
    "agg_unit_price",
    """select l_partkey, strftime(l_shipdate, '%Y') as year,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / nullif(cast(sum(cast(l_quantity as decimal(18,2))) as double), 0) as price
    from lineitem group by 1, 2""",
)
def agg_unit_price(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.date_format("l_shipdate", "yyyy").alias("year"),
        money("l_extendedprice").alias("v"), money("l_quantity").alias("q"),
    )
    return unit_price(rows, ["l_partkey", "year"], "v", "q", "price")


@query(
    "agg_attainment",
    """select o_custkey, cast(sum(case when o_orderstatus <> 'P' then v end) as double) as net, cast(sum(v) as double) as budget,
    round(100 * cast(sum(case when o_orderstatus <> 'P' then v end) as double) / nullif(cast(sum(v) as double), 0), 6) as attainment
    from (select *, cast(o_totalprice as decimal(18,2)) as v from orders) group by 1""",
)
def agg_attainment(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", money("o_totalprice")).alias("net"),
        money("o_totalprice").alias("budget"),
    )
    out = attainment(rows, ["o_custkey"], "net", "budget")
    return out.select("o_custkey", number("net").alias("net"), number("budget").alias("budget"), round6("attainment").alias("attainment"))


@query(
    "agg_global",
    """select p_partkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as value,
    (select cast(sum(cast(l_extendedprice as decimal(18,2))) as double) from lineitem) as grand_total
    from part join lineitem on l_partkey = p_partkey group by 1""",
)
def agg_global(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    value = number(F.sum(money("l_extendedprice")))
    items = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(value.alias("value"))
    return items.withColumn("grand_total", total(lines, value))


@query(
    "agg_duplicates",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
)
def agg_duplicates(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _sales(spark, sf_dir):
    """Sales by region, nation, segment and month."""
    n = table(spark, sf_dir, "nation").withColumnsRenamed({"n_nationkey": "c_nationkey", "n_regionkey": "r_regionkey"})
    c = table(spark, sf_dir, "customer").join(n, "c_nationkey").join(table(spark, sf_dir, "region"), "r_regionkey")
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return o.join(c, "c_custkey").select(
        F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"),
        F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("amount"),
    )


SALES = """(select r_name as region, n_name as nation, c_mktsegment as segment, o_orderdate as day,
    cast(o_totalprice as decimal(18,2)) as amount from orders join customer on c_custkey = o_custkey
    join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)"""


@query(
    "agg_rollup_totals",
    f"""select region, nation, cast(grouping(region, nation) as bigint) as level,
    coalesce(cast(sum(amount) filter (strftime(day, '%Y-%m') = '1998-01') as double), 0) as "1998-01",
    coalesce(cast(sum(amount) filter (strftime(day, '%Y-%m') = '1998-02') as double), 0) as "1998-02",
    coalesce(cast(sum(amount) filter (strftime(day, '%Y-%m') = '1998-03') as double), 0) as "1998-03",
    cast(sum(amount) as double) as total, round(cast(sum(amount) as double) / 3, 6) as mean
    from {SALES} where strftime(day, '%Y-%m') between '1998-01' and '1998-03' group by rollup (region, nation)""",
)
def agg_rollup_totals(spark, sf_dir):
    from datetime import date

    sales = _sales(spark, sf_dir)
    out = totals_report(sales, ["region", "nation"], "day", "amount", date(1998, 1, 1), 3)
    months = ["1998-01", "1998-02", "1998-03"]
    return out.select("region", "nation", "level", *[number(m).alias(m) for m in months],
                      number("total").alias("total"), round6("mean").alias("mean"))


@query(
    "agg_grouping_sets",
    f"""select region, segment, cast(sum(amount) as double) as amount, count(*) as n,
    cast(grouping(region, segment) as bigint) as level
    from {SALES} group by grouping sets ((region, segment), (segment), ())""",
)
def agg_grouping_sets(spark, sf_dir):
    sales = _sales(spark, sf_dir)
    sets = [["region", "segment"], ["segment"], []]
    grouped = sales.groupingSets([[F.col(c) for c in s] for s in sets], "region", "segment")
    return grouped.agg(
        number(F.sum("amount")).alias("amount"), F.count("*").alias("n"),
        F.grouping_id("region", "segment").alias("level"),
    )


@query(
    "agg_quarter_means",
    f"""select segment, cast(year(day) as integer) as year, cast(quarter(day) as integer) as quarter, cast(sum(amount) as double) as total,
    round(cast(sum(amount) as double) / 3, 6) as monthly_mean,
    round(100 * cast(sum(amount) as double) / nullif(cast(sum(case when nation <> 'NATION_3' then amount end) as double), 0), 6) as attainment
    from {SALES} group by 1, 2, 3""",
)
def agg_quarter_means(spark, sf_dir):
    sales = _sales(spark, sf_dir).withColumn("revised", F.when(F.col("nation") != "NATION_3", F.col("amount")))
    out = quarter_means(sales, ["segment"], "day", "amount", "revised")
    return out.select(
        "segment", "year", "quarter", number("total").alias("total"),
        round6("monthly_mean").alias("monthly_mean"), round6("attainment").alias("attainment"),
    )
