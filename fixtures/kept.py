"""Tables kept in a form that saves work: bucketed measures, month totals, digests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fixtures.base import money, number, query, table
from millrace.operators.digests import reconcile_rows
from millrace.sources.bucketed import star_chain, write_bucketed
from millrace.sources.kept_totals import KeptTotals
from millrace.sources.workspace import new_path


@query(
    "join_reconcile_digests",
    """select o_orderkey as id, case when o_orderstatus = 'P' then 'only_left' else 'changed' end as state from orders
    where o_orderstatus = 'P' or o_totalprice > 300000
    union all select -o_orderkey, 'only_right' from orders where o_orderstatus = 'O' and o_totalprice < 2000""",
)
def join_reconcile_digests(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", money("o_totalprice").alias("price"))
    higher = F.when(F.col("price") > 300000, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")
    changed = o.filter("o_orderstatus <> 'P'").withColumn("price", higher)
    added = o.filter("o_orderstatus = 'O' and price < 2000").withColumn("id", -F.col("id"))
    return reconcile_rows(o, changed.union(added), ["id"])


REPORT = ", ".join(f"""coalesce(sum(price) filter (date_trunc('month', l_shipdate) = date '1997-{m:02d}-01'), 0)::double as "1997-{m:02d}" """ for m in range(1, 7))


@query(
    "agg_kept_totals",
    f"""with rows as (select l_returnflag, l_linestatus, l_shipdate, cast(l_extendedprice as decimal(18,2)) as price from lineitem
      where l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1997-07-01' and not (l_returnflag = 'R' and month(l_shipdate) = 3))
    select l_returnflag, l_linestatus, {REPORT}, sum(price)::double as total, cast(grouping(l_returnflag, l_linestatus) as bigint) as level,
    round(sum(price)::double / 6, 6) as mean from rows group by rollup (l_returnflag, l_linestatus)""",
)
def agg_kept_totals(spark, sf_dir):
    # Three loads: most rows, late rows of two months, and a correction that takes rows back.
    lines = table(spark, sf_dir, "lineitem").withColumn("price", money("l_extendedprice"))
    late = (F.month("l_shipdate") <= 2) & (F.col("l_linestatus") == "O")
    kept = KeptTotals(spark, new_path(spark, "totals"), ["l_returnflag", "l_linestatus"], "l_shipdate", "price")
    kept.add(lines.filter(~late), load="most")
    kept.add(lines.filter(late), load="late")
    wrong = lines.filter((F.col("l_returnflag") == "R") & (F.month("l_shipdate") == 3))
    for _ in range(2):  # a load that is in changes nothing
        kept.add(lines.filter(F.lit(False)), withdrawn=wrong, load="correction")
    report = kept.report(date(1997, 1, 1), 6)
    return report.select(
        "l_returnflag", "l_linestatus", *[number(f"`1997-{m:02d}`").alias(f"1997-{m:02d}") for m in range(1, 7)],
        number("total").alias("total"), "level", F.round("mean", 6).alias("mean"),
    )


@query(
    "join_star_bucketed",
    """select p_partkey, p_brand, ordered, shipped_value, main_supplier, lines from part
    left join (select l_partkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as ordered from lineitem group by 1) a on a.l_partkey = p_partkey
    left join (select l_partkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as shipped_value from lineitem where l_linestatus = 'F' group by 1) b on b.l_partkey = p_partkey
    left join (select l_partkey, max(l_suppkey) as main_supplier from lineitem group by 1) c on c.l_partkey = p_partkey
    left join (select l_partkey, count(*) as lines from lineitem group by 1) d on d.l_partkey = p_partkey""",
)
def join_star_bucketed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    by_item = lambda df, agg: df.groupBy("p_partkey").agg(agg)
    measures = [
        by_item(lines, number(F.sum(money("l_quantity"))).alias("ordered")),
        by_item(lines.filter("l_linestatus = 'F'"), number(F.sum(money("l_extendedprice"))).alias("shipped_value")),
        by_item(lines, F.max("l_suppkey").alias("main_supplier")),
        by_item(lines, F.count("*").alias("lines")),
    ]
    spine = write_bucketed(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_partkey"], 8)
    return star_chain(spine, [write_bucketed(m, ["p_partkey"], 8) for m in measures], ["p_partkey"])
