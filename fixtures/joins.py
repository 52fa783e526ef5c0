"""Joins, snapshots and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, table
from millrace.functions import month_start, period
from millrace.operators.joins import (
    append_missing,
    cross_spine,
    enrich_geography,
    except_by_key,
    left_join_all,
    lookup_with_fallback,
    reconcile,
    split_conditions,
    texts_by_language,
)
from millrace.operators.reshape import months_from
from millrace.operators.sets import replace_slice, union_all, union_missing
from millrace.operators.snapshots import (
    latest_by_key,
    snapshot_overall,
    snapshot_per_group,
    snapshot_two_stage,
    top_n,
)

# A total order over line versions; rows equal in all of these are equal altogether.
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LINE_ORDER_SQL = "l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc"


@query(
    "join_inner",
    "select o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey",
)
def join_inner(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return o.join(table(spark, sf_dir, "customer"), ["c_custkey"], "inner").select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "join_left",
    "select o_orderkey, l_linenumber, l_quantity from orders left join lineitem on o_orderkey = l_orderkey",
)
def join_left(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return table(spark, sf_dir, "orders").join(lines, ["o_orderkey"], "left").select("o_orderkey", "l_linenumber", "l_quantity")


@query(
    "join_right",
    """select l_orderkey, l_linenumber, o_totalprice from (select * from orders where o_orderstatus = 'F')
    right join lineitem on o_orderkey = l_orderkey""",
)
def join_right(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "l_orderkey")
    return o.join(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "right").select(
        "l_orderkey", "l_linenumber", "o_totalprice"
    )


@query(
    "join_full",
    """select coalesce(o.month, l.month) as month, ordered, shipped from
    (select strftime(o_orderdate, '%Y-%m') as month, count(*) as ordered from orders group by 1) o
    full join (select strftime(l_shipdate, '%Y-%m') as month, cast(sum(l_quantity) as double) as shipped from lineitem group by 1) l
    on o.month = l.month""",
)
def join_full(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(period("o_orderdate").alias("month")).agg(F.count("*").alias("ordered"))
    shipped = number(F.sum(money("l_quantity"))).alias("shipped")
    s = table(spark, sf_dir, "lineitem").groupBy(period("l_shipdate").alias("month")).agg(shipped)
    return o.join(s, ["month"], "full")


@query(
    "join_anti",
    "select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
)
def join_anti(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return except_by_key(table(spark, sf_dir, "orders"), lines, ["o_orderkey"]).select("o_orderkey", "o_custkey")


SNAP_SQL = """select o_orderkey, month, cast(o_orderdate as date) as day from (
    select *, strftime(o_orderdate, '%Y-%m') as month,
      {fn}(o_orderdate) over (partition by strftime(o_orderdate, '%Y-%m')) as picked from orders)
    where o_orderdate = picked"""


def _snap(spark, sf_dir, pick):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", period("o_orderdate").alias("month"), F.to_date("o_orderdate").alias("day")
    )
    return snapshot_per_group(o, ["month"], "day", pick)


@query("snap_latest", SNAP_SQL.format(fn="max"))
def snap_latest(spark, sf_dir):
    return _snap(spark, sf_dir, "max")


@query("snap_first", SNAP_SQL.format(fn="min"))
def snap_first(spark, sf_dir):
    return _snap(spark, sf_dir, "min")


@query(
    "snap_two_stage",
    """with d as (select event_id, cast(ts as date) as day, date_trunc('month', ts) as m from events),
    f as (select m, min(day) as day from d group by m), n as (select max(day) as day from f)
    select 'first' as pick, event_id, day from d where day = (select day from n)
    union all select 'last', event_id, day from d where day = (select max(day) from d)""",
)
def snap_two_stage(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    picks = {"first": snapshot_two_stage(e, "day", "month", "min"), "last": snapshot_two_stage(e, "day", "month", "max")}
    first, last = (df.select(F.lit(name).alias("pick"), "event_id", "day") for name, df in picks.items())
    return first.unionByName(last)


@query(
    "join_star_chain",
    """select p_partkey, p_brand, ordered, shipped_value, main_supplier, brand_items from part
    left join (select l_partkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as ordered from lineitem group by 1) a on a.l_partkey = p_partkey
    left join (select l_partkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as shipped_value from lineitem where l_linestatus = 'F' group by 1) b on b.l_partkey = p_partkey
    left join (select l_partkey, max(l_suppkey) as main_supplier from lineitem group by 1) c on c.l_partkey = p_partkey
    left join (select p_brand as brand, count(*) as brand_items from part group by 1) d on d.brand = p_brand""",
)
def join_star_chain(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    ordered = lines.groupBy("p_partkey").agg(number(F.sum(money("l_quantity"))).alias("ordered"))
    shipped = lines.filter("l_linestatus = 'F'").groupBy("p_partkey").agg(
        number(F.sum(money("l_extendedprice"))).alias("shipped_value")
    )
    supplier = lines.groupBy("p_partkey").agg(F.max("l_suppkey").alias("main_supplier"))
    brands = p.groupBy("p_brand").agg(F.count("*").alias("brand_items"))
    return left_join_all(
        p, [(ordered, ["p_partkey"]), (shipped, ["p_partkey"]), (brands, ["p_brand"]), (supplier, ["p_partkey"])]
    )


@query(
    "join_cross_spine",
    """select s_suppkey, m::date as month, concept from supplier,
    generate_series(timestamp '1998-01-01', timestamp '1998-12-01', interval 1 month) t(m),
    (values ('PIECES'), ('AMOUNT')) c(concept)""",
)
def join_cross_spine(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    return cross_spine(s, months_from(date(1998, 1, 1), 12), {"concept": ["PIECES", "AMOUNT"]})


@query(
    "join_append_missing",
    """select p_partkey as item, p_name as name, p_brand as brand from part where p_type = 'PROMO'
    union all select distinct l_partkey, cast(null as varchar), cast(null as varchar) from lineitem
    where l_partkey not in (select p_partkey from part where p_type = 'PROMO')""",
)
def join_append_missing(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter("p_type = 'PROMO'")
    base = p.select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    used = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item")).distinct()
    return append_missing(base, used, ["item"])


@query(
    "join_reconcile",
    """select 'orders' as side, o_orderkey as id from orders where o_orderkey not in (select l_orderkey from lineitem)
    union all select distinct 'lines', l_orderkey from lineitem
    where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')""",
)
def join_reconcile(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    only_orders, _ = reconcile(o, lines, ["id"])
    _, only_lines = reconcile(o.filter("o_orderstatus <> 'P'"), lines, ["id"])
    return only_orders.select(F.lit("orders").alias("side"), "id").unionByName(
        only_lines.select(F.lit("lines").alias("side"), "id")
    )


@query(
    "join_text_variants",
    """select source, max(case when lang = 'en' then text end) as english, max(case when lang = 'de' then text end) as german,
    max(case when lang = 'fr' then text end) as french from documents group by 1""",
)
def join_text_variants(spark, sf_dir):
    variants = {"en": "english", "de": "german", "fr": "french"}
    return texts_by_language(table(spark, sf_dir, "documents"), ["source"], "lang", "text", variants)


@query(
    "join_fallback_price",
    """with e as (select l_partkey as item, strftime(l_shipdate, '%Y-%m') as month, max(l_extendedprice / l_quantity) as price
      from lineitem where l_returnflag = 'N' group by 1, 2)
    select l_orderkey, l_linenumber, round(coalesce(e.price, p_retailprice, 1.0), 6) as price from lineitem
    left join e on e.item = l_partkey and e.month = strftime(l_shipdate, '%Y-%m')
    left join (select * from part where p_type <> 'PROMO') on p_partkey = l_partkey""",
)
def join_fallback_price(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("item"), period("l_shipdate").alias("month"),
        "l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )
    monthly = lines.filter("l_returnflag = 'N'").groupBy("item", "month").agg(F.max("price").alias("price"))
    general = table(spark, sf_dir, "part").filter("p_type <> 'PROMO'").select(
        F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("price")
    )
    priced = lookup_with_fallback(
        lines.drop("price"), monthly, ["item", "month"], general, ["item"], "price", default=F.lit(1.0)
    )
    return priced.select("l_orderkey", "l_linenumber", F.round("price", 6).alias("price"))


@query(
    "join_geo",
    """select s_suppkey, s_name, n_name, r_name from supplier left join nation on n_nationkey = s_nationkey
    left join region on r_regionkey = n_regionkey""",
)
def join_geo(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    r = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    out = enrich_geography(s, table(spark, sf_dir, "nation"), "n_nationkey", r, "n_regionkey")
    return out.select("s_suppkey", "s_name", "n_name", "r_name")


@query(
    "join_condition_split",
    """select l_orderkey, l_suppkey, max(case when l_returnflag <> 'R' then 'USD' end) as currency,
    cast(sum(case when l_returnflag <> 'R' then cast(l_extendedprice as decimal(18,2)) end) as double) as amount,
    cast(sum(case when l_returnflag = 'R' then cast(l_discount as decimal(18,2)) end) as double) as percent
    from lineitem group by 1, 2""",
)
def join_condition_split(spark, sf_dir):
    is_rate = F.col("l_returnflag") == "R"
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.when(is_rate, "%").otherwise("USD").alias("unit"),
        F.when(is_rate, money("l_discount")).otherwise(money("l_extendedprice")).alias("value"),
    )
    out = split_conditions(rows, ["l_orderkey", "l_suppkey"], "unit", "value")
    return out.withColumns({c: number(c) for c in ("amount", "percent")})


@query(
    "win_latest_by_key",
    f"""select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) = 1""".replace(
        "select *",
        "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, cast(l_shipdate as date) as day",
    ),
)
def win_latest_by_key(spark, sf_dir):
    latest = latest_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return latest.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.to_date("l_shipdate").alias("day"),
    )


@query(
    "win_rank_latest",
    """select o_custkey, o_orderkey, o_totalprice from orders
    qualify rank() over (partition by o_custkey order by cast(o_orderdate as date) desc) = 1""",
)
def win_rank_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return snapshot_per_group(o, ["o_custkey"], "day").select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "snap_overall",
    "select o_orderkey from orders where cast(o_orderdate as date) = (select max(cast(o_orderdate as date)) from orders)",
)
def snap_overall(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return snapshot_overall(o, "day").select("o_orderkey")


@query(
    "win_topn_per_group",
    """select o_custkey, o_orderkey, o_totalprice from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) <= 2""",
)
def win_topn_per_group(spark, sf_dir):
    newest = top_n(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 2)
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "ord_sort_limit",
    """select o_orderkey, o_orderstatus, o_totalprice from orders
    order by o_totalprice desc, o_orderstatus, o_orderkey limit 100""",
)
def ord_sort_limit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.orderBy(F.desc("o_totalprice"), "o_orderstatus", "o_orderkey").limit(100)


@query(
    "set_union",
    """select c_custkey as id, c_nationkey as nation from customer union all select s_suppkey, s_nationkey from supplier""",
)
def set_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"))
    return c.unionByName(s)


@query(
    "set_union_missing",
    """select c_custkey as id, c_mktsegment as segment, cast(null as double) as balance from customer
    union all select s_suppkey, null, s_acctbal from supplier""",
)
def set_union_missing(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return union_missing(c, s)


@query(
    "set_union_many",
    """select c_custkey as id, 'client' as kind, c_mktsegment as segment, cast(null as double) as balance, cast(null as varchar) as brand from customer
    union all select s_suppkey, 'supplier', null, s_acctbal, null from supplier
    union all select p_partkey, 'part', null, null, p_brand from part""",
)
def set_union_many(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    kinds = zip((c, s, p), ("client", "supplier", "part"))
    return union_all(*[df.withColumn("kind", F.lit(kind)) for df, kind in kinds])


@query(
    "set_replace_slice",
    """select strftime(o_orderdate, '%Y-%m') as month, count(*) as n, 'old' as version from orders
      where o_orderdate < timestamp '1998-06-01' group by 1
    union all select strftime(l_shipdate, '%Y-%m'), count(*), 'new' from lineitem
      where l_shipdate >= timestamp '1998-06-01' group by 1""",
)
def set_replace_slice(spark, sf_dir):
    def months(name, day, version):
        by = table(spark, sf_dir, name).groupBy(month_start(day).alias("month"))
        return by.agg(F.count("*").alias("n")).withColumn("version", F.lit(version))

    out = replace_slice(
        months("orders", "o_orderdate", "old"),
        months("lineitem", "l_shipdate", "new"),
        F.col("month") >= F.lit(AS_OF.replace(day=1)),
    )
    return out.withColumn("month", period("month"))
