"""Tables at rest: merges by files, slices replaced in one step, snapshots through the index of loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.base import money, number, query, table
from millrace.sources.versioned import VersionedTable
from millrace.sources.workspace import new_path

MERGED = """with o as (select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as price, year(o_orderdate) as year from orders),
    versions as (
      select o_orderkey, o_orderstatus, price, year, 0 as seq from o
      union all select o_orderkey, 'A', price + 1, year, 1 from o where year <= 1996
      union all select o_orderkey, 'B', price + 2, year, 2 from o where year between 1996 and 1998
      union all select -o_orderkey, 'C', price + 3, year, 3 from o where o_orderstatus = 'P'),
    newest as (select * from (select *, row_number() over (partition by o_orderkey order by seq desc) as r from versions) where r = 1)"""


def _orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").alias("year")
    return o.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("price"), year, F.lit(0).alias("seq"))


def _changed(o, seq, status):
    price = (F.col("price") + seq).cast("decimal(18,2)")
    return o.withColumns({"o_orderstatus": F.lit(status), "price": price, "seq": F.lit(seq)})


@query("biz_merge_at_rest", MERGED + " select o_orderkey, o_orderstatus, cast(price as double) as price, cast(year as integer) as year, cast(seq as integer) as seq from newest")
def biz_merge_at_rest(spark, sf_dir):
    o = _orders(spark, sf_dir)
    kept = VersionedTable(spark, new_path(spark, "silver"), ["o_orderkey"], partition_by=["year"])
    kept.merge(o, ["seq"], load="base")
    increments = [
        _changed(o.filter("year <= 1996"), 1, "A"),
        _changed(o.filter("year between 1996 and 1998"), 2, "B"),
        _changed(o.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey")), 3, "C"),
    ]
    for i, increment in enumerate(increments):
        for _ in range(2):  # a load that is there already changes nothing
            kept.merge(increment, ["seq"], load=f"load-{i}")
    return kept.read().withColumn("price", number("price"))


@query(
    "snk_slice_versions",
    """with o as (select o_orderstatus, cast(o_totalprice as decimal(18,2)) as price, year(o_orderdate) as year from orders),
    views as (
      select 'before' as view, * from o
      union all select 'after', * from o where year < 1998
      union all select 'after', o_orderstatus, price * 2, year from o where year >= 1998)
    select view, cast(year as integer) as year, o_orderstatus, count(*) as n, cast(sum(price) as double) as price from views group by 1, 2, 3""",
)
def snk_slice_versions(spark, sf_dir):
    o = _orders(spark, sf_dir)
    kept = VersionedTable(spark, new_path(spark, "gold"), ["o_orderkey"], partition_by=["year"])
    kept.append(o)
    before = kept.read()  # opened before the swap, read after it
    doubled = o.filter("year >= 1998").withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    kept.replace_slice(doubled, F.col("year") < 1998)
    views = before.withColumn("view", F.lit("before")).unionByName(kept.read().withColumn("view", F.lit("after")))
    return views.groupBy("view", "year", "o_orderstatus").agg(F.count("*").alias("n"), number(F.sum("price")).alias("price"))


def _daily_loads(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", "event_type", "value", F.col("ts").cast("date").alias("load_day"))
    kept = VersionedTable(
        spark, new_path(spark, "loads"), ["event_id"], partition_by=["load_day"], load_time="load_day", load_group=["event_type"]
    )
    kept.append(rows)
    return kept


@query(
    "snap_index_latest",
    """select event_type, event_id, value, cast(load_day as date) as load_day from (
      select *, max(load_day) over (partition by event_type) as newest from (select *, cast(ts as date) as load_day from events))
    where load_day = newest""",
)
def snap_index_latest(spark, sf_dir):
    return _daily_loads(spark, sf_dir).snapshot(["event_type"]).select("event_type", "event_id", "value", "load_day")


@query(
    "snap_index_first",
    """select event_id, event_type, value, cast(load_day as date) as load_day from (
      select *, min(load_day) over (partition by date_trunc('week', load_day)) as first from (select *, cast(ts as date) as load_day from events))
    where load_day = first""",
)
def snap_index_first(spark, sf_dir):
    weekly = F.date_trunc("week", F.col("load_day"))
    return _daily_loads(spark, sf_dir).snapshot([weekly], "min").select("event_id", "event_type", "value", "load_day")
