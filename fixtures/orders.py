"""Table refresh and order status."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, table
from fixtures.joins import LINE_ORDER, LINE_ORDER_SQL
from millrace.functions import month_start, period
from millrace.operators.snapshots import opening_snapshot
from millrace.plans.orders import (
    AMOUNTS,
    MEASURES,
    opening_closing,
    order_status,
    order_status_cube,
    orders_for_planning,
    reserved_orders,
)
from millrace.plans.refresh import refresh_fact, refresh_silver, store_silver
from millrace.sources.registry import TableSpec, with_types
from millrace.sources.scans import literal_table
from millrace.sources.workspace import new_path

MAPPING = [
    ("LINES", "L_ORDERKEY", "Pedido"),
    ("LINES", "L_LINENUMBER", "Posición"),
    ("LINES", "L_PARTKEY", "Material"),
    ("LINES", "L_QUANTITY", "Cantidad/base"),
    ("LINES", "L_EXTENDEDPRICE", "Importe  (neto)"),
    ("LINES", "L_SHIPDATE", "Fecha de envío"),
    ("OTHER", "L_SUPPKEY", "Proveedor"),
]
DICTIONARY = [
    ("LINES", "L_QUANTITY", "QUAN"), ("LINES", "L_EXTENDEDPRICE", "CURR"), ("LINES", "L_PARTKEY", "INT4"),
    ("LINES", "L_SUPPKEY", "INT4"), ("LINES", "L_SHIPDATE", "DATS"), ("LINES", "L_RETURNFLAG", "CHAR"),
]


def _raw(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    text = [F.col(c).cast("string").alias(c.upper()) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")]
    return lines.select(
        *text, F.date_format("l_shipdate", "yyyy-MM-dd").alias("L_SHIPDATE"), F.col("l_shipdate").cast("timestamp").alias("SEQ_DATE"),
        F.year("l_shipdate").alias("YEAR"),
    )


def _lines_spec(spark):
    mapping = literal_table(spark, MAPPING, "tabla string, TEC string, USUARIO string")
    dictionary = literal_table(spark, DICTIONARY, "table string, column string, datatype string")
    spec = with_types(
        TableSpec(
            "LINES", ("L_ORDERKEY", "L_LINENUMBER"),
            order_by=("SEQ_DATE", "L_PARTKEY", "L_SUPPKEY", "L_QUANTITY", "L_EXTENDEDPRICE"),
        ),
        dictionary,
    )
    return spec, mapping


def _silver(spark, sf_dir, delta):
    spec, mapping = _lines_spec(spark)
    raw = _raw(spark, sf_dir)
    if delta:
        mark = datetime(2000, 1, 1)
        current = refresh_silver(raw.filter(F.col("SEQ_DATE") < F.lit(mark)), spec, mapping)
        out = refresh_silver(raw, spec, mapping, since=mark, current=current)
    else:
        out = refresh_silver(raw, spec, mapping)
    return out.drop("SEQ_DATE")


SILVER = f"""select l_orderkey::varchar as "PEDIDO", l_linenumber::varchar as "POSICION", l_partkey::double as "MATERIAL", l_suppkey::double as "L_SUPPKEY",
    l_quantity as "CANTIDAD_BASE", l_extendedprice as "IMPORTE_NETO", l_returnflag as "L_RETURNFLAG", cast(l_shipdate as date) as "FECHA_DE_ENVIO",
    cast(year(l_shipdate) as integer) as "YEAR" from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) = 1"""


@query("biz_refresh_silver", SILVER)
def biz_refresh_silver(spark, sf_dir):
    return _silver(spark, sf_dir, delta=False)


@query("biz_refresh_silver_delta", SILVER)
def biz_refresh_silver_delta(spark, sf_dir):
    return _silver(spark, sf_dir, delta=True)


@query("biz_store_silver", SILVER)
def biz_store_silver(spark, sf_dir):
    # A first load, then an increment that is merged into the files at rest, then the same again.
    spec, mapping = _lines_spec(spark)
    spec = replace(spec, partition_by=("YEAR",), load_mode="append")
    raw, path, mark = _raw(spark, sf_dir), new_path(spark, "silver"), datetime(2000, 1, 1)
    store_silver(raw.filter(F.col("SEQ_DATE") < F.lit(mark)), spec, mapping, path, load="first")
    for _ in range(2):
        kept = store_silver(raw, spec, mapping, path, since=mark, load="second")
    return kept.read().drop("SEQ_DATE")


@query(
    "biz_opening_snapshot",
    f"""select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where cast(l_shipdate as date) = date '1998-06-01'
    qualify row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) = 1""",
)
def biz_opening_snapshot(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    out = opening_snapshot(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", AS_OF, LINE_ORDER)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


FACT = """with r as (select concat('00', l_partkey) as material, l_quantity as units, cast(l_shipdate as date) as load_day,
      strftime(l_shipdate - interval 1 day, '%Y-%m') as month from lineitem)
    select distinct regexp_replace(material, '^0{{2,}}(.)', '\\1') as item, units, load_day, month from r
    qualify load_day = {fn}(load_day) over (partition by month)"""


def _fact(spark, sf_dir, pick):
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("00"), F.col("l_partkey").cast("string")).alias("material"),
        F.col("l_quantity").alias("units"), F.to_date("l_shipdate").alias("load_day"),
    )
    return refresh_fact(rows, "load_day", pick=pick, shift_days=1, names={"material": "item"})


@query("biz_refresh_fact", FACT.format(fn="max"))
def biz_refresh_fact(spark, sf_dir):
    return _fact(spark, sf_dir, "max")


@query("biz_refresh_fact_opening", FACT.format(fn="min"))
def biz_refresh_fact_opening(spark, sf_dir):
    return _fact(spark, sf_dir, "min")


def _facts(spark, sf_dir):
    o, c, lines = (table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    segment = F.col("c_mktsegment")
    channel = F.when(segment == "BUILDING", "MI").when(segment == "MACHINERY", "ME").when(segment == "FURNITURE", "MO").otherwise("XX")
    priority = F.col("o_orderpriority")
    order_class = F.when(priority == "1-URGENT", "ZOMI").when(priority == "2-HIGH", "ZOME").when(priority == "3-MEDIUM", "ZOMO").otherwise("ZREP")
    states = {
        "": F.lit(True), "billed_": F.col("l_linestatus") == "F", "rejected_": F.col("l_returnflag") == "R",
        "backlog_": F.col("l_linestatus") == "O",
    }
    pieces = [F.when(s, money("l_quantity")).otherwise(0).alias(f"{p}pieces") for p, s in states.items()]
    amounts = [F.when(s, money("l_extendedprice")).otherwise(0).alias(f"{p}amount") for p, s in states.items()]
    joined = lines.join(o, o.o_orderkey == lines.l_orderkey).join(c, c.c_custkey == o.o_custkey)
    day = F.to_date("o_orderdate")
    return joined.select(
        F.when(F.col("o_orderstatus") == "P", "505").otherwise("504").alias("client"), day.alias("registered"),
        F.to_date("l_shipdate").alias("promised"), F.col("o_custkey").cast("string").alias("customer"),
        F.concat(F.lit("00"), (F.col("l_partkey") + 1).cast("string")).alias("material"), order_class.alias("order_class"),
        channel.alias("channel"), F.when(F.col("l_linenumber") < 4, 2.0).otherwise(4.0).alias("rate"),
        F.date_add(day, F.col("l_linenumber") % 2).alias("loaded_at"), *pieces, *amounts,
    )


STATES = {"": "true", "billed_": "l_linestatus = 'F'", "rejected_": "l_returnflag = 'R'", "backlog_": "l_linestatus = 'O'"}
RULES = {
    "": "order_class <> 'ZREP'", "billed_": "true", "rejected_": "order_class <> 'ZREP'", "backlog_": "not promised > registered",
}
STATUS_COLUMNS = ", ".join(
    [f"sum(case when {RULES[p]} then {p}pieces else 0 end) as {p}pieces" for p in STATES]
    + [f"sum(case when {RULES[p]} then {p}amount else 0 end) as {p}amount" for p in STATES]
    + [
        f"sum(case when {RULES[p]} and channel <> 'MI' then cast({p}amount as double) / rate else 0 end) as {p}amount_usd"
        for p in STATES
    ]
)
STATUS = (
    "with raw as (select case o_orderstatus when 'P' then '505' else '504' end as client, cast(o_orderdate as date) as registered,"
    " cast(l_shipdate as date) as promised, o_custkey::varchar as customer, (l_partkey + 1)::varchar as material,"
    " case o_orderpriority when '1-URGENT' then 'ZOMI' when '2-HIGH' then 'ZOME' when '3-MEDIUM' then 'ZOMO' else 'ZREP' end as order_class,"
    " case c_mktsegment when 'BUILDING' then 'MI' when 'MACHINERY' then 'ME' when 'FURNITURE' then 'MO' else 'XX' end as channel,"
    " case when l_linenumber < 4 then 2.0::double else 4.0::double end as rate, l_linenumber % 2 as load, "
    + ", ".join(f"case when {s} then cast(l_quantity as decimal(18,2)) else 0 end as {p}pieces" for p, s in STATES.items())
    + ", "
    + ", ".join(f"case when {s} then cast(l_extendedprice as decimal(18,2)) else 0 end as {p}amount" for p, s in STATES.items())
    + " from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey),"
    " newest as (select * from raw qualify load = max(load) over (partition by registered)),"
    " wanted as (select *, strftime(registered, '%Y-%m') as month from newest where client = '504' and channel <> 'XX'),"
    " closing as (select * from wanted qualify registered = max(registered) over (partition by month)),"
    f" status as (select month, registered, promised, channel, customer, material, {STATUS_COLUMNS} from closing group by 1, 2, 3, 4, 5, 6)"
)
STATUS_MEASURES = [*MEASURES, *AMOUNTS, *[f"{a}_usd" for a in AMOUNTS]]


@query(
    "biz_order_status",
    f"{STATUS} select month, registered, promised, channel, customer, material, "
    + ", ".join(f"cast({m} as double) as {m}" for m in STATUS_MEASURES)
    + " from status",
)
def biz_order_status(spark, sf_dir):
    out = order_status(_facts(spark, sf_dir), "504")
    return out.withColumns({m: number(m) for m in STATUS_MEASURES})


CUBE_IDS = "month, registered, promised, channel, customer, system, line, line_group, class"


def _cube_row(unit, currency, suffix):
    kinds = {"orders": "", "sales": "billed_", "rejected": "rejected_", "backlog": "backlog_"}
    cells = ", ".join(f'cast(sum({p}{suffix}) as double) as "{k.upper()}"' for k, p in kinds.items())
    return f"select {CUBE_IDS}, '{unit}' as unit, '{currency}' as currency, {cells} from j group by all"


@query(
    "biz_order_status_cube",
    f"{STATUS}, j as (select status.*, p_type as system, p_brand as line, p_size % 5 as line_group, 'C' || (p_size % 3) as class"
    " from status join part on (p_partkey + 1)::varchar = material and (channel <> 'MO' or p_size > 10)), rows_ as ("
    + " union all ".join(
        [_cube_row("PIECES", "PIECES", "pieces"), _cube_row("AMOUNT", "MXN", "amount"), _cube_row("AMOUNT", "USD", "amount_usd")]
    )
    + ") select *, concat_ws('-', system, line, class, channel) as product_id, concat_ws('-', customer, channel) as customer_id from rows_",
)
def biz_order_status_cube(spark, sf_dir):
    channels = F.array(F.lit("MI"), F.lit("ME"), F.when(F.col("p_size") > 10, "MO"))
    materials = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).cast("string").alias("material"), F.explode(channels).alias("channel"),
        F.col("p_type").alias("system"), F.col("p_brand").alias("line"), (F.col("p_size") % 5).alias("line_group"),
        F.concat(F.lit("C"), (F.col("p_size") % 3).cast("string")).alias("class"),
    )
    return order_status_cube(order_status(_facts(spark, sf_dir), "504"), materials)


MONTHLY = """with m as (select l_partkey as item, strftime(o_orderdate, '%Y-%m') as month, sum(cast(l_quantity as decimal(18,2))) as p,
      sum(cast(l_extendedprice as decimal(18,2))) as a, sum(case when l_linestatus = 'F' then cast(l_quantity as decimal(18,2)) else 0 end) as bp,
      sum(case when l_linestatus = 'F' then cast(l_extendedprice as decimal(18,2)) else 0 end) as ba,
      sum(case when l_linestatus = 'O' then cast(l_quantity as decimal(18,2)) else 0 end) as kp,
      sum(case when l_linestatus = 'O' then cast(l_extendedprice as decimal(18,2)) else 0 end) as ka
      from lineitem join orders on o_orderkey = l_orderkey group by 1, 2)"""


def _planning_orders(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return facts.select(
        (F.col("material").cast("bigint") - 1).alias("item"), period("registered").alias("month"), *MEASURES, *AMOUNTS
    )


@query(
    "biz_orders_for_planning",
    f"""{MONTHLY} select item, month, 'PIECES' as concept, cast(bp as double) as sales, cast(p as double) as orders, cast(kp as double) as backlog from m
    union all select item, month, 'AMOUNT', cast(ba as double), cast(a as double), cast(ka as double) from m""",
)
def biz_orders_for_planning(spark, sf_dir):
    return orders_for_planning(_planning_orders(spark, sf_dir))


@query(
    "biz_opening_closing",
    """with m as (select l_partkey as item, date_trunc('month', l_shipdate)::date as month, cast(sum(l_quantity) as double) as backlog,
      count(*)::double as n from lineitem where l_linestatus = 'O' group by 1, 2)
    select coalesce(a.item, b.item) as item, coalesce(a.month, b.month) as month, b.backlog, b.n, a.backlog as backlog_closing, a.n as n_closing
    from m a full join (select item, (month + interval 1 month)::date as month, backlog, n from m) b on a.item = b.item and a.month = b.month""",
)
def biz_opening_closing(spark, sf_dir):
    months = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'").groupBy(
        F.col("l_partkey").alias("item"), month_start("l_shipdate").alias("month")
    ).agg(F.sum("l_quantity").alias("backlog"), F.count("*").alias("n"))
    return opening_closing(months, ["item"], "month", ["backlog", "n"])


@query(
    "biz_reserved_orders",
    """with d as (select *, strftime(o_orderdate, '%Y-%m') as month, cast(o_orderdate as date) as day from orders),
    c as (select * from d qualify day = max(day) over (partition by month))
    select (o_custkey + 1)::varchar as item, month, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as reserved_qty, 'PIECES' as concept
    from c where o_orderpriority <> '5-LOW' group by 1, 2""",
)
def biz_reserved_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("header_key"), F.col("o_orderkey").alias("position_key"),
        F.when(F.col("o_orderpriority") == "5-LOW", "B").otherwise("A").alias("plant"),
        F.concat(F.lit("0"), (F.col("o_custkey") + 1).cast("string")).alias("material"), money("o_totalprice").alias("remaining_qty"),
    )
    return reserved_orders(rows, "A").withColumn("reserved_qty", number("reserved_qty"))
