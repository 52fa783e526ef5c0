"""Purchasing operators over orders, lines, suppliers and parts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, table
from fixtures.joins import LINE_ORDER, LINE_ORDER_SQL
from millrace.functions import pad_key
from millrace.operators.snapshots import latest_by_key
from millrace.plans.purchasing import (
    delivery_plan,
    goods_receipts,
    info_records,
    order_views,
    po_indicators,
    requisitions,
    service_numbers,
)

LINE_KEY = ["l_orderkey", "l_linenumber"]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _latest_lines(spark, sf_dir):
    return latest_by_key(_lines(spark, sf_dir), LINE_KEY, LINE_ORDER)


LATEST = f"(select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) = 1)"


def _po_inputs(spark, sf_dir):
    o, lines = table(spark, sf_dir, "orders"), _lines(spark, sf_dir)
    header = o.select(
        F.col("o_orderkey").alias("document"),
        F.to_date("o_orderdate").alias("document_date"),
        (F.col("o_custkey") % 100).alias("supplier"),
        F.col("o_orderpriority").alias("plant"),
        F.when(F.col("o_orderstatus") == "F", "MXN").otherwise("USD").alias("currency"),
        F.lit(18.5).cast("decimal(18,2)").alias("exchange_rate"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("release_state"),
    )
    schedule = lines.select(
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("schedule_line"), F.to_date("l_shipdate").alias("delivery_date"),
        money("l_quantity").alias("scheduled_qty"),
    )
    # Joined by the padded key, so that the planners of a material find its items where the groups left them.
    groups = table(spark, sf_dir, "part").select(pad_key("p_partkey").alias("material"), F.col("p_brand").alias("material_group"))
    item = _latest_lines(spark, sf_dir).withColumn("material", pad_key("l_partkey")).join(groups, "material", "left").select(
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"),
        "material", "material_group",
        F.when(F.col("l_returnflag") == "R", "9").otherwise("0").alias("item_type"),
        F.when(F.col("l_linestatus") == "F", "ST").otherwise("KG").alias("price_unit"),
        money("l_extendedprice").alias("net_price"), money("l_extendedprice").alias("net_value"),
    )
    planning = table(spark, sf_dir, "part").select(
        pad_key("p_partkey").alias("material"), F.lit("1-URGENT").alias("plant"), F.col("p_brand").alias("planner")
    )
    document = F.concat_ws("-", "l_orderkey", "l_linenumber")
    history = lines.select(
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"), document.alias("material_document"),
        F.when(F.col("l_linestatus") == "O", "D").otherwise("E").alias("history_type"),
    )
    sheets = lines.select(
        document.alias("material_document"),
        F.when(F.col("l_suppkey") % 3 == 0, " ").otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("service"),
    )
    n = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    r = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    supplier = table(spark, sf_dir, "supplier").join(n, "s_nationkey", "left").join(r, "n_regionkey", "left").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("country"), F.col("r_name").alias("region"),
    )
    return header, schedule, item, planning, service_numbers(history, sheets), supplier


INDICATORS = f"""with sched as (select distinct l_orderkey as document, l_linenumber as position, l_partkey as schedule_line,
      cast(l_shipdate as date) as delivery_date, cast(l_quantity as decimal(18,2)) as q from lineitem),
    item as (select l_orderkey as document, l_linenumber as position, lpad(l_partkey::varchar, 10, '0') as material,
      p_brand as material_group, l_returnflag = 'R' as service_item,
      case l_linestatus when 'F' then 'PC' else 'KG' end as price_unit, cast(l_extendedprice as decimal(18,2)) as price
      from {LATEST} left join part on p_partkey = l_partkey),
    svc as (select distinct l_orderkey as document, l_linenumber as position, concat('S', l_suppkey) as service from lineitem
      where l_suppkey % 3 <> 0 and (l_orderkey, l_linenumber) in (select (l_orderkey, l_linenumber) from lineitem where l_linestatus = 'O')),
    f as (select o_orderkey as document, cast(o_orderdate as date) as document_date, s.position, s.schedule_line,
      case when i.service_item then v.service else i.material end as material,
      case when i.service_item then 'SERVICE' else 'MATERIAL' end as purchase_type,
      o_custkey % 100 as supplier, o_orderpriority as plant, case o_orderstatus when 'F' then 'MXN' else 'USD' end as currency,
      o_orderstatus as release_state, i.price_unit, p_brand as planner, s.delivery_date, i.material_group, s.q, i.price
      from orders left join sched s on s.document = o_orderkey
      left join item i on i.document = o_orderkey and i.position = s.position
      left join part on lpad(p_partkey::varchar, 10, '0') = i.material and o_orderpriority = '1-URGENT'
      left join svc v on v.document = o_orderkey and v.position = s.position),
    g as (select document, document_date, position, schedule_line, material, purchase_type, supplier, plant, currency,
      release_state, price_unit, planner, delivery_date, material_group, cast(coalesce(sum(q), 0) as double) as q,
      cast(coalesce(sum(price), 0) as double) as v, cast(coalesce(max(price), 0) as double) as p from f group by all),
    ind as (select g.*, unit, case unit when 'PIECES' then q else v end as quantity, p as price,
      case unit when 'PIECES' then 0.0 else 18.5 end::double as rate,
      strftime(delivery_date, '%Y-%m') as month from g, (values ('PIECES'), ('AMOUNT')) u(unit)),
    full_ind as (select ind.* exclude (q, v, p), case when currency = 'MXN' then quantity else quantity * rate end as local_amount,
      s_name as supplier_name, n_name as country, r_name as region from ind left join supplier on s_suppkey = supplier
      left join nation on n_nationkey = s_nationkey left join region on r_regionkey = n_regionkey)"""


@query("biz_po_indicators", f"{INDICATORS} select * from full_ind")
def biz_po_indicators(spark, sf_dir):
    return po_indicators(*_po_inputs(spark, sf_dir), ids=["material_group"])


def _views(spark, sf_dir):
    indicators = po_indicators(*_po_inputs(spark, sf_dir), ids=["material_group"])
    catalogue = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("material_id"), F.lit("1-URGENT").alias("plant"),
        F.col("p_name").alias("material_text"),
    )
    deny = table(spark, sf_dir, "orders").filter("o_totalprice < 1000").select(F.col("o_orderkey").alias("document"))
    return order_views(indicators, catalogue, deny=deny)


@query(
    "biz_order_lines",
    f"""{INDICATORS} select document, position, schedule_line, document_date, plant, delivery_date, quantity, price, rate,
    unit, local_amount, month as entry_month, strftime(document_date, '%Y-%m') as document_month from full_ind""",
)
def biz_order_lines(spark, sf_dir):
    return _views(spark, sf_dir)[0]


@query(
    "biz_order_views",
    f"""{INDICATORS}, s as (select *, regexp_replace(material, '^0+(.)', '\\1') as m from full_ind),
    t as (select * replace (case when m is not null and not regexp_matches(m, '\\S') then 'SERVICE' else purchase_type end as purchase_type,
      case when m is null or not regexp_matches(m, '\\S') then 'SERVICE' else m end as material) from s),
    u as (select *, case when purchase_type = 'SERVICE' then concat(material, '-', material_group) else material end as material_id,
      strftime(document_date, '%Y-%m') as document_month from t),
    v as (select supplier, document, document_date, delivery_date, position, price_unit, currency, release_state, plant, planner,
      material_group, purchase_type, document_month, max(material) as material, max(material_id) as material_id, round(max(price), 2) as price
      from u where document not in (select o_orderkey from orders where o_totalprice < 1000) group by all)
    select * replace (regexp_replace(supplier::varchar, '^0+(.)', '\\1') as supplier), p_name as material_text from v
    left join (select p_partkey::varchar as pk, p_name from part) on pk = material_id and plant = '1-URGENT'
    qualify row_number() over (partition by document, position, material, material_id order by delivery_date desc nulls last, price desc) = 1""".replace(
        "select * replace (regexp_replace(supplier", "select v.* replace (regexp_replace(supplier"
    ),
)
def biz_order_views(spark, sf_dir):
    return _views(spark, sf_dir)[1].withColumn("price", F.round("price", 2))


@query(
    "biz_requisitions",
    f"""with live as (select * from {LATEST} where l_linestatus = 'O' and l_returnflag <> 'R'),
    n as (select l_orderkey, l_linenumber, count(*) as n from lineitem where l_suppkey % 2 = 0 group by 1, 2),
    j as (select l_orderkey as requisition, l_linenumber as position, l_partkey::varchar as material,
      regexp_replace(l_suppkey::varchar, '^0+(.)', '\\1') as supplier, 'PC' as unit_of_measure, s_name as planner,
      strftime(l_shipdate, '%Y-%m') as month, coalesce(n, 1) as k, cast(l_quantity as decimal(18,2)) as q,
      cast(l_extendedprice as decimal(18,2)) as v, cast(l_tax as decimal(18,2)) as p
      from live left join supplier on s_suppkey = l_suppkey and s_suppkey % 3 = l_suppkey % 2
      left join n using (l_orderkey, l_linenumber))
    select requisition, position, material, supplier, unit_of_measure, planner, month, 'PIECES' as unit,
      cast(q * k as double) as ordered, cast(null as double) as price, cast((q + 1) * k as double) as requested from j
    union all select requisition, position, material, supplier, unit_of_measure, planner, month, 'AMOUNT',
      cast(v * k as double), cast(p * k as double), null from j""",
)
def biz_requisitions(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    req = lines.select(
        F.col("l_orderkey").alias("requisition"), F.col("l_linenumber").alias("position"),
        F.when(F.col("l_linestatus") == "O", "5").otherwise("2").alias("status"),
        F.when(F.col("l_returnflag") == "R", "X").when(F.col("l_returnflag") == "A", "").alias("deleted"),
        F.concat(F.lit("A"), (F.col("l_suppkey") % 2).cast("string")).alias("plant"),
        F.col("l_suppkey").alias("planner_code"), F.lit("ST").alias("unit_of_measure"),
        pad_key("l_suppkey").alias("supplier"), F.concat(F.lit("00"), F.col("l_partkey").cast("string")).alias("material"),
        money("l_quantity").alias("ordered_qty"), money("l_extendedprice").alias("release_value"),
        money("l_tax").alias("valuation_price"), (money("l_quantity") + 1).alias("requested_qty"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), *LINE_ORDER,
    )
    assign = lines.filter("l_suppkey % 2 = 0").select(
        F.col("l_orderkey").alias("requisition"), F.col("l_linenumber").alias("position")
    )
    planner = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("planner_code"),
        F.concat(F.lit("A"), (F.col("s_suppkey") % 3).cast("string")).alias("plant"), F.col("s_name").alias("planner"),
    )
    out = requisitions(req, assign, planner, ids=["month"], loaded=LINE_ORDER)
    # Item 0 is all zeros and would be stripped to nothing.
    return out.withColumn("material", F.when(F.col("material") == "", "0").otherwise(F.col("material")))


def _info(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumns(
        {
            "record": F.concat_ws("-", "l_partkey", "l_suppkey"),
            "valid_from": F.to_date("l_shipdate"),
            "condition_no": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        }
    )
    s = table(spark, sf_dir, "supplier")
    home = s.join(table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
    info = lines.select("record", "l_suppkey", F.col("l_partkey").alias("material")).distinct().join(
        home.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("country"), F.col("n_regionkey").alias("region")),
        "l_suppkey",
    ).withColumnRenamed("l_suppkey", "supplier")
    org = lines.groupBy("record", F.col("l_returnflag").alias("plant")).agg(
        F.max("l_extendedprice").alias("net_price"), F.min("l_extendedprice").alias("effective_price")
    ).withColumns({"purchasing_org": F.lit("P1"), "record_type": F.lit("0"), "currency": F.lit("USD")})
    material = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("material"), F.col("p_brand").alias("material_group"))
    index = lines.select(
        F.col("l_suppkey").alias("supplier"), F.col("l_partkey").alias("material"), F.lit("P1").alias("purchasing_org"),
        F.lit("0").alias("record_type"), F.col("l_returnflag").alias("plant"), "valid_from", "condition_no",
        F.when(F.col("l_linestatus") == "O", F.lit(date(9999, 12, 31))).otherwise(F.col("valid_from")).alias("valid_to"),
    ).distinct()
    rows = [
        ("PB00", F.lit("USD"), F.col("l_extendedprice"), F.lit(True)),
        ("FRA1", F.lit("%"), F.col("l_discount"), F.col("l_linenumber") <= 3),
        ("ZARA", F.lit("%"), F.col("l_tax"), F.col("l_linenumber") == 2),
    ]
    cells = [
        F.when(cond, F.struct(F.lit(c).alias("class"), unit.alias("unit"), value.alias("value"))) for c, unit, value, cond in rows
    ]
    amounts = lines.select("condition_no", F.inline(F.filter(F.array(*cells), lambda r: r.isNotNull())))
    names = s.select(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("supplier_name"))
    geo = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey").join(
        table(spark, sf_dir, "region"), "r_regionkey"
    ).select(
        F.col("n_nationkey").alias("country"), F.col("r_regionkey").alias("region"),
        F.col("n_name").alias("country_name"), F.col("r_name").alias("region_name"),
    )
    return info_records(info, org, material, index, amounts, names, geo)


FOUND = """with l as (select *, concat(l_partkey, '-', l_suppkey) as record, cast(l_shipdate as date) as vf,
      concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as cno from lineitem),
    org as (select record, l_returnflag as plant, max(l_extendedprice) as net_price, min(l_extendedprice) as effective_price from l group by 1, 2),
    info as (select distinct record, l_suppkey as supplier, l_partkey as material from l),
    idx as (select distinct record, l_returnflag as plant, vf as valid_from, cno as condition_no from l where l_linestatus = 'O'),
    found as (select info.*, org.plant, 'P1' as purchasing_org, '0' as record_type, net_price, effective_price, 'USD' as currency,
      p_brand as material_group, s_nationkey as country, n_regionkey as region, s_name as supplier_name, n_name as country_name,
      r_name as region_name, idx.valid_from, idx.condition_no from info join org using (record) join part on p_partkey = material
      join supplier on s_suppkey = supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
      left join idx on idx.record = info.record and idx.plant = org.plant)"""


@query(
    "biz_info_records",
    f"""{FOUND} select distinct record, supplier, material, purchasing_org, plant, country, region, net_price, effective_price,
    currency, material_group, valid_from, supplier_name, country_name, region_name from (
      select *, max(valid_from) over (partition by record) as newest from found) where valid_from = newest""",
)
def biz_info_records(spark, sf_dir):
    return _info(spark, sf_dir)[0]


@query(
    "biz_info_conditions",
    f"""{FOUND}, am as (select cno, l_linenumber, l_extendedprice as pb, case when l_linenumber <= 3 then l_discount end as fr,
      case when l_linenumber = 2 then l_tax end as za from l)
    select condition_no, record, supplier, plant, valid_from, 'USD' as condition_currency, min(pb) as "PRECIO_BASE", min(fr) as "FLETE", min(za) as "ZARA"
    from (select distinct condition_no, record, supplier, plant, valid_from from found) join am on cno = condition_no
    group by 1, 2, 3, 4, 5 having count(fr) > 0""",
)
def biz_info_conditions(spark, sf_dir):
    return _info(spark, sf_dir)[1].select(
        "condition_no", "record", "supplier", "plant", "valid_from", "condition_currency", "PRECIO_BASE", "FLETE", "ZARA"
    )


@query(
    "biz_goods_receipts",
    f"""with s as (select l_orderkey as document, l_linenumber as position, l_linestatus as plant, cast(l_shipdate as date) as posting_date,
      cast(sum(case when l_returnflag = 'R' then -1 else 1 end * cast(l_quantity as decimal(18,2))) as double) as q,
      cast(sum(case when l_returnflag = 'R' then -1 else 1 end * cast(l_extendedprice as decimal(18,2))) as double) as v
      from {LATEST} where l_returnflag <> 'N' or l_linestatus = 'O' group by 1, 2, 3, 4)
    select document, position, plant, posting_date, unit, case unit when 'PIECES' then q else v end as receipts,
    case unit when 'AMOUNT' then q end as supplier_qty, v / nullif(q, 0) as receipt_price, strftime(posting_date, '%Y-%m') as month
    from s, (values ('PIECES'), ('AMOUNT')) u(unit)""",
)
def biz_goods_receipts(spark, sf_dir):
    other = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    movement = F.when(other, 261).when(F.col("l_returnflag") == "R", 102).otherwise(101)
    mov = _lines(spark, sf_dir).select(
        *LINE_KEY, *LINE_ORDER, F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"),
        F.col("l_linestatus").alias("plant"), movement.alias("movement"), F.to_date("l_shipdate").alias("posting_date"),
        money("l_quantity").alias("quantity"), money("l_extendedprice").alias("local_value"),
    )
    return goods_receipts(mov, keys=LINE_KEY, loaded=LINE_ORDER)


def _plan(spark, sf_dir, snapshot):
    header = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("document"))
    item = _latest_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"),
        F.concat(F.lit("00"), (F.col("l_partkey") + 1).cast("string")).alias("material"),
        F.when(F.col("l_returnflag") == "R", "L").when(F.col("l_returnflag") == "N", " ").alias("deleted"),
        F.when(F.col("l_linestatus") == "F", "X").otherwise(" ").alias("complete"),
    )
    load = F.when(F.col("l_linenumber") % 3 == 0, F.lit(date(1998, 5, 20))).when(
        F.col("l_linenumber") % 3 == 1, F.lit(date(1998, 6, 1))
    ).otherwise(F.lit(date(1998, 6, 3)))
    delivered = F.when(F.col("l_returnflag") == "A", money("l_quantity") + 5).when(F.col("l_returnflag") == "N", money("l_tax"))
    schedule = _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("schedule_line"), F.to_date("l_shipdate").alias("delivery_date"),
        money("l_quantity").alias("scheduled_qty"), delivered.alias("delivered_qty"), load.alias("loaded_at"),
    )
    return delivery_plan(header, item, schedule, AS_OF, snapshot).withColumn("quantity", number("quantity"))


PLAN = """with rows_ as (select distinct l_orderkey as document, l_linenumber as position, l_partkey,
      cast(l_shipdate as date) as day, cast(l_quantity as decimal(18,2)) as o, coalesce(case l_returnflag when 'A' then cast(l_quantity as decimal(18,2)) + 5
      when 'N' then cast(l_tax as decimal(18,2)) end, 0) as d from lineitem where l_linenumber % 3 = {load}),
    due as (select document, position, case when day <= date '{cutoff}' then '1998-06' else strftime(day, '%Y-%m') end as month,
      sum({net}) as q from rows_ group by 1, 2, 3),
    live as (select distinct l_orderkey as document, l_linenumber as position, cast(l_partkey + 1 as varchar) as item
      from {latest} where l_returnflag <> 'R' and l_linestatus <> 'F')
    select due.month, live.item, cast(sum(due.q) as double) as quantity, 'PIECES' as concept
    from (select o_orderkey as document from orders where o_orderstatus <> 'P') h left join live using (document)
    left join due on due.document = live.document and due.position = live.position group by 1, 2"""


@query(
    "biz_delivery_plan",
    PLAN.format(load=1, cutoff="1998-06-30", net="greatest(case when o > 0 then o - d else o end, 0)", latest=LATEST),
)
def biz_delivery_plan(spark, sf_dir):
    return _plan(spark, sf_dir, "first")


@query(
    "biz_delivery_plan_current",
    PLAN.format(load=2, cutoff="1998-06-14", net="case when o > 0 then o - d else o end", latest=LATEST),
)
def biz_delivery_plan_current(spark, sf_dir):
    return _plan(spark, sf_dir, "last")
