"""Planning inputs, spine and stock projection."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, table
from fixtures.joins import LINE_ORDER, LINE_ORDER_SQL
from millrace.functions import month_start
from millrace.operators.joins import cross_spine
from millrace.operators.reshape import months_from
from millrace.plans.planning import (
    budget,
    demand_prices,
    fiscal_prices,
    forecast_vintages,
    main_supplier,
    planning_items,
    planning_spine,
    receipts_for_planning,
    stock_by_group,
    stock_positions,
    unconstrained_demand,
    yearly_targets,
)
from millrace.plans.projection import (
    PROJECTED,
    finish_projection,
    merge_projections,
    project_stock,
    value_projection,
)

MONTH = "date_trunc('month', l_shipdate)::date"
ORDER = [*LINE_ORDER, "l_orderkey", "l_linenumber"]
ORDER_SQL = f"{LINE_ORDER_SQL}, l_orderkey desc, l_linenumber desc"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumns(
        {"item": F.col("l_partkey"), "month": month_start("l_shipdate")}
    )


def _ownership():
    return F.when(F.col("l_returnflag") == "R", "CONSIGNED").otherwise("OWN")


def _stock(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    rows = lines.select("item", "month", _ownership().alias("ownership"), money("l_quantity").alias("units"), money("l_extendedprice").alias("value"))
    opening = rows.groupBy("item", "month", "ownership").agg(F.sum("units").alias("units"), F.sum("value").alias("value"))
    valuation = lines.filter("l_linestatus = 'O'").select(
        F.concat(F.lit("00"), (F.col("l_partkey") + 1).cast("string")).alias("item"),
        F.when(F.col("l_linenumber") == 7, 0.0).otherwise(F.col("l_extendedprice")).alias("fiscal_price"), *ORDER,
    )
    fiscal = fiscal_prices(valuation, ORDER).withColumn("item", F.col("item").cast("bigint") - 1)
    return opening, rows, fiscal


STOCK = f"""with fp as (select l_partkey as item, {MONTH} as month, l_extendedprice as price from lineitem where l_linestatus = 'O' and l_linenumber <> 7
      qualify row_number() over (partition by l_partkey, {MONTH} order by {ORDER_SQL}) = 1),
    lowest as (select item, min(price) as low from fp group by 1),
    op as (select l_partkey as item, {MONTH} as month, case l_returnflag when 'R' then 'CONSIGNED' else 'OWN' end as ownership,
      cast(sum(cast(l_quantity as decimal(18,2))) as double) as units, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as value from lineitem group by 1, 2, 3),
    c as (select op.*, case ownership when 'OWN' then value / units else coalesce(fp.price, low) end as unit_cost from op
      left join fp using (item, month) left join lowest using (item))"""


@query(
    "biz_stock_positions",
    f"""{STOCK}, e as (select item, month, sum(units) as units, sum(units * unit_cost) as amount from c group by 1, 2),
    o as (select distinct item, month, 'PIECES' as concept, units as stock from c
      union all select distinct item, month, 'AMOUNT', units * unit_cost from c)
    select *, cast(null as double) as stock_closing from o union all select item, month, 'PIECES', null, units from e
    union all select item, month, 'AMOUNT', null, amount from e""",
)
def biz_stock_positions(spark, sf_dir):
    opening, closing = stock_positions(*_stock(spark, sf_dir))
    return opening.unionByName(closing, allowMissingColumns=True)


@query(
    "biz_stock_positions_closing",
    f"""{STOCK}, e as (select item, month, sum(units) as units, sum(units * unit_cost) as amount from c group by 1, 2)
    select item, month, 'PIECES' as concept, units as stock_closing from e union all select item, month, 'AMOUNT', amount from e""",
)
def biz_stock_positions_closing(spark, sf_dir):
    return stock_positions(*_stock(spark, sf_dir))[1]


def _vintages(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = _lines(spark, sf_dir).join(o, "l_orderkey")
    kind = F.when(F.col("l_linestatus") == "F", "U_PRONO").otherwise("IMP_PRONO")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    unique = F.concat_ws("-", day, F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), "l_linenumber", "l_suppkey",
                         F.col("l_quantity").cast("int"), F.date_format("l_shipdate", "yyyyMMdd"))
    target = F.date_format("l_shipdate", "yyyy-MM")
    plan = lines.filter("l_suppkey % 2 = 0").select("item", target.alias("target"), kind.alias("kind"), money("l_quantity").alias("value"), unique.alias("version"))
    memo = lines.filter("l_suppkey % 2 = 1").select(
        "item", target.alias("target"), kind.alias("kind"), money("l_quantity").alias("value"), day.alias("version"),
        F.col("l_returnflag").alias("segment"),
    )
    return forecast_vintages(plan, memo)


VINTAGES = f"""with l as (select l_partkey as item, {MONTH} as target, case l_linestatus when 'F' then 'PIECES' else 'AMOUNT' end as concept,
      cast(l_quantity as decimal(18,2)) as q, cast(o_orderdate as date) as day, date_trunc('month', o_orderdate)::date as vintage, l_returnflag as segment, l_suppkey,
      concat_ws('-', strftime(o_orderdate, '%Y-%m-%d'), lpad(l_orderkey::varchar, 9, '0'), l_linenumber, l_suppkey, l_quantity::int, strftime(l_shipdate, '%Y%m%d')) as version
      from lineitem join orders on o_orderkey = l_orderkey),
    p as (select item, vintage, target, concept, q from l where l_suppkey % 2 = 0
      qualify row_number() over (partition by item, target, concept order by version desc) = 1),
    ms as (select item, segment, concept, vintage, target, day, sum(q) as q from l where l_suppkey % 2 = 1 group by all),
    m as (select item, vintage, target, concept, q from ms
      qualify row_number() over (partition by item, vintage, target, concept order by day desc, segment desc) = 1),
    t as (select item, vintage, target, concept, cast(sum(q) as double) * case concept when 'AMOUNT' then 1000 else 1 end as value
      from (select * from p union all select * from m) where target >= vintage group by 1, 2, 3, 4),
    v as (select item, target, concept, value, vintage from t where month(vintage) <> 12
      union all select item, target, concept, value, (vintage + interval 1 month)::date from t where month(vintage) = 11 and month(target) <> 11),
    d as (select item, target as month, concept, value as demand from v where vintage < date '1998-06-01'
      qualify row_number() over (partition by item, target, concept order by vintage desc) = 1)"""


@query("biz_forecast_vintages", f"{VINTAGES} select * from v")
def biz_forecast_vintages(spark, sf_dir):
    return _vintages(spark, sf_dir)


@query("biz_unconstrained_demand", f"{VINTAGES} select * from d")
def biz_unconstrained_demand(spark, sf_dir):
    return unconstrained_demand(_vintages(spark, sf_dir), AS_OF)


@query(
    "biz_demand_prices",
    f"""{VINTAGES}, mm as (select item, month, sum(demand) filter (concept = 'PIECES') as p, sum(demand) filter (concept = 'AMOUNT') as a from d group by 1, 2),
    y as (select item, year(month) as y, sum(p) as yp, sum(a) as ya from mm group by 1, 2)
    select mm.item, month, a / nullif(p, 0) as monthly_price, ya / nullif(yp, 0) as annual_price from mm join y on y.item = mm.item and y.y = year(month)""",
)
def biz_demand_prices(spark, sf_dir):
    return demand_prices(unconstrained_demand(_vintages(spark, sf_dir), AS_OF))


@query(
    "biz_yearly_targets",
    """select (p_partkey + 1)::varchar as item, m::date as month, concept, case when concept = 'PIECES' then p_size + (year(m) - 1997)
    else p_retailprice end::double as target_stock from part, generate_series(timestamp '1997-01-01', timestamp '1998-12-01', interval 1 month) t(m),
    (values ('PIECES'), ('AMOUNT')) c(concept)""",
)
def biz_yearly_targets(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(
        F.concat(F.lit("0"), (F.col("p_partkey") + 1).cast("string")).alias("item"), F.col("p_size").alias("t97"),
        (F.col("p_size") + 1).alias("t98"), F.col("p_retailprice").alias("v"),
    )
    return yearly_targets(items, {1997: {"PIECES": "t97", "AMOUNT": "v"}, 1998: {"PIECES": "t98", "AMOUNT": "v"}})


@query(
    "biz_stock_by_group",
    f"""with k as (select l_partkey as item, {MONTH} as month, max(l_extendedprice) as cost from lineitem where l_linenumber > 1 group by 1, 2),
    r as (select l_partkey as item, {MONTH} as month, l_returnflag as w, l_linestatus as st, l_suppkey % 2 = 0 as consigned,
      case when l_linenumber % 2 = 0 then 'PIECES' else 'AMOUNT' end as concept, l_quantity as s from lineitem),
    e as (select item, month, w, st, concept, s from r where concept = 'PIECES' or not consigned
      union all select r.item, r.month, w, st, 'AMOUNT', s * cost from r left join k using (item, month) where concept = 'PIECES' and consigned)
    select item, month, concept, round(sum(s) filter (w = 'A' and st = 'O'), 2) as main, round(sum(s) filter (w in ('N', 'R') and st = 'O'), 2) as others,
    round(sum(s) filter (w = 'R'), 2) as returns from e group by 1, 2, 3""",
)
def biz_stock_by_group(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    costs = lines.filter("l_linenumber > 1").groupBy("item", "month").agg(F.max("l_extendedprice").alias("unit_cost"))
    rows = lines.select(
        "item", "month", F.col("l_returnflag").alias("warehouse"), F.col("l_linestatus").alias("status"),
        F.when(F.col("l_suppkey") % 2 == 0, "CONSIGNED").otherwise("OWN").alias("ownership"),
        F.when(F.col("l_linenumber") % 2 == 0, "PIECES").otherwise("AMOUNT").alias("concept"), F.col("l_quantity").alias("stock"),
    )
    groups = {"main": ["A"], "others": ["N", "R"], "returns": ["R"]}
    out = stock_by_group(rows, costs, groups, statuses=["O"], any_status=["returns"])
    return out.withColumns({g: F.round(g, 2) for g in groups})


@query(
    "biz_budget",
    """select case when o_orderpriority = '5-LOW' then o_custkey::varchar else concat('C', o_custkey) end as item, date_trunc('month', o_orderdate)::date as month,
    o_orderstatus as concept, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as budget from orders
    where year(o_orderdate) not in (1996, 2000) group by 1, 2, 3""",
)
def biz_budget(spark, sf_dir):
    new = F.col("o_orderpriority") == "5-LOW"
    customer = F.col("o_custkey").cast("string")
    rows = table(spark, sf_dir, "orders").select(
        F.when(new, "New product").otherwise(F.concat(F.lit("C"), customer)).alias("item"),
        F.concat(customer, F.lit("-MI")).alias("product_key"), month_start("o_orderdate").alias("month"),
        F.col("o_orderstatus").alias("concept"), money("o_totalprice").alias("budget"),
    )
    return budget(rows, [1996, 2000], marker="New").withColumn("budget", number("budget"))


def _receipts(spark, sf_dir):
    movement = F.when(F.col("l_returnflag") == "R", 102).when(F.col("l_returnflag") == "N", 311).otherwise(101)
    lines = _lines(spark, sf_dir)
    mov = lines.select(
        *ORDER, F.concat(F.lit("00"), (F.col("l_partkey") + 1).cast("string")).alias("material"),
        F.when(F.col("l_suppkey") % 10 == 0, "B").otherwise("A").alias("plant"),
        F.when(F.col("l_suppkey") % 10 > 7, "X").when(F.col("l_suppkey") % 10 > 2, "M").alias("warehouse"),
        movement.alias("movement"), F.to_date("l_shipdate").alias("entry_date"), money("l_quantity").alias("quantity"),
    )
    costs = lines.filter("l_linenumber > 2").groupBy((F.col("item") + 1).cast("string").alias("item"), "month").agg(
        F.max("l_extendedprice").alias("unit_cost")
    )
    return receipts_for_planning(mov, costs, "A", excluded_warehouses=["X"], keys=["l_orderkey", "l_linenumber"], loaded=ORDER)


RECEIPTS = f"""r as (select (l_partkey + 1)::varchar as item, {MONTH} as month, cast(sum(case l_returnflag when 'R' then -1 else 1 end * cast(l_quantity as decimal(18,2))) as double) as q
      from (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) = 1)
      where l_suppkey % 10 between 1 and 7 group by 1, 2),
    rk as (select (l_partkey + 1)::varchar as item, {MONTH} as month, max(l_extendedprice) as cost from lineitem where l_linenumber > 2 group by 1, 2),
    rec as (select item, month, 'PIECES' as concept, q as receipts from r union all select r.item, r.month, 'AMOUNT', q * cost from r left join rk using (item, month))"""


@query("biz_receipts_for_planning", f"with {RECEIPTS} select * from rec")
def biz_receipts_for_planning(spark, sf_dir):
    return _receipts(spark, sf_dir)


def _supplier(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("supplier_name"),
        F.col("s_nationkey").cast("string").alias("country_name"), F.lit("R").alias("region_name"),
    )
    records = _lines(spark, sf_dir).join(s, "l_suppkey").select(
        F.concat(F.lit("00"), (F.col("l_partkey") + 1).cast("string")).alias("material"), F.col("l_linestatus").alias("plant"),
        F.col("l_suppkey").alias("supplier"), "supplier_name", "country_name", "region_name",
    )
    return main_supplier(records, "O")


SUPPLIER = """sup as (select (l_partkey + 1)::varchar as item, max(l_suppkey) as supplier from lineitem where l_linestatus = 'O' group by 1)"""


@query(
    "biz_main_supplier",
    f"""with {SUPPLIER} select item, supplier, s_name as supplier_name, s_nationkey::varchar as country_name, 'R' as region_name
    from sup join supplier on s_suppkey = supplier""",
)
def biz_main_supplier(spark, sf_dir):
    return _supplier(spark, sf_dir)


@query(
    "biz_planning_spine",
    f"""with {RECEIPTS}, {SUPPLIER}, items as (select (p_partkey + 1)::varchar as item, p_size as max_stock from part where p_type <> 'PROMO'
      union all select (p_partkey + 1)::varchar, null from part where p_type = 'PROMO'),
    ordered as (select (l_partkey + 1)::varchar as item, {MONTH} as month, cast(sum(cast(l_quantity as decimal(18,2))) as double) as ordered from lineitem group by 1, 2),
    targets as (select (p_partkey + 1)::varchar as item, p_size * 2 as t from part where p_brand = 'Brand#3')
    select items.item, max_stock, m::date as month, c.concept, ordered, receipts, supplier,
    cast(coalesce(case when year(m) = 1998 and c.concept = 'PIECES' then t end, max_stock) as double) as target_stock
    from items, generate_series(timestamp '1998-01-01', timestamp '1999-02-01', interval 1 month) s(m), (values ('PIECES'), ('AMOUNT')) c(concept)
    left join ordered on ordered.item = items.item and ordered.month = m left join rec on rec.item = items.item and rec.month = m and rec.concept = c.concept
    left join sup on sup.item = items.item left join targets on targets.item = items.item""",
)
def biz_planning_spine(spark, sf_dir):
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") + 1).cast("string").alias("item"), "p_size", "p_type", "p_brand")
    listed = p.filter("p_type <> 'PROMO'").select("item", F.col("p_size").alias("max_stock"))
    items = planning_items(listed, p.select("item"))
    ordered = _lines(spark, sf_dir).groupBy((F.col("item") + 1).cast("string").alias("item"), "month").agg(
        number(F.sum(money("l_quantity"))).alias("ordered")
    )
    aims = p.filter("p_brand = 'Brand#3'").select("item", (F.col("p_size") * 2).alias("t"))
    targets = yearly_targets(aims, {1998: {"PIECES": "t"}})
    measures = [
        (ordered, ["item", "month"]),
        (_receipts(spark, sf_dir), ["item", "month", "concept"]),
        (targets, ["item", "month", "concept"]),
        (_supplier(spark, sf_dir).select("item", "supplier"), ["item"]),
    ]
    return planning_spine(items, months_from(date(1998, 1, 1), 14), measures)


def _grid(spark, sf_dir):
    """Item and month grid with planned, demanded and owed quantities of the coming months."""
    lines = _lines(spark, sf_dir)
    months = months_from(AS_OF, 6)
    q = money("l_quantity")
    flows = lines.groupBy("item", "month").agg(
        number(F.sum(F.when(F.col("l_returnflag") == "A", q))).alias("planned_qty"),
        number(F.sum(F.when(F.col("l_returnflag") != "A", q))).alias("demand"),
        number(F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), q))).alias("backlog"),
        number(F.sum(F.when(F.col("l_linestatus") == "F", q))).alias("sales"),
    )
    held = lines.filter(F.col("month") == F.lit(date(1998, 5, 1))).groupBy("item").agg(number(F.sum(q)).alias("held"))
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("stock_price"), (F.col("p_size") * 20.0).alias("unit_cost"),
        (F.col("p_size") * 8.0).alias("demand_price"), (F.col("p_size") * 4.0).alias("backlog_price"),
    )
    grid = cross_spine(items, months).join(flows, ["item", "month"], "left").join(held, "item", "left")
    return grid.withColumn("stock", F.when(F.col("month") == F.lit(date(1998, 6, 1)), F.col("held"))).drop("held")


GRID = f"""f as (select l_partkey as item, {MONTH} as month, sum(l_quantity) filter (l_returnflag = 'A') as a, sum(l_quantity) filter (l_returnflag <> 'A') as dm,
      sum(l_quantity) filter (l_returnflag = 'R' and l_linestatus = 'O') as b, sum(l_quantity) filter (l_linestatus = 'F') as sl from lineitem group by 1, 2),
    h as (select l_partkey as item, sum(l_quantity) as held from lineitem where {MONTH} = date '1998-05-01' group by 1),
    g as (select p_partkey as item, m::date as month, datediff('month', date '1998-06-01', m::date) as step, coalesce(a, 0)::double as planned_qty, coalesce(dm, 0)::double as demand,
      coalesce(b, 0)::double as backlog, coalesce(sl, 0)::double as sales, case when m = timestamp '1998-06-01' then coalesce(held, 0) else 0 end::double as stock,
      p_retailprice as stock_price, p_size * 20.0::double as unit_cost, p_size * 8.0::double as demand_price, p_size * 4.0::double as backlog_price
      from part, generate_series(timestamp '1998-06-01', timestamp '1998-11-01', interval 1 month) t(m)
      left join f on f.item = p_partkey and f.month = m left join h on h.item = p_partkey),
    r0 as (select *, planned_qty + stock - demand - backlog{{sales}} as final, 0::double as op, 0::double as pb from g where step = 0),"""
# The recurrence spelled out month by month, to check the running sum against it.
STEPS = GRID + ",".join(
    f"""r{i} as (select g.*, g.planned_qty + greatest(p.final, 0) - g.demand - greatest(-p.final, 0) as final, greatest(p.final, 0) as op, greatest(-p.final, 0) as pb
      from g join r{i - 1} p on p.item = g.item where g.step = {i})"""
    for i in (1, 2, 3)
) + """, u as (select * from r0 union all select * from r1 union all select * from r2 union all select * from r3),
    w as (select *, case when step = 0 then stock else op end + planned_qty as have, case when step = 0 then backlog else pb end as owed,
      case when step = 0 then backlog else greatest(-final, 0) end as own from u),
    pr as materialized (select item, month, stock_price, unit_cost, demand_price, backlog_price, planned_qty, demand, backlog, sales, stock, final as final_stock, greatest(final, 0) as end_stock,
      greatest(-final, 0) as estimated_backlog, op as opening_stock, pb as prior_backlog, case when own = 0 then 0 when have > owed then own else have end as recovered_backlog,
      case when have - owed > demand then demand when have - owed < 0 then 0 else have - owed end as covered_demand from w
      union all select item, month, stock_price, unit_cost, demand_price, backlog_price, planned_qty, demand, backlog, sales, stock, 0, 0, 0, 0, 0, 0, 0 from g where step > 3)"""


def _projection_columns(df):
    return df.withColumns({c: number(c) for c in PROJECTED})


@query("biz_project_stock", f"with {STEPS.format(sales='')} select * from pr")
def biz_project_stock(spark, sf_dir):
    grid = _grid(spark, sf_dir).na.fill(0, ["sales"])
    return _projection_columns(project_stock(grid, AS_OF))


@query("biz_project_stock_daily", f"with {STEPS.format(sales=' - sales')} select * from pr")
def biz_project_stock_daily(spark, sf_dir):
    return _projection_columns(project_stock(_grid(spark, sf_dir), AS_OF, deduct_sales=True))


def _valued(spark, sf_dir):
    projection = project_stock(_grid(spark, sf_dir).na.fill(0, ["sales"]), AS_OF)
    at_stock = ["planned_qty", "stock", "final_stock", "end_stock", "opening_stock"]
    out = value_projection(projection, at_stock, ["estimated_backlog", "covered_demand"], ["recovered_backlog"])
    return out.drop("stock_price", "unit_cost", "demand_price", "backlog_price")


VALUED = """val as materialized (select item, month, concept, backlog, demand, sales, prior_backlog, greatest(stock_price, unit_cost) as max_price,
      planned_qty * k as planned_qty, stock * k as stock, final_stock * k as final_stock, end_stock * k as end_stock, opening_stock * k as opening_stock,
      estimated_backlog * d as estimated_backlog, covered_demand * d as covered_demand, recovered_backlog * b as recovered_backlog
      from (select pr.*, concept, case concept when 'PIECES' then 1 else greatest(stock_price, unit_cost) end as k,
        case concept when 'PIECES' then 1 else demand_price end as d, case concept when 'PIECES' then 1 else backlog_price end as b
        from pr, (values ('PIECES'), ('AMOUNT')) c(concept)))"""


@query("biz_value_projection", f"with {STEPS.format(sales='')}, {VALUED} select * from val")
def biz_value_projection(spark, sf_dir):
    out = _valued(spark, sf_dir)
    return out.withColumn("prior_backlog", number("prior_backlog"))


def _history(spark, sf_dir):
    """Last run: every shipped month, before and after the current one."""
    return _lines(spark, sf_dir).groupBy("item", "month").agg(
        number(F.sum(money("l_quantity"))).alias("stock"), number(F.count("*")).alias("estimated_backlog"),
        number(F.max("l_quantity")).alias("opening_stock"),
    ).withColumn("concept", F.lit("PIECES"))


FINISH = f"""hist as (select l_partkey as item, {MONTH} as month, 'PIECES' as concept, sum(l_quantity)::double as stock, count(*)::double as estimated_backlog, max(l_quantity)::double as opening_stock
      from lineitem where l_shipdate < timestamp '1998-06-01' group by 1, 2),
    fin as materialized (select item, month, concept, case when month > date '1998-06-01' then 0 else stock end as stock,
      case when month <= date '1998-06-01' then case when month > date '1998-06-01' then 0 else stock end when month > date '1998-09-01' then 0 else opening_stock end as opening_stock,
      case when month >= date '1998-06-01' then 0.25 else 1 end * case when month > date '1998-09-01' then 0 else estimated_backlog end as estimated_backlog
      from (select item, month, concept, stock, estimated_backlog, opening_stock from hist union all by name select item, month, concept, stock, estimated_backlog, opening_stock from val))"""


def _finished(spark, sf_dir):
    columns = ["item", "month", "concept", "stock", "estimated_backlog", "opening_stock"]
    return finish_projection(
        _valued(spark, sf_dir).select(*columns), _history(spark, sf_dir).select(*columns), AS_OF, 3,
        actuals=["stock"], opening_from={"opening_stock": "stock"}, projected=["estimated_backlog", "opening_stock"],
    )


@query("biz_finish_projection", f"with {STEPS.format(sales='')}, {VALUED}, {FINISH} select * from fin")
def biz_finish_projection(spark, sf_dir):
    return _finished(spark, sf_dir)


@query(
    "biz_merge_projections",
    f"""with {STEPS.format(sales='')}, {VALUED}, {FINISH}, {RECEIPTS}
    select f.item, f.month, f.concept, f.opening_stock, case when f.month < date '1998-06-01' then 0 else d.planned_qty end as planned_qty, d.end_stock, receipts
    from fin f left join val d on d.item = f.item and d.month = f.month and d.concept = f.concept
    left join rec on rec.item = (f.item + 1)::varchar and rec.month = f.month and rec.concept = f.concept""",
)
def biz_merge_projections(spark, sf_dir):
    opening = _finished(spark, sf_dir).select("item", "month", "concept", "opening_stock")
    daily = _valued(spark, sf_dir).select("item", "month", "concept", "planned_qty", "end_stock")
    receipts = _receipts(spark, sf_dir).withColumn("item", F.col("item").cast("bigint") - 1)
    return merge_projections(opening, daily, opening, receipts, AS_OF, ["planned_qty"])
