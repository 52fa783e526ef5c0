"""Coverage, replenishment, alerts and classification of stock."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, round6, table
from fixtures.planning import MONTH, ORDER, ORDER_SQL, _lines
from fixtures.purchasing import INDICATORS, _po_inputs
from millrace.functions import month_start
from millrace.operators.reshape import with_amounts
from millrace.plans.inventory import (
    actual_demand,
    classify_stock,
    demand_models,
    forecast_stats,
    raw_material_stock,
    receipts_by_month,
    replenishment,
    stock_alerts,
    stock_coverage,
    storage_cost,
)
from millrace.plans.purchasing import po_indicators


def _forecast(spark, sf_dir):
    """Forecast rows: vintage = month of the order, target = month of the shipment."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), month_start("o_orderdate").alias("vintage"))
    return _lines(spark, sf_dir).join(o, "l_orderkey").select(
        "item", "vintage", F.col("month").alias("target"), F.col("l_linestatus"), F.col("l_quantity").alias("value"),
    )


FORECAST = f"""with fc as (select l_partkey as item, date_trunc('month', o_orderdate)::date as vintage, {MONTH} as target, l_linestatus, l_quantity as v
      from lineitem join orders on o_orderkey = l_orderkey)"""


@query(
    "biz_forecast_stats",
    f"""{FORECAST}, s as (select item, vintage, target, case l_linestatus when 'F' then 'PIECES' else 'AMOUNT' end as concept, sum(v) as v from fc where target >= vintage group by 1, 2, 3, 4
      qualify row_number() over (partition by item, vintage, concept order by target) <= 12)
    select item, concept, vintage, case concept when 'PIECES' then ceil(avg(v)) else round(avg(v), 6) end as mean_demand, round(stddev_samp(v), 6) as sd_demand from s group by 1, 2, 3""",
)
def biz_forecast_stats(spark, sf_dir):
    rows = _forecast(spark, sf_dir).withColumn("concept", F.when(F.col("l_linestatus") == "F", "PIECES").otherwise("AMOUNT"))
    out = forecast_stats(rows)
    return out.withColumns({"mean_demand": round6("mean_demand"), "sd_demand": round6("sd_demand")})


@query(
    "biz_demand_models",
    f"""{FORECAST}, k as (select item, vintage, count(*)::double as cost from fc where l_linestatus = 'O' group by 1, 2),
    p as (select item, vintage, target, sum(v) as v, 'SALES_PLAN' as model from fc where l_linestatus = 'F' and target >= vintage group by 1, 2, 3
      qualify row_number() over (partition by item, vintage order by target) <= 12),
    a as (select item, vintage, target, ceil(sum(v / 4)) as v, 'MODEL' as model from fc where l_linestatus = 'O' and target >= vintage group by 1, 2, 3
      qualify row_number() over (partition by item, vintage order by target) <= 12),
    b as (select u.*, cost from (select * from p union all select * from a) u left join k using (item, vintage)),
    c as (select item, vintage, target, model, 'PIECES' as concept, v as demand from b union all select item, vintage, target, model, 'AMOUNT', v * cost from b)
    select * from c where month(vintage) <> 12 or model = 'MODEL'
    union all select * replace ((vintage + interval 1 month)::date as vintage) from c where model = 'SALES_PLAN' and month(vintage) = 11 and month(target) <> 11""",
)
def biz_demand_models(spark, sf_dir):
    rows = _forecast(spark, sf_dir)
    plan, model = (rows.filter(F.col("l_linestatus") == s) for s in ("F", "O"))
    costs = model.groupBy("item", "vintage").agg(F.count("*").cast("double").alias("unit_cost"))
    quarter = model.withColumn("value", F.col("value") / 4)
    return demand_models(plan.drop("l_linestatus"), quarter.drop("l_linestatus"), costs)


@query(
    "biz_actual_demand",
    f"""with s as (select l_partkey as item, {MONTH} as month, sum(l_quantity) as p from lineitem where l_linestatus = 'F' group by 1, 2),
    k as (select l_partkey as item, {MONTH} as month, max(l_extendedprice) as cost from lineitem where l_linestatus = 'O' group by 1, 2)
    select item, month, 'PIECES' as concept, p as actual_demand from s union all select s.item, s.month, 'AMOUNT', p * cost from s left join k using (item, month)""",
)
def biz_actual_demand(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    billed = lines.filter("l_linestatus = 'F'").withColumn("billed_pieces", money("l_quantity"))
    costs = lines.filter("l_linestatus = 'O'").groupBy("item", "month").agg(F.max("l_extendedprice").alias("unit_cost"))
    return actual_demand(billed, costs)


@query(
    "biz_receipts_by_month",
    f"""{INDICATORS} select regexp_replace(material, '^0{{2,}}(.)', '\\1') as item, date_trunc('month', delivery_date)::date as month, unit as concept,
    cast(sum(cast(case unit when 'AMOUNT' then local_amount else quantity end::varchar as decimal(38,12))) as double) as due_qty
    from full_ind where plant = '1-URGENT' and date_trunc('month', delivery_date) <= date '1999-06-01' group by 1, 2, 3""",
)
def biz_receipts_by_month(spark, sf_dir):
    indicators = po_indicators(*_po_inputs(spark, sf_dir), ids=["material_group"])
    return receipts_by_month(indicators, "1-URGENT", AS_OF)


RENT = (3_000_000.0, 12_000_000.0, 15_000.0)


@query(
    "biz_storage_cost",
    """with i as (select p_partkey as item, p_brand as line, case when p_type in ('SMALL', 'PROMO') then p_size / 1000.0::double else 0.0::double end as volume,
      p_size::double as length, (p_size + 1)::double as width, (p_size + 2)::double as height from part),
    u as (select *, case when volume <> 0 then 1.56 / volume else floor(1.56 / ((1.0 * (length / 100)) * (width / 100) * (height / 100))) end as units from i),
    c as (select item, line, units as units_per_pallet, 1000.0 / units as storage_cost from u)
    select item, line, round(units_per_pallet, 6) as units_per_pallet, round(storage_cost, 6) as storage_cost, round(median(storage_cost) over (partition by line), 6) as line_storage_cost from c""",
)
def biz_storage_cost(spark, sf_dir):
    small = F.col("p_type").isin("SMALL", "PROMO")
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_brand").alias("line"),
        F.when(small, (F.col("p_size") / 1000).cast("string")).otherwise("0").alias("volume"),
        F.col("p_size").cast("string").alias("length"), (F.col("p_size") + 1).cast("string").alias("width"),
        (F.col("p_size") + 2).cast("string").alias("height"),
    )
    out = storage_cost(items, *RENT)
    return out.select("item", "line", *[round6(c).alias(c) for c in ("units_per_pallet", "storage_cost", "line_storage_cost")])


def _series(spark, sf_dir):
    """Twelve months per item and vintage, with stock, receipts, planned and actual demand."""
    rows = _forecast(spark, sf_dir)
    nothing = rows.drop("l_linestatus").filter(F.lit(False))
    costs = rows.select("item", "vintage", F.lit(2.0).alias("unit_cost")).distinct()
    plan = demand_models(rows.drop("l_linestatus"), nothing, costs)
    lines = _lines(spark, sf_dir)
    flows = lines.groupBy("item", "month").agg(
        number(F.sum(F.when(F.col("l_returnflag") == "A", money("l_quantity")))).alias("due_qty"),
        number(F.sum(F.when(F.col("l_returnflag") == "N", money("l_quantity")))).alias("actual_demand"),
        number(F.sum(money("l_quantity"))).alias("stock"),
    )
    pieces = plan.filter("concept = 'PIECES'").withColumnRenamed("target", "month")
    return pieces.join(flows, ["item", "month"], "left")


SERIES = f"""{FORECAST}, p as (select item, vintage, target, sum(v) as v from fc where target >= vintage group by 1, 2, 3
      qualify row_number() over (partition by item, vintage order by target) <= 12),
    v as (select item, vintage, target as month, v as demand from p where month(vintage) <> 12
      union all select item, (vintage + interval 1 month)::date, target, v from p where month(vintage) = 11 and month(target) <> 11),
    fl as (select l_partkey as item, {MONTH} as month, sum(l_quantity) filter (l_returnflag = 'A') as due, sum(l_quantity) filter (l_returnflag = 'N') as act,
      sum(l_quantity) as st from lineitem group by 1, 2),
    s as (select v.item, v.vintage, v.month, 'SALES_PLAN' as model, 'PIECES' as concept, coalesce(demand, 0) as demand, coalesce(due, 0)::double as due_qty, coalesce(act, 0)::double as actual_demand,
      case when v.month = v.vintage then coalesce(st, 0) else 0 end::double as stock, coalesce(lag(demand) over w, 0) as pd, coalesce(lag(act) over w, 0)::double as pa, avg(demand) over (partition by v.item, v.vintage) as mean
      from v left join fl on fl.item = v.item and fl.month = v.month window w as (partition by v.item, v.vintage order by v.month)),
    l as (select *, greatest(sum(case when stock <> 0 then stock else -pa end + due_qty) over w, 0) as rl, greatest(sum(case when stock <> 0 then stock else -pd end + due_qty) over w, 0) as level,
      greatest(sum(case when stock <> 0 then stock else -pd end) over w, 0) as nl from s window w as (partition by item, vintage order by month)),
    cov as (select item, vintage, month, model, concept, demand, due_qty, actual_demand, stock, level, nl as level_without_receipts, case when month > date '1998-06-01' then level else rl end as real_level,
      coalesce(level / nullif(mean, 0), 0) as coverage_months, coalesce(nl / nullif(mean, 0) * 4.345, 0) as survive_weeks from l)"""


@query(
    "biz_stock_coverage",
    f"{SERIES} select * replace (round(coverage_months, 6) as coverage_months, round(survive_weeks, 6) as survive_weeks) from cov",
)
def biz_stock_coverage(spark, sf_dir):
    out = stock_coverage(_series(spark, sf_dir), AS_OF)
    return out.withColumns({c: round6(c) for c in ("coverage_months", "survive_weeks")})


@query(
    "biz_replenishment",
    """with mo as (select l_partkey as item, date_trunc('month', l_shipdate) as m, ceil(sum(l_quantity)) as s from lineitem where l_linestatus = 'F' and year(l_shipdate) = 1997 group by 1, 2),
    us as (select item, avg(s) as d, var_samp(s) as vd from mo group by 1),
    rc as (select l_partkey as item, l_tax * 100 as cost, l_quantity as q, datediff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as days from lineitem join orders on o_orderkey = l_orderkey where l_returnflag = 'A'),
    st as (select item, median(cost / q) as c, var_samp(days / 30.0::double) as vl from rc group by 1),
    j as (select p_partkey as item, p_size::double as lt, case when p_type <> 'LARGE' then p_size * 2.0::double end as lot, p_retailprice / 10 as h, d, vd,
      case when c = 0 then 1 else c end as c, case when vl = 0 then 1 else vl end as vl from part left join us on us.item = p_partkey left join st on st.item = p_partkey),
    k as (select *, sqrt(2 * d * c / (h / 12)) as q, ceil(1.28::double * sqrt(lt / 30 * vd + d * d * vl)) as ss from j)
    select item, round(d, 6) as mean_demand, ceil(case when q < lot then lot else q end) as order_qty, ss as safety_stock, ceil(d * (lt / 30) + ss) as reorder_point from k""",
)
def biz_replenishment(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    demand = lines.filter("l_linestatus = 'F'").filter(F.year("l_shipdate") == 1997).select("item", "month", F.col("l_quantity").alias("pieces"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("document_date"))
    receipts = lines.filter("l_returnflag = 'A'").join(o, "l_orderkey").select(
        "item", (F.col("l_tax") * 100).alias("acquisition_cost"), F.col("l_quantity").alias("quantity"),
        "document_date", F.to_date("l_shipdate").alias("entry_date"),
    )
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_size").cast("string").alias("lead_time"),
        F.when(F.col("p_type") != "LARGE", (F.col("p_size") * 2).cast("string")).alias("min_lot"),
        (F.col("p_retailprice") / 10).alias("storage_cost"),
    )
    out = replenishment(demand, receipts, items)
    return out.select("item", round6("mean_demand").alias("mean_demand"), "order_qty", "safety_stock", "reorder_point")


def _alerts(spark, sf_dir):
    covered = stock_coverage(_series(spark, sf_dir), AS_OF).withColumns(
        {"reorder_point": (F.col("item") % 7) * 100.0, "order_qty": F.lit(500.0)}
    )
    return stock_alerts(covered)


ALERTS = f"""{SERIES}, al as (select * exclude (survive_weeks), sum(case when level / nullif((item % 7) * 100.0, 0) > 1.2 then 1 else 0 end) over w::bigint as covered_months,
      arg_min(survive_weeks, month) over w as survive_weeks, case when real_level - ((item % 7) * 100.0 + 500) < 0 then level else real_level - ((item % 7) * 100.0 + 500) end::double as excess
      from cov window w as (partition by item, model, concept, vintage)),
    lt as (select item, vintage, month, covered_months, case when covered_months <= 1 then 'RED' when covered_months <= 2 then 'AMBER' else 'GREEN' end as light, excess,
      case when survive_weeks <= 4 then '0 - 4' when survive_weeks <= 12 then '4 - 12' when survive_weeks <= 21 then '12 - 21' else '+21' end as survival,
      round(excess * 0.0066, 6) as opportunity_cost, round(covered_months * 4.345::double, 6) as covered_weeks from al)"""


@query("biz_stock_alerts", f"{ALERTS} select * from lt")
def biz_stock_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir).select(
        "item", "vintage", "month", "covered_months", "light", "excess", "survival",
        round6("opportunity_cost").alias("opportunity_cost"), round6("covered_weeks").alias("covered_weeks"),
    )


@query(
    "biz_stock_alerts_amounts",
    f"{ALERTS} select item, vintage, month, light, 'PIECES' as unit, excess from lt union all select item, vintage, month, light, 'AMOUNT', excess * (item + 1) from lt",
)
def biz_stock_alerts_amounts(spark, sf_dir):
    out = _alerts(spark, sf_dir).select("item", "vintage", "month", "light", "excess")
    return with_amounts(out, ["excess"], F.col("item") + 1, tag="unit")


def _classed(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    stock = lines.groupBy("item").agg(number(F.sum(money("l_quantity"))).alias("stock"))
    target = F.when(F.col("p_size") % 7 > 1, F.col("p_size") * 4.0).when(F.col("p_size") % 7 == 1, 0.0)
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), "p_brand", target.alias("target"))
    both = items.join(stock, "item", "left").na.fill(0, ["stock"])
    return both.select("*", F.explode(F.array(F.lit("PIECES"), F.lit("AMOUNT"))).alias("concept"))


CLASSED = """with st as (select l_partkey as item, sum(l_quantity) as s from lineitem group by 1),
    i as (select p_partkey as item, p_brand, case when p_size % 7 > 1 then p_size * 4.0 else 0 end::double as target, coalesce(s, 0)::double as stock, concept
      from part left join st on st.item = p_partkey, (values ('PIECES'), ('AMOUNT')) c(concept)),"""


@query(
    "biz_classify_finished",
    f"""{CLASSED} w as (select *, case concept when 'PIECES' then floor(least(stock, target * 1.255)) else least(stock, target * 1.255) end as within from i),
    r as (select item, p_brand, concept, target, stock, 'WITHIN TARGET' as part, within as quantity from w
      union all select item, p_brand, concept, target, stock, 'EXCESS', stock - within from w where target > 0
      union all select item, p_brand, concept, target, stock, 'NO TARGET', stock from w where target = 0 and stock <> 0),
    f as (select *, quantity / nullif(stock, 0) as share, quantity / nullif(target, 0) as times_target from r),
    g as (select *, case when part = 'WITHIN TARGET' and times_target <= 0.75 then 'BELOW TARGET' when part = 'WITHIN TARGET' and times_target <= 1.256 then 'ON TARGET'
      when part = 'EXCESS' and quantity > 0 then 'EXCESS STOCK' else 'NO TARGET' end as flag from f),
    h as (select *, case when flag in ('EXCESS STOCK', 'BELOW TARGET') then 'RED' when flag = 'ON TARGET' then 'GREEN' when target = 0 then 'GREY' end as light from g)
    select distinct * replace (round(quantity, 6) as quantity, round(share, 6) as share, round(times_target, 6) as times_target) from h where light is not null""",
)
def biz_classify_finished(spark, sf_dir):
    out = classify_stock(_classed(spark, sf_dir))
    return out.withColumns({c: round6(c) for c in ("quantity", "share", "times_target")})


@query(
    "biz_classify_raw",
    f"""{CLASSED} w as (select *, target = 0 and stock <> 0 as un from i),
    x as (select *, case when not un then case when stock <= target * 1.255 then stock else target * 1.255 end end as within from w),
    r as (select item, p_brand, concept, target, stock, 'WITHIN TARGET' as part, within as quantity from x where not un
      union all select item, p_brand, concept, target, stock, 'EXCESS', case when target > 0 then stock - within else 0 end from x where not un
      union all select item, p_brand, concept, target, stock, 'NO TARGET', stock from x where un),
    f as (select *, quantity / nullif(stock, 0) as share, quantity / nullif(target, 0) as times_target from r),
    g as (select *, case when part = 'WITHIN TARGET' and times_target <= 0.75 then 'BELOW TARGET' when part = 'WITHIN TARGET' and times_target <= 1.256 then 'ON TARGET'
      when part = 'EXCESS' and quantity > 0 then 'EXCESS STOCK' else 'NO TARGET' end as flag from f),
    h as (select *, case when (flag = 'EXCESS STOCK' and times_target > 1.8) or (flag = 'BELOW TARGET' and times_target < 0.3) then 'RED'
      when (flag = 'EXCESS STOCK' and times_target > 1) or (flag = 'BELOW TARGET' and times_target < 0.75) then 'AMBER'
      when flag in ('EXCESS STOCK', 'BELOW TARGET', 'ON TARGET') then 'GREEN' when target = 0 then 'GREY' end as light from g)
    select distinct * replace (round(quantity, 6) as quantity, round(share, 6) as share, round(times_target, 6) as times_target) from h where light is not null""",
)
def biz_classify_raw(spark, sf_dir):
    out = classify_stock(_classed(spark, sf_dir), policy="raw")
    return out.withColumns({c: round6(c) for c in ("quantity", "share", "times_target")})


@query(
    "biz_raw_material_stock",
    f"""with ld as (select l_partkey as m, l_returnflag as plant, l_linestatus as warehouse, {MONTH} as month, l_quantity as q from lineitem where day(l_shipdate) = 1),
    pl as (select l_partkey as m, l_returnflag as plant, l_linenumber * 10.0 as mx, l_linenumber * 2.0 as rp from lineitem qualify row_number() over (partition by l_partkey, l_returnflag order by {ORDER_SQL}) = 1),
    va as (select l_partkey as m, l_returnflag as plant, case l_linestatus when 'O' then l_extendedprice else l_extendedprice / 2 end / 4 as cost from lineitem qualify row_number() over (partition by l_partkey, l_returnflag order by {ORDER_SQL}) = 1),
    s as (select ld.m, ld.plant, warehouse, month, cost, case when p_size % 2 = 0 then 'PC' else 'KG' end as unit, sum(q) as stock, sum(mx) as target, sum(rp) as reorder_point
      from ld left join pl on pl.m = ld.m and pl.plant = ld.plant left join va on va.m = ld.m and va.plant = ld.plant left join part on p_partkey = ld.m group by all),
    d as (select (m + 1)::varchar as item, plant, warehouse, month, unit, strftime(month, '%Y-%m') as period, concept, case concept when 'PIECES' then 1 else cost end as k, stock, target, reorder_point
      from s, (values ('PIECES'), ('AMOUNT')) c(concept))
    select item, plant, warehouse, month, unit, period, concept, stock * k as stock, (target * k)::double as target, (reorder_point * k)::double as reorder_point from d""",
)
def biz_raw_material_stock(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    material = F.concat(F.lit("00"), (F.col("l_partkey") + 1).cast("string")).alias("material")
    loads = lines.select(
        material, F.col("l_returnflag").alias("plant"), F.col("l_linestatus").alias("warehouse"),
        F.to_date("l_shipdate").alias("load_day"), F.col("l_quantity").alias("units"),
    )
    plant = lines.select(
        material, F.col("l_returnflag").alias("plant"), (F.col("l_linenumber") * 10).cast("string").alias("max_stock"),
        (F.col("l_linenumber") * 2).cast("string").alias("reorder_point"), *ORDER,
    )
    valuation = lines.select(
        material, F.col("l_returnflag").alias("plant"), F.when(F.col("l_linestatus") == "O", "S").otherwise("V").alias("price_control"),
        F.col("l_extendedprice").alias("standard_price"), (F.col("l_extendedprice") / 2).alias("variable_price"),
        F.lit(4.0).alias("price_base"), *ORDER,
    )
    names = table(spark, sf_dir, "part").select(
        F.concat(F.lit("00"), (F.col("p_partkey") + 1).cast("string")).alias("material"),
        F.when(F.col("p_size") % 2 == 0, "ST").otherwise("KG").alias("unit"), *[F.lit(0).alias(c) for c in ORDER],
    )
    return raw_material_stock(loads, plant, names, valuation, loaded=ORDER)
