"""Forecast ladders and pre-filled forecasts."""

from __future__ import annotations

from datetime import date

from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, table
from fixtures.planning import MONTH, _lines
from millrace.functions import month_start, pad_key
from millrace.operators.reshape import months_from
from millrace.plans.ladder import (
    ladder_domestic,
    ladder_export,
    ladder_stats,
    ladder_summary,
    prefill_units,
    prior_forecast,
)
from millrace.plans.sales_prefill import sales_prefill

BASE = date(1998, 6, 1)
PAST = months_from(BASE - relativedelta(months=36), 36)
AHEAD = months_from(date(1998, 1, 1), 32)
PREFILL = months_from(BASE, 12)


def _ordered(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey", "o_orderpriority")
    return _lines(spark, sf_dir).join(o, "l_orderkey").withColumn("ordered", month_start("o_orderdate"))


def _sales(spark, sf_dir):
    return _ordered(spark, sf_dir).select(
        "item", F.col("o_custkey").alias("customer"), F.col("ordered").alias("month"),
        F.when(F.col("o_custkey") % 3 == 0, "ME").when(F.col("o_custkey") % 3 == 1, "MO").otherwise("MI").alias("channel"),
        money("l_quantity").alias("pieces"), money("l_extendedprice").alias("amount"),
        F.when(F.col("l_linestatus") == "O", money("l_quantity")).otherwise(0).alias("backlog_pieces"),
    )


def _history(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    version = F.concat_ws("-", day, F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), "l_linenumber", "l_suppkey",
                          F.col("l_quantity").cast("int"), F.date_format("l_shipdate", "yyyyMMdd"))
    return _ordered(spark, sf_dir).select(
        "item", pad_key("o_custkey").alias("ship_to"), F.date_format("l_shipdate", "yyyy-MM").alias("target"),
        F.when(F.col("l_linestatus") == "F", "U_PRONO").otherwise("IMP_PRONO").alias("kind"),
        F.col("l_quantity").alias("value"), version.alias("version"),
    )


HISTORY = f"""hi as (select l_partkey as item, lpad(o_custkey::varchar, 10, '0') as ship_to, {MONTH} as target, l_quantity as units,
      concat_ws('-', strftime(o_orderdate, '%Y-%m-%d'), lpad(l_orderkey::varchar, 9, '0'), l_linenumber, l_suppkey, l_quantity::int, strftime(l_shipdate, '%Y%m%d')) as version
      from lineitem join orders on o_orderkey = l_orderkey where l_linestatus = 'F' and strftime(o_orderdate, '%Y-%m') = '1998-05')"""
SALES = f"""sa as (select l_partkey as item, o_custkey as customer, date_trunc('month', o_orderdate)::date as month,
      case o_custkey % 3 when 0 then 'ME' when 1 then 'MO' else 'MI' end as channel, cast(l_quantity as decimal(18,2)) as p, cast(l_extendedprice as decimal(18,2)) as a,
      case when l_linestatus = 'O' then cast(l_quantity as decimal(18,2)) else 0 end as b from lineitem join orders on o_orderkey = l_orderkey)"""
ACTUALS = (
    ", ".join(f"""cast(coalesce(sum(p) filter (month = date '{m}'), 0) as double) as "{m:%Y-%m} U REAL" """ for m in PAST)
    + ", "
    + ", ".join(f"""cast(coalesce(sum(a) filter (month = date '{m}'), 0) as double) / 1000 as "{m:%Y-%m} $ REAL" """ for m in PAST)
    + """, cast(coalesce(sum(p) filter (month between date '1998-01-01' and date '1998-06-01'), 0) as double) as "TOTAL 1998 U",
    cast(coalesce(sum(b) filter (month = date '1998-05-01'), 0) as double) as backlog """
)
FORECASTS = ", ".join(f"""coalesce(sum(units) filter (target = date '{m}'), 0)::double as "{m:%Y-%m} U PRONO" """ for m in AHEAD)


@query(
    "biz_prior_forecast",
    f"with {HISTORY} select item, target, units from hi qualify row_number() over (partition by item, target order by version desc) = 1",
)
def biz_prior_forecast(spark, sf_dir):
    return prior_forecast(_history(spark, sf_dir), ["item"], AS_OF)


def _group(p):
    return {
        "system": F.col("p_type"), "company": F.concat(F.lit("C"), (F.col("p_size") % 2).cast("string")), "line": F.col("p_brand"),
        "line_group": F.col("p_brand"), "class": F.lit("K"), "segment": F.lit("S"),
    }


def _products(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    group = [c.alias(n) for n, c in _group(p).items()]
    catalogue = p.select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("text"), *group,
        F.when(F.col("p_size") % 10 == 0, "95").otherwise("99").alias("status"), F.lit("MI").alias("channel"),
    )
    prices = p.filter("p_size % 9 <> 0").select(F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("list_price"))
    owners = p.filter("p_brand <> 'Brand#5'").select(*group).distinct().withColumns(
        {
            "coordinator": F.concat(F.lit("co_"), "system"), "specialist": F.concat(F.lit("sp_"), "line"),
            "discount": F.when(F.col("system") == "SMALL", 0.0).otherwise(0.8), "factor": F.lit(0.6),
        }
    )
    return catalogue, prices, owners


PRODUCTS = """ca as (select p_partkey as item, p_name as text, p_type as system, concat('C', p_size % 2) as company, p_brand as line, p_brand as line_group, 'K' as class, 'S' as segment,
      case when p_size % 10 = 0 then '95' else '99' end as status, 'MI' as channel, case when p_size % 9 <> 0 then p_retailprice end as list_price,
      case when p_brand <> 'Brand#5' then concat('co_', p_type) end as coordinator, case when p_brand <> 'Brand#5' then concat('sp_', p_brand) end as specialist,
      case when p_brand <> 'Brand#5' then case when p_type = 'SMALL' then 0.0 else 0.8 end end::double as discount, case when p_brand <> 'Brand#5' then 0.6 end::double as factor from part)"""


def _amounts(spark, sf_dir):
    """Amount forecast: vintage = month of the order, target = month of the shipment."""
    sums = _ordered(spark, sf_dir).groupBy("item", "month", F.col("ordered").alias("vintage")).agg(
        F.sum(money("l_extendedprice")).alias("amount")
    )
    return sums.withColumn("channel", F.lit("MI"))


UNITS = f"""am as (select l_partkey as item, {MONTH} as month, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as amount
      from lineitem join orders on o_orderkey = l_orderkey where date_trunc('month', o_orderdate) = timestamp '1998-06-01' group by 1, 2),
    pf as (select am.item, 'MI' as channel, am.month, ceil(coalesce(amount / nullif(least(coalesce(list_price * factor, 0), coalesce(list_price * factor * discount, 0)), 0), amount / list_price))::bigint as units,
      amount / 1000 as thousands from am join ca using (item) where list_price is not null)"""


@query("biz_prefill_units", f"with {PRODUCTS}, {UNITS} select * from pf")
def biz_prefill_units(spark, sf_dir):
    return prefill_units(_amounts(spark, sf_dir), *_products(spark, sf_dir), AS_OF)


def _domestic(spark, sf_dir):
    catalogue, prices, owners = _products(spark, sf_dir)
    prior = prior_forecast(_history(spark, sf_dir), ["item"], AS_OF)
    prefill = prefill_units(_amounts(spark, sf_dir), catalogue, prices, owners, AS_OF)
    stock = _lines(spark, sf_dir).filter(F.col("month") == F.lit(BASE)).groupBy("item").agg(number(F.sum(money("l_quantity"))).alias("stock"))
    return ladder_domestic(_sales(spark, sf_dir), catalogue, prices, owners, stock, prior, prefill, AS_OF)


def _zero(names):
    return ", ".join(f'coalesce("{n}", 0) as "{n}"' for n in names)


U_PREFILLS = [f"{m:%Y-%m} U PRELLENADO" for m in PREFILL]
V_PREFILLS = [f"{m:%Y-%m} $ PRELLENADO" for m in PREFILL]
U_FORECASTS = [f"{m:%Y-%m} U PRONO" for m in AHEAD]
DOMESTIC = f"""with {HISTORY}, {SALES}, {PRODUCTS}, {UNITS},
    ac as (select item, {ACTUALS} from sa where channel = 'MI' group by 1 having count(*) filter (month >= date '{PAST[0]}' and month < date '1998-06-01') > 0),
    pr as (select item, target, units from hi qualify row_number() over (partition by item, target order by version desc) = 1),
    fo as (select item, {FORECASTS} from pr where target >= date '1998-01-01' group by 1),
    pu as (select item, {", ".join(f'''coalesce(sum(units) filter (month = date '{m}'), 0)::bigint as "{m:%Y-%m} U PRELLENADO", coalesce(sum(thousands) filter (month = date '{m}'), 0)::double as "{m:%Y-%m} $ PRELLENADO" ''' for m in PREFILL)} from pf group by 1),
    st as (select l_partkey as item, sum(l_quantity)::double as stock from lineitem where {MONTH} = date '1998-06-01' group by 1),
    dom as (select ac.*, text, system, company, line, line_group, class, segment, status, ca.channel, coalesce(list_price, 0) as list_price, coalesce(coordinator, 'coordinator') as coordinator,
      coalesce(specialist, 'specialist') as specialist, coalesce(discount, 0) as discount, coalesce(factor, 0) as factor, coalesce(round(list_price * factor, 2), 0) as sale_price,
      coalesce(round(discount * round(list_price * factor, 2), 2), 0) as promotion_price, coalesce(stock, 0) as stock,
      {_zero(U_FORECASTS)}, {_zero(U_PREFILLS)}, {_zero(V_PREFILLS)}, {", ".join(f'0.0::double as "{m:%Y-%m} $ PRONO"' for m in AHEAD)}
      from ac join ca on ca.item = ac.item and status = '99' left join fo on fo.item = ac.item left join pu on pu.item = ac.item left join st on st.item = ac.item)"""


@query("biz_ladder_domestic", f"{DOMESTIC} select * from dom")
def biz_ladder_domestic(spark, sf_dir):
    return _domestic(spark, sf_dir)


def _mean(names):
    return "(" + " + ".join(f'"{n}"' for n in names) + f") / {len(names)}"


def _stat_columns():
    out = []
    for n in (12, 6, 3):
        past = _mean([f"{m:%Y-%m} U REAL" for m in PAST[-n:]])
        future = _mean([f"{m:%Y-%m} U PRONO" for m in months_from(BASE, n)])
        out.append(f"{past} as mean_{n}m, {future} as future_{n}m")
    return ", ".join(out)


@query(
    "biz_ladder_stats",
    f"""{DOMESTIC}, s as (select item, specialist, "1998-07 U PRONO" * case when promotion_price > 0 then promotion_price else sale_price end / 1000 as amount,
    {_stat_columns()}, {" + ".join(f'"{n}"' for n in U_FORECASTS[:12])} as total from dom)
    select item, specialist, round(amount, 2) as amount, round(mean_12m, 2) as mean_12m, round(mean_6m, 2) as mean_6m, round(mean_3m, 2) as mean_3m,
    round(round(mean_12m, 2) / nullif(future_12m, 0) * 100, 2) as variation_12m, round(round(mean_3m, 2) / nullif(future_3m, 0) * 100, 2) as variation_3m, total from s""",
)
def biz_ladder_stats(spark, sf_dir):
    out = ladder_stats(_domestic(spark, sf_dir), AS_OF)
    return out.select(
        "item", "specialist", F.col("`1998-07 $ PRONO`").alias("amount"), "mean_12m", "mean_6m", "mean_3m",
        "variation_12m", "variation_3m", F.col("`TOTAL 1998 PRONO`").alias("total"),
    )


@query(
    "biz_ladder_summary",
    f"""{DOMESTIC} select system, line_group, sum("1998-05 U REAL") as units, sum("1998-07 U PRONO") as forecast, sum("1998-07 U PRELLENADO")::bigint as prefill from dom group by 1, 2""",
)
def biz_ladder_summary(spark, sf_dir):
    out = ladder_summary(_domestic(spark, sf_dir), ["system", "line_group"])
    return out.select(
        "system", "line_group", F.col("`1998-05 U REAL`").alias("units"), F.col("`1998-07 U PRONO`").alias("forecast"),
        F.col("`1998-07 U PRELLENADO`").alias("prefill"),
    )


def _clients(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey").cast("string")
    return c.select(
        F.col("c_custkey").alias("customer"), F.when(F.col("c_custkey") % 3 == 0, "ME").otherwise("MO").alias("channel"),
        F.concat(F.lit("Z"), (F.col("c_nationkey") % 3).cast("string")).alias("region_id"),
        F.when(F.col("c_nationkey") == 6, "INACTIVE").otherwise(F.concat(F.lit("R"), nation)).alias("region"),
        F.concat(F.lit("A"), nation).alias("advisor"), nation.alias("country"), F.col("c_mktsegment").alias("state"),
        pad_key(F.col("c_custkey") % 10000).alias("group_id"), F.concat(F.lit("G"), (F.col("c_custkey") % 10000).cast("string")).alias("group_name"),
        pad_key("c_custkey").alias("ship_to"),
    )


@query(
    "biz_ladder_export",
    f"""with {HISTORY}, {SALES}, cl as (select c_custkey as customer, case c_custkey % 3 when 0 then 'ME' else 'MO' end as channel, concat('Z', c_nationkey % 3) as region_id,
      case when c_nationkey = 6 then 'INACTIVE' else concat('R', c_nationkey) end as region, concat('A', c_nationkey) as advisor, c_nationkey::varchar as country, c_mktsegment as state,
      lpad((c_custkey % 10000)::varchar, 10, '0') as group_id, concat('G', c_custkey % 10000) as group_name, lpad(c_custkey::varchar, 10, '0') as ship_to from customer),
    ac as (select advisor, country, region_id, region, state, group_id, ship_to, item, channel, {ACTUALS} from sa join cl using (customer, channel)
      where channel <> 'MI' and region_id = 'Z0' and region <> 'INACTIVE' group by 1, 2, 3, 4, 5, 6, 7, 8, 9 having count(*) filter (month >= date '{PAST[0]}' and month < date '1998-06-01') > 0),
    pr as (select item, ship_to, target, units from hi qualify row_number() over (partition by item, ship_to, target order by version desc) = 1),
    fo as (select item, lpad(regexp_extract(ship_to, '0*(\\d{{4}})$', 1), 10, '0') as group_id, ship_to, {FORECASTS} from pr where target >= date '1998-01-01' group by 1, 2, 3),
    nm as (select case when starts_with(ltrim(group_id, '0'), '3') then 'MO' else 'ME' end as nch, channel, regexp_replace(group_id, '^0+(.)', '\\1') as gid, max(group_name) as group_name from cl group by 1, 2, 3)
    select ac.* replace (concat('rm_', ac.region) as region, concat('am_', ac.advisor) as advisor, regexp_replace(ac.group_id, '^0+(.)', '\\1') as group_id, regexp_replace(ac.ship_to, '^0+(.)', '\\1') as ship_to,
      case when starts_with(ltrim(ac.group_id, '0'), '3') then 'MO' else 'ME' end as channel), p_name as text, case when p_size % 4 = 0 then '97' else '99' end as status,
      p_type as system, 'C' as company, p_brand as line, p_brand as line_group, 'K' as class, 'S' as segment, p_retailprice * 19.5::double as list_price, 0.0::double as stock, nm.group_name,
      {_zero(U_FORECASTS)}, {", ".join(f'0.0::double as "{m:%Y-%m} $ PRONO"' for m in AHEAD)}
    from ac join part on p_partkey = ac.item and p_size % 5 <> 0 left join fo on fo.item = ac.item and fo.group_id = ac.group_id and fo.ship_to = ac.ship_to
    left join nm on nm.gid = regexp_replace(ac.group_id, '^0+(.)', '\\1') and nm.channel = case when starts_with(ltrim(ac.group_id, '0'), '3') then 'MO' else 'ME' end""",
)
def biz_ladder_export(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    catalogue = p.select(
        F.col("p_partkey").alias("item"), F.explode(F.array(F.lit("ME"), F.lit("MO"))).alias("channel"),
        F.when(F.col("p_size") % 5 == 0, "10").when(F.col("p_size") % 4 == 0, "97").otherwise("99").alias("status"), F.col("p_name").alias("text"),
        F.col("p_type").alias("system"), F.lit("C").alias("company"), F.col("p_brand").alias("line"), F.col("p_brand").alias("line_group"),
        F.lit("K").alias("class"), F.lit("S").alias("segment"),
    )
    clients = _clients(spark, sf_dir)
    owners = clients.select("region", "advisor").distinct().withColumns(
        {"region_mail": F.concat(F.lit("rm_"), "region"), "advisor_mail": F.concat(F.lit("am_"), "advisor")}
    )
    # One price per customer group and item that the group has ever bought.
    group = (F.col("customer") % 10000).cast("string")
    bought = _sales(spark, sf_dir).select(group.alias("group_id"), "item").distinct()
    prices = bought.join(p.select(F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("list_price")), "item").withColumn("currency", F.lit("USD"))
    stock = p.select(F.col("p_partkey").alias("item"), F.lit(0.0).alias("stock"))
    prior = prior_forecast(_history(spark, sf_dir), ["item", "ship_to"], AS_OF)
    return ladder_export(
        _sales(spark, sf_dir), clients, catalogue, prices, owners, stock, prior, AS_OF,
        regions=["Z0"], exchange_rate=19.5,
    )


@query(
    "biz_sales_prefill",
    """with f as (select concat('R', c_nationkey % 5) as region, concat('A', c_nationkey) as advisor, c_mktsegment as grp, o_orderpriority as line, date_trunc('month', o_orderdate)::date as month,
      case when o_orderstatus <> 'P' then cast(o_totalprice as decimal(18,2)) else 0 end as sales, case when o_custkey % 2 = 0 then cast(o_totalprice as decimal(18,2)) else 0 end as backlog
      from orders join customer on c_custkey = o_custkey),
    k as (select distinct region, advisor, grp, line from f where line <> '5-LOW'),
    x as (select region, advisor, grp, line, month, sum(case when sales = 0 then backlog else sales end) as x from f
      where month >= date '1995-06-15' and month <= date '1998-06-15' and case when sales = 0 then backlog else sales end <> 0 group by all),
    g as (select *, (x::double - lead(x) over w::double) / x::double as gr from x window w as (partition by region, advisor, grp, line order by month)),
    st as (select region, advisor, grp, line, median(gr) as g, coalesce(stddev_pop(gr), 0) as s, count(gr) as n from g group by all),
    yr as (select region, advisor, grp, line, sum(sales) filter (month >= date '1997-06-01' and month < date '1998-06-01')::double as y, sum(sales) filter (month = date '1998-05-01')::double as z from f group by all),
    j as (select k.*, case when g < -0.99 then -1 else g end as g, s, coalesce(n, 0) as n, greatest(coalesce(y, 0) / 1000 / 12, 0) as b, greatest(coalesce(z, 0) / 1000, 0) as z, t
      from k left join st using (region, advisor, grp, line) left join yr using (region, advisor, grp, line), generate_series(0, 18) q(t)),
    q as (select *, 2.0345152974493383::double * (1 + 0.01::double * t) * sqrt(1 + s / nullif(n, 0)) as sp from j)
    select concat(region, '@x') as region, concat(advisor, '@x') as advisor, grp as "group", line, 'LG' as line_group, date '1998-06-01' as current_month,
    (date '1998-07-01' + t * interval 1 month)::date as month, round(z, 2) as last_month_sales, round(b, 2) as monthly_base,
    case when n > 0 then round(greatest(b * (1 - g - sp), 0), 2) + 0.0 else 0 end::double as lower_limit, case when n >= 7 then round(greatest(b * (1 + pow(g, n)), 0), 2) else 0 end::double as prefill,
    case when n > 0 then round(b * (1 + g + sp), 2) else 0 end::double as upper_limit from q""",
)
def biz_sales_prefill(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    facts = o.select(
        F.col("o_custkey").alias("customer"), F.lit("MI").alias("channel"), month_start("o_orderdate").alias("month"),
        F.col("o_orderpriority").alias("line"), F.lit("LG").alias("line_group"),
        F.when(F.col("o_orderstatus") != "P", money("o_totalprice")).otherwise(0).alias("sales"),
        F.when(F.col("o_custkey") % 2 == 0, money("o_totalprice")).otherwise(0).alias("backlog"),
    )
    clients = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer"), F.concat(F.lit("R"), (F.col("c_nationkey") % 5).cast("string")).alias("region"),
        F.concat(F.lit("A"), F.col("c_nationkey").cast("string")).alias("advisor"), F.col("c_mktsegment").alias("group"),
    )
    lines = F.array(*[F.lit(v) for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")])
    owners = clients.select("region", "advisor", "group").distinct().withColumns(
        {"region_mail": F.concat("region", F.lit("@x")), "advisor_mail": F.concat("advisor", F.lit("@x")), "line": F.explode(lines)}
    )
    return sales_prefill(facts, clients, owners, AS_OF)
