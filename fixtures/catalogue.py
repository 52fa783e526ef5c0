"""Article catalogues and price lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.base import query, table
from fixtures.joins import LINE_ORDER, LINE_ORDER_SQL
from millrace.functions import pad_key
from millrace.plans.catalogue import article_catalogue, sales_catalogue
from millrace.plans.prices import domestic_price_list, export_price_list, latest_conditions

ORDER = [*LINE_ORDER, "l_orderkey", "l_linenumber"]
ORDER_SQL = f"{LINE_ORDER_SQL}, l_orderkey desc, l_linenumber desc"


def _zeros(c):
    """Material number with two leading zeros, as an ERP table shows it."""
    return F.concat(F.lit("00"), F.col(c).cast("string"))


def _texts(p):
    langs = F.array(
        F.struct(F.lit("S").alias("language"), F.col("p_name").alias("text")),
        F.struct(F.lit("Z").alias("language"), F.col("p_brand").alias("text")),
        F.struct(F.lit("Y").alias("language"), F.col("p_type").alias("text")),
        F.struct(F.lit("E").alias("language"), F.lit("ignored").alias("text")),
    )
    return p.select(_zeros("p_partkey").alias("material"), F.lit(1).alias("loaded_at"), F.inline(langs))


def _master(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem")
    return p, lines


@query(
    "biz_article_catalogue",
    f"""with pl as (select l_partkey::varchar as material, l_returnflag as plant, l_suppkey as planner_code, l_linestatus as abc,
      concat('G', l_linenumber) as buying_group from lineitem
      qualify row_number() over (partition by l_partkey, l_returnflag order by {ORDER_SQL}) = 1),
    base as (select p_partkey::varchar as material, upper(p_type) as material_type, 'PC' as unit, upper(p_brand) as material_group, pl.plant,
      pl.planner_code::varchar as planner_code, upper(pl.buying_group) as buying_group, pl.abc, format('{{:,.2f}}', p_retailprice) as standard_price,
      format('{{:,.2f}}', p_retailprice * 2) as variable_price, upper(p_name) as text, upper(p_brand) as fiscal_code,
      upper(p_type) as waybill_code, upper(s_name) as planner, case when p_brand <> 'Brand#9' then 'GROUP ' || upper(p_brand) end as group_name
      from part left join pl on pl.material = p_partkey::varchar
      left join supplier on s_suppkey = pl.planner_code and pl.plant = 'A'),
    listed as (select base.*, case when plant = 'A' and p_size <= 25 then p_type end as system,
      case when plant = 'A' and p_size <= 25 then p_brand end as line from base join part on p_partkey::varchar = material),
    o as (select case when l_returnflag = 'R' then ' ' when l_linestatus = 'O' then concat('X', l_suppkey) else l_partkey::varchar end as m,
      l_returnflag as plant, concat('G', l_linenumber) as grp from lineitem),
    svc as (select distinct 'SERVICE' as material, plant, grp as material_group, concat('SERVICE-', grp) as material_id from o where m = ' '),
    mats as (select distinct m as material, plant from o where m <> ' '),
    extra as (select * from mats where (material, plant) not in (select (material, plant) from listed where plant is not null)),
    full_ as (select *, cast(null as varchar) as material_id, cast(null as varchar) as purchase_type from listed
      union all by name select *, 'SERVICE' as purchase_type from svc union all by name select * from extra)
    select distinct f.* replace (coalesce(material_id, material) as material_id, coalesce(purchase_type, 'MATERIAL') as purchase_type,
      case when purchase_type = 'SERVICE' then 'SERVICE' else system end as system, case when purchase_type = 'SERVICE' then 'SERVICE' else line end as line),
    case plant when 'A' then 'FIRST' when 'N' then 'SECOND' else 'THIRD' end as company,
    upper(case when plant = 'N' and p_size is not null then concat('size ', p_size) when plant = 'A' then case when purchase_type = 'SERVICE' then 'SERVICE' else system end end) as category
    from full_ f left join part on p_partkey::varchar = material""",
)
def biz_article_catalogue(spark, sf_dir):
    p, lines = _master(spark, sf_dir)
    material = p.select(
        _zeros("p_partkey").alias("material"), F.col("p_type").alias("material_type"), F.lit("ST").alias("unit"),
        F.col("p_brand").alias("material_group"), *[F.lit(0).alias(c) for c in ORDER],
    )
    plant = lines.select(
        _zeros("l_partkey").alias("material"), F.col("l_returnflag").alias("plant"),
        F.col("l_suppkey").cast("string").alias("planner_code"),
        F.concat(F.lit("g"), F.col("l_linenumber").cast("string")).alias("buying_group"), F.col("l_linestatus").alias("abc"), *ORDER,
    )
    valuation = p.select(
        _zeros("p_partkey").alias("material"), F.col("p_retailprice").alias("standard_price"),
        (F.col("p_retailprice") * 2).alias("variable_price"), *[F.lit(0).alias(c) for c in ORDER],
    )
    planners = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("planner_code"), F.lit("A").alias("plant"), F.col("s_name").alias("planner")
    )
    groups = p.select(F.upper("p_brand").alias("material_group")).distinct().filter("material_group <> 'BRAND#9'").withColumn(
        "group_name", F.concat(F.lit("group "), "material_group")
    )
    sales = p.filter("p_size <= 25").select(
        F.col("p_partkey").cast("string").alias("material"), F.col("p_type").alias("system"), F.col("p_brand").alias("line")
    )
    bought = F.when(F.col("l_returnflag") == "R", " ").when(
        F.col("l_linestatus") == "O", F.concat(F.lit("X"), F.col("l_suppkey").cast("string"))
    ).otherwise(_zeros("l_partkey"))
    orders = lines.select(
        bought.alias("material"), F.col("l_returnflag").alias("plant"),
        F.concat(F.lit("G"), F.col("l_linenumber").cast("string")).alias("material_group"),
        F.lit("MATERIAL").alias("purchase_type"),
    )
    categories = p.select(
        F.col("p_partkey").cast("string").alias("material"), F.lit("N").alias("plant"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("category"),
    )
    texts = _texts(p).withColumns({c: F.lit(0) for c in ORDER}).drop("loaded_at")
    return article_catalogue(
        material, plant, valuation, texts, planners, groups, sales, orders, categories,
        main_plant="A", company_by_plant={"A": "FIRST", "N": "SECOND"}, default_company="THIRD", loaded=ORDER,
    )


@query(
    "biz_sales_catalogue",
    f"""with so as (select l_partkey::varchar as material, case l_returnflag when 'A' then 'MI' when 'N' then 'ME' else 'MO' end as channel,
      l_suppkey as line_id, concat('9', l_linenumber) as status from lineitem
      qualify row_number() over (partition by l_partkey, l_returnflag order by {ORDER_SQL}) = 1)
    select so.material, so.channel, so.line_id, so.status, upper(s_name) as line_name, case when p_size % 4 = 0 then 'V1' when p_size % 4 = 1 then 'X0' else 'Z1' end as planning_type,
    'PC' as unit, format('{{:,.3f}}', p_size * 100.0) as gross_weight, format('{{:,.3f}}', p_size * 1.0) as net_weight,
    format('{{:,.3f}}', p_size / 8.0) as volume, 'CM3' as volume_unit, format('{{:,.3f}}', p_size * 2.0) as length,
    format('{{:,.3f}}', p_size * 3.0) as width, cast(null as varchar) as height, format('{{:,.2f}}', p_retailprice) as standard_price,
    format('{{:,.2f}}', p_retailprice * 1000) as variable_price, upper(p_type) as storage_type, upper(p_name) as text, upper(p_brand) as fiscal_code,
    upper(p_type) as waybill_code, upper(concat('t', p_size)) as tariff
    from so join part on p_partkey::varchar = material left join supplier on s_suppkey = so.line_id and s_suppkey % 2 = 0 where p_size % 4 <> 3""",
)
def biz_sales_catalogue(spark, sf_dir):
    p, lines = _master(spark, sf_dir)
    none = [F.lit(0).alias(c) for c in ORDER]
    sales_org = lines.select(
        _zeros("l_partkey").alias("material"),
        F.when(F.col("l_returnflag") == "A", "MI").when(F.col("l_returnflag") == "N", "ME").otherwise("MO").alias("channel"),
        F.col("l_suppkey").alias("line_id"), F.concat(F.lit("9"), F.col("l_linenumber").cast("string")).alias("status"),
        *ORDER[:-2], F.col("l_orderkey"), F.col("l_linenumber"),
    )
    key = _zeros("p_partkey").alias("material")
    size = F.col("p_size").cast("double")
    material = p.select(
        key, F.lit("ST").alias("unit"), (size * 100).alias("gross_weight"), size.alias("net_weight"),
        (size / 8).cast("string").alias("volume"), F.lit("CCM").alias("volume_unit"), (size * 2).cast("string").alias("length"),
        (size * 3).cast("string").alias("width"), F.lit("n/a").alias("height"), *none,
    )
    kind = F.when(F.col("p_size") % 4 == 0, "V1").when(F.col("p_size") % 4 == 1, "X0").when(F.col("p_size") % 4 == 2, "Z1")
    plant = p.select(key, F.coalesce(kind, F.lit("PD")).alias("planning_type"), *none)
    valuation = p.select(key, F.col("p_retailprice").alias("standard_price"), (F.col("p_retailprice") * 1000).alias("variable_price"), *none)
    warehouse = p.select(key, F.lower("p_type").alias("storage_type"), *none)
    texts = _texts(p).drop("loaded_at").withColumns({c: F.lit(0) for c in ORDER})
    names = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").alias("line_id"), F.col("s_name").alias("line_name")
    )
    products = p.select(F.col("p_partkey").cast("string").alias("material"), F.concat(F.lit("t"), F.col("p_size").cast("string")).alias("tariff"))
    return sales_catalogue(
        sales_org, material, plant, valuation, warehouse, texts, [(names, "line_id")], products, loaded=ORDER
    )


def _prices(spark, sf_dir):
    p, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    status = F.element_at(F.array(*[F.lit(s) for s in ("99", "97", "95", "93", "10")]), (F.col("p_size") % 5 + 1).cast("int"))
    catalogue = p.select(
        F.col("p_partkey").alias("material"), status.alias("status"), F.col("p_type").alias("system"), F.col("p_name").alias("text"),
        F.explode(F.array(F.lit("MI"), F.when(F.col("p_size") % 2 == 0, "ME").otherwise("MO"))).alias("channel"),
    )
    number = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    channel = F.when(F.col("l_returnflag") == "A", "MI").when(F.col("l_returnflag") == "N", "ME").otherwise("MO")
    rows = lines.select(
        F.col("l_partkey").alias("material"), channel.alias("channel"), F.col("l_suppkey").cast("string").alias("customer"),
        F.lit("ZPR0").alias("condition_class"), F.lit("V").alias("application"),
        F.to_date("l_shipdate").alias("valid_from"), F.to_date("l_shipdate").alias("valid_to"), number.alias("raw_no"),
        F.col("l_extendedprice").alias("amount"), F.col("l_tax").alias("tax"),
    )
    conditions = rows.select(
        "material", "channel", "customer", "condition_class", "application", F.col("raw_no").alias("condition_no"), "valid_from", "valid_to"
    ).distinct()
    amounts = rows.groupBy("condition_class", "application", F.col("raw_no").alias("condition_no")).agg(
        F.min("amount").alias("amount"), F.lit("MXN").alias("currency"), F.lit("ST").alias("unit"),
        F.max(F.when(F.col("tax") > 0, "A")).alias("scale_class"),
    )
    customers = table(spark, sf_dir, "supplier").select(pad_key("s_suppkey").alias("customer"), F.col("s_name").alias("customer_name"))
    return catalogue, conditions, amounts, customers


PRICES = """with cat as (select p_partkey as material, ['99','97','95','93','10'][p_size % 5 + 1] as status, p_type as system, p_name as text,
      unnest(['MI', case when p_size % 2 = 0 then 'ME' else 'MO' end]) as channel from part),
    r as (select l_partkey as material, case l_returnflag when 'A' then 'MI' when 'N' then 'ME' else 'MO' end as channel,
      lpad(l_suppkey::varchar, 10, '0') as customer, 'ZPR0' as condition_class, 'V' as application,
      concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as condition_no, cast(l_shipdate as date) as valid_from, l_extendedprice, l_tax from lineitem),
    con as (select distinct material, channel, customer, condition_class, application, condition_no, valid_from, valid_from as valid_to from r),
    am as (select condition_no, min(l_extendedprice) as amount, 'MXN' as currency, 'PC' as unit, max(case when l_tax > 0 then 'A' end) as scale_class from r group by 1)"""


@query(
    "biz_price_list",
    f"""{PRICES}, wanted as (select * from cat where status in ('99','97','95','93') and system in ('PROMO', 'SMALL', 'LARGE')),
    ab as (select con.*, status, system, text, amount, currency, unit, s_name as customer_name from con join wanted using (material, channel)
      join am using (condition_no) left join supplier on lpad(s_suppkey::varchar, 10, '0') = customer where channel in ('ME', 'MO') and scale_class is not null
      qualify row_number() over (partition by channel, customer, material order by valid_from desc, condition_no desc) = 1),
    ml as (select c.* replace ('ML' as channel), status, system, text, amount, currency, unit, s_name as customer_name
      from (select * from con where contains(customer, '77') qualify row_number() over (partition by customer, material order by valid_from desc, condition_no desc) = 1) c
      join (select * from wanted where channel = 'MI') w on w.material = c.material left join am using (condition_no)
      left join supplier on lpad(s_suppkey::varchar, 10, '0') = customer)
    select * replace (regexp_replace(customer, '^0{{2,}}(.)', '\\1') as customer, format('{{:,.2f}}', amount) as amount)
    from (select * from ab union all by name select * from ml)""",
)
def biz_price_list(spark, sf_dir):
    catalogue, conditions, amounts, customers = _prices(spark, sf_dir)
    return export_price_list(
        catalogue, conditions.withColumn("customer", pad_key("customer")), amounts, customers,
        special_customer="77", systems=["PROMO", "SMALL", "LARGE"],
    )


@query(
    "biz_price_list_domestic",
    f"""{PRICES} select con.* exclude (channel, customer), status, system, text, format('{{:,.2f}}', amount) as amount, currency, unit
    from con join (select * from cat where channel = 'MI') w using (material, channel) join am using (condition_no)
    where status in ('99', '95') qualify row_number() over (partition by material order by valid_from desc, condition_no desc) = 1""",
)
def biz_price_list_domestic(spark, sf_dir):
    catalogue, conditions, amounts, _ = _prices(spark, sf_dir)
    return domestic_price_list(catalogue, conditions, amounts).drop("channel", "customer")


@query(
    "biz_latest_conditions",
    f"""{PRICES} select material, customer, channel, case when length(condition_no) >= 10 then condition_no else lpad(condition_no, 10, '0') end as condition_no, valid_from from con
    qualify row_number() over (partition by material, customer, channel order by valid_from desc, case when length(condition_no) >= 10 then condition_no else lpad(condition_no, 10, '0') end desc) = 1""",
)
def biz_latest_conditions(spark, sf_dir):
    _, conditions, _, _ = _prices(spark, sf_dir)
    newest = latest_conditions(
        conditions, ["material", "customer", "channel"], order_by=["valid_from", "condition_no"]
    )
    return newest.select("material", "customer", "channel", "condition_no", "valid_from")
