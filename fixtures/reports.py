"""Weekly sales report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fixtures.base import EVENTS_AS_OF, money, number, query, round6, table
from millrace.plans.weekly import weekly_sales


@query(
    "biz_weekly_sales",
    """with d as (select user_id as customer, cast(ts as date) as day, sum(cast(value as decimal(18,2)))::double as billed,
      sum(case when event_type <> 'error' then cast(value as decimal(18,2)) else 0 end)::double as ordered,
      sum(case when event_type = 'view' then cast(value as decimal(18,2)) else 0 end)::double as rejected,
      sum(case when event_type = 'signup' then cast(value as decimal(18,2)) else 0 end)::double as backlog from events where ts >= timestamp '2023-12-31' group by 1, 2),
    w as (select date_trunc('week', day) as wk, max(day) as day from d group by 1),
    g as (select customer, w.day, coalesce(d.billed, 0) as billed, coalesce(ordered, 0) as ordered, coalesce(rejected, 0) as rejected, coalesce(backlog, 0) as backlog
      from (select distinct customer from d) c cross join w left join d using (customer, day)),
    c as (select *, case when date_trunc('month', day) <> lag(date_trunc('month', day)) over v then 0 when billed <> 0 then billed - lag(billed) over v else billed end as chg
      from g window v as (partition by customer order by day)),
    l as (select * from c where day = (select max(day) from w)),
    b as (select o_custkey as customer, sum(cast(o_totalprice as decimal(18,2)))::double as budget from orders where o_custkey % 3 <> 0 group by 1),
    s as (select c_nationkey % 5 as r, c_nationkey as a, c_mktsegment as grp, l.customer is not null as seen, sum(chg) as chg, sum(billed) as billed, sum(ordered) as ordered,
      sum(ordered - rejected) as net, sum(l.backlog) as backlog, sum(budget) as budget from customer left join l on l.customer = c_custkey left join b on b.customer = c_custkey
      where c_nationkey not in (6, 7) group by 1, 2, 3, 4 having sum(budget) is not null)
    select concat('R', r) as region, concat('m', r) as manager_mail, concat('A', a) as advisor, concat('a', a) as advisor_mail, grp as "group", '2024-01' as month,
    weekofyear((select max(day) from w))::int as week, round(sum(case when coalesce(chg, 0) = 0 then billed else chg end), 2) as week_sales, round(sum(billed), 2) as month_sales,
    round(sum(ordered), 2) as gross_orders, round(sum(net), 2) as net_orders, round(sum(backlog), 2) as backlog, round(sum(budget), 2) as budget,
    round(100 * sum(net) / nullif(sum(budget), 0), 6) as attainment from s group by r, a, grp""",
)
def biz_weekly_sales(spark, sf_dir):
    kind = F.col("event_type")
    value = money("value")
    facts = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer"), F.to_date("ts").alias("day"), value.alias("billed"),
        F.when(kind != "error", value).otherwise(0).alias("ordered"), F.when(kind == "view", value).otherwise(0).alias("rejected"),
        F.when(kind == "signup", value).otherwise(0).alias("backlog"),
    )
    c = table(spark, sf_dir, "customer")
    region = F.concat(F.lit("R"), (F.col("c_nationkey") % 5).cast("string"))
    clients = c.select(
        F.col("c_custkey").alias("customer"), F.when(F.col("c_nationkey") == 6, "INACTIVE").otherwise(region).alias("region"),
        F.concat(F.lit("A"), F.col("c_nationkey").cast("string")).alias("advisor"), F.col("c_mktsegment").alias("group"),
    )
    budget = table(spark, sf_dir, "orders").filter("o_custkey % 3 <> 0").select(
        F.col("o_custkey").alias("customer"), F.lit(date(2024, 1, 1)).alias("month"), money("o_totalprice").alias("budget")
    )
    managers = clients.select("region").distinct().withColumn("manager_mail", F.regexp_replace("region", "R", "m"))
    advisors = clients.filter("advisor <> 'A7'").select("advisor").distinct().withColumn("advisor_mail", F.lower("advisor"))
    out = weekly_sales(facts, clients, budget, managers, advisors, EVENTS_AS_OF)
    cents = ["week_sales", "month_sales", "gross_orders", "net_orders", "backlog", "budget"]
    return out.withColumns({**{m: F.round(number(m), 2) for m in cents}, "attainment": round6("attainment")})
