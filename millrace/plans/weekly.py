"""Weekly sales report."""

from __future__ import annotations

from datetime import date

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import ratio

MEASURES = ["billed", "ordered", "rejected", "backlog"]


def weekly_sales(
    facts: DataFrame,
    clients: DataFrame,
    budget: DataFrame,
    managers: DataFrame,
    advisors: DataFrame,
    as_of: date,
    *,
    inactive: str = "INACTIVE",
) -> DataFrame:
    """Sales of the week and of the month to date per customer group, against the budget of the month.

    ``facts``: customer, day and the cumulated month-to-date amounts billed, ordered, rejected, backlog. ``clients``:
    customer, region, advisor, group. ``budget``: customer, month (date), budget. ``managers``: region, manager_mail.
    ``advisors``: advisor, advisor_mail.

    Of each ISO week of the last month up to ``as_of`` the last recorded day counts, and every customer has every week (0 if missing).
    The week's sales are the value less the one of the week before: 0 in the first week of a month, also across a year
    end, and null in the first week of all. A group without sales this week shows its month to date. Groups without a
    budget go. Attainment is net orders over budget in percent, worked out from the sums.
    """
    start = as_of - relativedelta(months=1)
    rows = facts.filter(F.col("day").between(F.lit(start), F.lit(as_of)))
    daily = rows.groupBy("customer", "day").agg(*[F.sum(m).cast("double").alias(m) for m in MEASURES])
    # A month has at most six weeks, so their last days travel as one small array instead of a join.
    days = rows.select("day").distinct()
    lasts = days.groupBy(F.year(F.date_add(F.trunc("day", "week"), 3)).alias("y"), F.weekofyear("day").alias("week")).agg(F.max("day").alias("day"))
    weeks = lasts.agg(F.collect_list("day")).scalar()
    grid = daily.select("customer").distinct().select("customer", F.explode(weeks).alias("day"))
    filled = grid.join(daily, ["customer", "day"], "left").na.fill(0, MEASURES)

    by_customer = Window.partitionBy("customer").orderBy("day")
    before = F.lag("billed").over(by_customer)
    new_month = F.trunc("day", "month") != F.lag(F.trunc("day", "month")).over(by_customer)
    change = F.when(new_month, 0.0).when(F.col("billed") != 0, F.col("billed") - before).otherwise(F.col("billed"))
    newest = lasts.agg(F.max("day")).scalar()
    # The change is worked out over all weeks before the last week is picked.
    current = filled.withColumn("week_sales", change).filter(F.col("day") == newest).select(
        "customer", F.weekofyear("day").alias("_week"), "week_sales", F.col("billed").alias("month_sales"),
        F.col("ordered").alias("gross_orders"), (F.col("ordered") - F.col("rejected")).alias("net_orders"), "backlog",
    )
    month = as_of.replace(day=1)
    planned = budget.filter(F.col("month") == F.lit(month)).groupBy("customer").agg(F.sum("budget").cast("double").alias("budget"))
    served = (
        clients.filter(F.col("region") != inactive)
        .join(current, "customer", "left")
        .join(planned, "customer", "left")
        .join(managers, "region")
        .join(advisors, "advisor")
    )
    by = ["region", "manager_mail", "advisor", "advisor_mail", "group"]
    sums = ["week_sales", "month_sales", "gross_orders", "net_orders", "backlog", "budget"]
    parts = served.groupBy(*by, "_week").agg(*[F.sum(c).alias(c) for c in sums]).filter(F.col("budget").isNotNull())
    shown = F.when(F.coalesce(F.col("week_sales"), F.lit(0)) == 0, F.col("month_sales")).otherwise(F.col("week_sales"))
    report = parts.withColumn("week_sales", shown).groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])
    return report.withColumns(
        {
            "month": F.lit(f"{month:%Y-%m}"),
            "week": F.weekofyear(newest),
            "attainment": 100 * ratio("net_orders", "budget"),
        }
    )
