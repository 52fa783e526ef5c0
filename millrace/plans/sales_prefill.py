"""Pre-filled sales forecast with limits, from the growth of past sales."""

from __future__ import annotations

from datetime import date

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import ratio
from millrace.operators.reshape import months_from

# Student quantile 0.975 with 33 degrees of freedom, step of the limit factor, least number of growths.
T_QUANTILE = 2.0345152974493383
LIMIT_STEP = 0.01
LEAST_GROWTHS = 7
SERIES = ["region", "advisor", "group", "line", "line_group"]


def sales_prefill(
    facts: DataFrame, clients: DataFrame, owners: DataFrame, as_of: date, horizon: int = 19, *, channel: str = "MI"
) -> DataFrame:
    """Pre-fill, lower and upper limit of the next ``horizon`` months per region, advisor, group and line.

    ``facts``: customer, channel, month (date), line, line_group, sales, backlog. ``clients``: customer, region,
    advisor, group. ``owners``: region, advisor, group, line, region_mail, advisor_mail; only their series appear.

    Growth is (x - next x) / x over the last 36 months with sales (backlog where sales are 0), one row per series and
    month. With median growth g (below -0.99 counts as -1), its population deviation s and number n, and the base b =
    sales of twelve months / 12 in thousands: pre-fill = b (1 + g^n), 0 when n < 7; limits = b (1 ± (g + t a sqrt(1 +
    s / n))) with a = 1, 1.01, 1.02 …; pre-fill and lower limit are not below 0; all rounded to cents.

    Facts are summed per series and month in one pass; statistics and base are read off those at most 37 rows per series.
    """
    base_month = as_of.replace(day=1)
    oldest = as_of - relativedelta(months=36)
    year_ago = base_month - relativedelta(months=12)
    last_month = base_month - relativedelta(months=1)
    month = F.col("month")

    known = facts.filter(F.col("channel") == channel).join(clients, "customer")
    grown = F.when(F.col("sales") == 0, F.col("backlog")).otherwise(F.col("sales"))
    recent = (month >= F.lit(min(oldest, year_ago))) & (month <= F.lit(as_of))
    counted = (month >= F.lit(oldest)) & (month <= F.lit(as_of)) & (grown != 0)
    in_year = (month >= F.lit(year_ago)) & (month < F.lit(base_month))
    # Series that sold only before the window still get a row, so the months are filtered inside the sums.
    monthly = known.groupBy(*SERIES, F.when(recent, month).alias("month")).agg(
        F.sum(F.when(counted, grown)).alias("x"),
        F.sum(F.when(in_year, F.col("sales"))).alias("y"),
        F.sum(F.when(month == F.lit(last_month), F.col("sales"))).alias("z"),
    )
    by_series = Window.partitionBy(*SERIES).orderBy("month")
    following = F.first("x", ignorenulls=True).over(by_series.rowsBetween(1, Window.unboundedFollowing))
    growths = monthly.withColumn("growth", F.when(F.col("x").isNotNull(), ratio(F.col("x") - following, F.col("x"))))
    stats = growths.groupBy(*SERIES).agg(
        F.median("growth").alias("g"),
        F.coalesce(F.stddev_pop("growth"), F.lit(0.0)).alias("s"),
        F.count("growth").alias("n"),
        F.coalesce(F.sum("y").cast("double"), F.lit(0.0)).alias("year_sales"),
        F.coalesce(F.sum("z").cast("double"), F.lit(0.0)).alias("month_sales"),
    )
    owned = stats.join(owners, ["region", "advisor", "group", "line"])
    steps = [F.struct(F.lit(m).alias("month"), F.lit(i).alias("step")) for i, m in enumerate(months_from(base_month + relativedelta(months=1), horizon))]
    rows = owned.select("*", F.inline(F.array(*steps)))

    known_growth = F.col("n") > 0
    base = F.greatest(F.col("year_sales") / 1000 / 12, F.lit(0.0))
    growth = F.when(F.col("g") < -0.99, -1.0).otherwise(F.col("g"))
    spread = F.lit(T_QUANTILE) * (1 + LIMIT_STEP * F.col("step")) * F.sqrt(1 + F.try_divide(F.col("s"), F.col("n")))
    point = F.when(F.col("n") >= LEAST_GROWTHS, F.greatest(base * (1 + F.pow(growth, F.col("n"))), F.lit(0.0)))
    return rows.select(
        F.col("region_mail").alias("region"), F.col("advisor_mail").alias("advisor"), "group", "line", "line_group",
        F.lit(base_month).alias("current_month"), "month",
        F.round(F.greatest(F.col("month_sales") / 1000, F.lit(0.0)), 2).alias("last_month_sales"),
        F.round(base, 2).alias("monthly_base"),
        F.coalesce(F.when(known_growth, F.round(F.greatest(base * (1 - growth - spread), F.lit(0.0)), 2)), F.lit(0.0)).alias("lower_limit"),
        F.coalesce(F.round(point, 2), F.lit(0.0)).alias("prefill"),
        F.coalesce(F.when(known_growth, F.round(base * (1 + growth + spread), 2)), F.lit(0.0)).alias("upper_limit"),
    ).distinct()
