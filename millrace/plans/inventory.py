"""Stock coverage, replenishment, alerts and classification."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import bucket, clamp, map_unit, month_start, period, ratio, strip_zeros
from millrace.operators.aggregates import exact_median, with_group_median
from millrace.operators.snapshots import latest_by_key, top_n
from millrace.plans.planning import reuse_november

# Weeks per month, share of the stock value that idle stock costs, service factor, stock tolerance.
WEEKS_PER_MONTH = 4.345
OPPORTUNITY_RATE = 0.0066
SERVICE_FACTOR = 1.28
TOLERANCE = 1.255
# Survival classes in weeks.
SURVIVAL_EDGES = [4, 12, 21]
SURVIVAL_LABELS = ["0 - 4", "4 - 12", "12 - 21", "+21"]
SERIES = ["item", "model", "concept", "vintage"]


def first_targets(df: DataFrame, keys: Sequence[str], horizon: int = 12) -> DataFrame:
    """First ``horizon`` target months of each forecast vintage, values summed per target; earlier targets go."""
    sums = df.groupBy(*keys, "target").agg(F.sum("value").cast("double").alias("value"))
    return top_n(sums.filter(F.col("target") >= F.col("vintage")), keys, [F.asc("target")], horizon)


def forecast_stats(df: DataFrame, horizon: int = 12) -> DataFrame:
    """Mean (rounded up for pieces) and sample deviation of the first months of each forecast vintage.

    ``df``: item, concept, vintage, target, value.
    """
    keys = ["item", "concept", "vintage"]
    stats = first_targets(df, keys, horizon).groupBy(*keys).agg(
        F.avg("value").alias("mean_demand"), F.stddev_samp("value").alias("sd_demand")
    )
    mean = F.when(F.col("concept") == "PIECES", F.ceil("mean_demand").cast("double")).otherwise(F.col("mean_demand"))
    return stats.withColumn("mean_demand", mean)


def demand_models(plan: DataFrame, model: DataFrame, costs: DataFrame, horizon: int = 12) -> DataFrame:
    """Sales-plan and model forecasts side by side, in pieces and in amounts at the unit cost of the vintage month.

    ``plan`` and ``model``: item, vintage, target, value (pieces). ``costs``: item, vintage, unit_cost. Model values are
    rounded up. The December rule holds for the sales plan only.
    """
    keys = ["item", "vintage"]
    planned = first_targets(plan, keys, horizon).withColumn("model", F.lit("SALES_PLAN"))
    rounded = model.groupBy(*keys, "target").agg(F.ceil(F.sum("value")).cast("double").alias("value"))
    modelled = first_targets(rounded, keys, horizon).withColumn("model", F.lit("MODEL"))
    both = planned.unionByName(modelled).join(costs, keys, "left")
    cells = F.array(
        F.struct(F.lit("PIECES").alias("concept"), F.col("value").alias("demand")),
        F.struct(F.lit("AMOUNT").alias("concept"), (F.col("value") * F.col("unit_cost").cast("double")).alias("demand")),
    )
    rows = both.select("item", "vintage", "target", "model", F.inline(cells))
    return reuse_november(rows, applies=F.col("model") == "SALES_PLAN")


def actual_demand(df: DataFrame, costs: DataFrame) -> DataFrame:
    """Billed demand by item, month and concept; amounts are pieces at the unit cost of the month.

    ``df``: item, month, billed_pieces. ``costs``: item, month, unit_cost.
    """
    sums = df.groupBy("item", "month").agg(F.sum("billed_pieces").cast("double").alias("_p"))
    valued = sums.join(costs, ["item", "month"], "left")
    cells = F.array(
        F.struct(F.lit("PIECES").alias("concept"), F.col("_p").alias("actual_demand")),
        F.struct(F.lit("AMOUNT").alias("concept"), (F.col("_p") * F.col("unit_cost").cast("double")).alias("actual_demand")),
    )
    return valued.select("item", "month", F.inline(cells))


def receipts_by_month(indicators: DataFrame, plant: str, as_of: date) -> DataFrame:
    """Deliveries due by item, month and unit up to the same month of next year; amounts in local currency.

    ``indicators``: the result of ``po_indicators``.
    """
    last = as_of.replace(year=as_of.year + 1, day=1)
    due = indicators.withColumn("month", month_start("delivery_date"))
    rows = due.filter((F.col("plant") == plant) & (F.col("month") <= F.lit(last)))
    value = F.when(F.col("unit") == "AMOUNT", F.col("local_amount")).otherwise(F.col("quantity"))
    return rows.groupBy(strip_zeros("material", 2).alias("item"), "month", F.col("unit").alias("concept")).agg(
        F.sum(value.cast("decimal(38,12)")).cast("double").alias("due_qty")
    )


def storage_cost(
    items: DataFrame, rent: float, operation: float, pallets: float, pallet_volume: float = 1.2 * 1 * 1.3
) -> DataFrame:
    """Yearly storage cost per unit and its median by product line.

    ``items``: item, line, volume, length, width, height (centimetres). Units per pallet come from the unit volume, or
    from the dimensions, rounded down, where the volume is 0 or missing.
    """
    per_pallet = (rent + operation) / pallets
    size = F.lit(1.0)
    for side in ("length", "width", "height"):
        size = size * (F.col(side).try_cast("double") / 100)
    volume = F.col("volume").try_cast("double")
    units = F.when(volume != 0, F.try_divide(F.lit(pallet_volume), volume)).otherwise(
        F.floor(F.try_divide(F.lit(pallet_volume), size)).cast("double")
    )
    costed = items.withColumn("units_per_pallet", units).withColumn(
        "storage_cost", F.try_divide(F.lit(per_pallet), F.col("units_per_pallet"))
    )
    return with_group_median(costed, ["line"], "storage_cost", "line_storage_cost")


def stock_coverage(df: DataFrame, as_of: date) -> DataFrame:
    """Stock level, months of coverage and weeks to survive along each forecast vintage.

    ``df`` has at most a few dozen rows per series (item, model, concept, vintage): month, stock, due_qty, demand,
    actual_demand. The opening month starts from its stock; later months lose the demand of the month before and gain
    what arrives. The real level uses actual demand up to the month of ``as_of`` and is the planned level afterwards.
    """
    series = Window.partitionBy(*SERIES).orderBy("month")
    whole = Window.partitionBy(*SERIES)
    running = series.rowsBetween(Window.unboundedPreceding, 0)
    opening = F.col("month") == F.col("vintage")
    lagged = df.withColumns(
        {
            "stock": F.when(opening, F.col("stock")),
            "_planned": F.lag("demand").over(series),
            "_actual": F.lag("actual_demand").over(series),
            "_mean": F.avg("demand").over(whole),
        }
    ).na.fill(0, ["stock", "due_qty", "demand", "actual_demand", "_planned", "_actual", "_mean"])

    def level(out: str, due: bool) -> Column:
        moved = F.when(F.col("stock") != 0, F.col("stock")).otherwise(-F.col(out))
        return F.sum(moved + F.col("due_qty") if due else moved).over(running)

    levels = lagged.withColumns(
        {
            "real_level": clamp(level("_actual", True), 0),
            "level": clamp(level("_planned", True), 0),
            "level_without_receipts": clamp(level("_planned", False), 0),
        }
    )
    later = F.col("month") > F.lit(as_of.replace(day=1))
    return (
        levels.withColumns(
            {
                "coverage_months": F.coalesce(ratio("level", "_mean"), F.lit(0.0)),
                "survive_weeks": F.coalesce(ratio("level_without_receipts", "_mean") * WEEKS_PER_MONTH, F.lit(0.0)),
                "real_level": F.when(later, F.col("level")).otherwise(F.col("real_level")),
            }
        )
        .drop("_planned", "_actual", "_mean")
    )


def replenishment(demand: DataFrame, receipts: DataFrame, items: DataFrame, z: float = SERVICE_FACTOR) -> DataFrame:
    """Economic order quantity, safety stock and reorder point per item.

    ``demand``: item, month, pieces of one year. ``receipts``: item, acquisition_cost, quantity, document_date,
    entry_date. ``items``: item, lead_time (days), min_lot, storage_cost (per unit and year). The order cost is the
    median acquisition cost per unit and the lead-time variance is in months; both count 1 when they are 0.
    """
    monthly = demand.groupBy("item", "month").agg(F.ceil(F.sum("pieces")).cast("double").alias("_s"))
    usage = monthly.groupBy("item").agg(F.avg("_s").alias("mean_demand"), F.var_samp("_s").alias("var_demand"))
    per_unit = receipts.select("item", ratio("acquisition_cost", "quantity").alias("_c"))
    cost = exact_median(per_unit, ["item"], "_c", "order_cost")
    days = F.date_diff("entry_date", "document_date")
    lead = receipts.groupBy("item").agg(F.var_samp(days / 30).alias("var_lead_time"))

    def one(c: str) -> Column:
        return F.when(F.col(c) == 0, 1.0).otherwise(F.col(c))

    def root(c: Column) -> Column:
        return F.when(c >= 0, F.sqrt(c))

    joined = items.join(usage, "item", "left").join(cost, "item", "left").join(lead, "item", "left")
    known = joined.withColumns({"order_cost": one("order_cost"), "var_lead_time": one("var_lead_time")})
    wilson = root(F.try_divide(2 * F.col("mean_demand") * F.col("order_cost"), F.col("storage_cost") / 12))
    lot = F.col("min_lot").try_cast("double")
    months = F.col("lead_time").try_cast("double") / 30
    sigma = root(months * F.col("var_demand") + F.col("mean_demand") * F.col("mean_demand") * F.col("var_lead_time"))
    return (
        known.withColumn("_q", wilson)
        .withColumns(
            {
                "order_qty": F.ceil(F.when(F.col("_q") < lot, lot).otherwise(F.col("_q"))).cast("double"),
                "safety_stock": F.ceil(z * sigma).cast("double"),
            }
        )
        .withColumn("reorder_point", F.ceil(F.col("mean_demand") * months + F.col("safety_stock")).cast("double"))
        .drop("_q")
    )


def stock_alerts(df: DataFrame, *, negative_excess: str = "level") -> DataFrame:
    """Traffic light, excess stock and survival class of each series (item, model, concept, vintage).

    ``df``: the result of ``stock_coverage`` with reorder_point and order_qty. The light counts the months in which the
    level is over 1.2 times the reorder point: up to 1 red, up to 2 amber, else green. Excess is the real level over
    reorder point plus order quantity; a negative excess shows the level (``"zero"``: 0). Survival is that of the first
    month.
    """
    whole = Window.partitionBy(*SERIES)
    enough = F.coalesce(ratio("level", "reorder_point") > 1.2, F.lit(False))
    over = F.col("real_level") - (F.col("reorder_point") + F.col("order_qty"))
    below = F.col("level") if negative_excess == "level" else F.lit(0.0)
    months = F.col("covered_months")
    light = F.when(months <= 1, "RED").when(months <= 2, "AMBER").otherwise("GREEN")
    return (
        df.withColumns(
            {
                "covered_months": F.sum(enough.cast("bigint")).over(whole),
                "survive_weeks": F.min_by("survive_weeks", "month").over(whole),
                "excess": F.when(over < 0, below).otherwise(over),
            }
        )
        .withColumns(
            {
                "light": light,
                "covered_weeks": months * WEEKS_PER_MONTH,
                "opportunity_cost": F.col("excess") * OPPORTUNITY_RATE,
                "survival": bucket("survive_weeks", SURVIVAL_EDGES, SURVIVAL_LABELS),
            }
        )
    )


def classify_stock(df: DataFrame, *, tol: float = TOLERANCE, policy: str = "finished") -> DataFrame:
    """Split stock against its target into up to target, excess and without target, with flag and traffic light.

    ``df``: identifying columns, concept, target, stock. Up to ``tol`` times the target counts as within it (whole
    pieces under the finished policy). A null target counts as no target, 0. Under the raw policy the light grades the
    distance: red above 1.8 times or below 0.3 times the target, amber up to there, green near it; exactly 0.3 is
    amber. Rows without a quantity or a light go.
    """
    raw = policy == "raw"
    known = df.withColumn("target", F.coalesce(F.col("target").cast("double"), F.lit(0.0)))
    stock = F.col("stock").cast("double")
    target = F.col("target")
    limit = target * tol
    none = F.when(target == 0, stock)
    within = F.when(stock <= limit, stock).otherwise(limit)
    if raw:
        unaimed = F.coalesce(none != 0, F.lit(False))
        within = F.when(~unaimed, within)
        excess = F.when(~unaimed, F.when(target > 0, stock - within).otherwise(0.0))
    else:
        within = F.when(F.col("concept") == "PIECES", F.floor(within).cast("double")).otherwise(within)
        excess = F.when(target > 0, stock - within)
    parts = F.array(
        F.struct(F.lit("WITHIN TARGET").alias("part"), within.alias("quantity")),
        F.struct(F.lit("EXCESS").alias("part"), excess.alias("quantity")),
        F.struct(F.lit("NO TARGET").alias("part"), F.when(stock != 0, none).alias("quantity")),
    )
    split = known.select("*", F.inline(parts)).filter(F.col("quantity").isNotNull())
    times = F.col("times_target")
    held = F.col("part") == "WITHIN TARGET"
    flag = (
        F.when(held & (times <= 0.75), "BELOW TARGET")
        .when(held & (times > 0.75) & (times <= tol + 0.001), "ON TARGET")
        .when((F.col("part") == "EXCESS") & (F.col("quantity") > 0), "EXCESS STOCK")
        .otherwise("NO TARGET")
    )
    over, under, good = (F.col("flag") == f for f in ("EXCESS STOCK", "BELOW TARGET", "ON TARGET"))
    if raw:
        light = (
            F.when((over & (times > 1.8)) | (under & (times < 0.3)), "RED")
            .when((over & (times > 1)) | (under & (times < 0.75)), "AMBER")
            .when(over | under | good, "GREEN")
        )
    else:
        light = F.when(over | under, "RED").when(good, "GREEN")
    return (
        split.withColumns({"share": ratio("quantity", "stock"), "times_target": ratio("quantity", "target")})
        .withColumn("flag", flag)
        .withColumn("light", F.coalesce(light, F.when(target == 0, "GREY")))
        .filter(F.col("light").isNotNull())
        .distinct()
    )


def raw_material_stock(
    loads: DataFrame, plant: DataFrame, material: DataFrame, valuation: DataFrame, *, loaded: Sequence[str] = ("loaded_at",)
) -> DataFrame:
    """Opening stock of raw materials by warehouse, in pieces and amounts, with target and reorder point.

    ``loads``: material, plant, warehouse, load_day, units; only loads of the first of a month count. ``plant``:
    material, plant, max_stock, reorder_point. ``material``: material, unit. ``valuation``: material, plant,
    price_control, standard_price, variable_price, price_base. The last three carry the load columns.
    """
    first = loads.filter(F.col("load_day") == F.trunc("load_day", "month"))
    aims = latest_by_key(plant, ["material", "plant"], list(loaded)).select(
        "material", "plant", F.col("max_stock").try_cast("double").alias("max_stock"),
        F.col("reorder_point").try_cast("double").alias("reorder_point"),
    )
    price = F.when(F.col("price_control") == "S", F.col("standard_price")).otherwise(F.col("variable_price"))
    costs = latest_by_key(valuation, ["material", "plant"], list(loaded)).select(
        "material", "plant", ratio(price, "price_base").alias("unit_cost")
    )
    names = latest_by_key(material, ["material"], list(loaded)).select("material", map_unit("unit").alias("unit"))
    sums = (
        first.join(aims, ["material", "plant"], "left")
        .join(costs, ["material", "plant"], "left")
        .join(names, "material", "left")
        .groupBy("material", "plant", "warehouse", F.col("load_day").alias("month"), "unit", "unit_cost")
        .agg(
            F.sum("units").cast("double").alias("stock"),
            F.sum("max_stock").alias("target"),
            F.sum("reorder_point").alias("reorder_point"),
        )
    )
    measures = ["stock", "target", "reorder_point"]
    cells = F.array(
        F.struct(F.lit("PIECES").alias("concept"), *[F.col(m).alias(m) for m in measures]),
        F.struct(F.lit("AMOUNT").alias("concept"), *[(F.col(m) * F.col("unit_cost")).alias(m) for m in measures]),
    )
    out = sums.select("material", "plant", "warehouse", "month", "unit", F.inline(cells))
    return out.withColumn("item", strip_zeros("material", 2)).drop("material").withColumn("period", period("month"))
