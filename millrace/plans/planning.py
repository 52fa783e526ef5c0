"""Planning inputs and the monthly planning spine. Months are dates (first of the month)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import extract_period, month_start, ratio, strip_zeros
from millrace.operators.joins import append_missing, cross_spine, left_join_all
from millrace.operators.snapshots import latest_by_key
from millrace.plans.purchasing import signed

PIECES = "PIECES"
AMOUNT = "AMOUNT"


def fiscal_prices(valuation: DataFrame, loaded: Sequence[str] = ("loaded_at",)) -> DataFrame:
    """Fiscal price by item and month: the newest non-zero price of each month.

    ``valuation``: item, fiscal_price, load columns of which the first is the load time.
    """
    priced = valuation.filter(F.col("fiscal_price") != 0).withColumns(
        {"item": strip_zeros("item", 2), "month": month_start(loaded[0])}
    )
    return latest_by_key(priced, ["item", "month"], list(loaded)).select("item", "month", "fiscal_price")


def unit_costs(stock: DataFrame, fiscal: DataFrame, consigned: str = "CONSIGNED") -> DataFrame:
    """Opening stock with its unit cost: value over units; consigned stock takes the fiscal price.

    ``stock``: item, month, ownership, units, value. A consigned item without a price in the month takes its lowest
    fiscal price of all months.

    The prices of an item, one for each month, come side by side with its stock, so that the stock is shuffled once and
    the prices are worked out once.
    """
    prices = fiscal.groupBy("item").agg(
        F.collect_list(F.struct("month", "fiscal_price")).alias("_prices"), F.min("fiscal_price").alias("_lowest")
    )
    here = F.filter("_prices", lambda p: p["month"] == F.col("month"))
    priced = stock.join(prices, "item", "left").withColumn("_price", F.explode_outer(here))
    own = F.coalesce(ratio("value", "units"), F.lit(0.0))
    fiscal_cost = F.coalesce("_price.fiscal_price", "_lowest").cast("double")
    cost = F.when(F.col("ownership") == consigned, fiscal_cost).otherwise(own)
    return priced.withColumn("unit_cost", cost).drop("_prices", "_price", "_lowest")


def _both_units(df: DataFrame, ids: Sequence[str], pieces: Column, amount: Column, name: str) -> DataFrame:
    rows = F.array(
        F.struct(F.lit(PIECES).alias("concept"), pieces.cast("double").alias(name)),
        F.struct(F.lit(AMOUNT).alias("concept"), amount.cast("double").alias(name)),
    )
    return df.select(*ids, F.inline(rows))


def stock_positions(
    opening: DataFrame, closing: DataFrame, fiscal: DataFrame, consigned: str = "CONSIGNED"
) -> tuple[DataFrame, DataFrame]:
    """Opening and closing stock by item, month and concept.

    ``opening`` and ``closing``: item, month, ownership, units, value. The closing amount is the closing units at the
    opening unit cost of the same ownership, summed over ownerships, so an item has one row per month and concept.
    """
    costs = unit_costs(opening, fiscal, consigned)
    # Different values of an item and month are gathered before the rows double. Adding 0 makes one of both zeros.
    values = {PIECES: F.col("units").cast("double"), AMOUNT: (F.col("units") * F.col("unit_cost")).cast("double")}
    kinds = [F.collect_set(F.struct((v + F.lit(0.0)).alias("stock"))).alias(c) for c, v in values.items()]

    def tagged(concept: str) -> Column:
        return F.transform(concept, lambda v: F.struct(F.lit(concept).alias("concept"), v["stock"].alias("stock")))

    each = [tagged(c) for c in values]
    start = costs.groupBy("item", "month").agg(*kinds).select("item", "month", F.inline(F.concat(*each)))
    by = ["item", "month", "ownership"]
    ends = closing.groupBy(*by).agg(F.sum("units").cast("double").alias("units"))
    cost = costs.groupBy(*by).agg(F.max("unit_cost").alias("unit_cost"))
    valued = ends.join(cost, by, "left").withColumn("amount", F.col("units") * F.col("unit_cost"))
    total = valued.groupBy("item", "month").agg(F.sum("units").alias("units"), F.sum("amount").alias("amount"))
    return start, _both_units(total, ["item", "month"], F.col("units"), F.col("amount"), "stock_closing")


def reuse_november(df: DataFrame, vintage: str = "vintage", target: str = "target", applies: Column | None = None) -> DataFrame:
    """December rule: December vintages go; November's serve as December's, without their November target.

    ``applies`` limits the rule to some rows. Each row is expanded in place; there is no second pass over the table.
    """
    rule = F.lit(True) if applies is None else applies
    again = F.when(rule & (F.month(vintage) == 11) & (F.month(target) != 11), F.add_months(vintage, 1))
    own = F.when(~(rule & (F.month(vintage) == 12)), F.col(vintage))
    kept = F.filter(F.array(own, again), lambda v: v.isNotNull())
    return df.withColumn("_v", F.explode(kept)).drop(vintage).withColumnRenamed("_v", vintage)


def forecast_vintages(plan: DataFrame, memo: DataFrame, *, piece_kind: str = "U_PRONO", thousands: float = 1000) -> DataFrame:
    """Forecast values by item, vintage month, target month and concept.

    ``plan``: item, target, kind, value, version (text that starts with the day). ``memo``: the same and any group
    columns. Of the plan, the newest version per item, target and concept counts; of the memo, the values of a version
    are summed and the newest version per item, vintage, target and kind counts. Targets before the vintage go;
    amounts are in thousands.
    """
    concept = F.when(F.col("kind") == piece_kind, PIECES).otherwise(AMOUNT)

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {"vintage": extract_period("version").cast("date"), "target": month_start("target"), "concept": concept}
        )

    newest_plan = latest_by_key(dated(plan), ["item", "target", "concept"], ["version"])
    groups = [c for c in memo.columns if c not in ("value", "target")]
    summed = dated(memo).groupBy(*groups, "target", "vintage", "concept").agg(F.sum("value").alias("value"))
    rest = [c for c in groups if c not in ("item", "kind", "version")]
    newest_memo = latest_by_key(summed, ["item", "vintage", "target", "kind"], ["version", *rest])
    columns = ["item", "vintage", "target", "concept", "value"]
    rows = newest_memo.select(*columns).unionByName(newest_plan.select(*columns))
    total = rows.groupBy("item", "vintage", "target", "concept").agg(F.sum("value").cast("double").alias("value"))
    scaled = F.when(F.col("concept") == AMOUNT, F.col("value") * thousands).otherwise(F.col("value"))
    valid = total.filter(F.col("target") >= F.col("vintage")).withColumn("value", scaled)
    return reuse_november(valid)


def unconstrained_demand(vintages: DataFrame, as_of: date) -> DataFrame:
    """Demand by item, month and concept: the newest vintage before the month of ``as_of``."""
    earlier = vintages.filter(F.col("vintage") < F.lit(as_of.replace(day=1)))
    newest = latest_by_key(earlier, ["item", "target", "concept"], ["vintage"])
    return newest.select(
        "item", F.col("target").alias("month"), "concept", F.coalesce("value", F.lit(0.0)).alias("demand")
    )


def yearly_targets(df: DataFrame, years: Mapping[int, Mapping[str, str]]) -> DataFrame:
    """Stock targets of whole years, one row per item, month and concept.

    ``years`` names, per year and concept, the column that holds the target. Months are expanded in place.
    """
    cells = [
        F.struct(F.lit(date(year, m, 1)).alias("month"), F.lit(concept).alias("concept"), F.col(column).cast("double").alias("target_stock"))
        for year, columns in years.items()
        for concept, column in columns.items()
        for m in range(1, 13)
    ]
    return df.withColumn("item", strip_zeros("item")).select("item", F.inline(F.array(*cells)))


def stock_by_group(
    df: DataFrame,
    costs: DataFrame,
    groups: Mapping[str, Sequence[str]],
    *,
    statuses: Sequence[str],
    any_status: Sequence[str] = (),
    consigned: str = "CONSIGNED",
    own: str = "OWN",
) -> DataFrame:
    """Stock by item, month and concept in one column per warehouse group.

    ``df``: item, month, warehouse, status, ownership, concept, stock. ``costs``: item, month, unit_cost. A group
    counts the given statuses, or all of them when it is in ``any_status``. Amounts are the own amount rows plus
    consigned pieces at unit cost. Channels are summed.
    """
    priced = df.join(costs, ["item", "month"], "left")
    is_pieces = F.col("concept") == PIECES
    is_amount = (F.col("concept") == AMOUNT) & (F.col("ownership") == own)
    stock = F.col("stock").cast("double")
    as_is = F.when(is_pieces | is_amount, F.struct(F.col("concept").alias("c"), stock.alias("s")))
    valued = F.when(
        is_pieces & (F.col("ownership") == consigned),
        F.struct(F.lit(AMOUNT).alias("c"), (stock * F.col("unit_cost").cast("double")).alias("s")),
    )
    rows = priced.select(
        "item", "month", "warehouse", "status", F.inline(F.filter(F.array(as_is, valued), lambda r: r.isNotNull()))
    )
    sums = []
    for name, warehouses in groups.items():
        cond = F.col("warehouse").isin(*warehouses)
        if name not in any_status:
            cond = cond & F.col("status").isin(*statuses)
        sums.append(F.sum(F.when(cond, F.col("s"))).alias(name))
    return rows.groupBy("item", "month", F.col("c").alias("concept")).agg(*sums)


def budget(df: DataFrame, exclude_years: Sequence[int], marker: str | None = None, suffix_length: int = 3) -> DataFrame:
    """Budget by item, month and concept.

    ``df``: item, product_key, month, concept, budget. Items whose id contains ``marker`` (not yet numbered products)
    take the product key without its suffix.
    """
    rows = df.filter(~F.year("month").isin(*exclude_years))
    if marker is not None:
        key = F.col("product_key")
        short = F.left(key, F.greatest(F.length(key) - suffix_length, F.lit(0)))
        rows = rows.withColumn("item", F.when(F.col("item").contains(marker), short).otherwise(F.col("item")))
    return rows.groupBy("item", "month", "concept").agg(F.sum("budget").alias("budget"))


def demand_prices(demand: DataFrame) -> DataFrame:
    """Demand price by item and month: of the month, and of its whole year.

    ``demand``: item, month, concept, demand. Months are summed once; the year totals come from the month totals.
    """
    pieces = F.sum(F.when(F.col("concept") == PIECES, F.col("demand")))
    amount = F.sum(F.when(F.col("concept") == AMOUNT, F.col("demand")))
    monthly = demand.groupBy("item", "month").agg(pieces.alias("_p"), amount.alias("_a"))
    by_month = monthly.withColumn("_year", F.year("month"))
    yearly = by_month.groupBy("item", "_year").agg(F.sum("_p").alias("_yp"), F.sum("_a").alias("_ya"))
    return by_month.join(yearly, ["item", "_year"]).select(
        "item", "month", ratio("_a", "_p").alias("monthly_price"), ratio("_ya", "_yp").alias("annual_price")
    )


def receipts_for_planning(
    mov: DataFrame,
    costs: DataFrame,
    plant: str,
    *,
    excluded_warehouses: Sequence[str] = (),
    plus: Sequence[int] = (101, 311),
    minus: Sequence[int] = (102, 312),
    keys: Sequence[str] = ("movement_id",),
    loaded: Sequence[str] = ("loaded_at",),
    signed_pieces: bool = True,
) -> DataFrame:
    """Received stock by item, month and concept, amounts at the unit cost of the month.

    ``mov``: key and load columns, material, plant, warehouse, movement, entry_date, quantity. ``costs``: item, month,
    unit_cost. Reversals count negative in pieces and amounts; ``signed_pieces=False`` adds them, as older reports did.
    """
    newest = latest_by_key(mov, list(keys), list(loaded))
    rows = newest.filter((F.col("plant") == plant) & F.col("movement").isin(*plus, *minus))
    if excluded_warehouses:
        rows = rows.filter(~F.coalesce(F.col("warehouse").isin(*excluded_warehouses), F.lit(False)))
    quantity = signed("quantity", "movement", minus) if signed_pieces else F.col("quantity")
    sums = rows.groupBy(strip_zeros("material", 2).alias("item"), month_start("entry_date").alias("month")).agg(
        F.sum(quantity).cast("double").alias("_q")
    )
    valued = sums.join(costs, ["item", "month"], "left")
    return _both_units(valued, ["item", "month"], F.col("_q"), F.col("_q") * F.col("unit_cost").cast("double"), "receipts")


def main_supplier(records: DataFrame, plant: str) -> DataFrame:
    """One supplier per item: the greatest id among the item's info records of a plant, with its names.

    ``records``: material, plant, supplier, supplier_name, country_name, region_name.
    """
    named = F.struct("supplier", "supplier_name", "country_name", "region_name")
    return (
        records.filter(F.col("plant") == plant)
        .groupBy(strip_zeros("material", 2).alias("item"))
        .agg(F.max(named).alias("_s"))
        .select("item", "_s.*")
    )


def planning_items(catalogue: DataFrame, products: DataFrame) -> DataFrame:
    """Catalogue items plus products that the catalogue lacks."""
    return append_missing(catalogue, products, ["item"])


def planning_spine(
    items: DataFrame,
    months: Sequence[date],
    measures: Iterable[tuple[DataFrame, Sequence[str]]],
    *,
    target: str = "target_stock",
    max_stock: str = "max_stock",
) -> DataFrame:
    """Items by month and concept with all measures beside them.

    ``items``: item, max_stock and any attributes. Every measure table is unique on its keys (item, month and concept,
    or some of them). The stock target falls back to the plant's maximum stock.

    Measures per item are joined before the items are expanded to months, and those per item and month before the
    expansion to concepts, so that each join shuffles the shortest spine that has its keys.
    """
    parts = [(df, frozenset(keys), list(keys)) for df, keys in measures]
    by_item = [(df, keys) for df, known, keys in parts if known == {"item"}]
    by_month = [(df, keys) for df, known, keys in parts if "month" in known and "concept" not in known]
    by_concept = [(df, keys) for df, known, keys in parts if "concept" in known]
    spine = cross_spine(left_join_all(items, by_item), months)
    spine = left_join_all(spine, by_month)
    concepts = F.explode(F.array(F.lit(PIECES), F.lit(AMOUNT)))
    out = left_join_all(spine.withColumn("concept", concepts), by_concept)
    if target in out.columns:
        out = out.withColumn(target, F.coalesce(F.col(target), F.col(max_stock)).cast("double"))
    return out
