"""Purchasing: order indicators, requisitions, info records, goods receipts, order views and the delivery plan.

Tables carry the column names given in each docstring; other columns travel along as identifiers where said so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import has_text, map_code, map_unit, period, ratio, strip_zeros
from millrace.operators.filters import open_items
from millrace.operators.joins import match
from millrace.operators.reshape import measure_reshape
from millrace.operators.snapshots import (
    latest_by_key,
    snapshot_overall,
    snapshot_two_stage,
)

# Condition classes and their labels.
CONDITION_LABELS = {"PB00": "PRECIO_BASE", "FRA1": "FLETE", "FRA2": "EMPAQUE", "ZOA1": "ADUANA"}
# Percent condition classes reported beside the base price.
PERCENT_CONDITIONS = ["ADUANA", "EMPAQUE", "FLETE", "P000", "ZARA", "ZFIM", "ZFNM"]
# Fixed value: end of validity of the conditions in force.
OPEN_END = date(9999, 12, 31)
# Tasks of a stage that holds joins, sums and rankings of an item at once, for each shuffle partition.
FINER = 4


def _dealt(df: DataFrame) -> DataFrame:
    """Rows dealt by order item to ``FINER`` times the session's shuffle partitions."""
    return df.repartition(FINER * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "document", "position")


def service_numbers(history: DataFrame, entry_sheets: DataFrame, kind: str = "D") -> DataFrame:
    """Service of each order item: history rows of one kind with the non-blank service of their entry sheet.

    ``history``: document, position, material_document, history_type. ``entry_sheets``: material_document, service.
    """
    posted = history.filter(F.col("history_type") == kind).select("document", "position", "material_document")
    named = entry_sheets.filter(has_text("service")).select("material_document", "service")
    return _dealt(posted.join(named, "material_document").select("document", "position", "service")).distinct()


def po_indicators(
    header: DataFrame,
    schedule: DataFrame,
    item: DataFrame,
    planning: DataFrame,
    services: DataFrame,
    supplier: DataFrame,
    *,
    ids: Sequence[str] = (),
    local_currency: str = "MXN",
) -> DataFrame:
    """Purchase-order indicators, one row per schedule line and unit (``PIECES``, ``AMOUNT``).

    ``header``: document, document_date, supplier, plant, currency, exchange_rate, release_state. ``schedule``:
    document, position, schedule_line, delivery_date, scheduled_qty. ``item``: document, position, material,
    item_type, price_unit, net_price, net_value. ``planning``: material, plant, planner. ``services``: document,
    position, service. ``supplier``: supplier plus its name and geography. ``ids`` names further columns to keep.

    Quantities are summed; prices and rates averaged; missing ones are 0, so the local amount of a foreign order's
    piece row is 0 as well. Items of type ``9`` are services and take the service number as material.

    Schedule lines, items and services are dealt by item; their joins, the sums and what follows on the key of an item
    run in one stage without another shuffle. As a task holds them all at once, they are dealt to ``FINER`` times the
    session's shuffle partitions. So that whole lines need not travel to the planners, the planners of a material, one
    for each of its plants, come with its items, and the header's plant picks among them.
    """
    named = [c for c in planning.columns if c not in ("material", "plant")]
    planners = planning.groupBy("material").agg(F.collect_list(F.struct("plant", F.struct(*named).alias("p"))).alias("_planners"))
    items = item.join(planners, "material", "left")
    # Dealt by the key of the join with the headers before repeated lines are sorted out.
    lines = header.join(schedule.repartition("document").distinct(), "document", "left")
    joined = _dealt(lines).join(_dealt(items), ["document", "position"], "left").join(_dealt(services), ["document", "position"], "left")
    here = F.filter("_planners", lambda r: r["plant"] == F.col("plant"))
    planned = joined.withColumn("_p", F.explode_outer(here)).select("*", "_p.p.*").drop("_planners", "_p")
    is_service = F.col("item_type").eqNullSafe("9")
    facts = planned.withColumns(
        {
            "purchase_type": F.when(is_service, "SERVICE").otherwise("MATERIAL"),
            "material": F.when(is_service, F.col("service")).otherwise(F.col("material")),
            "release_state": F.trim("release_state"),
            "piece_price": F.col("net_price"),
        }
    )
    keys = [
        "document", "document_date", "position", "schedule_line", "material", "purchase_type", "supplier", "plant",
        "currency", "release_state", "price_unit", "planner", "delivery_date", *ids,
    ]
    measures = {
        "scheduled_qty": {"unit": "PIECES", "kind": "quantity"},
        "net_value": {"unit": "AMOUNT", "kind": "quantity"},
        "piece_price": {"unit": "PIECES", "kind": "price"},
        "net_price": {"unit": "AMOUNT", "kind": "price"},
        "exchange_rate": {"unit": "AMOUNT", "kind": "rate"},
    }
    averaged = ["piece_price", "net_price", "exchange_rate"]
    out = measure_reshape(facts, keys, measures, "kind", averaged).na.fill(0, ["quantity", "price", "rate"])
    local = F.when(F.col("currency") == local_currency, F.col("quantity")).otherwise(F.col("quantity") * F.col("rate"))
    return out.withColumns(
        {"local_amount": local, "month": period("delivery_date"), "price_unit": map_unit("price_unit")}
    ).join(supplier, "supplier", "left")


def requisitions(
    req: DataFrame,
    assign: DataFrame,
    planner: DataFrame,
    *,
    ids: Sequence[str],
    loaded: Sequence[str] = ("loaded_at",),
    status: str = "5",
) -> DataFrame:
    """Open requisition items, ordered / price / requested by unit.

    ``req``: requisition, position, status, deleted, plant, planner_code, unit_of_measure, supplier, material,
    ordered_qty, release_value, valuation_price, requested_qty, load time. ``assign``: requisition, position.
    ``planner``: planner_code, plant, planner. Newest version per item, with the status and not flagged ``X`` (a
    null flag counts as not deleted). Account assignments multiply the sums of an item, one share per assignment.
    """
    is_live = (F.col("status") == status) & ~F.coalesce(F.col("deleted").contains("X"), F.lit(False))
    # Rows that are not live only compete for their item, so they travel to it without their values.
    ranked = {"requisition", "position", *loaded}
    rest = [c for c in req.columns if c not in {*ranked, "status", "deleted"}]
    lean = req.select(*[c for c in req.columns if c in ranked], is_live.alias("_live"), *[F.when(is_live, F.col(c)).alias(c) for c in rest])
    live = latest_by_key(lean, ["requisition", "position"], list(loaded)).filter("_live")
    # Only the number of assignments matters, so they are counted before the join instead of multiplying rows.
    shares = assign.groupBy("requisition", "position").agg(F.count(F.lit(1)).alias("_n"))
    joined = live.join(planner, ["planner_code", "plant"], "left").join(shares, ["requisition", "position"], "left")
    values = ["ordered_qty", "release_value", "valuation_price", "requested_qty"]
    counted = joined.withColumns({v: F.col(v) * F.coalesce(F.col("_n"), F.lit(1)) for v in values})
    measures = {
        "ordered_qty": {"unit": "PIECES", "kind": "ordered"},
        "release_value": {"unit": "AMOUNT", "kind": "ordered"},
        "valuation_price": {"unit": "AMOUNT", "kind": "price"},
        "requested_qty": {"unit": "PIECES", "kind": "requested"},
    }
    keys = ["requisition", "position", "material", "supplier", "unit_of_measure", "planner", *ids]
    out = measure_reshape(counted, keys, measures, "kind")
    return out.withColumns(
        {
            "unit_of_measure": map_unit("unit_of_measure"),
            "supplier": strip_zeros("supplier"),
            "material": strip_zeros("material"),
        }
    )


def info_records(
    info: DataFrame,
    org: DataFrame,
    material: DataFrame,
    index: DataFrame,
    amounts: DataFrame,
    supplier: DataFrame,
    region: DataFrame,
    *,
    labels: Mapping[str, str] = CONDITION_LABELS,
    percent_classes: Sequence[str] = PERCENT_CONDITIONS,
    base_class: str = "PRECIO_BASE",
) -> tuple[DataFrame, DataFrame]:
    """Supplier info records: the newest per record with its geography, and its conditions side by side.

    ``info``: record, supplier, material, country, region. ``org``: record, plant, purchasing_org, record_type,
    net_price, effective_price, currency. ``material``: material, material_group. ``index``: supplier, material,
    purchasing_org, record_type, plant, valid_from, valid_to, condition_no. ``amounts``: condition_no, class, value,
    unit. ``supplier``: supplier, supplier_name. ``region``: country, region, country_name, region_name.

    The second table has the base price and every percent class per condition; as before, only conditions with both
    an amount row and a percent row appear, but null key parts no longer drop a condition.
    """
    in_force = index.filter(F.col("valid_to") == F.lit(OPEN_END))
    at = ["supplier", "material", "purchasing_org", "record_type", "plant"]
    report = [
        "record", "supplier", "material", "purchasing_org", "plant", "country", "region", "net_price",
        "effective_price", "currency", "material_group", "valid_from",
    ]
    def recorded(rows: DataFrame) -> DataFrame:
        # The index leads, so that wide records are shuffled only where an index row wants them.
        wanted = rows.join(info, ["supplier", "material"])
        return wanted.join(org, ["record", "purchasing_org", "record_type", "plant"]).join(material, "material")

    # Conditions do not change which record is the newest, so the index is cut to its newest day before the join.
    # What is left has one row per record and plant, so that a ranking holds no large group.
    days = in_force.groupBy(*at).agg(F.max("valid_from").alias("valid_from")).filter(F.col("valid_from").isNotNull())
    rank = F.rank().over(Window.partitionBy("record").orderBy(F.desc("valid_from")))
    newest = recorded(days).withColumn("_rank", rank).filter(F.col("_rank") == 1)
    latest = newest.select(*report).distinct().join(supplier, "supplier", "left").join(region, ["country", "region"])

    keys = [
        "condition_no", "record", "supplier", "material", "purchasing_org", "record_type", "plant", "country", "region",
        "net_price", "effective_price", "currency", "material_group", "valid_from", "valid_to",
    ]
    # Amounts are put side by side and joined to the narrow index first; the wide records meet only what is left.
    classed = amounts.withColumn("class", map_code("class", labels, F.col("class")))
    percent = F.col("unit") == "%"
    cells = [F.min(F.when(percent & (F.col("class") == c), F.col("value"))).alias(c) for c in percent_classes]
    priced = classed.groupBy("condition_no").agg(
        F.min(F.when(~percent, F.col("unit"))).alias("condition_currency"),
        F.min(F.when(~percent & (F.col("class") == base_class), F.col("value"))).alias(base_class),
        *cells,
        F.count(F.when(percent, 1)).alias("_percents"),
        F.count(F.when(~percent, 1)).alias("_amounts"),
    )
    both = priced.filter((F.col("_percents") > 0) & (F.col("_amounts") > 0)).drop("_percents", "_amounts")
    found = recorded(in_force.join(both, "condition_no"))
    measures = ["condition_currency", base_class, *percent_classes]
    both = found.select(*keys, *measures).distinct()
    return latest, both


def signed(value: Column | str, movement: Column | str, minus: Sequence[int]) -> Column:
    """Value with the sign of its movement: reversals count negative."""
    v = F.col(value) if isinstance(value, str) else value
    m = F.col(movement) if isinstance(movement, str) else movement
    return F.when(m.isin(*minus), -v).otherwise(v)


def goods_receipts(
    mov: DataFrame,
    *,
    keys: Sequence[str] = ("movement_id",),
    loaded: Sequence[str] = ("loaded_at",),
    plus: Sequence[int] = (101,),
    minus: Sequence[int] = (102,),
) -> DataFrame:
    """Goods receipts by document, position, plant and posting day, in pieces and amounts.

    ``mov``: the key columns, document, position, plant, movement, posting_date, quantity, local_value, load time.
    Newest version per key; reversal movements count negative; the price is value over quantity (null at 0). The
    amount row also carries the quantity as ``supplier_qty``.
    """
    newest = latest_by_key(mov, list(keys), list(loaded)).filter(F.col("movement").isin(*plus, *minus))
    sums = newest.groupBy("document", "position", "plant", "posting_date").agg(
        F.sum(signed("quantity", "movement", minus)).cast("double").alias("qty"),
        F.sum(signed("local_value", "movement", minus)).cast("double").alias("value"),
    )
    none = F.lit(None).cast("double")
    price = ratio("value", "qty")
    def row(unit: str, receipts: str, supplier_qty: Column) -> Column:
        return F.struct(
            F.lit(unit).alias("unit"), F.col(receipts).alias("receipts"), supplier_qty.alias("supplier_qty"),
            F.col("_p").alias("receipt_price"),
        )

    rows = F.array(row("PIECES", "qty", none), row("AMOUNT", "value", F.col("qty")))
    out = sums.withColumn("_p", price).select("document", "position", "plant", "posting_date", F.inline(rows))
    return out.withColumn("month", period("posting_date"))


def order_views(
    indicators: DataFrame, catalogue: DataFrame, *, deny: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ordered lines and the order pivot, from purchase-order indicators.

    ``indicators``: the result of ``po_indicators`` with ``material_group`` among its ids. ``catalogue``: material_id,
    plant, material_text. A missing or blank material is a service; services get the id material-group. The pivot has
    one row per document and position: greatest material, mean price. ``deny`` lists documents to leave out. Of several
    texts of a material in a plant the greatest counts.

    The newest row of an item is chosen where its indicators are, and only that row travels to the catalogue.
    """
    stripped = strip_zeros("material")
    blank = ~F.coalesce(has_text("_m"), F.lit(True))
    facts = (
        indicators.withColumn("_m", stripped)
        .withColumns(
            {
                "purchase_type": F.when(blank, "SERVICE").otherwise(F.col("purchase_type")),
                "material": F.when(F.col("_m").isNull() | blank, "SERVICE").otherwise(F.col("_m")),
            }
        )
        .drop("_m")
    )
    is_service = F.col("purchase_type") == "SERVICE"
    facts = facts.withColumns(
        {
            "material_id": F.when(is_service, F.concat("material", F.lit("-"), "material_group")).otherwise(F.col("material")),
            "entry_month": period("delivery_date"),
        }
    )
    document_month = period("document_date").alias("document_month")
    ordered = facts.select(
        "document", "position", "schedule_line", "document_date", "plant", "delivery_date", "quantity", "price",
        "rate", "unit", "local_amount", "entry_month", document_month,
    )
    kept = facts if deny is None else facts.join(deny, "document", "left_anti")
    by = [
        "supplier", "document", "document_date", "delivery_date", "position", "price_unit", "currency",
        "release_state", "plant", "planner", "material_group", "purchase_type",
    ]
    pivoted = kept.groupBy(*by).agg(
        F.max("material").alias("material"), F.max("material_id").alias("material_id"), F.avg("price").alias("price")
    )
    one = latest_by_key(
        pivoted, ["document", "position", "material", "material_id"],
        ["delivery_date", "price", "document_date", "supplier", "plant", "price_unit", "currency", "release_state", "planner"],
    )
    texts = catalogue.groupBy("material_id", "plant").agg(F.max("material_text").alias("material_text"))
    named = match(one, texts, ["material_id", "plant"])
    views = named.select(*by, document_month, "material", "material_id", "price", "material_text")
    return ordered, views.withColumn("supplier", strip_zeros("supplier"))


def delivery_plan(
    header: DataFrame, item: DataFrame, schedule: DataFrame, as_of: date, snapshot: str = "first"
) -> DataFrame:
    """Open deliveries by month and material.

    ``header``: document (of the plants wanted). ``item``: document, position, material, deleted, complete.
    ``schedule``: document, position, schedule_line, delivery_date, scheduled_qty, delivered_qty, loaded_at.

    ``snapshot="first"`` takes the first load of the newest month: net quantities are not below 0 and everything due
    by the end of the month of ``as_of`` falls into that month. ``"last"`` takes the newest load: everything due by
    the day before ``as_of`` falls into that day's month, and net quantities are left as they are. The net quantity is
    ordered less delivered, or the ordered quantity where that is not positive. The month end is a calendar month end
    in December too.
    """
    dated = schedule.withColumn("_load", F.to_date("loaded_at"))
    if snapshot == "first":
        loads = snapshot_two_stage(dated, "_load", "month", "min")
        cutoff = as_of.replace(day=1) + relativedelta(months=1) - timedelta(days=1)
    elif snapshot == "last":
        loads = snapshot_overall(dated, "_load", "max")
        cutoff = as_of - timedelta(days=1)
    else:
        raise ValueError("snapshot is 'first' or 'last'")
    rows = loads.select(
        "document", "position", "schedule_line",
        F.coalesce(F.col("delivery_date").cast("date"), F.lit(date(1900, 1, 1))).alias("day"),
        F.coalesce(F.col("scheduled_qty"), F.lit(0)).alias("ordered"),
        F.coalesce(F.col("delivered_qty"), F.lit(0)).alias("delivered"),
    ).distinct()
    net = F.when(F.col("ordered") > 0, F.col("ordered") - F.col("delivered")).otherwise(F.col("ordered"))
    if snapshot == "first":
        net = F.greatest(net, F.lit(0))
    month = F.when(F.col("day") <= F.lit(cutoff), F.lit(f"{cutoff:%Y-%m}")).otherwise(period("day"))
    # Summed per position before the join, so the join carries one row per position and month.
    due = rows.groupBy("document", "position", month.alias("month")).agg(F.sum(net).alias("quantity"))
    live = open_items(item, "deleted", "complete").select("document", "position", strip_zeros("material").alias("item"))
    wanted = header.select("document").distinct().join(live.distinct(), "document", "left")
    plan = wanted.join(due, ["document", "position"], "left")
    return plan.groupBy("month", "item").agg(F.sum("quantity").alias("quantity")).withColumn("concept", F.lit("PIECES"))
