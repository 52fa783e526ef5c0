"""Order status: backlog snapshots, cubes and the measures that planning takes from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import composite_key, key_timestamp, period, ratio, strip_zeros
from millrace.operators.joins import match
from millrace.operators.reshape import measure_reshape
from millrace.operators.snapshots import snapshot_per_group

# Document classes that count as orders.
ORDER_CLASSES = ["ZOMI", "ZOME", "ZOMO"]
MEASURES = ["pieces", "billed_pieces", "rejected_pieces", "backlog_pieces"]
AMOUNTS = ["amount", "billed_amount", "rejected_amount", "backlog_amount"]


def order_status(
    df: DataFrame,
    client: str,
    *,
    channels: Sequence[str] = ("MI", "ME", "MO"),
    domestic: str = "MI",
    order_classes: Sequence[str] = ORDER_CLASSES,
) -> DataFrame:
    """Order status on the last recorded day of each month, per customer, material, channel and promised day.

    ``df``: client, registered, promised, customer, material, order_class, channel, rate, loaded_at, and four piece
    and four amount measures. Of each recorded day only the newest load counts. Foreign amounts are divided by the
    rate (0 for the domestic channel). Backlog promised after the recorded day is 0; ordered and rejected measures
    count for order classes only.

    The last day of each month is chosen before the sums, since all sums are per day. It is read off one aggregate by
    day: a day counts if its newest load holds wanted rows. That leaves one row per calendar month, which is broadcast;
    the facts are then read once more, filtered to those loads.
    """
    wanted = (F.col("client") == client) & F.col("channel").isin(*channels)
    days = df.groupBy("registered").agg(
        F.max("loaded_at").alias("loaded_at"), F.max(F.when(wanted, F.col("loaded_at"))).alias("_wanted")
    )
    held = days.filter(F.col("loaded_at") == F.col("_wanted")).filter(F.col("registered").isNotNull())
    last = held.groupBy(period("registered")).agg(F.max(F.struct("registered", "loaded_at")).alias("_l")).select("_l.*")
    closing = match(df.filter(wanted), F.broadcast(last), ["registered", "loaded_at"], "left_semi").withColumn("month", period("registered"))

    due = ~F.coalesce(F.col("promised") > F.col("registered"), F.lit(False))
    is_order = F.coalesce(F.col("order_class").isin(*order_classes), F.lit(False))
    abroad = F.col("channel") != domestic
    sums = []
    for measure in [*MEASURES, *AMOUNTS]:
        rule = due if measure.startswith("backlog") else None if measure.startswith("billed") else is_order
        value = F.col(measure)
        kept = value if rule is None else F.when(rule, value).otherwise(0)
        sums.append(F.sum(kept).alias(measure))
        if measure in AMOUNTS:
            dollars = F.when(abroad, ratio(measure, "rate")).otherwise(0.0)
            kept = dollars if rule is None else F.when(rule, dollars).otherwise(0.0)
            sums.append(F.sum(kept.cast("decimal(28,8)")).alias(f"{measure}_usd"))
    out = closing.groupBy("month", "registered", "promised", "channel", "customer", "material").agg(*sums)
    return out.withColumn("material", strip_zeros("material"))


def order_status_cube(df: DataFrame, materials: DataFrame) -> DataFrame:
    """Order status by product line: sales, orders, rejected and backlog side by side, per unit and currency.

    ``materials``: material, channel, system, line, line_group, class. Pieces are their own currency.
    """
    joined = df.join(materials, ["material", "channel"])
    ids = ["month", "registered", "promised", "channel", "customer", "system", "line", "line_group", "class"]
    kinds = {"billed": "SALES", "rejected": "REJECTED", "backlog": "BACKLOG"}
    tags = {}
    for measure in [*MEASURES, *AMOUNTS]:
        kind = kinds.get(measure.split("_")[0], "ORDERS")
        if measure in MEASURES:
            tags[measure] = {"unit": "PIECES", "currency": "PIECES", "kind": kind}
        else:
            tags[measure] = {"unit": "AMOUNT", "currency": "MXN", "kind": kind}
            tags[f"{measure}_usd"] = {"unit": "AMOUNT", "currency": "USD", "kind": kind}
    cube = measure_reshape(joined, ids, tags, "kind")
    return cube.withColumns(
        {
            "product_id": composite_key("system", "line", "class", "channel"),
            "customer_id": composite_key("customer", "channel"),
        }
    )


def orders_for_planning(df: DataFrame, amounts_as_pieces: bool = False) -> DataFrame:
    """Orders, sales and backlog by item and month, in pieces and amounts.

    ``df``: item, month and the six measures below. ``amounts_as_pieces`` adds the ordered amount to the ordered
    pieces instead, as older reports did.
    """
    tags = {
        "billed_pieces": {"concept": "PIECES", "kind": "sales"},
        "billed_amount": {"concept": "AMOUNT", "kind": "sales"},
        "pieces": {"concept": "PIECES", "kind": "orders"},
        "amount": {"concept": "PIECES" if amounts_as_pieces else "AMOUNT", "kind": "orders"},
        "backlog_pieces": {"concept": "PIECES", "kind": "backlog"},
        "backlog_amount": {"concept": "AMOUNT", "kind": "backlog"},
    }
    return measure_reshape(df, ["item", "month"], tags, "kind")


def opening_closing(df: DataFrame, keys: Sequence[str], month: str, measures: Sequence[str], suffix: str = "_closing") -> DataFrame:
    """Month measures as closing values of their month and opening values of the next, one row per key and month.

    ``df`` is unique per key and month (a date). Each row is expanded into its two views and grouped, so later joins
    find one table and not two.
    """
    none = F.lit(None).cast("double")
    value = {m: F.col(m).cast("double") for m in measures}
    closing = F.struct(F.col(month).alias(month), *[none.alias(m) for m in measures], *[v.alias(f"{m}{suffix}") for m, v in value.items()])
    opening = F.struct(
        F.add_months(month, 1).alias(month), *[v.alias(m) for m, v in value.items()], *[none.alias(f"{m}{suffix}") for m in measures]
    )
    both = df.select(*keys, F.inline(F.array(closing, opening)))
    aggs = [F.max(c).alias(c) for c in [*measures, *[f"{m}{suffix}" for m in measures]]]
    return both.groupBy(*keys, month).agg(*aggs)


def reserved_orders(df: DataFrame, plant: str) -> DataFrame:
    """Reserved pieces by item and month, as on the last day of each month.

    ``df``: header_key (``yyyyMMddHHmmss`` text), position_key, plant, material, remaining_qty. The last day is that
    of all plants; repeated rows count once.
    """
    dated = df.withColumn("_day", key_timestamp("header_key").cast("date")).withColumn("month", period("_day"))
    closing = snapshot_per_group(dated, ["month"], "_day", calendar_groups=True).distinct().filter(F.col("plant") == plant)
    sums = closing.groupBy("material", "month").agg(F.sum("remaining_qty").alias("reserved_qty"))
    return sums.select(strip_zeros("material").alias("item"), "month", "reserved_qty", F.lit("PIECES").alias("concept"))
