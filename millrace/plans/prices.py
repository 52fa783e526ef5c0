"""Price lists.

Both lists end by asking for a status that only the catalogue has, so rows without a catalogue entry cannot survive.
The outer joins of such a list are therefore plain inner joins here, filtered before they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import map_unit, pad_key, strip_zeros
from millrace.operators.snapshots import latest_by_key

# Article statuses of the export and of the domestic list.
EXPORT_STATUSES = ["99", "97", "95", "93"]
DOMESTIC_STATUSES = ["99", "95"]
AMOUNT_KEYS = ["condition_class", "application", "condition_no"]


def latest_conditions(
    conditions: DataFrame, keys: Sequence[str], condition_class: str = "ZPR0", order_by: Sequence[str] = ("valid_from", "loaded_at")
) -> DataFrame:
    """Newest condition per key by start of validity, then by load; condition and customer numbers at full length."""
    own = conditions.filter(F.col("condition_class") == condition_class)
    padded = {c: pad_key(c) for c in ("condition_no", "customer") if c in own.columns}
    return latest_by_key(own.withColumns(padded), list(keys), list(order_by))


def export_price_list(
    catalogue: DataFrame,
    conditions: DataFrame,
    amounts: DataFrame,
    customers: DataFrame,
    *,
    channels: Sequence[str] = ("ME", "MO"),
    domestic: str = "MI",
    special_customer: str | None = None,
    special_channel: str = "ML",
    systems: Sequence[str] | None = None,
    statuses: Sequence[str] = EXPORT_STATUSES,
) -> DataFrame:
    """Export price list: newest price per channel, customer, material and condition class.

    ``catalogue``: material, channel, status, system, text. ``conditions``: material, channel, customer, the amount
    keys, valid_from, valid_to. ``amounts``: the amount keys, amount, currency, unit, scale_class. ``customers``:
    customer, customer_name. Prices need a scale and a start of validity. Customers whose number contains
    ``special_customer`` get a second set of rows under ``special_channel``, priced from the domestic catalogue.
    """
    wanted = catalogue.filter(F.col("status").isin(*statuses))
    if systems is not None:
        wanted = wanted.filter(F.col("system").isin(*systems))
    order = ["valid_from", "valid_to", "condition_no"]
    abroad = (
        conditions.filter(F.col("channel").isin(*channels) & F.col("valid_from").isNotNull())
        .join(wanted.filter(F.col("channel").isin(*channels)), ["material", "channel"])
        .join(amounts.filter(F.col("scale_class").isNotNull()).drop("scale_class"), AMOUNT_KEYS)
        .join(customers, "customer", "left")
    )
    prices = latest_by_key(abroad, ["channel", "customer", "customer_name", "material", "condition_class"], order)
    if special_customer is not None:
        family = conditions.filter(F.col("customer").contains(special_customer))
        newest = latest_by_key(family, ["customer", "material", "condition_class", "application"], order)
        home = wanted.filter(F.col("channel") == domestic).drop("channel")
        tagged = (
            newest.withColumn("channel", F.lit(special_channel))
            .join(home, "material")
            .join(amounts.drop("scale_class"), AMOUNT_KEYS, "left")
            .join(customers, "customer", "left")
        )
        prices = prices.unionByName(tagged)
    return prices.withColumns(
        {
            "customer": strip_zeros("customer", 2),
            "unit": map_unit("unit"),
            "amount": F.format_number(F.round(F.col("amount").cast("double"), 2), 2),
        }
    )


def domestic_price_list(
    catalogue: DataFrame,
    conditions: DataFrame,
    amounts: DataFrame,
    *,
    channel: str = "MI",
    currency: str = "MXN",
    statuses: Sequence[str] = DOMESTIC_STATUSES,
) -> DataFrame:
    """Domestic price list: newest price per material, condition class and application, if it is in local currency.

    Tables as for ``export_price_list`` without customers.
    """
    wanted = catalogue.filter((F.col("channel") == channel) & F.col("status").isin(*statuses)).drop("channel")
    priced = (
        conditions.filter(F.col("channel") == channel)
        .join(wanted, "material")
        .join(amounts.drop("scale_class"), AMOUNT_KEYS)
    )
    newest = latest_by_key(
        priced, ["material", "condition_class", "application"], ["valid_from", "valid_to", "condition_no"]
    )
    return newest.filter(F.col("currency") == currency).withColumns(
        {"unit": map_unit("unit"), "amount": F.format_number(F.col("amount").cast("double"), 2)}
    )
