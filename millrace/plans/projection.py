"""Stock projection over the coming months, its valuation and the merge of projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import clamp
from millrace.operators.columns import mask_after, mask_before

PROJECTED = ["final_stock", "end_stock", "estimated_backlog", "opening_stock", "prior_backlog", "recovered_backlog", "covered_demand"]


def project_stock(df: DataFrame, as_of: date, horizon: int = 3, *, deduct_sales: bool = False) -> DataFrame:
    """Roll stock forward from the month of ``as_of`` over ``horizon`` further months.

    ``df`` has one row per item and month without gaps: item, month (date), planned_qty, stock, demand, backlog and,
    with ``deduct_sales``, sales; nulls are 0. Base month: final = planned + stock - demand - backlog (- sales). Later
    months start from the end stock and the backlog of the month before: final = planned + end stock - demand - backlog.

    Since end stock less backlog is the final stock itself, each later month only adds planned less demand: the final
    stock is one running sum per item, over ``horizon + 1`` rows, and nothing is iterated. Rows before the base month
    go; rows after the horizon stay with 0 in the projected columns.
    """
    base = as_of.replace(day=1)
    last = base + relativedelta(months=horizon)
    numbers = ["planned_qty", "stock", "demand", "backlog", *(["sales"] if deduct_sales else [])]
    rows = df.filter(F.col("month") >= F.lit(base)).na.fill(0, numbers)
    is_base = F.col("month") == F.lit(base)
    flow = F.col("planned_qty") - F.col("demand")
    start = F.col("stock") - F.col("backlog") - (F.col("sales") if deduct_sales else F.lit(0))
    inside = F.col("month") <= F.lit(last)
    by_item = Window.partitionBy("item").orderBy("month")
    stepped = rows.withColumn("_step", F.when(inside, flow + F.when(is_base, start).otherwise(0)))
    final = F.sum("_step").over(by_item.rowsBetween(Window.unboundedPreceding, 0))
    out = stepped.withColumn("final_stock", F.when(inside, final))
    before = F.lag("final_stock").over(by_item)
    out = out.withColumns(
        {
            "end_stock": clamp("final_stock", 0),
            "estimated_backlog": clamp(-F.col("final_stock"), 0),
            "opening_stock": F.when(inside, F.coalesce(clamp(before, 0), F.lit(0))),
            "prior_backlog": F.when(inside, F.coalesce(clamp(-before, 0), F.lit(0))),
        }
    )
    # The base month opens with its stock and owes its backlog; later months open with what the month before left.
    have = F.when(is_base, F.col("stock")).otherwise(F.col("opening_stock")) + F.col("planned_qty")
    owed = F.when(is_base, F.col("backlog")).otherwise(F.col("prior_backlog"))
    own = F.when(is_base, F.col("backlog")).otherwise(F.col("estimated_backlog"))
    recovered = F.when(own == 0, 0).when(have > owed, own).otherwise(have)
    left = have - owed
    covered = F.when(left > F.col("demand"), F.col("demand")).when(left < 0, 0).otherwise(left)
    return (
        out.withColumns(
            {"recovered_backlog": F.when(inside, recovered), "covered_demand": F.when(inside, covered)}
        )
        .drop("_step")
        .na.fill(0, PROJECTED)
    )


def value_projection(
    df: DataFrame, at_stock_price: Sequence[str], at_demand_price: Sequence[str], at_backlog_price: Sequence[str]
) -> DataFrame:
    """Projection rows in pieces and, beside them, in amounts.

    ``df`` also has stock_price, unit_cost, demand_price and backlog_price. Stock measures are valued at the higher of
    stock price and unit cost (a missing one gives way to the other).
    """
    priced = df.withColumn("max_price", F.greatest("stock_price", "unit_cost"))
    price = {
        **{c: F.col("max_price") for c in at_stock_price},
        **{c: F.col("demand_price") for c in at_demand_price},
        **{c: F.col("backlog_price") for c in at_backlog_price},
    }
    rest = [c for c in priced.columns if c not in price]

    def row(concept: str, valued: bool) -> Column:
        cells = [(F.col(c).cast("double") * (p.cast("double") if valued else F.lit(1.0))).alias(c) for c, p in price.items()]
        return F.struct(F.lit(concept).alias("concept"), *cells)

    return priced.select(*rest, F.inline(F.array(row("PIECES", False), row("AMOUNT", True))))


def finish_projection(
    new: DataFrame,
    history: DataFrame,
    as_of: date,
    horizon: int,
    *,
    actuals: Sequence[str],
    opening_from: Mapping[str, str],
    backlog: str = "estimated_backlog",
    factor: float = 0.25,
    projected: Sequence[str] = PROJECTED,
) -> DataFrame:
    """Projection with its past: past months come from the last run, the rest from this one.

    Projected measures are 0 after the horizon and actual ones 0 after the month of ``as_of``. Up to that month the
    opening columns show the actual stock (``opening_from`` maps opening to actual column). From that month on the
    estimated backlog counts with ``factor``.
    """
    base = as_of.replace(day=1)
    past = history.filter(F.col("month") < F.lit(base))
    rows = past.unionByName(new.filter(F.col("month") >= F.lit(base)), allowMissingColumns=True)
    rows = mask_after(rows, projected, "month", base + relativedelta(months=horizon))
    rows = mask_after(rows, actuals, "month", base)
    opened = F.col("month") <= F.lit(base)
    changes = {o: F.when(opened, F.col(a)).otherwise(F.col(o)) for o, a in opening_from.items()}
    changes[backlog] = F.when(F.col("month") >= F.lit(base), F.col(backlog) * factor).otherwise(F.col(backlog))
    return rows.withColumns(changes)


def merge_projections(
    spine: DataFrame, daily: DataFrame, opening: DataFrame, receipts: DataFrame, as_of: date, planned: Sequence[str]
) -> DataFrame:
    """Daily and month-opening projections side by side on the spine, with receipts; past planned quantities are 0.

    All tables share the keys item, month and concept, so they are joined in one partitioning of the spine.
    """
    keys = ["item", "month", "concept"]
    out = spine.select(*keys).distinct()
    for part in (daily, opening, receipts):
        out = out.join(part, keys, "left")
    return mask_before(out, planned, "month", as_of.replace(day=1))
