import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import QUERIES
from millrace.operators.reshape import months_from
from millrace.plans.imports import imports_cube, imports_silver
from millrace.plans.inventory import (
    SERIES,
    classify_stock,
    replenishment,
    stock_alerts,
    stock_coverage,
    storage_cost,
)
from millrace.plans.ladder import prior_forecast
from millrace.plans.orders import opening_closing, order_status, orders_for_planning
from millrace.plans.planning import (
    forecast_vintages,
    receipts_for_planning,
    reuse_november,
    stock_by_group,
    stock_positions,
    unconstrained_demand,
    unit_costs,
)
from millrace.plans.projection import finish_projection, project_stock, value_projection
from millrace.plans.purchasing import delivery_plan, goods_receipts, info_records, order_views, po_indicators, requisitions
from millrace.plans.refresh import refresh_fact, refresh_silver
from millrace.plans.weekly import weekly_sales
from millrace.sources.registry import TableSpec


def test_delivery_plan_in_december(spark):
    header = spark.createDataFrame([("d",)], "document string")
    item = spark.createDataFrame([("d", 1, "00A", None, ""), ("d", 2, "00B", "L", "")], "document string, position int, material string, deleted string, complete string")
    rows = [
        ("d", 1, 1, date(2023, 12, 31), 10.0, 4.0, date(2023, 12, 1)),
        ("d", 1, 2, date(2024, 1, 2), 5.0, 9.0, date(2023, 12, 1)),
        ("d", 1, 3, None, 1.0, None, date(2023, 12, 1)),
        ("d", 1, 4, date(2024, 1, 2), 7.0, 0.0, date(2023, 12, 20)),
        ("d", 2, 1, date(2023, 12, 5), 50.0, 0.0, date(2023, 12, 1)),
    ]
    schema = "document string, position int, schedule_line int, delivery_date date, scheduled_qty double, delivered_qty double, loaded_at date"
    schedule = spark.createDataFrame(rows, schema)
    first = delivery_plan(header, item, schedule, date(2023, 12, 15), "first")
    assert {(r["month"], r["item"], r["quantity"]) for r in first.collect()} == {("2023-12", "A", 7.0), ("2024-01", "A", 0.0)}
    last = delivery_plan(header, item, schedule, date(2024, 1, 2), "last")
    assert {(r["month"], r["quantity"]) for r in last.collect()} == {("2024-01", 7.0)}
    with pytest.raises(ValueError):
        delivery_plan(header, item, schedule, date(2024, 1, 1), "middle")


def test_goods_receipts_signs_and_versions(spark):
    rows = [(1, 1, "d", 101, 10.0, 100.0), (1, 2, "d", 101, 12.0, 120.0), (2, 1, "d", 102, 12.0, 120.0), (3, 1, "e", 102, 3.0, 30.0), (4, 1, "d", 261, 9.0, 9.0)]
    mov = spark.createDataFrame(rows, "movement_id int, loaded_at int, document string, movement int, quantity double, local_value double").withColumns(
        {"position": F.lit(1), "plant": F.lit("P"), "posting_date": F.lit(date(2024, 1, 1))}
    )
    out = {(r["document"], r["unit"]): (r["receipts"], r["receipt_price"]) for r in goods_receipts(mov).collect()}
    assert out == {("d", "PIECES"): (0.0, None), ("d", "AMOUNT"): (0.0, None), ("e", "PIECES"): (-3.0, 10.0), ("e", "AMOUNT"): (-30.0, 10.0)}


def test_requisitions_share_per_assignment(spark):
    req = spark.createDataFrame(
        [("r", 1, 1, "5", "", 2.0), ("r", 1, 2, "5", None, 3.0), ("s", 1, 1, "5", "X", 9.0), ("t", 1, 1, "2", "", 9.0)],
        "requisition string, position int, loaded_at int, status string, deleted string, ordered_qty double",
    ).withColumns(
        {c: F.lit("1") for c in ("plant", "planner_code", "material", "supplier", "unit_of_measure")}
        | {c: F.lit(1.0) for c in ("release_value", "valuation_price", "requested_qty")}
    )
    assign = spark.createDataFrame([("r", 1), ("r", 1)], "requisition string, position int")
    planner = spark.createDataFrame([], "planner_code string, plant string, planner string")
    out = requisitions(req, assign, planner, ids=[]).filter("unit = 'PIECES'").collect()
    assert [(r["requisition"], r["ordered"]) for r in out] == [("r", 6.0)]


def test_blank_materials_are_services(spark):
    row = {
        "document": "d", "position": 1, "schedule_line": 1, "document_date": date(2024, 1, 1), "delivery_date": date(2024, 2, 1),
        "supplier": "007", "plant": "P", "quantity": 1.0, "price": 2.0, "rate": 0.0, "unit": "PIECES", "local_amount": 1.0,
        "price_unit": "PC", "currency": "MXN", "release_state": "R", "planner": "p", "material_group": "G", "purchase_type": "MATERIAL",
    }
    df = spark.createDataFrame([row | {"material": m, "document": d} for d, m in (("a", "000"), ("b", " "), ("c", None), ("d", "00X"))])
    catalogue = spark.createDataFrame([("X", "P", "text")], "material_id string, plant string, material_text string")
    _, views = order_views(df, catalogue)
    got = {r["document"]: (r["material"], r["purchase_type"], r["material_id"], r["material_text"]) for r in views.collect()}
    assert got["a"] == got["b"] == ("SERVICE", "SERVICE", "SERVICE-G", None)
    assert got["c"] == ("SERVICE", "MATERIAL", "SERVICE", None)
    assert got["d"] == ("X", "MATERIAL", "X", "text")


def brute_projection(rows, sales):
    out, prior = [], None
    for i, r in enumerate(rows):
        opening, owed = (r["stock"], r["backlog"]) if i == 0 else (max(prior, 0), max(-prior, 0))
        final = r["planned_qty"] + opening - r["demand"] - owed - (r["sales"] if sales and i == 0 else 0)
        out.append(final)
        prior = final
    return out


@pytest.mark.parametrize("sales", [False, True])
def test_projection_equals_the_recurrence(spark, sales):
    rng = random.Random(11)
    months = months_from(date(2023, 11, 1), 6)
    data = [
        (i, m, *[float(rng.choice([0, 0, rng.randrange(100)])) for _ in range(5)]) for i in range(60) for m in months
    ]
    df = spark.createDataFrame(data, "item int, month date, planned_qty double, stock double, demand double, backlog double, sales double")
    got = project_stock(df, date(2023, 11, 20), 3, deduct_sales=sales).collect()
    by_item = {}
    for r in sorted(got, key=lambda r: (r["item"], r["month"])):
        by_item.setdefault(r["item"], []).append(r)
    for rows in by_item.values():
        expected = brute_projection([r.asDict() for r in rows[:4]], sales)
        assert [r["final_stock"] for r in rows[:4]] == expected
        assert all(r["end_stock"] == max(r["final_stock"], 0) and r["estimated_backlog"] == max(-r["final_stock"], 0) for r in rows)
        assert all(r["final_stock"] == 0 for r in rows[4:])
        assert [r["opening_stock"] for r in rows[1:4]] == [max(f, 0) for f in expected[:3]]


def test_projection_crosses_zero_and_recovers(spark):
    months = months_from(date(2024, 1, 1), 4)
    data = [(1, months[0], 0.0, 10.0, 15.0, 0.0), (1, months[1], 2.0, 0.0, 4.0, 0.0), (1, months[2], 20.0, 0.0, 3.0, 0.0), (1, months[3], None, None, None, None)]
    df = spark.createDataFrame(data, "item int, month date, planned_qty double, stock double, demand double, backlog double")
    rows = project_stock(df, date(2024, 1, 31), 3).orderBy("month").collect()
    assert [r["final_stock"] for r in rows] == [-5.0, -7.0, 10.0, 10.0]
    assert [r["recovered_backlog"] for r in rows] == [0.0, 2.0, 0.0, 0.0]
    assert [r["covered_demand"] for r in rows] == [10.0, 0.0, 3.0, 0.0]


def test_valued_projection_takes_the_price_there_is(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, None, 5.0, 7.0, 11.0)], "item int, s double, d double, stock_price double, unit_cost double, demand_price double, backlog_price double")
    out = {r["concept"]: (r["s"], r["d"]) for r in value_projection(df, ["s"], ["d"], []).collect()}
    assert out == {"PIECES": (2.0, 3.0), "AMOUNT": (10.0, 21.0)}


def test_finished_projection_keeps_the_past(spark):
    schema = "item int, month date, estimated_backlog double, opening_stock double, stock double"
    old = spark.createDataFrame([(1, date(2023, 12, 1), 4.0, 1.0, 6.0), (1, date(2024, 1, 1), 9.0, 9.0, 9.0)], schema)
    new = spark.createDataFrame([(1, date(2024, 1, 1), 4.0, 2.0, 8.0), (1, date(2024, 2, 1), 8.0, 3.0, 7.0), (1, date(2024, 5, 1), 8.0, 3.0, 7.0)], schema)
    out = finish_projection(new, old, date(2024, 1, 10), 3, actuals=["stock"], opening_from={"opening_stock": "stock"}, projected=["estimated_backlog", "opening_stock"])
    assert [tuple(r)[2:] for r in out.orderBy("month").collect()] == [(4.0, 6.0, 6.0), (1.0, 8.0, 8.0), (2.0, 3.0, 0.0), (0.0, 0.0, 0.0)]


def classes(spark, policy, cases):
    df = spark.createDataFrame([(i, "PIECES", t, s) for i, (t, s) in enumerate(cases)], "item int, concept string, target double, stock double")
    return {(r["item"], r["part"]): (r["quantity"], r["flag"], r["light"]) for r in classify_stock(df, policy=policy).collect()}


def test_finished_classes_at_the_borders(spark):
    got = classes(spark, "finished", [(100.0, 75.0), (100.0, 76.0), (100.0, 125.0), (100.0, 180.0), (0.0, 5.0), (None, 5.0), (0.0, 0.0)])
    assert got[0, "WITHIN TARGET"] == (75.0, "BELOW TARGET", "RED")
    assert got[1, "WITHIN TARGET"] == (76.0, "ON TARGET", "GREEN")
    assert got[2, "WITHIN TARGET"] == (125.0, "ON TARGET", "GREEN") and (2, "EXCESS") not in got
    assert got[3, "WITHIN TARGET"] == (125.0, "ON TARGET", "GREEN") and got[3, "EXCESS"] == (55.0, "EXCESS STOCK", "RED")
    assert got[4, "NO TARGET"] == got[5, "NO TARGET"] == (5.0, "NO TARGET", "GREY")
    assert (6, "NO TARGET") not in got


def test_raw_classes_at_the_borders(spark):
    got = classes(spark, "raw", [(100.0, 29.0), (100.0, 30.0), (100.0, 75.0), (100.0, 130.0), (100.0, 230.0), (100.0, 400.0), (None, 5.0)])
    assert got[0, "WITHIN TARGET"][2] == "RED"
    assert got[1, "WITHIN TARGET"][2] == "AMBER"
    assert got[2, "WITHIN TARGET"][2] == "GREEN"
    assert got[3, "EXCESS"][2] == "GREEN" and got[4, "EXCESS"][2] == "AMBER" and got[5, "EXCESS"][2] == "RED"
    assert got[6, "NO TARGET"] == (5.0, "NO TARGET", "GREY")


def test_split_adds_up_to_the_stock(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, "AMOUNT", float(rng.randrange(1, 50)), float(rng.randrange(200))) for i in range(200)], "item int, concept string, target double, stock double")
    parts = classify_stock(df, policy="raw").groupBy("item", "stock").agg(F.sum("quantity").alias("q"))
    assert parts.filter(F.abs(F.col("q") - F.col("stock")) > 1e-6).count() == 0


def coverage_input(spark, stock):
    months = months_from(date(2024, 1, 1), 3)
    data = [(1, "m", "PIECES", months[0], m, stock if i == 0 else 99.0, d, q, a) for i, (m, d, q, a) in enumerate(zip(months, (0.0, 5.0, 0.0), (10.0, 20.0, 30.0), (7.0, 9.0, None)))]
    return spark.createDataFrame(data, "item int, model string, concept string, vintage date, month date, stock double, due_qty double, demand double, actual_demand double")


def test_stock_coverage(spark):
    rows = stock_coverage(coverage_input(spark, 20.0), date(2024, 2, 10)).orderBy("month").collect()
    assert [r["level"] for r in rows] == [20.0, 15.0, 0.0]
    assert [r["level_without_receipts"] for r in rows] == [20.0, 10.0, 0.0]
    assert [r["real_level"] for r in rows] == [20.0, 18.0, 0.0]
    assert rows[0]["coverage_months"] == 1.0


def test_stock_alerts_choose_the_excess_rule(spark):
    covered = stock_coverage(coverage_input(spark, 20.0), date(2024, 2, 10)).withColumns({"reorder_point": F.lit(12.0), "order_qty": F.lit(4.0)})
    rows = stock_alerts(covered).orderBy("month").collect()
    assert [r["covered_months"] for r in rows] == [2, 2, 2] and {r["light"] for r in rows} == {"AMBER"}
    assert [r["excess"] for r in rows] == [4.0, 2.0, 0.0]
    assert {r["survival"] for r in rows} == {"4 - 12"}
    assert [r["excess"] for r in stock_alerts(covered, negative_excess="zero").orderBy("month").collect()] == [4.0, 2.0, 0.0]
    assert SERIES == ["item", "model", "concept", "vintage"]


def test_replenishment_of_known_numbers(spark):
    demand = spark.createDataFrame([(1, date(2023, 1, 1), 90.0), (1, date(2023, 2, 1), 110.0), (2, date(2023, 1, 1), 5.0)], "item int, month date, pieces double")
    base = date(2023, 1, 1)
    receipts = spark.createDataFrame([(1, 0.0, 10.0, base, base + timedelta(days=30)), (1, 0.0, 5.0, base, base + timedelta(days=30)), (1, 4.0, 0.0, base, base + timedelta(days=30))], "item int, acquisition_cost double, quantity double, document_date date, entry_date date")
    items = spark.createDataFrame([(1, "30", "50", 12.0), (2, "30", None, 0.0)], "item int, lead_time string, min_lot string, storage_cost double")
    got = {r["item"]: r for r in replenishment(demand, receipts, items).collect()}
    # mean 100, variance 200; cost and lead-time variance 0 count as 1; EOQ sqrt(2*100*1/1) = 14.1, the lot is larger
    assert (got[1]["order_qty"], got[1]["safety_stock"], got[1]["reorder_point"]) == (50.0, 130.0, 230.0)
    assert got[2]["order_qty"] is None and got[2]["safety_stock"] is None


def test_storage_cost_without_volume_or_size(spark):
    items = spark.createDataFrame([(1, "L", "0", "100", "100", "100"), (2, "L", None, "0", "1", "1"), (3, "L", "0.5", "x", None, "1")], "item int, line string, volume string, length string, width string, height string")
    got = {r["item"]: r for r in storage_cost(items, 50.0, 50.0, 10.0).collect()}
    assert (got[1]["units_per_pallet"], got[1]["storage_cost"]) == (1.0, 10.0)
    assert got[2]["storage_cost"] is None and got[3]["units_per_pallet"] == pytest.approx(3.12)


def test_december_rule(spark):
    rows = [(date(2023, 11, 1), date(2023, 11, 1)), (date(2023, 11, 1), date(2023, 12, 1)), (date(2023, 12, 1), date(2024, 1, 1)), (date(2024, 1, 1), date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "vintage date, target date")
    got = sorted((r["vintage"], r["target"]) for r in reuse_november(df).collect())
    assert got == [(date(2023, 11, 1), date(2023, 11, 1)), (date(2023, 11, 1), date(2023, 12, 1)), (date(2023, 12, 1), date(2023, 12, 1)), (date(2024, 1, 1), date(2024, 1, 1))]
    assert reuse_november(df, applies=F.lit(False)).count() == 4


def test_newest_vintage_before_the_month(spark):
    plan = spark.createDataFrame([("i", "2024-03", "U_PRONO", 5.0, "2024-01-10"), ("i", "2024-03", "U_PRONO", 7.0, "2024-01-20"), ("i", "2024-02", "IMP", 2.0, "2024-01-20")], "item string, target string, kind string, value double, version string")
    memo = spark.createDataFrame([("i", "2024-03", "U_PRONO", 1.0, "2024-01-20", "s")], "item string, target string, kind string, value double, version string, segment string")
    vintages = forecast_vintages(plan, memo)
    got = {(r["concept"], r["target"]): r["value"] for r in vintages.collect()}
    assert got == {("PIECES", date(2024, 3, 1)): 8.0, ("AMOUNT", date(2024, 2, 1)): 2000.0}
    assert unconstrained_demand(vintages, date(2024, 1, 31)).count() == 0
    assert unconstrained_demand(vintages, date(2024, 2, 1)).count() == 2


def test_consigned_stock_takes_the_fiscal_price(spark):
    stock = spark.createDataFrame([("a", date(2024, 1, 1), "CONSIGNED", 2.0, 50.0), ("a", date(2024, 2, 1), "CONSIGNED", 2.0, 50.0), ("a", date(2024, 1, 1), "OWN", 0.0, 50.0)], "item string, month date, ownership string, units double, value double")
    fiscal = spark.createDataFrame([("a", date(2024, 1, 1), 9.0), ("a", date(2023, 1, 1), 4.0)], "item string, month date, fiscal_price double")
    got = {(r["month"], r["ownership"]): r["unit_cost"] for r in unit_costs(stock, fiscal).collect()}
    assert got == {(date(2024, 1, 1), "CONSIGNED"): 9.0, (date(2024, 2, 1), "CONSIGNED"): 4.0, (date(2024, 1, 1), "OWN"): 0.0}


def test_stock_by_group_values_consigned_pieces(spark):
    rows = [("a", "W1", "FREE", "CONSIGNED", "PIECES", 3.0), ("a", "W1", "FREE", "OWN", "AMOUNT", 10.0), ("a", "W1", "BLOCKED", "OWN", "PIECES", 8.0), ("a", "W1", "FREE", "CONSIGNED", "AMOUNT", 77.0)]
    df = spark.createDataFrame(rows, "item string, warehouse string, status string, ownership string, concept string, stock double").withColumn("month", F.lit(date(2024, 1, 1)))
    costs = spark.createDataFrame([("a", date(2024, 1, 1), 2.0)], "item string, month date, unit_cost double")
    got = {r["concept"]: (r["g"], r["all"]) for r in stock_by_group(df, costs, {"g": ["W1"], "all": ["W1"]}, statuses=["FREE"], any_status=["all"]).collect()}
    assert got == {"PIECES": (3.0, 11.0), "AMOUNT": (16.0, 16.0)}


def test_receipts_for_planning_signs(spark):
    rows = [(1, 101, 5.0, None), (2, 102, 2.0, "W"), (3, 101, 9.0, "X"), (4, 999, 9.0, "W")]
    mov = spark.createDataFrame(rows, "movement_id int, movement int, quantity double, warehouse string").withColumns(
        {"material": F.lit("00A"), "plant": F.lit("P"), "entry_date": F.lit(date(2024, 1, 9)), "loaded_at": F.lit(1)}
    )
    costs = spark.createDataFrame([("A", date(2024, 1, 1), 10.0)], "item string, month date, unit_cost double")
    args = dict(excluded_warehouses=["X"])
    got = {r["concept"]: r["receipts"] for r in receipts_for_planning(mov, costs, "P", **args).collect()}
    assert got == {"PIECES": 3.0, "AMOUNT": 30.0}
    old = {r["concept"]: r["receipts"] for r in receipts_for_planning(mov, costs, "P", signed_pieces=False, **args).collect()}
    assert old["PIECES"] == 7.0


def test_order_status_counts_the_newest_load_of_the_last_day(spark):
    base = {"client": "1", "customer": "c", "material": "00A", "channel": "ME", "rate": 2.0, "order_class": "ZOME"}
    zero = {m: 0.0 for m in ("billed_pieces", "rejected_pieces", "backlog_pieces", "amount", "billed_amount", "rejected_amount", "backlog_amount")}
    rows = [
        base | zero | {"registered": date(2024, 1, 30), "promised": date(2024, 1, 1), "loaded_at": 1, "pieces": 1.0},
        base | zero | {"registered": date(2024, 1, 31), "promised": date(2024, 1, 1), "loaded_at": 1, "pieces": 2.0},
        base | zero | {"registered": date(2024, 1, 31), "promised": date(2024, 1, 1), "loaded_at": 2, "pieces": 4.0, "backlog_pieces": 3.0, "amount": 6.0},
        base | zero | {"registered": date(2024, 1, 31), "promised": date(2024, 2, 9), "loaded_at": 2, "pieces": 8.0, "backlog_pieces": 5.0, "order_class": "ZZ"},
        base | zero | {"registered": date(2024, 1, 31), "promised": date(2024, 1, 1), "loaded_at": 3, "pieces": 99.0, "client": "2"},
    ]
    df = spark.createDataFrame(rows)
    # The newest load of the 31st holds no rows of the client, so its last day is the 30th.
    assert [(r["registered"], r["pieces"]) for r in order_status(df, "1").collect()] == [(date(2024, 1, 30), 1.0)]
    got = {r["promised"]: r for r in order_status(df.filter("loaded_at < 3"), "1").collect()}
    first, later = got[date(2024, 1, 1)], got[date(2024, 2, 9)]
    assert (first["material"], first["pieces"], first["backlog_pieces"], float(first["amount_usd"])) == ("A", 4.0, 3.0, 3.0)
    assert (later["pieces"], later["backlog_pieces"]) == (0.0, 0.0)


def test_ordered_amounts_as_pieces_is_a_choice(spark):
    names = ["pieces", "billed_pieces", "backlog_pieces", "amount", "billed_amount", "backlog_amount"]
    df = spark.createDataFrame([("i", "2024-01", *[1.0, 2.0, 4.0, 8.0, 16.0, 32.0])], ["item", "month", *names])
    sane = {r["concept"]: r["orders"] for r in orders_for_planning(df).collect()}
    assert sane == {"PIECES": 1.0, "AMOUNT": 8.0}
    old = {r["concept"]: r["orders"] for r in orders_for_planning(df, amounts_as_pieces=True).collect()}
    assert old == {"PIECES": 9.0, "AMOUNT": None}


def test_closing_becomes_the_next_opening(spark):
    df = spark.createDataFrame([("i", date(2023, 12, 1), 5.0), ("i", date(2024, 1, 1), 7.0)], "item string, month date, b double")
    got = [tuple(r)[1:] for r in opening_closing(df, ["item"], "month", ["b"]).orderBy("month").collect()]
    assert got == [(date(2023, 12, 1), None, 5.0), (date(2024, 1, 1), 5.0, 7.0), (date(2024, 2, 1), 7.0, None)]


def test_refresh_keeps_one_version_over_increments(spark):
    mapping = spark.createDataFrame([("T", "K", "Clave"), ("T", "V", "Valor")], "tabla string, TEC string, USUARIO string")
    spec = TableSpec("T", ("K",), numeric=("V",))
    schema = "K string, V string, SEQ_DATE int, YEAR int"
    current = refresh_silver(spark.createDataFrame([("a", "1", 1, 2024), ("b", "2", 1, 2024)], schema), spec, mapping)
    out = refresh_silver(spark.createDataFrame([("a", "NA", 2, 2024), ("c", "3", 2, 2024)], schema), spec, mapping, current=current)
    assert sorted((r["CLAVE"], r["VALOR"]) for r in out.collect()) == [("a", None), ("b", 2.0), ("c", 3.0)]


def test_refresh_fact_takes_the_month_before_the_first(spark):
    df = spark.createDataFrame([("00A", date(2024, 2, 1)), ("00A", date(2024, 1, 31)), (None, None)], "material string, day date")
    got = refresh_fact(df, "day", shift_days=1).collect()
    assert [(r["material"], r["month"], r["day"]) for r in got] == [("A", "2024-01", date(2024, 2, 1))]


def test_prior_forecast_in_january_and_december(spark):
    rows = [("i", "2024-01", "U_PRONO", 1.0, "2023-12-05"), ("i", "2024-01", "U_PRONO", 2.0, "2023-12-09"), ("i", "2023-12", "U_PRONO", 3.0, "2023-11-05"), ("i", "2024-02", "U_PRONO", 4.0, "2023-11-05")]
    df = spark.createDataFrame(rows, "item string, target string, kind string, value double, version string")
    assert [(r["target"], r["units"]) for r in prior_forecast(df, ["item"], date(2024, 1, 20)).collect()] == [(date(2024, 1, 1), 2.0)]
    assert [(r["target"], r["units"]) for r in prior_forecast(df, ["item"], date(2023, 12, 20)).collect()] == [(date(2024, 2, 1), 4.0)]


def test_weekly_report_across_the_year_end(spark):
    days = [(date(2023, 12, 28), 100.0), (date(2023, 12, 31), 140.0), (date(2024, 1, 5), 30.0)]
    days.append((date(2024, 3, 20), 500.0))  # after as_of: not yet known
    facts = spark.createDataFrame([("c", d, v, v, 10.0, 1.0) for d, v in days] + [("x", date(2024, 1, 5), 5.0, 5.0, 0.0, 0.0)], "customer string, day date, billed double, ordered double, rejected double, backlog double")
    clients = spark.createDataFrame([("c", "R", "A", "G"), ("x", "R", "A", "H"), ("z", "R", "A", "G")], "customer string, region string, advisor string, group string")
    budget = spark.createDataFrame([("c", date(2024, 1, 1), 40.0), ("z", date(2024, 1, 1), 10.0)], "customer string, month date, budget double")
    managers = spark.createDataFrame([("R", "r@x")], "region string, manager_mail string")
    advisors = spark.createDataFrame([("A", "a@x")], "advisor string, advisor_mail string")
    (row,) = weekly_sales(facts, clients, budget, managers, advisors, date(2024, 1, 10)).collect()
    # First week of January: the change is 0, so the month to date is shown; the group without budget goes.
    assert (row["group"], row["week"], row["week_sales"], row["month_sales"], row["net_orders"], row["budget"]) == ("G", 1, 30.0, 30.0, 20.0, 50.0)
    assert row["attainment"] == 40.0


def test_imports_sum_small_and_large_values(spark):
    rows = [("a", "2024-01-01", 1, "0.00004", "200000000000000")] * 50 + [("b", "2024-01-01", 1, "0.00004", "1")]
    df = spark.createDataFrame(rows, "T string, FECHA_PAGO string, SEQ_DATE int, CANTIDAD string, VALOR_COMERCIAL string")
    silver = imports_silver(df, text=["T"])
    assert sorted((r["T"], r["CANTIDAD"], r["VALOR_COMERCIAL"]) for r in silver.collect()) == [("a", 0.002, 1e16), ("b", 0.00004, 1.0)]
    (row,) = imports_cube(silver, "day", columns=["ANIO", "DIA"]).collect()
    assert (row["CANTIDAD"], row["VALOR_COMERCIAL"]) == (0.00204, float(10**16 + 1) / 1000)


def test_revised_imports_replace_or_stay(spark):
    rows = [("r", "2024-01-01", 1, "5", "10"), ("r", "2024-01-01", 2, "6", "10"), ("", "2024-01-02", 1, "1", "NA")]
    df = spark.createDataFrame(rows, "T string, FECHA_PAGO string, SEQ_DATE int, CANTIDAD string, VALOR_COMERCIAL string")
    got = sorted(((r["T"], r["CANTIDAD"], r["VALOR_COMERCIAL"], r["ANIO"]) for r in imports_silver(df, text=["T"]).collect()), key=repr)
    assert got == sorted([("r", 6.0, 10.0, 2024), (None, 1.0, None, 2024)], key=repr)
    assert imports_silver(df, text=["T"], keep_revisions=True).count() == 3


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _info_inputs(spark):
    info = spark.createDataFrame([("r", "s", "m", 1, 2), ("q", "s", "n", 1, 2)], "record string, supplier string, material string, country int, region int")
    org = spark.createDataFrame(
        [(r, p, "P1", "0", v, v, "USD") for r in "rq" for p, v in (("a", 1.0), ("b", 2.0))],
        "record string, plant string, purchasing_org string, record_type string, net_price double, effective_price double, currency string",
    )
    material = spark.createDataFrame([("m", "g"), ("n", "h")], "material string, material_group string")
    rows = [("m", "a", 1, "c1"), ("m", "a", 3, "c2"), ("m", "b", 3, "c3"), ("m", "b", 3, "c3"), ("n", "a", 2, "c4"), ("n", "b", 1, None), ("n", "b", None, "c5")]
    index = spark.createDataFrame(
        [("s", m, "P1", "0", p, d and date(2024, 1, d), date(9999, 12, 31), c) for m, p, d, c in rows],
        "supplier string, material string, purchasing_org string, record_type string, plant string, valid_from date, valid_to date, condition_no string",
    )
    amounts = spark.createDataFrame(
        [(c, k, u, v) for c in ("c1", "c3", "c4") for k, u, v in (("PB00", "USD", 5.0), ("FRA1", "%", 1.0)) if (c, k) != ("c4", "FRA1")],
        "condition_no string, class string, unit string, value double",
    )
    supplier = spark.createDataFrame([("s", "name")], "supplier string, supplier_name string")
    region = spark.createDataFrame([(1, 2, "c", "r")], "country int, region int, country_name string, region_name string")
    return info, org, material, index, amounts, supplier, region


def test_info_records_meet_the_index_once(spark):
    latest, conditions = info_records(*_info_inputs(spark))
    assert sorted((r["record"], r["plant"], r["valid_from"].day) for r in latest.collect()) == [("q", "a", 2), ("r", "a", 3), ("r", "b", 3)]
    assert sorted((r["condition_no"], r["PRECIO_BASE"], r["FLETE"]) for r in conditions.collect()) == [("c1", 5.0, 1.0), ("c3", 5.0, 1.0)]
    # The index is read once for the newest days; the ranking reads no side again.
    assert _plan(latest).count("Join") == 5


def test_amounts_are_put_side_by_side_before_records_are_met(spark):
    plan = _plan(info_records(*_info_inputs(spark))[1]).splitlines()
    sums = [i for i, line in enumerate(plan) if "PRECIO_BASE" in line and "Aggregate [condition_no" in line and "min(" in line]
    assert sums and max(i for i, line in enumerate(plan) if "Join" in line and "condition_no" in line) < sums[-1]


def test_requisitions_that_are_not_live_travel_without_values(spark):
    columns = "requisition int, position int, status string, deleted string, plant string, planner_code int, unit_of_measure string, supplier string, material string, ordered_qty double, release_value double, valuation_price double, requested_qty double, loaded_at int"
    rows = [(1, 1, "5", None, 1), (1, 1, "2", None, 2), (2, 1, "2", None, 1), (2, 1, "5", "", 2), (3, 1, "5", "X", 1), (4, 1, None, None, 1)]
    req = spark.createDataFrame([(q, p, s, d, "P", 7, "ST", "01", "02", 1.0, 2.0, 3.0, 4.0, t) for q, p, s, d, t in rows], columns)
    assign = spark.createDataFrame([(2, 1), (2, 1)], "requisition int, position int")
    planner = spark.createDataFrame([(7, "P", "n")], "planner_code int, plant string, planner string")
    out = requisitions(req, assign, planner, ids=[])
    assert sorted((r["requisition"], r["unit"], r["ordered"], r["planner"]) for r in out.collect()) == [(2, "AMOUNT", 4.0, "n"), (2, "PIECES", 2.0, "n")]
    window = _plan(out).split("Window [", 1)[1]
    assert "CASE WHEN" in window and "supplier" in window.split("CASE WHEN", 1)[1].split("LogicalRDD")[0]


def test_stock_values_are_gathered_before_rows_double(spark):
    rows = [(1, "OWN", 2, 6), (1, "CONSIGNED", 2, 8), (1, "CONSIGNED", 2, 8), (None, "OWN", None, 4), (2, "OWN", 0, 3), (2, "CONSIGNED", -1, 0)]
    stock = spark.createDataFrame([(i, date(2024, 1, 1), o, u, v) for i, o, u, v in rows], "item int, month date, ownership string, units int, value int")
    fiscal = spark.createDataFrame([(1, date(2024, 1, 1), 5.0), (2, date(2024, 1, 1), 0.0)], "item int, month date, fiscal_price double")
    start, _ = stock_positions(stock, stock, fiscal)
    got = sorted(((r["item"], r["concept"], r["stock"]) for r in start.collect()), key=str)
    assert got == sorted(
        [(1, "PIECES", 2.0), (1, "AMOUNT", 6.0), (1, "AMOUNT", 10.0), (None, "PIECES", None), (None, "AMOUNT", None),
         (2, "PIECES", 0.0), (2, "PIECES", -1.0), (2, "AMOUNT", 0.0)], key=str,
    )
    assert "Generate inline" in _plan(start).split("Aggregate", 1)[0]  # the rows double last


def test_items_are_dealt_to_more_tasks_than_shuffle_partitions(spark):
    header = spark.createDataFrame(
        [(f"d{i}", date(2024, 1, 1), "s", "P", "MXN", 1.0, " R ") for i in range(50)],
        "document string, document_date date, supplier string, plant string, currency string, exchange_rate double, release_state string",
    )
    schedule = header.select("document", F.lit(1).alias("position"), F.lit(1).alias("schedule_line"), F.lit(date(2024, 2, 1)).alias("delivery_date"), F.lit(2.0).alias("scheduled_qty"))
    item = header.select(
        "document", F.lit(1).alias("position"), F.lit("7").alias("material"), F.lit("0").alias("item_type"),
        F.lit("ST").alias("price_unit"), F.lit(3.0).alias("net_price"), F.lit(6.0).alias("net_value"), F.lit("G").alias("material_group"),
    )
    planning = spark.createDataFrame([("7", "P", "p")], "material string, plant string, planner string")
    services = spark.createDataFrame([("d1", 1, "S1")], "document string, position int, service string")
    supplier = spark.createDataFrame([("s", "name")], "supplier string, supplier_name string")
    indicators = po_indicators(header, schedule, item, planning, services, supplier, ids=["material_group"])
    _, views = order_views(indicators, planning.select(F.col("material").alias("material_id"), "plant", F.lit("t").alias("material_text")))
    assert "hashpartitioning(document" in (plan := views._jdf.queryExecution().executedPlan().toString())
    finer = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [line for line in plan.splitlines() if "hashpartitioning(document" in line and f", {finer})" in line]
    assert views.count() == 50 and views.agg(F.avg("price")).first()[0] == 3.0


def _po_tables(spark):
    header = spark.createDataFrame(
        [("d1", "P"), ("d1", "Q"), ("d2", None), ("d3", "P"), (None, "P"), ("d4", "P")], "document string, plant string"
    ).withColumns(
        {"document_date": F.lit(date(2024, 1, 1)), "supplier": F.lit("s"), "currency": F.lit("USD"), "exchange_rate": F.lit(2.0), "release_state": F.lit("R")}
    )
    schedule = spark.createDataFrame(
        [("d1", 1, 5.0), ("d1", 1, 5.0), ("d1", 2, 6.0), ("d2", 1, 7.0), ("d3", 1, 8.0), (None, 1, 9.0), ("d4", None, 4.0)],
        "document string, position int, scheduled_qty double",
    ).withColumns({"schedule_line": F.lit(1), "delivery_date": F.lit(date(2024, 2, 1))})
    item = spark.createDataFrame(
        [("d1", 1, "7"), ("d1", 2, "8"), ("d2", 1, "7"), ("d3", 1, None), (None, 1, "7"), ("d4", None, "7")], "document string, position int, material string"
    ).withColumns(
        {"item_type": F.when(F.col("position") == 2, "9").otherwise("0"), "price_unit": F.lit("ST"), "net_price": F.lit(3.0), "net_value": F.lit(6.0)}
    )
    planning = spark.createDataFrame(
        [("7", "P", "a"), ("7", "P", "b"), ("7", "Q", "c"), ("7", None, "d"), ("8", "Q", None), (None, "P", "e")], "material string, plant string, planner string"
    )
    services = spark.createDataFrame([("d1", 2, "S1"), ("d1", 2, "S2"), ("d9", 1, "S3")], "document string, position int, service string")
    supplier = spark.createDataFrame([("s", "name")], "supplier string, supplier_name string")
    return header, schedule, item, planning, services, supplier


def test_planners_come_with_the_items_of_a_material(spark):
    out = po_indicators(*_po_tables(spark)).filter("unit = 'PIECES'")
    got = sorted(((r["document"], r["plant"], r["position"], r["material"], r["planner"], r["quantity"], r["price"]) for r in out.collect()), key=str)
    assert got == sorted(
        [
            ("d1", "P", 1, "7", "a", 5.0, 3.0), ("d1", "P", 1, "7", "b", 5.0, 3.0), ("d1", "Q", 1, "7", "c", 5.0, 3.0),
            ("d1", "P", 2, "S1", None, 6.0, 3.0), ("d1", "P", 2, "S2", None, 6.0, 3.0), ("d1", "Q", 2, "S1", None, 6.0, 3.0),
            ("d1", "Q", 2, "S2", None, 6.0, 3.0), ("d2", None, 1, "7", None, 7.0, 3.0), ("d3", "P", 1, None, None, 8.0, 3.0),
            (None, "P", None, None, None, 0.0, 0.0), ("d4", "P", None, None, None, 4.0, 0.0),
        ], key=str,
    )


def test_whole_lines_travel_to_their_items_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = po_indicators(*_po_tables(spark))._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line.split("Exchange ", 1)[1].split(")")[0] for line in plan if "Exchange " in line]
    # Once to the headers, once to the items (lines, items, services), and never with the lines to the planners.
    assert sum("(document" in m and "position" not in m for m in moved) == 2
    assert sum("(document" in m and "position" in m for m in moved) == 3
    assert sum("(material" in m for m in moved) == 2 and not any("plant" in m for m in moved)


def test_only_the_newest_rows_of_items_travel_to_the_catalogue(spark):
    indicators = po_indicators(*_po_tables(spark)).withColumn("material_group", F.when(F.col("document") != "d1", "G"))
    catalogue = spark.createDataFrame(
        [("7", "P", "x"), ("7", "P", "y"), ("7", "P", None), ("7", "Q", None), (None, "Q", "none"), ("SERVICE", "P", "z")],
        "material_id string, plant string, material_text string",
    )
    deny = spark.createDataFrame([("d4",)], "document string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, views = order_views(indicators, catalogue, deny=deny)
        plan = views._jdf.queryExecution().executedPlan().toString().splitlines()
        rows = views.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = sorted(((r["document"], r["position"], r["plant"], r["material"], r["material_id"], r["material_text"], r["document_month"]) for r in rows), key=str)
    assert got == sorted(
        [
            ("d1", 1, "Q", "7", "7", None, "2024-01"), ("d1", 2, "Q", "S2", None, "none", "2024-01"),
            ("d2", 1, None, "7", "7", None, "2024-01"), ("d3", 1, "P", "SERVICE", "SERVICE", "z", "2024-01"),
            (None, None, "P", "SERVICE", "SERVICE", "z", "2024-01"),
        ], key=str,
    )
    ranked = min(i for i, line in enumerate(plan) if "Window [row_number()" in line)
    met = min(i for i, line in enumerate(plan) if "Join [" in line and "material_id" in line)
    assert met < ranked  # the join is above the ranking
    assert not any("Exchange hashpartitioning(document" in line and "material" in line for line in plan)


def test_of_several_texts_of_a_material_the_greatest_counts(spark):
    indicators = po_indicators(*_po_tables(spark)).withColumn("material_group", F.lit("G")).filter("document = 'd1' and plant = 'P' and position = 1")
    catalogue = spark.createDataFrame([("7", "P", t) for t in (None, "a", "c", "b")], "material_id string, plant string, material_text string")
    _, views = order_views(indicators, catalogue)
    assert [(r["document"], r["material_text"]) for r in views.collect()] == [("d1", "c")]


def test_stock_positions_hold_opening_and_closing(spark, tmp_path):
    rows = [(1, 1, "A", 2.0, 6.0, 1), (2, 1, "R", 3.0, 9.0, 1), (3, 1, "R", 1.0, 4.0, 2), (4, 2, "N", 5.0, 5.0, 1)]
    lines = spark.createDataFrame(
        [(k, 1, p, 1, f, "O", q, v, datetime(2024, m, 9)) for k, p, f, q, v, m in rows],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double, l_shipdate timestamp",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {}
    for r in QUERIES["biz_stock_positions"](spark, str(tmp_path)).collect():
        got.setdefault((r["item"], r["month"].month, r["concept"]), []).append((r["stock"], r["stock_closing"]))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        (1, 1, "PIECES"): [(2.0, None), (3.0, None), (None, 5.0)], (1, 1, "AMOUNT"): [(27.0, None), (6.0, None), (None, 33.0)],
        (1, 2, "PIECES"): [(1.0, None), (None, 1.0)], (1, 2, "AMOUNT"): [(4.0, None), (None, 4.0)],
        (2, 1, "PIECES"): [(5.0, None), (None, 5.0)], (2, 1, "AMOUNT"): [(5.0, None), (None, 5.0)],
    }


def test_prices_of_an_item_come_with_its_stock(spark):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    stock = spark.createDataFrame(
        [(1, jan, "CONSIGNED"), (1, feb, "CONSIGNED"), (1, None, "CONSIGNED"), (1, jan, None), (2, jan, "CONSIGNED"), (None, jan, "CONSIGNED")],
        "item int, month date, ownership string",
    ).withColumns({"units": F.lit(2.0), "value": F.lit(6.0)})
    prices = [(1, jan, 5.0), (1, jan, 7.0), (1, feb, None), (1, None, 4.0), (None, jan, 1.0)]
    out = unit_costs(stock, spark.createDataFrame(prices, "item int, month date, fiscal_price double"))
    got = sorted(((r["item"], r["month"], r["ownership"], r["unit_cost"]) for r in out.collect()), key=str)
    assert got == sorted(
        [
            (1, jan, "CONSIGNED", 5.0), (1, jan, "CONSIGNED", 7.0), (1, feb, "CONSIGNED", 4.0), (1, None, "CONSIGNED", 4.0),
            (1, jan, None, 3.0), (1, jan, None, 3.0), (2, jan, "CONSIGNED", None), (None, jan, "CONSIGNED", None),
        ], key=str,
    )
    assert _plan(out).count("Join ") == 1
