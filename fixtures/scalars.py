"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.base import query, table
from millrace.functions import (
    bucket,
    clamp,
    clean_number,
    composite_key,
    extract_period,
    key_timestamp,
    map_code,
    map_unit,
    pad_key,
    period,
    shift_period,
    strip_zeros,
)


@query(
    "sca_strip_zeros",
    """select p_partkey, regexp_replace(k, '^0+(.)', '\\1') as any_zero, regexp_replace(k, '^0{2,}(.)', '\\1') as two_zeros
    from (select p_partkey, concat(repeat('0', cast(p_partkey % 4 as integer)), case when p_size % 3 = 0 then '000' else concat(p_size, 'A') end) as k from part)""",
)
def sca_strip_zeros(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = F.concat(
        F.repeat(F.lit("0"), (F.col("p_partkey") % 4).cast("int")),
        F.when(F.col("p_size") % 3 == 0, "000").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("A"))),
    )
    return p.select("p_partkey", strip_zeros(key).alias("any_zero"), strip_zeros(key, 2).alias("two_zeros"))


@query(
    "sca_lpad",
    "select o_orderkey, lpad(cast(o_orderkey as varchar), 10, '0') as padded, case when length(o_orderpriority) >= 11 then o_orderpriority else lpad(o_orderpriority, 11, '0') end as mixed from orders",
)
def sca_lpad(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", pad_key("o_orderkey").alias("padded"), pad_key("o_orderpriority", 11).alias("mixed"))


@query(
    "sca_unit_code",
    """select l_orderkey, l_linenumber, case l_linestatus when 'F' then 'PC' else 'KST' end as unit from lineitem""",
)
def sca_unit_code(spark, sf_dir):
    unit = F.when(F.col("l_linestatus") == "F", "ST").otherwise("KST")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", map_unit(unit).alias("unit"))


@query("sca_period", "select o_orderkey, strftime(o_orderdate, '%Y-%m') as period from orders")
def sca_period(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", period("o_orderdate").alias("period"))


@query(
    "sca_period_shift",
    """select o_orderkey, strftime(o_orderdate + interval 1 month, '%Y-%m') as next,
    strftime(date_trunc('month', o_orderdate) - interval 13 month, '%Y-%m') as last_year from orders""",
)
def sca_period_shift(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("p", period("o_orderdate"))
    return o.select("o_orderkey", shift_period("p", 1).alias("next"), shift_period("p", -13).alias("last_year"))


@query(
    "sca_extract_period",
    """select o_orderkey, case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m') end as period from orders""",
)
def sca_extract_period(spark, sf_dir):
    name = F.when(F.col("o_orderstatus") == "P", "forecast_final.csv").otherwise(
        F.concat(F.lit("forecast_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_v2.csv"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", extract_period(name).alias("period"))


@query(
    "sca_composite_key",
    """select o_orderkey, concat_ws('-', o_orderstatus, o_custkey, strftime(o_orderdate, '%Y-%m')) as id,
    case when o_orderstatus <> 'P' then concat(o_orderstatus, '-', o_orderkey) end as holed from orders""",
)
def sca_composite_key(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        composite_key("o_orderstatus", "o_custkey", period("o_orderdate")).alias("id"),
        composite_key(status, "o_orderkey").alias("holed"),
    )


@query(
    "sca_ts_key",
    """select event_id, case when event_type <> 'error' then strftime(ts, '%Y-%m-%d %H:%M:%S') end as stamp from events""",
)
def sca_ts_key(spark, sf_dir):
    key = F.when(F.col("event_type") == "error", "2024-13-99").otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    stamp = F.date_format(key_timestamp(key), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select("event_id", stamp.alias("stamp"))


@query("sca_clean_number", "select s_suppkey, abs(s_acctbal) as amount from supplier")
def sca_clean_number(spark, sf_dir):
    text = F.concat(F.lit("USD "), F.format_number("s_acctbal", 2), F.lit(" net"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", clean_number(text).alias("amount"))


@query(
    "sca_code_map",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 'EXPRESS' when '2-HIGH' then 'EXPRESS'
    when '5-LOW' then 'ECONOMY' else o_orderpriority end as service from orders""",
)
def sca_code_map(spark, sf_dir):
    labels = {"1-URGENT": "EXPRESS", "2-HIGH": "EXPRESS", "5-LOW": "ECONOMY"}
    service = map_code("o_orderpriority", labels, default=F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", service.alias("service"))


@query(
    "sca_bucket",
    """select l_orderkey, l_linenumber, case when l_returnflag = 'R' then '+21' when l_quantity <= 4 then '0 - 4'
    when l_quantity <= 12 then '4 - 12' when l_quantity <= 21 then '12 - 21' else '+21' end as weeks from lineitem""",
)
def sca_bucket(spark, sf_dir):
    weeks = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    label = bucket(weeks, [4, 12, 21], ["0 - 4", "4 - 12", "12 - 21", "+21"])
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("weeks"))


@query(
    "sca_clamp",
    """select c_custkey, greatest(c_acctbal, 0) as floor_zero, least(greatest(c_acctbal, -100), 5000) as both_ends,
    case when c_mktsegment <> 'BUILDING' then greatest(c_acctbal, 0) end as holed from customer""",
)
def sca_clamp(spark, sf_dir):
    holed = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        clamp("c_acctbal", 0.0).alias("floor_zero"),
        clamp("c_acctbal", -100.0, 5000.0).alias("both_ends"),
        clamp(holed, 0.0).alias("holed"),
    )
