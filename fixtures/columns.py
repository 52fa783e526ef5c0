"""Projections, casts and filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, table
from millrace.functions import has_text, in_period, month_start, normalise_name
from millrace.operators.columns import (
    blank_to_null,
    cast_columns,
    drop_matching,
    mask_after,
    mask_before,
    rename_from_mapping,
    rename_map,
    upper_all,
)
from millrace.operators.filters import drop_empty, from_month, last_months, open_items
from millrace.operators.joins import exclude_ids
from millrace.sources.scans import literal_table


@query("prj_select", "select l_partkey as item, l_orderkey as document, l_quantity as quantity from lineitem")
def prj_select(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("document"), F.col("l_quantity").alias("quantity")
    )


@query(
    "prj_rename_map",
    "select o_orderkey as document, o_custkey as client, o_orderstatus, o_orderpriority as class from orders",
)
def prj_rename_map(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return rename_map(o, {"o_orderkey": "document", "o_custkey": "client", "o_orderpriority": "class", "absent": "x"})


@query(
    "prj_mapping_rename",
    """select c_custkey as "NUMERO_DE_CLIENTE", c_name as "NOMBRE_1", c_mktsegment as "SEGMENTO_MERCADO",
    c_acctbal from customer""",
)
def prj_mapping_rename(spark, sf_dir):
    mapping = literal_table(
        spark,
        [
            ("customer", "c_custkey", " Número de  cliente "),
            ("customer", "c_name", "Nombre.1"),
            ("customer", "c_mktsegment", "Segmento/mercado"),
            ("supplier", "c_acctbal", "Saldo"),
        ],
        "tabla string, TEC string, USUARIO string",
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return rename_from_mapping(c, mapping, "customer")


@query(
    "prj_normalise_name",
    """select p_partkey, replace(translate(translate(replace(trim(translate(upper(
      concat(' ', p_name, '/', p_brand, '. (', p_type, ')  n° = año-', p_size, ' Łódź Ærø ')), '/°º.', '_OO ')), '  ', ' '),
      ' =-()', '___'), 'ÁÉÍÓÚÑŁŹØ', 'AEIOUNLZO'), 'Æ', 'AE') as name from part""",
)
def prj_normalise_name(spark, sf_dir):
    text = F.concat(
        F.lit(" "), "p_name", F.lit("/"), "p_brand", F.lit(". ("), "p_type", F.lit(")  n° = año-"),
        F.col("p_size").cast("string"), F.lit(" Łódź Ærø "),
    )
    return table(spark, sf_dir, "part").select("p_partkey", normalise_name(text).alias("name"))


@query(
    "prj_cast",
    """select l_orderkey, l_linenumber, l_quantity as qty, cast(l_shipdate as date) as day,
    cast(null as double) as flag from lineitem""",
)
def prj_cast(spark, sf_dir):
    text = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("string").alias("qty"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.col("l_returnflag").alias("flag"),
    )
    return cast_columns(text, ["qty", "flag"], ["day"])


@query("prj_upper_all", "select doc_id, replace(upper(text), 'ẞ', 'SS') as text, upper(lang) as lang, n_chars from documents")
def prj_upper_all(spark, sf_dir):
    return upper_all(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars"))


@query(
    "prj_blank_to_null",
    """select l_orderkey, l_linenumber, case when l_returnflag <> 'R' then l_returnflag end as flag,
    l_linestatus as status from lineitem""",
)
def prj_blank_to_null(spark, sf_dir):
    blanked = F.when(F.col("l_returnflag") == "R", " ").otherwise(F.col("l_returnflag"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", blanked.alias("flag"), F.col("l_linestatus").alias("status")
    )
    return blank_to_null(rows, ["flag", "status"])


@query("prj_drop_pattern", "select o_orderkey, o_custkey, o_totalprice from orders")
def prj_drop_pattern(spark, sf_dir):
    return drop_matching(table(spark, sf_dir, "orders"), "order(status|date|priority)")


@query(
    "prj_mask_after",
    """select date_trunc('month', o_orderdate)::date as month,
    cast(case when date_trunc('month', o_orderdate) > timestamp '1998-06-01' then 0
      else sum(cast(o_totalprice as decimal(18,2))) end as double) as sales,
    cast(case when date_trunc('month', o_orderdate) < timestamp '1998-06-01' then 0 else count(*) end as double) as plan
    from orders group by date_trunc('month', o_orderdate)""",
)
def prj_mask_after(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    months = o.groupBy(month_start("o_orderdate").alias("month")).agg(
        number(F.sum(money("o_totalprice"))).alias("sales"), F.count("*").cast("double").alias("plan")
    )
    first = AS_OF.replace(day=1)
    return mask_before(mask_after(months, ["sales"], "month", first, 0.0), ["plan"], "month", first, 0.0)


@query(
    "flt_bool",
    """select l_orderkey, l_linenumber from lineitem
    where (l_returnflag = 'R' or l_linestatus <> 'F') and not l_quantity > 25""",
)
def flt_bool(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").filter(
        ((F.col("l_returnflag") == "R") | (F.col("l_linestatus") != "F")) & ~(F.col("l_quantity") > 25)
    )
    return rows.select("l_orderkey", "l_linenumber")


@query(
    "flt_isin",
    """select o_orderkey from orders where o_orderpriority in ('1-URGENT', '2-HIGH')
    and o_orderstatus not in ('P')""",
)
def flt_isin(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kept = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P"))
    return kept.select("o_orderkey")


@query(
    "flt_like",
    """select p_partkey from part where p_name like '%ring%' and not starts_with(p_type, 'S')""",
)
def flt_like(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.filter(F.col("p_name").contains("ring") & ~F.col("p_type").startswith("S")).select("p_partkey")


@query("flt_rlike", "select count(*) as n from documents where regexp_matches(text, '\\S')")
def flt_rlike(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(has_text("text")).agg(F.count("*").alias("n"))


@query(
    "flt_between",
    """select o_orderkey from orders where o_orderdate >= timestamp '1997-11-01' and o_orderdate < timestamp '1998-03-01'""",
)
def flt_between(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(in_period("o_orderdate", "1997-11", "1998-02")).select("o_orderkey")


@query(
    "flt_null",
    """select o.o_orderkey from orders o left join (select distinct l_orderkey from lineitem) l
    on l.l_orderkey = o.o_orderkey where l.l_orderkey is null""",
)
def flt_null(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    o = table(spark, sf_dir, "orders")
    return o.join(lines, o.o_orderkey == lines.l_orderkey, "left").filter("l_orderkey is null").select("o_orderkey")


@query(
    "flt_relative_date",
    """select o_orderkey, case when o_orderdate >= timestamp '1998-06-01' then 'from month' else 'before' end as part
    from orders where o_orderdate > timestamp '1995-06-15' and o_orderdate < timestamp '1998-06-16'
    union all select o_orderkey, 'open end' from orders where o_orderdate >= timestamp '1998-06-01'""",
)
def flt_relative_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    part = F.when(F.col("o_orderdate") >= F.lit(date(1998, 6, 1)), "from month").otherwise("before")
    recent = last_months(o, "o_orderdate", 36, AS_OF).select("o_orderkey", part.alias("part"))
    return recent.unionByName(from_month(o, "o_orderdate", AS_OF).select("o_orderkey", F.lit("open end").alias("part")))


@query(
    "flt_na_drop",
    """select how, count(*) as n from (
      select 'all' as how from lineitem where l_returnflag <> 'R' or l_linestatus <> 'O'
      union all select 'any' from lineitem where l_returnflag <> 'R' and l_linestatus <> 'O') group by 1""",
)
def flt_na_drop(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.expr("nullif(l_returnflag, 'R')").alias("flag"), F.expr("nullif(l_linestatus, 'O')").alias("status")
    )
    kept = [drop_empty(rows, how).select(F.lit(how).alias("how")) for how in ("all", "any")]
    return kept[0].unionByName(kept[1]).groupBy("how").agg(F.count("*").alias("n"))


@query(
    "flt_open_items",
    "select l_orderkey, l_linenumber, l_partkey from lineitem where l_linestatus = 'O' and l_returnflag <> 'R'",
)
def flt_open_items(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumns(
        {
            "deleted": F.when(F.col("l_returnflag") == "R", "L").when(F.col("l_returnflag") == "N", " "),
            "complete": F.when(F.col("l_linestatus") == "F", "X").otherwise(""),
        }
    )
    return open_items(rows, "deleted", "complete").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "flt_denylist",
    """select l_orderkey, l_linenumber, l_suppkey from lineitem
    where l_suppkey not in (select s_suppkey from supplier where s_acctbal < 0)""",
)
def flt_denylist(spark, sf_dir):
    deny = table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return exclude_ids(table(spark, sf_dir, "lineitem"), "l_suppkey", deny).select("l_orderkey", "l_linenumber", "l_suppkey")
