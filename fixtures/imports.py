"""Customs imports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.base import query, table
from millrace.plans.imports import imports_cube, imports_silver

TEXT = ["RFC_CAUSANTE", "PAISORIGEN", "FRACCION", "REGISTRO"]


def _silver(spark, sf_dir, keep_revisions=False):
    raw = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("RFC_CAUSANTE"),
        F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_returnflag")).alias("PAISORIGEN"),
        F.when(F.col("l_linestatus") == "O", "8708").otherwise("x").alias("FRACCION"),
        (F.col("l_partkey") % 10).cast("string").alias("REGISTRO"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("FECHA_PAGO"), F.col("l_linenumber").alias("SEQ_DATE"),
        F.col("l_quantity").cast("string").alias("CANTIDAD"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("VALOR_COMERCIAL"),
    )
    return imports_silver(raw, text=TEXT, keep_revisions=keep_revisions)


SILVER = """s as (select concat('S', l_suppkey) as "RFC_CAUSANTE", case when l_returnflag <> 'R' then l_returnflag end as "PAISORIGEN", case l_linestatus when 'O' then '8708' else 'x' end as "FRACCION",
      (l_partkey % 10)::varchar as "REGISTRO", cast(l_shipdate as date) as "FECHA_PAGO", l_linenumber as "SEQ_DATE", cast(sum(cast(l_quantity as decimal(18,2))) as double) as "CANTIDAD",
      cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as "VALOR_COMERCIAL" from lineitem group by 1, 2, 3, 4, 5, 6),
    n as (select *, cast(year("FECHA_PAGO") as integer) as "ANIO" from s qualify row_number() over (partition by "RFC_CAUSANTE", "PAISORIGEN", "FRACCION", "REGISTRO", "FECHA_PAGO"{extra} order by "SEQ_DATE" desc) = 1)"""


@query("biz_imports_silver", f"with {SILVER.format(extra='')} select * from n")
def biz_imports_silver(spark, sf_dir):
    return _silver(spark, sf_dir)


@query("biz_imports_silver_revisions", f"""with {SILVER.format(extra=', "CANTIDAD", "VALOR_COMERCIAL"')} select * from n""")
def biz_imports_silver_revisions(spark, sf_dir):
    return _silver(spark, sf_dir, keep_revisions=True)


@query(
    "biz_imports_month",
    f"""with {SILVER.format(extra='')}, m as (select "ANIO", cast(month("FECHA_PAGO") as integer) as "MES", "RFC_CAUSANTE", "PAISORIGEN", try_cast("FRACCION" as double) as "FRACCION",
      cast(sum(cast("VALOR_COMERCIAL" as decimal(28,4))) as double) / 1000 as v, cast(sum(cast("CANTIDAD" as decimal(28,4))) as double) as q from n group by 1, 2, 3, 4, 5)
    select "ANIO", "MES", "RFC_CAUSANTE", "PAISORIGEN", "FRACCION", 'VALOR_COMERCIAL' as "UNIDAD", v as "CANTIDAD" from m
    union all select "ANIO", "MES", "RFC_CAUSANTE", "PAISORIGEN", "FRACCION", 'CANTIDAD', q from m""",
)
def biz_imports_month(spark, sf_dir):
    return imports_cube(_silver(spark, sf_dir), "month", columns=["ANIO", "MES", "RFC_CAUSANTE", "PAISORIGEN", "FRACCION"])


@query(
    "biz_imports_day",
    f"""with {SILVER.format(extra='')} select "ANIO", cast(month("FECHA_PAGO") as integer) as "MES", cast(day("FECHA_PAGO") as integer) as "DIA", "FECHA_PAGO", "PAISORIGEN",
      cast(sum(cast("VALOR_COMERCIAL" as decimal(28,4))) as double) / 1000 as "VALOR_COMERCIAL", cast(sum(cast("CANTIDAD" as decimal(28,4))) as double) as "CANTIDAD" from n group by 1, 2, 3, 4, 5""",
)
def biz_imports_day(spark, sf_dir):
    return imports_cube(_silver(spark, sf_dir), "day", columns=["ANIO", "MES", "DIA", "FECHA_PAGO", "PAISORIGEN"])
