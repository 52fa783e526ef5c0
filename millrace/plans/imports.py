"""Customs imports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import to_number
from millrace.operators.columns import blank_to_null, cast_columns
from millrace.operators.snapshots import latest_by_key

# Text columns of a customs record, and the columns of its month and day cubes.
TEXT_COLUMNS = [
    "CP", "CP_CAUSANTE", "DENOMINACION", "DESCRIPCION", "DIRECCION", "DOMICILIO_CAUSANTE", "ESTADO", "ESTADO_CAUSANTE",
    "ID_FECHA", "MUNICIPIO_CAUSANTE", "NOMBRE_ADUANA", "PAISORIGEN", "PAISRUTA", "RAZON_CAUSANTE", "RAZON_SOCIAL",
    "REGISTRO", "RFC_CAUSANTE", "FRACCION_NICO", "FRACCION",
]
MONTH_COLUMNS = [
    "ANIO", "MES", "RFC_CAUSANTE", "RAZON_CAUSANTE", "DENOMINACION", "NOMBRE_ADUANA", "ESTADO_CAUSANTE", "FRACCION",
    "DESCRIPCION", "RAZON_SOCIAL", "PAISORIGEN", "PAISRUTA", "REGISTRO", "FRACCION_NICO",
]
DAY_COLUMNS = [
    *MONTH_COLUMNS, "DIA", "DOMICILIO_CAUSANTE", "CP_CAUSANTE", "MUNICIPIO_CAUSANTE", "FECHA_PAGO", "ID_FECHA",
    "DIRECCION", "ESTADO", "CP",
]


def imports_silver(
    df: DataFrame, *, text: Sequence[str] = TEXT_COLUMNS, day: str = "FECHA_PAGO", quantity: str = "CANTIDAD",
    value: str = "VALOR_COMERCIAL", loaded: str = "SEQ_DATE", keep_revisions: bool = False,
) -> DataFrame:
    """Typed customs records, summed per load, newest load per record, blanks as null, with the year.

    A record is its text columns and its day. ``keep_revisions`` keeps records whose sums changed between loads side by
    side, as older tables did; by default the newest load replaces the older ones.
    """
    typed = cast_columns(df, [quantity, value], [day])
    sums = typed.groupBy(*text, day, loaded).agg(
        F.sum(F.col(quantity).cast("decimal(38,12)")).cast("double").alias(quantity),
        F.sum(F.col(value).cast("decimal(38,12)")).cast("double").alias(value),
    )
    keys = [*text, day, *([quantity, value] if keep_revisions else [])]
    newest = latest_by_key(sums, keys, [loaded])
    return blank_to_null(newest, text).withColumn("ANIO", F.year(day))


def imports_cube(
    df: DataFrame, grain: str, *, day: str = "FECHA_PAGO", quantity: str = "CANTIDAD", value: str = "VALOR_COMERCIAL",
    columns: Sequence[str] | None = None, numbers: Sequence[str] = ("FRACCION", "FRACCION_NICO"),
) -> DataFrame:
    """Imports by month (value in thousands and quantity stacked by unit) or by day (side by side, with addresses)."""
    if grain not in ("month", "day"):
        raise ValueError("grain is 'month' or 'day'")
    ids = list(columns if columns is not None else MONTH_COLUMNS if grain == "month" else DAY_COLUMNS)
    codes = {c: to_number(c) for c in numbers if c in df.columns}
    dated = df.withColumns({"MES": F.month(day), "DIA": F.dayofmonth(day), **codes})
    sums = dated.groupBy(*ids).agg(
        (F.sum(F.col(value).cast("decimal(38,12)")).cast("double") / 1000).alias(value),
        F.sum(F.col(quantity).cast("decimal(38,12)")).cast("double").alias(quantity),
    )
    return sums if grain == "day" else sums.unpivot(ids, [value, quantity], "UNIDAD", quantity)
