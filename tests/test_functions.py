from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace import functions as M


def one(spark, column, value, type_="string"):
    df = spark.createDataFrame([(value,)], f"v {type_}")
    return df.select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "key, any_zero, two_zeros",
    [("0ABC", "ABC", "0ABC"), ("00ABC", "ABC", "ABC"), ("000", "0", "0"), ("0", "0", "0"), ("", "", ""), (" ", " ", " "), (None, None, None)],
)
def test_strip_zeros(spark, key, any_zero, two_zeros):
    assert one(spark, M.strip_zeros, key) == any_zero
    assert one(spark, lambda c: M.strip_zeros(c, 2), key) == two_zeros


def test_pad_key_keeps_long_keys(spark):
    assert one(spark, M.pad_key, "12") == "0000000012"
    assert one(spark, M.pad_key, "12345678901") == "12345678901"


@pytest.mark.parametrize("text, number", [("1.5", 1.5), ("NA", None), ("1,234.50", None), ("", None), (None, None)])
def test_to_number_never_fails(spark, text, number):
    assert one(spark, M.to_number, text) == number


@pytest.mark.parametrize("text, day", [("2024-02-29", date(2024, 2, 29)), ("2023-02-29", None), ("20240101", None), ("x", None), ("2024-1-05", None), ("2024-01-1 ", None), (" 2024-01-1", None), ("2024-13-01", None), ("ab24-01-01", None), ("2024-01-01T00", None)])
def test_to_day_never_fails(spark, text, day):
    assert one(spark, M.to_day, text) == day


def test_map_unit_is_exact(spark):
    assert one(spark, M.map_unit, "ST") == "PC"
    assert one(spark, M.map_unit, "KST") == "KST"


def test_composite_key_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(M.composite_key("x", "y")).collect()] == [None, "a-b"]


@pytest.mark.parametrize("month, n, out", [("2023-12", 1, "2024-01"), ("2024-01", -1, "2023-12"), ("2024-01", -13, "2022-12")])
def test_shift_period_crosses_years(spark, month, n, out):
    assert one(spark, lambda c: M.shift_period(c, n), month) == out


def test_in_period_takes_whole_months(spark):
    df = spark.createDataFrame([(date(2023, 12, 1),), (date(2024, 1, 31),), (date(2024, 2, 1),)], "d date")
    assert df.filter(M.in_period("d", "2023-12", "2024-01")).count() == 2
    assert df.filter(M.in_period("d", date(2023, 12, 20), date(2023, 12, 2))).count() == 1


def test_clamp_keeps_null(spark):
    assert one(spark, lambda c: M.clamp(c, 0.0), None, "double") is None
    assert one(spark, lambda c: M.clamp(c, 0.0), -1.0, "double") == 0.0
    assert one(spark, lambda c: M.clamp(c, 0.0, 5.0), 9.0, "double") == 5.0


@pytest.mark.parametrize("weeks, label", [(0.0, "0 - 4"), (4.0, "0 - 4"), (4.1, "4 - 12"), (21.0, "12 - 21"), (21.1, "+21"), (None, "+21")])
def test_bucket_borders(spark, weeks, label):
    got = one(spark, lambda c: M.bucket(c, [4, 12, 21], ["0 - 4", "4 - 12", "12 - 21", "+21"]), weeks, "double")
    assert got == label


def test_bucket_wants_one_label_more(spark):
    with pytest.raises(ValueError):
        M.bucket(F.lit(1), [1, 2], ["a", "b"])


def test_clean_number_drops_the_sign(spark):
    assert one(spark, M.clean_number, "$ -1,234.567") == 1234.57
    assert one(spark, M.clean_number, "none") is None


def test_key_timestamp(spark):
    assert one(spark, M.key_timestamp, "20240131235959") == datetime(2024, 1, 31, 23, 59, 59)
    assert one(spark, M.key_timestamp, "20241331000000") is None


@pytest.mark.parametrize(
    "name, out",
    [(" Número de  cliente ", "NUMERO_DE_CLIENTE"), ("Imp./Valor (MXN)", "IMP__VALOR_MXN"), ("N° doc-1=2", "NO_DOC_1_2"), ("Łódź Ørsted straße", "LODZ_ORSTED_STRASSE"), ("Ærø Þór Đỗ ẞ Ŋ Ǆ ő", "AERO_THOR_DO_SS_NG_DZ_O")],
)
def test_normalise_name(spark, name, out):
    assert one(spark, M.normalise_name, name) == out


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(M.ratio("a", "b")).collect()] == [None, 0.25, None]


def test_has_text(spark):
    assert [one(spark, M.has_text, t) for t in ("a", " ", "", None, "\t\n", " x\t")] == [True, False, False, None, False, True]
