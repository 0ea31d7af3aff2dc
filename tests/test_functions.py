from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType

from shelfwise.functions.labels import class_rank, month_name, month_names, next_peak, quarter_names
from shelfwise.functions.text import bare_key, filled_text, is_filled, normalize_key, number_or_zero, safe_divide, strip
from shelfwise.functions.time import end_of_day, parse_stamp
from shelfwise.sources.stock import snapshot_date_from_name


def one(spark, schema, values, expression):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {schema}")
    return [row.x for row in rows.select("n", expression(F.col("v")).alias("x")).orderBy("n").collect()]


def test_keys(spark):
    raw = [" 019080\t", "123.0", "NaN", " nan ", "", "  ", None, "A1.0", "1.00", " x ", "x y", "nana"]
    wanted = ["019080", "123", None, None, None, None, None, "A1.0", "1.00", "x", "x y", "nana"]
    assert one(spark, "string", raw, lambda v: normalize_key(bare_key(v))) == wanted
    # The filter agrees with the key.
    kept = one(spark, "string", raw, is_filled)
    assert [bool(k) for k in kept] == [w is not None for w in wanted]


def test_strip_matches_python(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = [f"{b}a{b}b{b}" for b in blanks] + ["ñ", " ñ", "ñ ", "é　"]
    assert one(spark, "string", texts, strip) == [t.strip() for t in texts]
    assert one(spark, "string", [b + b for b in blanks], lambda v: filled_text(strip(v))) == [None] * len(blanks)
    assert not any(one(spark, "string", [b + "NaN" + b for b in blanks], is_filled))


def test_numeric_keys(spark):
    values = [123.0, 12345678.0, 1.5, float("nan"), None]
    assert one(spark, "double", values, lambda v: normalize_key(bare_key(v, DoubleType()))) == [
        "123",
        "12345678",
        "1.5",
        None,
        None,
    ]


def test_numbers(spark):
    assert one(spark, "string", ["5", "-2.5", "x", "", None, "NaN"], number_or_zero) == [5, -2.5, 0, 0, 0, 0]
    assert one(spark, "double", [1.5, float("nan"), None], lambda v: number_or_zero(v, DoubleType())) == [1.5, 0, 0]
    assert one(spark, "double", [2.0, 0.0, None], lambda v: safe_divide(F.lit(5), v)) == [2.5, None, None]


def test_dates(spark):
    texts = ["31/03/2026", "31/03/2026 08:05:00", "2026-03-31", "31/02/2026", "x", None]
    assert one(spark, "string", texts, lambda v: parse_stamp(v, StringType())) == [
        datetime(2026, 3, 31),
        datetime(2026, 3, 31, 8, 5),
        None,
        None,
        None,
        None,
    ]
    assert one(spark, "date", [date(2026, 3, 31)], lambda v: parse_stamp(v, DateType())) == [datetime(2026, 3, 31)]
    assert one(spark, "date", [date(2026, 3, 31)], end_of_day) == [datetime(2026, 3, 31, 23, 59, 59, 999999)]


def test_snapshot_names(spark):
    names = ["31-03-2026.xlsx", "foto 01-02-2025 b.csv", "movimientos.xlsx", "31-02-2026.xlsx"]
    assert one(spark, "string", names, snapshot_date_from_name) == [date(2026, 3, 31), date(2025, 2, 1), None, None]


@pytest.mark.parametrize(
    "peaks, month, distance", [([1, 3, 6], "Junio", 2), ([4], "Abril", 0), ([3], "Marzo", 11), ([], None, None)]
)
def test_next_peak(spark, peaks, month, distance):
    rows = spark.createDataFrame([(peaks,)], "p array<int>")
    found = rows.select(next_peak(F.col("p"), 4, 12).alias("x")).select(
        month_name(F.col("x.number")).alias("m"), F.col("x.distance").alias("d")
    )
    assert tuple(found.first()) == (month, distance)


def test_names(spark):
    rows = spark.createDataFrame([([5, 6], [2]), ([], [])], "m array<int>, q array<int>")
    found = rows.select(month_names(F.col("m")), quarter_names(F.col("q"))).collect()
    assert [tuple(row) for row in found] == [("Mayo, Junio", "Q2"), (None, None)]
    # A null index into literals must stay null.
    assert one(spark, "int", [None, 1, 12], month_name) == [None, "Enero", "Diciembre"]


def test_class_rank(spark):
    classes = ["A", "B", "C", "D", "Sin rotación 30d, recién llegado", "?"]
    assert one(spark, "string", classes, class_rank) == [4, 3, 2, 1, 1, 0]


def test_day_first_dates_and_plain_numbers(spark):
    texts = ["31/03/2026 10:30", "1/3/2026", "31/03/2026 8:05:00", "31/02/2026", "2026-03-31", "1/3/26", "10/10/2026 25:00", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_stamp(F.col("t"), StringType()).alias("s")).collect()
    assert [str(r.s) if r.s else None for r in rows] == [
        "2026-03-31 10:30:00", "2026-03-01 00:00:00", "2026-03-31 08:05:00", None, None, None, None, None
    ]
    texts = ["10", " 2.5 ", "-3", "1e3", ".5", "10d", "5F", "0x1p3", "NaN", "Infinity", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(number_or_zero(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows] == [10.0, 2.5, -3.0, 1000.0, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]
