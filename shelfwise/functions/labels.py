"""Names, ranks and orders of classes and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import is_recent_arrival
from shelfwise.params import MONTHS, QUARTERS, RECENT_30D, RECENT_QUARTER, RECENT_YTD


def _names(texts: list[str]) -> Column:
    return F.array(*[F.lit(text) for text in texts])


def _name(number: Column, texts: list[str]) -> Column:
    # ``element_at`` answers a null index into literals with the last entry; ``get`` with null.
    return F.get(_names(texts), number.cast("int") - 1)


def month_name(number: Column) -> Column:
    return _name(number, MONTHS)


def quarter_name(number: Column) -> Column:
    return _name(number, QUARTERS)


def _joined(numbers: Column, texts: list[str]) -> Column:
    named = F.transform(numbers, lambda n: _name(n, texts))
    return F.when(F.size(numbers) > 0, F.array_join(named, ", "))


def month_names(numbers: Column) -> Column:
    """``Mayo, Junio``; null for an empty list."""
    return _joined(numbers, MONTHS)


def quarter_names(numbers: Column) -> Column:
    return _joined(numbers, QUARTERS)


def next_peak(peaks: Column, current: int, cycle: int) -> Column:
    """Nearest peak going forward round the cycle, as ``struct(distance, number)``.

    Distance 0 is the current period. Null where there is no peak.
    """
    ahead = F.transform(
        peaks,
        lambda n: F.struct(F.pmod(n - F.lit(current), F.lit(cycle)).alias("distance"), n.alias("number")),
    )
    return F.array_min(ahead)


def class_rank(rotation: Column) -> Column:
    """Worth of a class when two quarters are compared."""
    return (
        F.when(rotation == "A", 4)
        .when(rotation == "B", 3)
        .when(rotation == "C", 2)
        .when(is_recent_arrival(rotation) | (rotation == "D"), 1)
        .otherwise(0)
    )


def class_order(rotation: Column) -> Column:
    """Position of a class in reports."""
    return (
        F.when(rotation == "A", 1)
        .when(rotation == "B", 2)
        .when(rotation == "C", 3)
        .when(rotation.isin(RECENT_YTD, RECENT_30D, RECENT_QUARTER), 4)
        .when(rotation == "D", 5)
        .otherwise(9)
    )
