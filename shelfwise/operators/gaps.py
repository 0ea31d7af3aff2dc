"""Filling the gaps of a sparse time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Last period of a row's span.
LAST = "_last"


def with_spans(sparse: DataFrame, keys: list[str], period: str, end: Column, months: int) -> DataFrame:
    """Add ``LAST``: a row's state holds from its ``period`` up to it, the one before the key's next row, or ``end``.

    One row a change is what joins and rankings should see; ``expand`` makes the periods of it at the end.
    """
    following = F.lead(period).over(Window.partitionBy(*keys).orderBy(period))
    return sparse.withColumn(LAST, F.coalesce(F.add_months(following, -months), end))


def expand(spans: DataFrame, period: str, months: int, blank: dict[str, Column]) -> DataFrame:
    """One row per period of every span. ``blank`` gives the values of measures after a span's first period."""
    step = F.make_interval(months=F.lit(months))
    rows = spans.withColumn("_period", F.explode(F.sequence(F.col(period), F.col(LAST), step)))
    original = F.col("_period") == F.col(period)
    return (
        rows.withColumns({name: F.when(original, F.col(name)).otherwise(value) for name, value in blank.items()})
        .withColumn(period, F.col("_period"))
        .drop(LAST, "_period")
    )


def fill_gaps(
    sparse: DataFrame,
    keys: list[str],
    period: str,
    end: Column,
    months: int,
    blank: dict[str, Column],
) -> DataFrame:
    """One row per key and period, from the key's first period to ``end``.

    Each row is repeated up to the period before the key's next row. ``blank`` gives the values
    of measures in the added rows; all other columns carry forward. Nothing is joined: the
    rows stay where the window put them.
    """
    return expand(with_spans(sparse, keys, period, end, months), period, months, blank)
