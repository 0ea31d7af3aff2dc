"""Exact quantiles of a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.running import running_total


def exact_quantiles(frame: DataFrame, measures: dict[str, tuple[Column, float]]) -> DataFrame:
    """One row, one column per measure: the quantile with linear interpolation, 0 without rows.

    All measures go through one histogram. Equal values are counted before the shuffle, and
    the counts are accumulated with the distributed running total, so no task ever holds a
    whole measure. Nulls do not count.
    """
    names = list(measures)
    cells = [
        F.struct(F.lit(name).alias("measure"), value.cast("double").alias("value"))
        for name, (value, _) in measures.items()
    ]
    values = frame.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    histogram = values.where(F.col("value").isNotNull()).groupBy("measure", "value").agg(F.count("*").alias("n"))
    placed = running_total(histogram, "n", [F.col("value").asc()], ["measure"], "before", "total")

    level = F.lit(None).cast("double")
    for name, (_, quantile) in measures.items():
        level = F.when(F.col("measure") == name, F.lit(quantile)).otherwise(level)
    place = (F.col("total") - 1) * level
    rank = F.floor(place)

    def at(wanted: Column) -> Column:
        held = (F.col("before") <= wanted) & (wanted < F.col("before") + F.col("n"))
        return F.max(F.when(held, F.col("value")))

    found = placed.groupBy("measure").agg(
        at(rank).alias("low"), at(rank + 1).alias("high"), F.max(place - rank).alias("part")
    )
    low, high = F.col("low"), F.coalesce(F.col("high"), F.col("low"))
    answer = low + (high - low) * F.col("part")
    return found.agg(
        *[F.coalesce(F.max(F.when(F.col("measure") == name, answer)), F.lit(0.0)).alias(name) for name in names]
    )
