"""Activity: the one shape of movement data that all metrics read.

A row stands for one or more lines of one key, movement type, day and text. Every window of
the rules starts and ends with a day, so lines may be added up per day without loss. Metrics
work on single lines as well as on daily sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import filled_text, strip
from shelfwise.functions.time import day_start, month_start, quarter_start
from shelfwise.params import INBOUND, OUTBOUND, Params


KEYS = ["owner_key", "article_key"]


def outbound() -> Column:
    return F.col("tipo") == OUTBOUND


def inbound() -> Column:
    return F.col("tipo") == INBOUND


def line_activity(movements: DataFrame) -> DataFrame:
    """One row per movement line."""
    stamp = F.col("fecha_movimiento")
    return movements.withColumn("_texto", strip(F.col("descripcion_movimiento"))).select(
        "owner_key",
        "article_key",
        F.col("tipo_movimiento").alias("tipo"),
        filled_text(F.col("_texto")).alias("texto"),
        F.lit(1).cast("bigint").alias("lineas"),
        F.col("cantidad_movimiento").alias("cantidad"),
        stamp.alias("primera"),
        stamp.alias("ultima"),
        F.col("row_no").alias("fila"),
    )


def _summed(activity: DataFrame, period: Column, keys: list[str] = KEYS) -> DataFrame:
    """One row per key, type, period and text.

    The text is a grouping key, not an aggregate: all buffers stay fixed-width, so both sides
    of the shuffle hash instead of sort.
    """
    return (
        activity.groupBy(*keys, "tipo", period.alias("periodo"), "texto")
        .agg(
            F.sum("lineas").alias("lineas"),
            F.sum("cantidad").alias("cantidad"),
            F.min("primera").alias("primera"),
            F.max("ultima").alias("ultima"),
            F.min("fila").alias("fila"),
        )
        .drop("periodo")
    )


def daily_activity(movements: DataFrame) -> DataFrame:
    """Daily sums: the compact base for a run that writes all tables."""
    return _summed(line_activity(movements), F.to_date("primera"))


def window_text(params: Params) -> Column:
    """The text of outbound lines in a window of the current tables. Nothing reads that of others: without it they add up."""
    first = min(params.year_start, params.rolling_start)
    return F.when(outbound() & (F.col("primera") >= day_start(first)), F.col("texto"))


def windowed_activity(movements: DataFrame, params: Params, keys: list[str] = KEYS) -> DataFrame:
    """Outbound and inbound sums per month, the month of the rolling window's first day cut in two: enough for the current
    tables of the grain of ``keys`` and above, whose windows begin with a year or that day, and for all of temporality."""
    rolling = F.col("primera") >= day_start(params.rolling_start)
    lines = line_activity(movements).where(outbound() | inbound()).withColumn("texto", window_text(params))
    return _summed(lines, F.struct(month_start(F.col("primera")).alias("mes"), rolling.alias("reciente")), keys)


def quarterly_activity(movements: DataFrame) -> DataFrame:
    """Sums per quarter: enough for the quarterly tables, whose windows are quarters, and for
    the dimensions, which have none."""
    return _summed(line_activity(movements), quarter_start(F.col("primera")))


def first_text(row: str = "fila", text: str = "texto") -> Column:
    """Aggregate: the text of the earliest row that has one; equal rows go by the text."""
    usable = F.col(text).isNotNull() & F.col(row).isNotNull()
    return F.min_by(text, F.when(usable, F.struct(row, text)))
