"""Final rotation class, criteria text, coverage, inactivity and stock flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import is_recent_arrival, safe_divide, yes_no
from shelfwise.functions.time import days_since, end_of_day
from shelfwise.operators.quantiles import exact_quantiles
from shelfwise.params import CRITERIA_RECENT, Params, YES


def recent_arrival(lines: Column, last_inbound: Column, reference: Column, params: Params) -> Column:
    """No outbound line, and an inbound one after the last instant of day ``reference - 14``."""
    cutoff = end_of_day(F.date_sub(reference, params.recent_days))
    return (lines == 0) & F.coalesce(last_inbound >= cutoff, F.lit(False))


def final_class(rotation: Column, lines: Column, recent: Column, recent_text: str) -> Column:
    return F.when(recent, recent_text).when(lines == 0, "D").otherwise(rotation)


def criteria(final: Column, recent: Column, active: Column, idle: Column, params: Params) -> Column:
    return (
        F.when(recent, CRITERIA_RECENT.format(n=params.recent_days)).when(final == "D", idle).otherwise(active)
    )


def inactive(last_outbound: Column, params: Params, days: int) -> Column:
    """Yes when the last outbound line ever is more than ``days`` ago, or there is none."""
    age = days_since(F.lit(params.snapshot), last_outbound)
    return yes_no(last_outbound.isNull() | (age > days))


def with_usage(frame: DataFrame, stock: str) -> DataFrame:
    """Density, dispersion, and stock against recent outbound lines and quantity."""
    by_lines = safe_divide(F.col(stock), F.col("lineas_pi_30d"))
    by_quantity = safe_divide(F.col(stock), F.col("cantidad_pi_30d"))
    return frame.withColumns(
        {
            "cobertura_lineas_30d": by_lines,
            "cobertura_cantidad_30d": by_quantity,
            "indice_stock_vs_lineas_salida_30d": by_lines,
            "indice_stock_vs_cantidad_salida_30d": by_quantity,
            "dispersion_stock": F.col("ubicaciones_con_stock"),
            "densidad_stock": safe_divide(F.col(stock), F.col("ubicaciones_con_stock")),
        }
    )


def stock_thresholds(stock: DataFrame, amount: str, params: Params) -> DataFrame:
    """One row: upper quantiles of stock and locations, lower quantile of density."""
    locations = F.col("ubicaciones_con_stock")
    positive = F.col(amount) > 0
    density = safe_divide(F.col(amount), locations)
    return exact_quantiles(
        stock,
        {
            "umbral_stock": (F.when(positive, F.col(amount)), params.stock_quantile),
            "umbral_ubicaciones": (F.when(positive, locations), params.stock_quantile),
            "umbral_densidad": (F.when(locations > 1, density), params.density_quantile),
        },
    )


def with_flags(frame: DataFrame, thresholds: DataFrame, amount: str, params: Params) -> DataFrame:
    """Overstock and relocation flags.

    The thresholds are one row of three numbers, a subquery that runs with the table.
    """
    frame = frame.withColumn("_limits", thresholds.select(F.struct(*thresholds.columns)).scalar())
    limits = F.col("_limits")
    rotation = F.col("rotacion_final_ytd")
    overstock = (
        (F.col(amount) >= limits["umbral_stock"])
        & rotation.isin("C", "D")
        & (F.col("inactivo_90d") == YES)
        & ~is_recent_arrival(rotation)
    )
    relocate = (
        rotation.isin("A", "B")
        & (F.col("ubicaciones_con_stock") >= F.greatest(F.lit(float(params.min_locations)), limits["umbral_ubicaciones"]))
        & (F.coalesce("densidad_stock", F.lit(0.0)) <= limits["umbral_densidad"])
    )
    return frame.withColumns(
        {
            "flag_sobrestock": yes_no(overstock),
            "flag_stock_alto_vs_uso_reciente": yes_no(overstock),
            "flag_reubicar": yes_no(relocate),
        }
    ).drop("_limits")
