"""Current rotation and stock, per owner and article and per article."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.time import days_since
from shelfwise.operators.metrics import ARTICLE, OWNER_ARTICLE, key_metrics, text_sums
from shelfwise.operators.pareto import Measure, ranked
from shelfwise.operators.rotation import (
    criteria,
    final_class,
    inactive,
    recent_arrival,
    stock_thresholds,
    with_flags,
    with_usage,
)
from shelfwise.params import (
    CRITERIA_ARTICLE_ACTIVE,
    CRITERIA_ARTICLE_IDLE,
    CRITERIA_OWNER_ACTIVE,
    CRITERIA_OWNER_IDLE,
    RECENT_30D,
    RECENT_YTD,
    Params,
)
from shelfwise.plans.common import stamped, with_ids
from shelfwise.plans.layouts import CURRENT_ARTICLE, CURRENT_OWNER_ARTICLE, ROLLING_ARTICLE, ROLLING_OWNER_ARTICLE


@dataclass(frozen=True)
class Grain:
    """What differs between the owner and the article variants of the current table."""

    keys: list[str]
    stock: str
    active: str
    idle: str
    layout: list[str]
    rolling: list[str]


BY_OWNER = Grain(
    OWNER_ARTICLE, "stock_actual", CRITERIA_OWNER_ACTIVE, CRITERIA_OWNER_IDLE, CURRENT_OWNER_ARTICLE, ROLLING_OWNER_ARTICLE
)
BY_ARTICLE = Grain(
    ARTICLE, "stock_actual_total", CRITERIA_ARTICLE_ACTIVE, CRITERIA_ARTICLE_IDLE, CURRENT_ARTICLE, ROLLING_ARTICLE
)

HORIZONS = {"ytd": RECENT_YTD, "30d": RECENT_30D}


def classified_metrics(
    activity: DataFrame, keys: list[str], params: Params, shares: bool, horizons: tuple[str, ...] = tuple(HORIZONS)
) -> DataFrame:
    """Log metrics of every key ever moved, ranked by the lines of each horizon.

    The rankings are over all keys with outbound lines, whether in stock or not. Without ``shares``
    the cumulative ones are left out, and with them the order of all keys.
    """
    measures = [
        Measure(
            f"lineas_pi_{name}",
            f"cantidad_pi_{name}",
            f"rotacion_abc_{name}",
            f"porcentaje_lineas_pi_{name}",
            f"porcentaje_acumulado_pi_{name}" if shares else None,
        )
        for name in horizons
    ]
    found = key_metrics(text_sums(activity, params), keys)
    others = [name for name in found.columns for other in HORIZONS if other not in horizons and name.endswith(f"_{other}")]
    return ranked(found.drop(*others), params, keys, measures)


def rotation(
    activity: DataFrame, stock: DataFrame, grain: Grain, params: Params, shares: bool = True, horizons: tuple[str, ...] = tuple(HORIZONS)
) -> DataFrame:
    """Stock keys with their log metrics, final classes and criteria for the horizons.

    ``activity`` may be the log's ``text_sums``, from which both grains are made.
    """
    found = stock.join(classified_metrics(activity, grain.keys, params, shares, horizons), grain.keys, "left")
    zeros = {"lineas_cr_historico": 0, "cantidad_cr_historico": 0.0}
    for horizon in horizons:
        zeros |= {
            f"lineas_pi_{horizon}": 0,
            f"cantidad_pi_{horizon}": 0.0,
            f"rotacion_abc_{horizon}": "D",
            f"porcentaje_lineas_pi_{horizon}": 0.0,
            f"porcentaje_acumulado_pi_{horizon}": 0.0,
        }
    found = found.fillna({name: value for name, value in zeros.items() if name in found.columns})

    day = F.lit(params.snapshot)
    new = {"dias_desde_ultima_cr": days_since(day, F.col("ultima_cr"))}
    for horizon in horizons:
        recent_text = HORIZONS[horizon]
        lines = F.col(f"lineas_pi_{horizon}")
        recent = recent_arrival(lines, F.col("ultima_cr"), day, params)
        final = final_class(F.col(f"rotacion_abc_{horizon}"), lines, recent, recent_text)
        new[f"rotacion_final_{horizon}"] = final
        new[f"dias_desde_ultima_pi_{horizon}"] = days_since(day, F.col(f"ultima_pi_{horizon}"))
        if horizon == "ytd":
            year = params.snapshot.year
            active = F.lit(grain.active.format(y=year))
            idle = F.lit(grain.idle.format(y=year, n=params.recent_days))
            new["criterio_rotacion_ytd"] = criteria(final, recent, active, idle, params)
    return found.withColumns(new)


def current(rotated: DataFrame, stock: DataFrame, grain: Grain, params: Params) -> DataFrame:
    """The published current table of one grain, from its rotation; without the shares that a rotation leaves out."""
    short, long = params.inactive_days
    detail = rotated.withColumns(
        {
            "descripcion": F.coalesce("descripcion_stock", "descripcion_pi_ytd"),
            f"inactivo_{short}d": inactive(F.col("ultima_pi_historica"), params, short),
            f"inactivo_{long}d": inactive(F.col("ultima_pi_historica"), params, long),
        }
    )
    detail = with_usage(detail, grain.stock)
    detail = with_flags(detail, stock_thresholds(stock, grain.stock, params), grain.stock, params)
    detail = stamped(with_ids(detail), params)
    return detail.select(*[name for name in grain.layout if name in detail.columns])


def current_owner_article(activity: DataFrame, stock: DataFrame, params: Params, shares: bool = True) -> DataFrame:
    return current(rotation(activity, stock, BY_OWNER, params, shares), stock, BY_OWNER, params)


def current_article(activity: DataFrame, stock: DataFrame, params: Params, shares: bool = True) -> DataFrame:
    return current(rotation(activity, stock, BY_ARTICLE, params, shares), stock, BY_ARTICLE, params)


def inactivity(activity: DataFrame, stock: DataFrame, grain: Grain, params: Params) -> DataFrame:
    """Keys in stock and whether they have rested for each number of days; no ranking is needed."""
    last = key_metrics(text_sums(activity, params), grain.keys).select(*grain.keys, "ultima_pi_historica")
    flags = {f"inactivo_{days}d": inactive(F.col("ultima_pi_historica"), params, days) for days in params.inactive_days}
    return stock.select(*grain.keys).join(last, grain.keys, "left").withColumns(flags)


def rolling_detail(rotated: DataFrame, grain: Grain) -> DataFrame:
    """The 30-day audit table, from a grain's rotation. Its text falls back to the first one of the 30 days."""
    text = F.coalesce("descripcion_stock", "descripcion_pi_30d")
    return with_ids(rotated).withColumn("descripcion", text).select(*grain.rolling)
