"""The warehouse decision per stock article."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.params import (
    ACTION_KEEP,
    ACTION_OFF_SEASON,
    ACTION_REVIEW,
    ACTION_SECONDARY,
    CODE_KEEP,
    CODE_OFF_SEASON,
    CODE_REVIEW,
    CODE_SECONDARY,
    PATTERN_ERRATIC,
    PATTERN_NEW,
    PATTERN_REGULAR,
    PRIORITY_HIGH,
    PRIORITY_LOW,
    PRIORITY_MEDIUM,
    REASON_KEEP,
    REASON_OFF_SEASON,
    REASON_REVIEW,
    REASON_SECONDARY,
    RECENT_30D,
    RECENT_YTD,
    RISK_HIGH,
    RISK_LOW,
    RISK_MEDIUM,
    WINDOW_KEEP,
    WINDOW_OFF_SEASON,
    WINDOW_OFF_SEASON_OPEN,
    WINDOW_REVIEW,
    WINDOW_SECONDARY,
    YES,
    Params,
)
from shelfwise.plans.common import stamped
from shelfwise.plans.layouts import DECISION_ARTICLE


def with_decision(detail: DataFrame, params: Params) -> DataFrame:
    """Risk, action, code, reason, window and priority. The first matching rule wins."""
    pattern, ytd, rolling = F.col("temporalidad_clase"), F.col("rotacion_final_ytd"), F.col("rotacion_final_30d")
    seasonal, soon = F.col("es_estacional"), F.col("flag_pico_proximo")
    reactivation = F.col("warning_posible_reactivacion_proxima")
    slow = ytd.isin("C", "D", RECENT_YTD) & rolling.isin("C", "D", RECENT_30D)
    busy_now = rolling.isin("A", "B")
    plenty = (F.col("flag_stock_alto_vs_uso_reciente") == YES) | (
        F.coalesce("indice_stock_vs_lineas_salida_30d", F.lit(0.0)) >= params.high_stock_index
    )

    risk = (
        F.when(
            seasonal
            | F.col("warning_rotacion_baja_pero_estacional")
            | busy_now
            | (pattern == PATTERN_REGULAR)
            | reactivation,
            RISK_HIGH,
        )
        .when(F.col("es_dormido") & ~soon, RISK_LOW)
        .otherwise(RISK_MEDIUM)
    )
    action = (
        F.when(pattern.isin(PATTERN_NEW, PATTERN_ERRATIC), ACTION_REVIEW)
        .when(
            ~seasonal
            & slow
            & plenty
            & (F.col("inactivo_90d") == YES)
            & (F.col("recurrencia_estacional") < params.low_recurrence),
            ACTION_SECONDARY,
        )
        .when(seasonal & slow & ~soon, ACTION_OFF_SEASON)
        .when(busy_now | ytd.isin("A", "B") | soon | reactivation, ACTION_KEEP)
        .otherwise(ACTION_REVIEW)
    )
    decided = detail.withColumns({"riesgo_mover_almacen": risk, "accion_recomendada": action})

    chosen = F.col("accion_recomendada")
    peak = F.coalesce("peak_period_upcoming", "next_peak_quarter")
    off_season = F.coalesce(F.concat(F.lit(WINDOW_OFF_SEASON), peak), F.lit(WINDOW_OFF_SEASON_OPEN))

    def by_action(keep, secondary, move, review):
        return (
            F.when(chosen == ACTION_KEEP, keep)
            .when(chosen == ACTION_SECONDARY, secondary)
            .when(chosen == ACTION_OFF_SEASON, move)
            .otherwise(review)
        )

    level = F.col("riesgo_mover_almacen")
    return decided.withColumns(
        {
            "accion_recomendada_codigo": by_action(CODE_KEEP, CODE_SECONDARY, CODE_OFF_SEASON, CODE_REVIEW),
            "motivo_recomendacion": by_action(REASON_KEEP, REASON_SECONDARY, REASON_OFF_SEASON, REASON_REVIEW),
            "ventana_reubicacion_recomendada": by_action(WINDOW_KEEP, WINDOW_SECONDARY, off_season, WINDOW_REVIEW),
            "prioridad_revision": F.when(level == RISK_HIGH, PRIORITY_HIGH)
            .when(level == RISK_LOW, PRIORITY_LOW)
            .otherwise(PRIORITY_MEDIUM),
            "es_candidato_mover": chosen == ACTION_SECONDARY,
            "es_candidato_mover_fuera_temporada": chosen == ACTION_OFF_SEASON,
            "es_candidato_mantener": chosen == ACTION_KEEP,
            "lineas_pi_historico": F.col("total_lineas_pi_historico"),
        }
    )


def decision_article(decided: DataFrame, params: Params) -> DataFrame:
    """The published decision table, from a detail that `with_decision` has gone over."""
    return stamped(decided, params).select(*DECISION_ARTICLE)
