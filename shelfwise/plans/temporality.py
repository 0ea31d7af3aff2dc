"""Seasonality of each article in stock: profiles, peaks, demand pattern, heat maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.labels import month_name, month_names, next_peak, quarter_name, quarter_names
from shelfwise.functions.text import is_recent_arrival, safe_divide
from shelfwise.functions.time import (
    days_since,
    month_index,
    month_label,
    month_start,
    quarter_index,
    quarter_label,
    quarter_start,
)
from shelfwise.operators.activity import outbound
from shelfwise.operators.gaps import fill_gaps
from shelfwise.params import (
    PATTERN_DORMANT,
    PATTERN_ERRATIC,
    PATTERN_INTERMITTENT,
    PATTERN_NEW,
    PATTERN_REGULAR,
    PATTERN_SEASONAL,
    RECENT_YTD,
    YES,
    Params,
)
from shelfwise.plans.common import stamped
from shelfwise.plans.layouts import (
    CURRENT_ARTICLE,
    DECISION_ARTICLE,
    TEMPORALITY_ARTICLE,
    TEMPORALITY_MONTHLY,
    TEMPORALITY_QUARTERLY,
)

# What the seasonality and decision tables take over from the current one, and what only their rules read.
_USED = {*TEMPORALITY_ARTICLE, *DECISION_ARTICLE, "propietarios_distintos", "flag_reubicar", "lineas_pi_ytd"}
BASE = [name for name in CURRENT_ARTICLE if name in _USED - {"snapshot_date", "generated_at"}]


def monthly_actual(activity: DataFrame) -> DataFrame:
    """Outbound lines per article and month with any. All of temporality is built on this."""
    return (
        activity.where(outbound())
        .groupBy("article_key", month_start(F.col("primera")).alias("mes"))
        .agg(
            F.sum("lineas").alias("lineas_pi_mes"),
            F.sum("cantidad").alias("cantidad_pi_mes"),
            F.min("primera").alias("primera"),
            F.max("ultima").alias("ultima"),
        )
    )


def quarterly_actual(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("article_key", quarter_start(F.col("mes")).alias("trimestre")).agg(
        F.sum("lineas_pi_mes").alias("lineas_pi_trimestre"), F.sum("cantidad_pi_mes").alias("cantidad_pi_trimestre")
    )


def calendar_start(monthly: DataFrame) -> Column:
    """First month with an outbound line of any article, as a one-value subquery."""
    return monthly.agg(F.min("mes")).scalar()


def _profile(actual: DataFrame, cycle: int, number: Column, lines: str, quantity: str, name: str) -> DataFrame:
    """Per article, sums by month of the year (or quarter): an array with an entry for each of the ``cycle``.

    One aggregate of fixed width, which hashes; the entry of a period without lines holds no sums.
    """
    entries = {}
    for n in range(1, cycle + 1):
        here = number == n
        entries[n] = {
            "lineas": F.sum(F.when(here, F.col(lines))),
            "cantidad": F.sum(F.when(here, F.col(quantity))),
            "activos": F.count(F.when(here, 1)),
        }
    sums = actual.groupBy("article_key").agg(
        *[value.alias(f"_{kind}_{n}") for n, entry in entries.items() for kind, value in entry.items()],
        F.sum(lines).alias(f"lineas_{name}"),
        F.sum(quantity).alias(f"cantidad_{name}"),
        F.count("*").alias(f"activos_{name}"),
        F.max(lines).alias(f"max_lineas_{name}"),
        F.max(quantity).alias(f"max_cantidad_{name}"),
        F.sum(F.col(lines).cast("double") * F.col(lines)).alias(f"cuadrados_{name}"),
    )
    structs = [F.struct(*[F.col(f"_{kind}_{n}").alias(kind) for kind in entry]) for n, entry in entries.items()]
    kept = [column for column in sums.columns if not column.startswith("_")]
    return sums.select(*kept, F.array(*structs).alias(f"perfil_{name}"))


def article_history(monthly: DataFrame) -> DataFrame:
    """One row per article ever moved outbound: history, activity and both profiles.

    Of months that are partitioned by article nothing is shuffled; no article has more rows than the calendar has months.
    """
    yearly = monthly.groupBy("article_key", F.year("mes").alias("year")).agg(
        F.min("primera").alias("primera"), F.max("ultima").alias("ultima")
    )
    history = yearly.groupBy("article_key").agg(
        F.min("primera").alias("first_pi_date"),
        F.max("ultima").alias("last_pi_date"),
        F.count("year").alias("years_with_activity"),
    )
    months = _profile(monthly, 12, F.month("mes"), "lineas_pi_mes", "cantidad_pi_mes", "mes")
    quarters = _profile(
        quarterly_actual(monthly), 4, F.quarter("trimestre"), "lineas_pi_trimestre", "cantidad_pi_trimestre", "trimestre"
    )
    return history.join(months, "article_key").join(quarters, "article_key")


def _dense_profile(entries: Column, first: Column, last: Column, cycle: int, years: Column) -> Column:
    """All periods of the year that the calendar holds, with means over their occurrences.

    ``first`` and ``last`` are the calendar's ends as running period numbers, so the number
    of occurrences of a period is a difference of two floors. The entries are written out, without
    lambdas: whatever they share is computed once a row.
    """

    def entry(n: int) -> Column:
        occurrences = F.floor((last - n + 1) / cycle) - F.floor((first - n) / cycle)
        found = entries[n - 1]
        lines = F.coalesce(found["lineas"], F.lit(0))
        quantity = F.coalesce(found["cantidad"], F.lit(0.0))
        active = F.coalesce(found["activos"], F.lit(0))
        return F.when(
            occurrences > 0,
            F.struct(
                F.lit(n).alias("n"),
                safe_divide(lines, occurrences).alias("lineas_media"),
                safe_divide(quantity, occurrences).alias("cantidad_media"),
                lines.alias("lineas_total"),
                quantity.alias("cantidad_total"),
                active.alias("activos"),
                F.coalesce(safe_divide(active, years), F.lit(0.0)).alias("recurrencia"),
            ),
        )

    return F.array_compact(F.array(*[entry(n) for n in range(1, cycle + 1)]))


def _top(profile: Column, *order: str) -> Column:
    """Number of the best entry; ties go to the lower number."""
    ranked = F.transform(
        profile, lambda e: F.struct(*[e[name].alias(name) for name in order], (-e["n"]).alias("n"))
    )
    return -F.array_max(ranked)["n"]


def _best_sum(profile: Column, count: int) -> Column:
    best = F.slice(F.sort_array(F.transform(profile, lambda e: e["lineas_total"]), asc=False), 1, count)
    return F.aggregate(best, F.lit(0).cast("bigint"), lambda total, value: total + value)


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda total, value: total + value)
    return F.coalesce(F.try_divide(total, F.size(values).cast("double")), F.lit(0.0))


def _peaks(profile: Column, mean: Column, factor: float, recurrence: float) -> Column:
    return F.filter(
        profile,
        lambda e: (e["lineas_media"] >= mean * factor)
        & (e["recurrencia"] >= recurrence)
        & (e["lineas_total"] > 0),
    )


def with_profiles(base: DataFrame, monthly: DataFrame, params: Params) -> DataFrame:
    """Stock articles with their history and dense month and quarter profiles."""
    start = calendar_start(monthly)
    end = F.lit(params.snapshot)
    found = base.join(article_history(monthly), "article_key", "left").fillna(
        {"years_with_activity": 0}
        | {
            f"{name}_{kind}": 0
            for kind in ("mes", "trimestre")
            for name in ("lineas", "cantidad", "activos", "max_lineas", "max_cantidad", "cuadrados")
        }
    )
    years = F.col("years_with_activity")
    found = found.withColumn("inicio", start)
    begin = F.col("inicio")
    return found.withColumns(
        {
            "meses_calendario": month_index(end) - month_index(begin) + 1,
            "trimestres_calendario": quarter_index(end) - quarter_index(begin) + 1,
            "perfil_mes": _dense_profile(
                F.col("perfil_mes"), month_index(begin), month_index(end), 12, years
            ),
            "perfil_trimestre": _dense_profile(
                F.col("perfil_trimestre"), quarter_index(begin), quarter_index(end), 4, years
            ),
        }
    )


def with_statistics(profiles: DataFrame, params: Params) -> DataFrame:
    """Means, maxima, peaks, concentration, indices, intermittency and variability."""

    def mean_of(total: str, periods: str) -> Column:
        return F.coalesce(safe_divide(F.col(total), F.col(periods)), F.lit(0.0))

    # A calendar month without lines counts as 0, which beats a negative quantity.
    gap = F.col("activos_mes") < F.col("meses_calendario")
    top_quantity = F.col("max_cantidad_mes")
    stats = profiles.withColumns(
        {
            "total_months_with_pi": F.col("activos_mes"),
            "total_quarters_with_pi": F.col("activos_trimestre"),
            "total_lineas_pi_historico": F.col("lineas_mes"),
            "total_cantidad_pi_historico": F.col("cantidad_mes"),
            "lineas_media_mensual": mean_of("lineas_mes", "meses_calendario"),
            "cantidad_media_mensual": mean_of("cantidad_mes", "meses_calendario"),
            "lineas_pi_trimestre_media": mean_of("lineas_mes", "trimestres_calendario"),
            "cantidad_pi_trimestre_media": mean_of("cantidad_mes", "trimestres_calendario"),
            "lineas_max_mes": F.col("max_lineas_mes"),
            "cantidad_max_mes": F.when(gap, F.greatest(top_quantity, F.lit(0.0))).otherwise(top_quantity),
            "mes_pico_numero": _top(F.col("perfil_mes"), "lineas_media", "cantidad_media"),
            "mes_pico_cantidad_numero": _top(F.col("perfil_mes"), "cantidad_media", "lineas_media"),
            "trimestre_pico_numero": _top(F.col("perfil_trimestre"), "lineas_media"),
        }
    )

    lines = F.col("total_lineas_pi_historico")
    month, quarter = F.col("perfil_mes"), F.col("perfil_trimestre")

    def share(profile: Column, count: int) -> Column:
        return F.coalesce(safe_divide(_best_sum(profile, count), lines), F.lit(0.0))

    def index(profile: Column, mean: str) -> Column:
        best = F.array_max(F.transform(profile, lambda e: e["lineas_media"]))
        return F.coalesce(safe_divide(best, F.col(mean)), F.lit(0.0))

    stats = stats.withColumns(
        {
            "porcentaje_concentracion_top_1_mes": share(month, 1),
            "porcentaje_concentracion_top_2_meses": share(month, 2),
            "porcentaje_concentracion_top_1_trimestre": share(quarter, 1),
            "porcentaje_concentracion_top_2_trimestres": share(quarter, 2),
            "porcentaje_concentracion_top_trimestre": share(quarter, 1),
            "seasonality_index_monthly": index(month, "lineas_media_mensual"),
            "seasonality_index_quarterly": index(quarter, "lineas_pi_trimestre_media"),
            "picos_mes": _peaks(
                month, F.col("lineas_media_mensual"), params.peak_month_factor, params.peak_recurrence
            ),
            "picos_trimestre": _peaks(
                quarter, F.col("lineas_pi_trimestre_media"), params.peak_quarter_factor, params.peak_recurrence
            ),
        }
    )

    observed = month_index(F.lit(params.snapshot)) - month_index(F.col("first_pi_date")) + 1
    # Squared coefficient of variation of the months with lines, from exact sums.
    count, total, squares = F.col("activos_mes"), F.col("lineas_mes").cast("double"), F.col("cuadrados_mes")
    ratio = F.sqrt(F.greatest(count * squares - total * total, F.lit(0.0))) / total
    return stats.withColumns(
        {
            "peak_months": F.transform("picos_mes", lambda e: e["n"]),
            "peak_quarters": F.transform("picos_trimestre", lambda e: e["n"]),
            "monthly_peak_recurrence": _mean(F.transform("picos_mes", lambda e: e["recurrencia"])),
            "quarterly_peak_recurrence": _mean(F.transform("picos_trimestre", lambda e: e["recurrencia"])),
            "months_observed": F.coalesce(observed, F.lit(0)),
            "ADI": F.coalesce(safe_divide(observed, count), F.lit(0.0)),
            "CV2": F.when(count > 1, ratio * ratio).otherwise(0.0),
        }
    )


def with_pattern(stats: DataFrame, params: Params) -> DataFrame:
    """Next peak and demand pattern. The first matching rule wins."""
    stats = stats.withColumns(
        {
            "recurrencia_estacional": F.greatest("monthly_peak_recurrence", "quarterly_peak_recurrence"),
            "proximo_mes": next_peak(F.col("peak_months"), params.snapshot.month, 12),
            "proximo_trimestre": next_peak(F.col("peak_quarters"), params.quarter, 4),
        }
    )
    insufficient = (
        (F.col("total_lineas_pi_historico") == 0)
        | (F.col("months_observed") < params.min_months_observed)
        | (F.col("total_months_with_pi") < params.min_active_months)
    )
    age = days_since(F.lit(params.snapshot), F.col("last_pi_date"))
    dormant = (F.col("last_pi_date").isNull() | (age > params.dormant_days)) & (
        F.col("total_months_with_pi") <= params.dormant_max_months
    )
    by_month = (
        (F.col("seasonality_index_monthly") >= params.seasonal_index_month)
        & (F.col("porcentaje_concentracion_top_2_meses") >= params.seasonal_top2_months)
        & (F.col("monthly_peak_recurrence") >= params.peak_recurrence)
    )
    by_quarter = (
        (F.col("seasonality_index_quarterly") >= params.seasonal_index_quarter)
        & (F.col("porcentaje_concentracion_top_1_trimestre") >= params.seasonal_top_quarter)
        & (F.col("quarterly_peak_recurrence") >= params.peak_recurrence)
    )
    seasonal = (F.col("years_with_activity") >= params.seasonal_years) & (by_month | by_quarter)
    return stats.withColumns(
        {
            "temporalidad_clase": F.when(insufficient, PATTERN_NEW)
            .when(dormant, PATTERN_DORMANT)
            .when(seasonal, PATTERN_SEASONAL)
            .when(F.col("CV2") >= params.erratic_cv2, PATTERN_ERRATIC)
            .when(F.col("ADI") >= params.intermittent_adi, PATTERN_INTERMITTENT)
            .otherwise(PATTERN_REGULAR),
            "peak_period_upcoming": month_name(F.col("proximo_mes.number")),
            "months_to_next_peak": F.col("proximo_mes.distance").cast("double"),
            "next_peak_quarter": quarter_name(F.col("proximo_trimestre.number")),
            "quarters_to_next_peak": F.col("proximo_trimestre.distance").cast("double"),
            "meses_pico_recurrentes": month_names(F.col("peak_months")),
            "trimestres_pico_recurrentes": quarter_names(F.col("peak_quarters")),
            "mes_pico_lineas": month_name(F.col("mes_pico_numero")),
            "mes_pico_cantidad": month_name(F.col("mes_pico_cantidad_numero")),
            "quarter_peak": quarter_name(F.col("trimestre_pico_numero")),
        }
    )


def with_warnings(patterned: DataFrame, params: Params) -> DataFrame:
    pattern = F.col("temporalidad_clase")
    seasonal, dormant = pattern == PATTERN_SEASONAL, pattern == PATTERN_DORMANT
    soon = F.coalesce(F.col("months_to_next_peak") <= params.peak_soon_months, F.lit(False))
    sleeping = dormant & (F.col("stock_actual_total") > 0) & (F.col("inactivo_90d") == YES)
    arrived = is_recent_arrival(F.col("rotacion_final_ytd")) | is_recent_arrival(F.col("rotacion_final_30d"))
    entered = F.coalesce(F.col("dias_desde_ultima_cr") <= params.rolling_days, F.lit(False))
    comes_back = pattern.isin(PATTERN_SEASONAL, PATTERN_INTERMITTENT, PATTERN_DORMANT)
    return patterned.withColumns(
        {
            "es_estacional": seasonal,
            "es_dormido": dormant,
            "es_intermitente": pattern == PATTERN_INTERMITTENT,
            "es_erratico": pattern == PATTERN_ERRATIC,
            "flag_pico_proximo": soon,
            "warning_rotacion_baja_pero_estacional": seasonal
            & F.col("rotacion_final_ytd").isin("C", "D", RECENT_YTD),
            "warning_stock_dormido_real": sleeping,
            "warning_stock_inmovilizado_sin_salida_reciente": sleeping,
            "warning_posible_reactivacion_proxima": (soon & comes_back) | (arrived & entered),
        }
    )


def temporality_detail(current_article: DataFrame, monthly: DataFrame, params: Params) -> DataFrame:
    """All temporality columns per stock article, published and internal."""
    profiles = with_profiles(current_article.select(*BASE), monthly, params)
    return with_warnings(with_pattern(with_statistics(profiles, params), params), params)


def temporality_article(detail: DataFrame, params: Params) -> DataFrame:
    return stamped(detail, params).select(*TEMPORALITY_ARTICLE)


def _dense(
    detail: DataFrame, actual: DataFrame, period: str, months: int, end: Column, start: Column, values: list[str]
) -> DataFrame:
    """Every stock article in every calendar period, 0 where it had no line.

    Each article gets a zero row in the first period; sums merge it with a real one; gaps are
    filled from there. One shuffle by article serves the sums, the join and the gap filling.
    """
    lines, quantity = values
    seeds = detail.select(
        "article_key",
        start.alias(period),
        F.lit(0).cast("bigint").alias(lines),
        F.lit(0.0).alias(quantity),
    ).where(F.col(period).isNotNull())
    merged = (
        actual.select("article_key", period, *values)
        .unionByName(seeds)
        .repartition("article_key")
        .groupBy("article_key", period)
        .agg(F.sum(lines).alias(lines), F.sum(quantity).alias(quantity))
    )
    blank = {lines: F.lit(0).cast("bigint"), quantity: F.lit(0.0)}
    return fill_gaps(merged.join(detail, "article_key"), ["article_key"], period, end, months, blank)


def monthly_dense(articles: DataFrame, monthly: DataFrame, params: Params) -> DataFrame:
    return _dense(
        articles,
        monthly,
        "mes",
        1,
        F.lit(params.month_start),
        calendar_start(monthly),
        ["lineas_pi_mes", "cantidad_pi_mes"],
    ).withColumns({"year": F.year("mes"), "month": F.month("mes"), "period_label": month_label(F.col("mes"))})


def quarterly_dense(articles: DataFrame, monthly: DataFrame, params: Params) -> DataFrame:
    return _dense(
        articles,
        quarterly_actual(monthly),
        "trimestre",
        3,
        F.lit(params.quarter_start),
        quarter_start(calendar_start(monthly)),
        ["lineas_pi_trimestre", "cantidad_pi_trimestre"],
    ).withColumns(
        {
            "year": F.year("trimestre"),
            "quarter": F.quarter("trimestre"),
            "period_label": quarter_label(F.col("trimestre")),
        }
    )


def temporality_monthly(detail: DataFrame, monthly: DataFrame, params: Params) -> DataFrame:
    """Monthly heat map: lines against the article's mean, and is it a peak month?"""
    articles = detail.select(
        "id_article", "articulo", "article_key", "descripcion", "lineas_media_mensual", "peak_months"
    )
    index = F.coalesce(safe_divide(F.col("lineas_pi_mes"), F.col("lineas_media_mensual")), F.lit(0.0))
    return (
        stamped(monthly_dense(articles, monthly, params), params)
        .withColumns({"indice_vs_media": index, "es_mes_pico": F.array_contains("peak_months", F.col("month"))})
        .select(*TEMPORALITY_MONTHLY)
    )


def temporality_quarterly(detail: DataFrame, monthly: DataFrame, params: Params) -> DataFrame:
    articles = detail.select(
        "id_article", "articulo", "article_key", "descripcion", "lineas_pi_trimestre_media", "peak_quarters"
    )
    index = F.coalesce(
        safe_divide(F.col("lineas_pi_trimestre"), F.col("lineas_pi_trimestre_media")), F.lit(0.0)
    )
    return (
        stamped(quarterly_dense(articles, monthly, params), params)
        .withColumns(
            {"indice_vs_media": index, "es_trimestre_pico": F.array_contains("peak_quarters", F.col("quarter"))}
        )
        .select(*TEMPORALITY_QUARTERLY)
    )
