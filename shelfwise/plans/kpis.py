"""Top lists and the two KPI documents.

Inputs are the published tables, already written or staged: each is read a few times here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StructType

from shelfwise.functions.labels import class_order
from shelfwise.params import (
    ACTION_REVIEW,
    PATTERN_DORMANT,
    PATTERN_ERRATIC,
    PATTERN_INTERMITTENT,
    PATTERN_NEW,
    PATTERN_REGULAR,
    PATTERN_SEASONAL,
    RECENT_30D,
    RECENT_YTD,
    RISK_HIGH,
    YES,
    Params,
)

DECIMALS = 10


def report_order(stock: str = "stock_actual_total", *more: str) -> list[Column]:
    """Order of a current table; that of the article table settles ties in the top lists."""
    return [
        class_order(F.col("rotacion_final_ytd")).asc(),
        F.col("lineas_pi_ytd").desc(),
        F.col(stock).desc(),
        F.col("articulo").asc(),
        *[F.col(name).asc() for name in more],
    ]


def _top(
    frame: DataFrame, count: int, order: list[Column], columns: list[str], wanted: Column | None = None
) -> DataFrame:
    """The first rows, numbered. The numbering window sees only those few rows.

    Rows that are ``wanted`` sort first, and the others are dropped from the first rows: a filter below the limit would
    be pushed down to the frame's input, with all the columns it reads worked out once more for every time they are named.
    """
    if wanted is None:
        best = frame.orderBy(*order).limit(count)
    else:
        best = frame.orderBy(F.coalesce(wanted, F.lit(False)).desc(), *order).limit(count).where(wanted)
    return best.withColumn("puesto", F.row_number().over(Window.orderBy(*order))).select("puesto", *columns)


def top_ytd(article_table: DataFrame, params: Params) -> DataFrame:
    order = [F.col(name).desc() for name in ("lineas_pi_ytd", "cantidad_pi_ytd", "stock_actual_total")]
    columns = "articulo descripcion lineas_pi_ytd cantidad_pi_ytd rotacion_final_ytd stock_actual_total"
    return _top(article_table, params.top_n, [*order, *report_order()], columns.split())


def top_30d(article_table: DataFrame, params: Params) -> DataFrame:
    order = [F.col(name).desc() for name in ("lineas_pi_30d", "cantidad_pi_30d", "stock_actual_total")]
    columns = "articulo descripcion lineas_pi_30d cantidad_pi_30d rotacion_final_30d stock_actual_total"
    return _top(article_table, params.top_n, [*order, *report_order()], columns.split())


def top_seasonal(detail: DataFrame, params: Params) -> DataFrame:
    order = [F.col("recurrencia_estacional").desc(), F.col("seasonality_index_quarterly").desc()]
    columns = "articulo descripcion recurrencia_estacional seasonality_index_quarterly peak_period_upcoming"
    seasonal = F.col("temporalidad_clase") == PATTERN_SEASONAL
    return _top(detail, params.top_n, [*order, *report_order()], columns.split(), seasonal)


def top_dormant(detail: DataFrame, params: Params) -> DataFrame:
    order = [F.col("stock_actual_total").desc(), F.col("lineas_pi_historico").asc()]
    columns = "articulo descripcion stock_actual_total accion_recomendada warning_stock_dormido_real"
    sleeping = F.col("warning_stock_dormido_real")
    return _top(detail, params.top_n, [*order, *report_order()], columns.split(), sleeping)


def top_risk(detail: DataFrame, params: Params) -> DataFrame:
    order = [F.col("months_to_next_peak").asc_nulls_last(), F.col("stock_actual_total").desc()]
    columns = "articulo descripcion riesgo_mover_almacen accion_recomendada peak_period_upcoming months_to_next_peak"
    risky = F.col("riesgo_mover_almacen") == RISK_HIGH
    return _top(detail, params.top_n, [*order, *report_order()], columns.split(), risky)


def kpi_abc_scalars(
    owner_table: DataFrame, article_table: DataFrame, quarters: DataFrame, params: Params
) -> DataFrame:
    """One row of totals, counts and stock per class. ``quarters`` has the period columns."""
    ytd, rolling = F.col("rotacion_final_ytd"), F.col("rotacion_final_30d")

    def stock_of(rotation: str) -> Column:
        return F.coalesce(F.sum(F.when(ytd == rotation, F.col("stock_actual_total"))), F.lit(0.0))

    classes = {"A": "A", "B": "B", "C": "C", "D": "D"}
    owners = owner_table.agg(
        F.struct(F.count("*").alias("n"), F.coalesce(F.sum("stock_actual"), F.lit(0.0)).alias("stock"))
    )
    latest = quarters.agg(F.max(F.struct("year", "quarter", "period_label")).getField("period_label"))
    articles = article_table.agg(
        F.count("*").alias("total_referencias_articulo"),
        F.coalesce(F.sum("stock_actual_total"), F.lit(0.0)).alias("stock_total_articulo"),
        *[
            F.count_if(ytd == value).alias(f"referencias_{name}_ytd")
            for name, value in (classes | {"recien_llegado": RECENT_YTD}).items()
        ],
        *[
            stock_of(value).alias(f"stock_{name}_ytd")
            for name, value in (classes | {"recien_llegado": RECENT_YTD}).items()
        ],
        *[
            F.count_if(rolling == value).alias(f"referencias_{name}_30d")
            for name, value in (classes | {"recien_llegado": RECENT_30D}).items()
        ],
        *[
            F.count_if(F.col(flag) == YES).alias(f"articulos_{flag}")
            for flag in ("flag_sobrestock", "flag_stock_alto_vs_uso_reciente", "flag_reubicar")
        ],
    )
    return articles.select(
        F.lit(params.snapshot_text).alias("snapshot_date"),
        F.lit(params.generated_at).alias("generated_at"),
        owners.scalar()["n"].alias("total_referencias_owner_article"),
        "total_referencias_articulo",
        owners.scalar()["stock"].alias("stock_total_owner_article"),
        *articles.columns[1:],
        latest.scalar().alias("ultimo_trimestre_disponible"),
    )


def temporality_scalars(detail: DataFrame, params: Params) -> DataFrame:
    """One row of pattern, action and flag counts."""
    pattern = F.col("temporalidad_clase")
    counts = {
        "numero_articulos_regulares": pattern == PATTERN_REGULAR,
        "numero_articulos_estacionales": pattern == PATTERN_SEASONAL,
        "numero_articulos_intermitentes": pattern == PATTERN_INTERMITTENT,
        "numero_articulos_dormidos": pattern == PATTERN_DORMANT,
        "numero_articulos_erraticos": pattern == PATTERN_ERRATIC,
        "numero_articulos_nuevos_sin_historico_suficiente": pattern == PATTERN_NEW,
        "numero_candidatos_mover": F.col("es_candidato_mover"),
        "numero_candidatos_mantener": F.col("es_candidato_mantener"),
        "numero_candidatos_mover_fuera_temporada": F.col("es_candidato_mover_fuera_temporada"),
        "numero_revisar_manualmente": F.col("accion_recomendada") == ACTION_REVIEW,
        "numero_pico_proximo": F.col("flag_pico_proximo"),
        "numero_posible_reactivacion_proxima": F.col("warning_posible_reactivacion_proxima"),
    }
    return detail.agg(*[F.count_if(condition).alias(name) for name, condition in counts.items()]).select(
        F.lit(params.snapshot_text).alias("snapshot_date"), F.lit(params.generated_at).alias("generated_at"), "*"
    )


def count_by(detail: DataFrame, column: str) -> DataFrame:
    return detail.groupBy(column).agg(F.count("*").alias("articulos"))


def _records(top: DataFrame) -> Column:
    """A numbered top list as one array value, in order, doubles to 10 decimals."""
    fields = [
        F.round(name, DECIMALS).alias(name) if kind == "double" else F.col(name)
        for name, kind in top.dtypes
        if name != "puesto"
    ]
    rows = top.agg(F.array_sort(F.collect_list(F.struct("puesto", F.struct(*fields).alias("fila")))).alias("filas"))
    return rows.select(F.transform("filas", lambda row: row["fila"])).scalar()


def _count_map(detail: DataFrame, column: str) -> Column:
    counts = count_by(detail, column)
    return counts.agg(F.map_from_entries(F.collect_list(F.struct(column, "articulos")))).scalar()


def _distinct_sorted(column: str) -> Column:
    return F.array_sort(F.collect_set(column))


def kpi_abc(owner_table: DataFrame, article_table: DataFrame, quarters: DataFrame, params: Params) -> DataFrame:
    """The rotation document as one row."""
    scalars = kpi_abc_scalars(owner_table, article_table, quarters, params)
    return scalars.select(
        *scalars.columns[:-1],
        _records(top_ytd(article_table, params)).alias("top_10_articulos_ytd"),
        _records(top_30d(article_table, params)).alias("top_10_articulos_30d"),
        scalars.columns[-1],
    )


def kpi_temporality(detail: DataFrame, params: Params) -> DataFrame:
    """The temporality document as one row. ``detail`` holds decision and internal columns."""
    scalars = temporality_scalars(detail, params)
    peaks = detail.agg(
        F.struct(
            _distinct_sorted("peak_period_upcoming").alias("meses"),
            _distinct_sorted("next_peak_quarter").alias("trimestres"),
        )
    )
    return scalars.select(
        "*",
        _count_map(detail, "temporalidad_clase").alias("conteo_temporalidad_clase"),
        _count_map(detail, "accion_recomendada").alias("conteo_acciones_recomendadas"),
        _records(top_seasonal(detail, params)).alias("top_estacionales"),
        _records(top_dormant(detail, params)).alias("top_dormidos"),
        _records(top_risk(detail, params)).alias("top_riesgo_mala_decision_si_se_mueven"),
        peaks.scalar()["meses"].alias("proximos_meses_pico_detectados"),
        peaks.scalar()["trimestres"].alias("proximos_trimestres_pico_detectados"),
    )


def _leaves(value: Column, kind: DataType, path: Column) -> Column:
    """The scalars below a value, as an array of (ruta, texto, numero)."""
    if isinstance(kind, StructType):
        dot = lambda f: F.concat(path, F.when(path != "", ".").otherwise(""), F.lit(f.name))
        return F.flatten(F.array(*[_leaves(value[f.name], f.dataType, dot(f)) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        return F.flatten(F.transform(F.coalesce(value, F.array()), lambda x, i: _leaves(x, kind.elementType, at(i))))
    if isinstance(kind, MapType):
        entries = F.map_entries(F.coalesce(value, F.create_map().cast(kind)))
        return F.flatten(F.transform(entries, lambda e: _leaves(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"]))))
    number = isinstance(kind, NumericType)
    text, size = (F.lit(None), value) if number else (value, F.lit(None))
    return F.array(F.struct(path.alias("ruta"), text.cast("string").alias("texto"), size.cast("double").alias("numero")))


def shredded(texts: DataFrame, kind: StructType) -> DataFrame:
    """JSON documents as rows of path and text or number: one a value, nulls included; empty lists have none."""
    parsed = texts.select(F.from_json("value", kind).alias("documento"))
    return parsed.select(F.inline(_leaves(F.col("documento"), kind, F.lit(""))))


def as_json(document: DataFrame) -> DataFrame:
    """The document as one line of JSON text; nulls are written."""
    return document.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
