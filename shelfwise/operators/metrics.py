"""Aggregates of activity and stock per key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import filled_text, strip
from shelfwise.functions.time import day_start, within
from shelfwise.operators.activity import KEYS, first_text, inbound, outbound, window_text
from shelfwise.params import Params

OWNER_ARTICLE = KEYS
ARTICLE = ["article_key"]


def known_owner(activity: DataFrame, keys: list[str]) -> DataFrame:
    """Lines without an owner count for an article but not for an owner."""
    return activity.where(F.col("owner_key").isNotNull()) if "owner_key" in keys else activity


def pi_metrics(activity: DataFrame, keys: list[str], first: date, past: date) -> DataFrame:
    """Outbound lines, quantity, last date and first text per key inside a window of days.

    Grouping by key and text first leaves a handful of rows per key, so that the text, which
    cannot be aggregated by hash, is only picked from those.
    """
    window = known_owner(activity, keys).where(outbound() & within(F.col("primera"), first, past))
    by_text = window.groupBy(*keys, "texto").agg(
        F.sum("lineas").alias("lineas"),
        F.sum("cantidad").alias("cantidad"),
        F.max("ultima").alias("ultima"),
        F.min("fila").alias("fila"),
    )
    return by_text.groupBy(*keys).agg(
        F.sum("lineas").alias("lineas_pi"),
        F.sum("cantidad").alias("cantidad_pi"),
        F.max("ultima").alias("ultima_pi"),
        first_text().alias("descripcion_pi"),
    )


def cr_metrics(activity: DataFrame, keys: list[str], past: date) -> DataFrame:
    """Inbound lines, quantity and last date per key, all history before ``past``."""
    return (
        activity.where(inbound() & (F.col("primera") < day_start(past)))
        .groupBy(*keys)
        .agg(
            F.sum("lineas").alias("lineas_cr_historico"),
            F.sum("cantidad").alias("cantidad_cr_historico"),
            F.max("ultima").alias("ultima_cr"),
        )
    )


def last_pi(activity: DataFrame, keys: list[str], past: date) -> DataFrame:
    return (
        activity.where(outbound() & (F.col("primera") < day_start(past)))
        .groupBy(*keys)
        .agg(F.max("ultima").alias("ultima_pi_historica"))
    )


def text_sums(activity: DataFrame, params: Params) -> DataFrame:
    """Everything the current tables need from the log, in one pass over it, per owner, article and text.

    The base of both grains, or of the article's if ``activity`` has no owners: all of its columns can be merged further.
    A frame that is such a base already is returned.
    """
    if "lineas_pi_ytd" in activity.columns:
        return activity
    ytd = outbound() & (F.col("primera") >= day_start(params.year_start))
    rolling = outbound() & (F.col("primera") >= day_start(params.rolling_start))

    def only(condition: Column, name: str) -> Column:
        return F.when(condition, F.col(name))

    keys = [key for key in OWNER_ARTICLE if key in activity.columns]
    return activity.where(outbound() | inbound()).groupBy(*keys, window_text(params).alias("texto")).agg(
        F.sum(only(ytd, "lineas")).alias("lineas_pi_ytd"),
        F.sum(only(ytd, "cantidad")).alias("cantidad_pi_ytd"),
        F.max(only(ytd, "ultima")).alias("ultima_pi_ytd"),
        F.min(only(ytd, "fila")).alias("fila_ytd"),
        F.sum(only(rolling, "lineas")).alias("lineas_pi_30d"),
        F.sum(only(rolling, "cantidad")).alias("cantidad_pi_30d"),
        F.max(only(rolling, "ultima")).alias("ultima_pi_30d"),
        F.min(only(rolling, "fila")).alias("fila_30d"),
        F.max(only(outbound(), "ultima")).alias("ultima_pi_historica"),
        F.sum(only(inbound(), "lineas")).alias("lineas_cr_historico"),
        F.sum(only(inbound(), "cantidad")).alias("cantidad_cr_historico"),
        F.max(only(inbound(), "ultima")).alias("ultima_cr"),
    )


def key_metrics(by_text: DataFrame, keys: list[str]) -> DataFrame:
    """``text_sums`` added up for the keys of one grain."""
    sums = [
        "lineas_pi_ytd",
        "cantidad_pi_ytd",
        "lineas_pi_30d",
        "cantidad_pi_30d",
        "lineas_cr_historico",
        "cantidad_cr_historico",
    ]
    dates = ["ultima_pi_ytd", "ultima_pi_30d", "ultima_pi_historica", "ultima_cr"]
    return known_owner(by_text, keys).groupBy(*keys).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
        *[F.max(name).alias(name) for name in dates],
        first_text("fila_ytd").alias("descripcion_pi_ytd"),
        first_text("fila_30d").alias("descripcion_pi_30d"),
    )


def first_descriptions(activity: DataFrame, keys: list[str]) -> DataFrame:
    """First text of each key over all its lines, of whatever movement type."""
    by_text = activity.groupBy(*keys, "texto").agg(F.min("fila").alias("fila"))
    return by_text.groupBy(*keys).agg(first_text().alias("descripcion_movimiento"))


def active_keys(activity: DataFrame, keys: list[str], past: date) -> DataFrame:
    """Keys with any outbound or inbound line before ``past``."""
    return activity.where((outbound() | inbound()) & (F.col("primera") < day_start(past))).select(*keys).distinct()


def _first_filled(name: str) -> Column:
    return F.min_by(f"_{name}", F.when(F.col(f"_{name}").isNotNull(), F.struct("row_no", f"_{name}")))


def _with_texts(occupied: DataFrame) -> DataFrame:
    stripped = occupied.withColumns(
        {"_nombre": strip(F.col("denominacion_propietario")), "_texto": strip(F.col("denominacion"))}
    )
    return stripped.withColumns(
        {"_propietario": filled_text(F.col("_nombre")), "_descripcion": filled_text(F.col("_texto"))}
    )


def stock_places(occupied: DataFrame) -> DataFrame:
    """Stock per owner, article, location and texts: the base of both grains.

    All that a row is summed into is of fixed width, so the rows of the snapshot are hashed, not sorted. A frame that
    is such a base already is returned.
    """
    if "_descripcion" in occupied.columns:
        return occupied
    return (
        _with_texts(occupied)
        .groupBy(*OWNER_ARTICLE, "ubicacion", "_propietario", "_descripcion")
        .agg(F.sum("stock_actual").alias("stock_actual"), F.min("row_no").alias("row_no"))
    )


def stock_by_owner_article(occupied: DataFrame) -> DataFrame:
    return stock_places(occupied).groupBy(*OWNER_ARTICLE).agg(
        _first_filled("propietario").alias("propietario"),
        _first_filled("descripcion").alias("descripcion_stock"),
        F.sum("stock_actual").alias("stock_actual"),
        F.count_distinct("ubicacion").alias("ubicaciones_con_stock"),
    )


def stock_by_article(occupied: DataFrame) -> DataFrame:
    return stock_places(occupied).groupBy(*ARTICLE).agg(
        _first_filled("descripcion").alias("descripcion_stock"),
        F.sum("stock_actual").alias("stock_actual_total"),
        F.count_distinct("ubicacion").alias("ubicaciones_con_stock"),
        F.count_distinct("owner_key").alias("propietarios_distintos"),
    )


def owner_dimension(activity: DataFrame, stock: DataFrame) -> DataFrame:
    """Every owner and article seen in the log or in stock."""
    moved = first_descriptions(known_owner(activity, OWNER_ARTICLE), OWNER_ARTICLE)
    return moved.join(stock, OWNER_ARTICLE, "full").select(
        F.coalesce("propietario", "owner_key").alias("propietario"),
        "owner_key",
        "article_key",
        F.col("article_key").alias("articulo"),
        F.coalesce("descripcion_stock", "descripcion_movimiento").alias("descripcion"),
        F.coalesce("stock_actual", F.lit(0.0)).alias("stock_actual"),
        F.coalesce("ubicaciones_con_stock", F.lit(0)).cast("bigint").alias("ubicaciones_con_stock"),
    )


def article_dimension(activity: DataFrame, stock: DataFrame) -> DataFrame:
    """Every article seen in the log or in stock; owners as in stock, else as in the log."""
    by_owner = activity.groupBy("article_key", "owner_key", "texto").agg(F.min("fila").alias("fila"))
    moved = by_owner.groupBy("article_key").agg(
        first_text().alias("descripcion_movimiento"), F.count_distinct("owner_key").alias("propietarios_movimiento")
    )
    return moved.join(stock, ARTICLE, "full").select(
        "article_key",
        F.col("article_key").alias("articulo"),
        F.coalesce("descripcion_stock", "descripcion_movimiento").alias("descripcion"),
        F.coalesce("propietarios_distintos", "propietarios_movimiento", F.lit(0))
        .cast("bigint")
        .alias("propietarios_distintos"),
        F.coalesce("stock_actual_total", F.lit(0.0)).alias("stock_actual_total"),
        F.coalesce("ubicaciones_con_stock", F.lit(0)).cast("bigint").alias("ubicaciones_con_stock"),
    )
