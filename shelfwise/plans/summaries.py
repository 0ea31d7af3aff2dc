"""Summaries by rotation class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.labels import class_order
from shelfwise.plans.current import BY_ARTICLE, BY_OWNER

# Names of the two levels of analysis.
OWNER_LEVEL = "owner-articulo"
ARTICLE_LEVEL = "articulo_unico"


def _share(value: Column, total: Column) -> Column:
    return F.when(total != 0, value / total).otherwise(0.0)


def class_summary(
    frame: DataFrame, rotation: str, stock: str, lines: str, quantity: str, by: list[str] | None = None, counted: Column | str = "articulo"
) -> DataFrame:
    """References, stock, lines and quantity per class, with shares of all classes.

    The shares are taken over the summary itself: a handful of rows per group.
    """
    by = by or []
    summary = frame.groupBy(*by, F.col(rotation).alias("rotacion")).agg(
        F.count(counted).alias("referencias"),
        F.coalesce(F.sum(stock), F.lit(0.0)).alias("stock_total"),
        F.coalesce(F.sum(lines), F.lit(0)).alias("lineas_pi"),
        F.coalesce(F.sum(quantity), F.lit(0.0)).alias("cantidad_pi"),
    )
    whole = Window.partitionBy(*by)
    return summary.withColumns(
        {
            "porcentaje_stock": _share(F.col("stock_total"), F.sum("stock_total").over(whole)),
            "porcentaje_referencias": _share(F.col("referencias"), F.sum("referencias").over(whole)),
        }
    )


def in_class_order(summary: DataFrame, *before: str) -> DataFrame:
    """Report order."""
    return summary.orderBy(*before, class_order(F.col("rotacion")))


def summary_current(owner_table: DataFrame) -> DataFrame:
    return owner_table.groupBy(F.col("rotacion_final_ytd").alias("rotacion")).agg(
        F.count("articulo").alias("referencias"),
        F.sum("stock_actual").alias("stock_total"),
        F.sum("lineas_pi_ytd").alias("lineas_pi_ytd"),
    )


def summary_article_ytd(article_table: DataFrame) -> DataFrame:
    return class_summary(
        article_table, "rotacion_final_ytd", BY_ARTICLE.stock, "lineas_pi_ytd", "cantidad_pi_ytd"
    )


def _at_level(summary: DataFrame, level: str) -> DataFrame:
    return summary.select(F.lit(level).alias("analisis"), "*")


def summary_30d(owner_table: DataFrame, article_table: DataFrame) -> DataFrame:
    rest = ("lineas_pi_30d", "cantidad_pi_30d")
    owners = class_summary(owner_table, "rotacion_final_30d", BY_OWNER.stock, *rest)
    articles = class_summary(article_table, "rotacion_final_30d", BY_ARTICLE.stock, *rest)
    return _at_level(owners, OWNER_LEVEL).unionByName(_at_level(articles, ARTICLE_LEVEL))


def summary_quarterly(owner_quarters: DataFrame, article_quarters: DataFrame) -> DataFrame:
    rest = ("lineas_pi_trimestre", "cantidad_pi_trimestre")
    # Lines without owner have rows of their own, which name no reference of an owner.
    owned = F.when(F.col("owner_key").isNotNull(), F.col("articulo"))
    owners = class_summary(
        owner_quarters, "rotacion_final_trimestre", f"{BY_OWNER.stock}_foto", *rest, by=["period_label"], counted=owned
    )
    articles = class_summary(
        article_quarters, "rotacion_final_trimestre", f"{BY_ARTICLE.stock}_foto", *rest, by=["period_label"]
    )
    return _at_level(owners, OWNER_LEVEL).unionByName(_at_level(articles, ARTICLE_LEVEL))
