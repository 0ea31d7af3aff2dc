"""The movement log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import bare_key, is_filled, normalize_key, number_or_zero
from shelfwise.functions.time import day_start, parse_stamp, quarter_label
from shelfwise.params import Params
from shelfwise.sources.columns import MOVEMENT_HEADERS, from_headers, require_columns
from shelfwise.sources.file_order import with_file_order


def read_movements(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a log in any Spark format. CSV is read as text and parsed by ``prepare_movements``."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return from_headers(with_file_order(reader.options(**options).load(path), fmt), MOVEMENT_HEADERS)


def with_row_no(frame: DataFrame) -> DataFrame:
    """Some order for tables that carry none and do not come from ``read_movements`` or ``read_stock``."""
    if "row_no" in frame.columns:
        return frame
    return frame.withColumn("row_no", F.monotonically_increasing_id())


def prepare_movements(raw: DataFrame, params: Params) -> DataFrame:
    """Valid movement lines up to the end of the snapshot day, with normalised keys."""
    raw = from_headers(raw, MOVEMENT_HEADERS)
    require_columns(movements=(raw, MOVEMENT_HEADERS))
    raw = with_row_no(raw)
    kinds = {field.name: field.dataType for field in raw.schema}

    stamp = F.col("fecha_movimiento")
    lines = raw.withColumns(
        {
            "fecha_movimiento": parse_stamp(F.col("fecha_inicio"), kinds["fecha_inicio"]),
            "_propietario": bare_key(F.col("propietario"), kinds["propietario"]),
            "_articulo": bare_key(F.col("articulo"), kinds["articulo"]),
        }
    ).where((stamp < day_start(params.next_day)) & is_filled(F.col("articulo").cast("string")))
    return lines.select(
        "tipo_movimiento",
        stamp,
        normalize_key(F.col("_propietario")).alias("owner_key"),
        normalize_key(F.col("_articulo")).alias("article_key"),
        F.col("denominacion_articulo").cast("string").alias("descripcion_movimiento"),
        number_or_zero(F.col("cantidad"), kinds["cantidad"]).alias("cantidad_movimiento"),
        F.year(stamp).alias("year"),
        F.quarter(stamp).alias("quarter"),
        quarter_label(stamp).alias("period_label"),
        F.col("row_no").cast("bigint").alias("row_no"),
    )
