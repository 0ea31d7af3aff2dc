"""Source schemas and the check for missing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Spreadsheet headers of the movement log and their column names here.
MOVEMENT_HEADERS = {
    "Tipo movimiento": "tipo_movimiento",
    "Fecha inicio": "fecha_inicio",
    "Artículo": "articulo",
    "Denominación artículo": "denominacion_articulo",
    "Cantidad": "cantidad",
    "Propietario": "propietario",
}

# Spreadsheet headers of a stock snapshot and their column names here.
STOCK_HEADERS = {
    "Denominación propietario": "denominacion_propietario",
    "Propie.": "propie",
    "Art._y": "art_y",
    "Denominación": "denominacion",
    "Stock pal.": "stock_pal",
    "Ubicacion": "ubicacion",
    "Ocupacion": "ocupacion",
}

MOVEMENT_SCHEMA = StructType(
    [
        StructField("tipo_movimiento", StringType()),
        StructField("fecha_inicio", TimestampNTZType()),
        StructField("articulo", StringType()),
        StructField("denominacion_articulo", StringType()),
        StructField("cantidad", DoubleType()),
        StructField("propietario", StringType()),
        StructField("row_no", LongType()),
    ]
)

STOCK_SCHEMA = StructType(
    [
        StructField("denominacion_propietario", StringType()),
        StructField("propie", StringType()),
        StructField("art_y", StringType()),
        StructField("denominacion", StringType()),
        StructField("stock_pal", DoubleType()),
        StructField("ubicacion", StringType()),
        StructField("ocupacion", StringType()),
        StructField("row_no", LongType()),
        StructField("snapshot_date", DateType()),
    ]
)


def from_headers(frame: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Accept a table exported with its spreadsheet headers."""
    return frame.withColumnsRenamed({k: v for k, v in headers.items() if k in frame.columns})


def require_columns(**datasets: tuple[DataFrame, dict[str, str]]) -> None:
    """Fail before any job runs: each dataset, with its table of headers, must have all their columns."""
    absent = {name: sorted(set(headers.values()).difference(frame.columns)) for name, (frame, headers) in datasets.items()}
    faults = [f"{name}: {', '.join(names)}" for name, names in absent.items() if names]
    if faults:
        raise ValueError("columns not found in " + "; ".join(faults))
