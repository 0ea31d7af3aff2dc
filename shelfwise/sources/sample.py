"""Movements and stock derived from the star-schema test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.params import Params

SAMPLE = Params(snapshot=date(2001, 10, 31), generated_at="2001-10-31 00:00:00")


# Columns used here, so that no job has to look for them in the files.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _article() -> Column:
    part = F.col("l_partkey")
    return F.when(part % 10 == 4, part % 50).otherwise(part).cast("string")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their part name and their supplier's region number."""
    suppliers = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey")
    )
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey"))
        .join(suppliers, F.col("s_suppkey") == F.col("l_suppkey"))
    )


def sample_movements(spark: SparkSession, folder: str) -> DataFrame:
    """A raw movement log; the part number shapes the demand of each article."""
    part, day = F.col("l_partkey") % 10, F.col("l_shipdate")
    idle = (
        ((part == 0) & ~F.month(day).isin(4, 5, 6))
        | ((part == 1) & ~((day < F.lit("1999-01-01").cast("timestamp_ntz")) & (F.col("l_linenumber") <= 4)))
        | ((part == 2) & (day < F.lit("2001-07-01").cast("timestamp_ntz")))
        | ((part == 5) & (F.col("l_returnflag") != "R"))
    )
    copies = F.when((part == 3) & (F.col("l_linenumber") == 1), 8).otherwise(1)
    return (
        _lines(spark, folder)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .select(
            F.when(F.col("l_returnflag") == "A", "CR").when(idle, "XX").otherwise("PI").alias("tipo_movimiento"),
            F.col("l_shipdate").alias("fecha_inicio"),
            _article().alias("articulo"),
            F.col("p_name").alias("denominacion_articulo"),
            F.col("l_quantity").alias("cantidad"),
            F.when(F.col("l_suppkey") % 17 != 0, F.col("n_regionkey").cast("string")).alias("propietario"),
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10 + F.col("copy")).alias("row_no"),
        )
    )


def sample_stock(spark: SparkSession, folder: str) -> DataFrame:
    """A raw stock snapshot table of every line; most positions are free. ``snapshot_date`` spreads over month ends."""
    held = (F.col("l_linestatus") == "F") & (F.col("l_orderkey") % 3 == 0) & (F.col("l_orderkey") % 5 != 0)
    return (
        _lines(spark, folder)
        .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .select(
            F.col("r_name").alias("denominacion_propietario"),
            F.col("n_regionkey").cast("string").alias("propie"),
            _article().alias("art_y"),
            F.when(F.col("l_partkey") % 7 != 0, F.col("p_name")).alias("denominacion"),
            F.col("l_quantity").alias("stock_pal"),
            F.concat(F.lit("L"), (F.col("l_orderkey") % 97).cast("string")).alias("ubicacion"),
            F.when(held, "Ocupado").otherwise("Libre").alias("ocupacion"),
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10).alias("row_no"),
            F.last_day("l_shipdate").alias("snapshot_date"),
        )
    )
