"""Stock snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import bare_key, is_filled, normalize_key, number_or_zero
from shelfwise.params import OCCUPIED
from shelfwise.sources.columns import STOCK_HEADERS, from_headers, require_columns
from shelfwise.sources.file_order import with_file_order
from shelfwise.sources.movements import with_row_no

# Fixed value: a day-first date anywhere in a file name.
NAME_DATE = r"(\d{2})-(\d{2})-(\d{4})"


def read_stock(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return from_headers(with_file_order(reader.options(**options).load(path), fmt), STOCK_HEADERS)


def snapshot_date_from_name(name: Column) -> Column:
    """Date of the first ``dd-mm-yyyy`` in a file name; null without one or if it is no date."""
    found = F.regexp_extract(name, NAME_DATE, 0)
    return F.try_to_date(F.nullif(found, F.lit("")), "dd-MM-yyyy")


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the newest snapshot in a table of many.

    The newest date is a one-value subquery, so on a table partitioned by ``snapshot_date``
    only that partition is read.
    """
    newest = snapshots.agg(F.max("snapshot_date")).scalar()
    return snapshots.where(F.col("snapshot_date") == newest)


def latest_stock_file(spark: SparkSession, folder: str) -> tuple[str, object]:
    """Path and date of the newest dated file, or folder of files, below a folder; ties go to the last one written.

    Only the listing is read, never the contents, and one row comes back.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    # The last dated part of the path: a file, or a folder that a writer made in one go.
    part = F.regexp_extract("path", rf"^(.*/[^/]*{NAME_DATE}[^/]*)(/[^/]*)*$", 1)
    day = snapshot_date_from_name(F.element_at(F.split(part, "/"), -1))
    dated = listing.select(part.alias("path"), "modificationTime", day.alias("day")).where(F.col("day").isNotNull())
    newest = dated.agg(
        F.max_by("path", F.struct("day", "modificationTime")).alias("path"), F.max("day").alias("day")
    ).first()
    if newest.path is None:
        raise FileNotFoundError(f"no name with a day-first date (dd-mm-yyyy) under {folder}")
    return newest.path, newest.day


def open_stock(spark: SparkSession, path: str, fmt: str = "parquet", day: date | None = None) -> tuple[DataFrame, date]:
    """A snapshot and its date: of `day` in a table of many, of a dated path, the newest in a folder of dated ones,
    or else the newest in a table of many."""
    if day:
        stock = read_stock(spark, path, fmt)
        return (stock.where(F.col("snapshot_date") == F.lit(day)) if "snapshot_date" in stock.columns else stock), day
    try:
        found, day = latest_stock_file(spark, path)
        return read_stock(spark, found, fmt), day
    except FileNotFoundError:
        stock = read_stock(spark, path, fmt)
        if "snapshot_date" not in stock.columns:
            raise
        newest = stock.agg(F.max(F.col("snapshot_date").cast("date")).alias("day")).first().day
        return latest_snapshot(stock), newest


def occupied_stock(raw: DataFrame) -> DataFrame:
    """Occupied positions with positive stock and both keys."""
    raw = from_headers(raw, STOCK_HEADERS)
    require_columns(stock=(raw, STOCK_HEADERS))
    raw = with_row_no(raw)
    kinds = {field.name: field.dataType for field in raw.schema}
    owner, article, amount = F.col("_propie"), F.col("_art"), F.col("stock_actual")
    keyed = is_filled(F.col("propie").cast("string")) & is_filled(F.col("art_y").cast("string"))
    held = raw.withColumns(
        {
            "_propie": bare_key(F.col("propie"), kinds["propie"]),
            "_art": bare_key(F.col("art_y"), kinds["art_y"]),
            "stock_actual": number_or_zero(F.col("stock_pal"), kinds["stock_pal"]),
        }
    ).where((F.col("ocupacion") == OCCUPIED) & (amount > 0) & keyed)
    return held.select(
        normalize_key(owner).alias("owner_key"),
        normalize_key(article).alias("article_key"),
        F.col("denominacion_propietario").cast("string").alias("denominacion_propietario"),
        F.col("denominacion").cast("string").alias("denominacion"),
        amount,
        F.col("ubicacion").cast("string").alias("ubicacion"),
        F.col("row_no").cast("bigint").alias("row_no"),
    )
