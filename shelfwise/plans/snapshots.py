"""Snapshots of published tables: replaced whole or not at all, and stored in report order."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.params import Params


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.exists(where)


def _move(spark: SparkSession, source: str, target: str) -> None:
    store, where = _at(spark, source)
    if not store.rename(where, _at(spark, target)[1]):
        raise OSError(f"{source} could not be renamed to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    store, where = _at(spark, path)
    store.delete(where, True)


def _folder(path: str, params: Params) -> tuple[str, str]:
    """The snapshot's folder, and where the rows before it wait while it is replaced. Spark's readers skip names with a dot."""
    return f"{path}/snapshot_date={params.snapshot_text}", f"{path}/.antes-{params.snapshot_text}"


def recover(spark: SparkSession, path: str, params: Params) -> None:
    """Put back what a run that ended between two renames had taken away."""
    folder, before = _folder(path, params)
    if exists(spark, before):
        if exists(spark, folder):
            _delete(spark, before)
        else:
            _move(spark, before, folder)


def replace_snapshot(spark: SparkSession, path: str, params: Params, write) -> None:
    """``write(folder)`` makes the new rows aside; only once they are all there they take the old ones' place.

    If writing fails, nothing has changed. Between the two renames the old rows lie aside, from where ``recover`` puts
    them back.
    """
    folder, before = _folder(path, params)
    aside = f"{path}/.nuevo-{params.snapshot_text}-{uuid4().hex}"
    try:
        write(aside)
    except BaseException:
        _delete(spark, aside)
        raise
    recover(spark, path, params)
    if exists(spark, folder):
        _move(spark, folder, before)
    _move(spark, aside, folder)
    _delete(spark, before)


def in_report_order(frame: DataFrame, order: list[Column]) -> DataFrame:
    """Files hold stretches of the report order, by their numbers, and rows lie in it: no task sorts the whole."""
    return frame.repartitionByRange(*order).sortWithinPartitions(*order)


def read_in_order(spark: SparkSession, path: str, params: Params) -> DataFrame:
    """A stored snapshot with ``orden``, which sorts its rows as they were written: number of the file, place in it."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    rows = spark.read.parquet(_folder(path, params)[0])
    return rows.select("*", (F.shiftleft(part, 40) + F.col("_metadata.row_index")).alias("orden"))
