"""A daily base that grows with the log: files that have been added up are not read again."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.activity import daily_activity
from shelfwise.params import Params
from shelfwise.plans.snapshots import exists
from shelfwise.sources.columns import MOVEMENT_HEADERS, from_headers
from shelfwise.sources.file_order import with_file_order
from shelfwise.sources.movements import prepare_movements

#: A day after every line: the base holds the whole log, whatever the snapshot.
NEVER = date(9999, 12, 30)
_LISTED = "ruta string, bytes bigint, modificado timestamp, lote bigint"


@dataclass(frozen=True)
class DailyBase:
    """Daily sums below ``root``: ``dias`` by batch and day, ``leidos`` with the files that each batch has read.

    A batch's sums are written first and its files are listed last, so a run that fails leaves nothing that counts.
    Sums of one day from several batches are rows of their own; every metric adds them up.
    """

    root: str

    def listed(self, spark: SparkSession) -> DataFrame:
        path = f"{self.root}/leidos"
        return spark.read.schema(_LISTED).parquet(path) if exists(spark, path) else spark.createDataFrame([], _LISTED)

    def update(self, spark: SparkSession, log: str, params: Params, fmt: str = "parquet") -> list[str]:
        """Read the files of the folder ``log`` that are new, and return their paths.

        If a file that was read has changed or gone, what it added cannot be taken out again: all is read anew, as a
        generation of its own, which replaces the one before.
        """
        there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(log)
        there = there.select(F.col("path").alias("ruta"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modificado"))
        there = there.where(~F.element_at(F.split("ruta", "/"), -1).rlike("^[._]"))
        seen = self.listed(spark)
        same = ["ruta", "bytes", "modificado"]
        latest = seen.agg(F.max("lote").alias("last"), F.count("*").alias("n")).first()
        if seen.join(there, same, "left_anti").isEmpty():
            fresh, batch, number = there.join(seen, same, "left_anti"), (latest["last"] or 0) + 1, latest["n"]
        else:
            fresh, batch, number = there, 1, 0
        new = fresh.orderBy("ruta").collect()  # a listing: a row a file
        if batch == 1 and latest["n"]:
            return self._rebuild(spark, new, params, fmt)
        if new:
            self._add(spark, new, batch, number, params, fmt)
        return [r["ruta"] for r in new]

    def _add(self, spark: SparkSession, files: list, batch: int, number: int, params: Params, fmt: str, mode: str = "append") -> None:
        reader = spark.read.format(fmt)
        reader = reader.option("header", True) if fmt == "csv" else reader
        raw = with_file_order(reader.load([r["ruta"] for r in files]), fmt, number)
        lines = prepare_movements(from_headers(raw, MOVEMENT_HEADERS), replace(params, snapshot=NEVER))
        sums = daily_activity(lines).withColumn("dia", F.to_date("primera"))
        sums.write.mode("overwrite").partitionBy("dia").parquet(f"{self.root}/dias/lote={batch}")
        done = spark.createDataFrame([(*r, batch) for r in files], _LISTED)
        done.coalesce(1).write.mode(mode).parquet(f"{self.root}/leidos")

    def _rebuild(self, spark: SparkSession, files: list, params: Params, fmt: str) -> list[str]:
        """Everything into a batch with a new number, then a listing of that batch alone."""
        last = self.listed(spark).agg(F.max("lote")).first()[0]
        self._add(spark, files, last + 1, 0, params, fmt, mode="overwrite")
        return [r["ruta"] for r in files]

    def activity(self, spark: SparkSession, params: Params) -> DataFrame:
        """The base up to the snapshot's day, as ``daily_activity`` of the whole log would give it, in one row a batch.

        Batches that are not listed do not count. Only partitions of listed batches and of days up to the snapshot are read.
        """
        batches = [r["lote"] for r in self.listed(spark).select("lote").distinct().collect()]
        if not batches:
            raise FileNotFoundError(f"nothing has been read into {self.root}")
        base = spark.read.option("basePath", f"{self.root}/dias").parquet(*[f"{self.root}/dias/lote={n}" for n in sorted(batches)])
        return base.where(F.col("dia") <= F.lit(params.snapshot)).drop("dia", "lote")
