"""Helpers shared by the operators: reading, staging in shared storage, components, native text expressions."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task hands to its Python worker at a time.
BATCH_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; a local session without it (tests) gets its own."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shelfwise-"))
    return spark.conf.get("spark.checkpoint.dir").rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about BATCH_BYTES, if the session has no bound of its own; a longer row is one batch.

    Spark's default (64 MB or 10,000 rows) costs each task a buffer of that size outside the JVM's heap, twice while it
    grows, and its worker another.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended; the folder expires like any checkpoint folder
        return


class Scratch:
    """Tables written to the shared folder, which cut lineage; `drop` deletes one that is superseded.

    What is left when the program ends is deleted then.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self.written = 0
        atexit.register(_delete, spark, self.root)

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.written}"
        self.written += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        # Shuffle files of what has just been written are no longer needed; Spark deletes them with their frames.
        gc.collect()
        self.spark._jvm.System.gc()
        return out

    def drop(self, df: DataFrame) -> None:
        _delete(self.spark, df._scratch_path)

    def clear(self) -> None:
        """Deletes all of its tables, once what was made of them is written or collected."""
        _delete(self.spark, self.root)


def few(frame: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """A written table of a few numbers a row: broadcast if it has at most `rows` rows, else joined as Spark sees fit."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component): the smallest id reachable from every id that `links` (a, b) names.

    Alternates two local star rewrites until no edge changes: every node links its larger neighbours to its
    smallest one, then its smaller ones to the smallest. Each round is grouped by a node with a partial minimum
    before the shuffle, so a node with very many links is only a join key, which adaptive execution may split.
    """
    edges = scratch.put(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    )
    was = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        step = (
            large.join(small, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a > b")
            .distinct()
        )
        new = scratch.put(step)
        now = new.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if was is not None:
            scratch.drop(edges)
        edges, before, was = new, was, now
        if now == before:
            return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
