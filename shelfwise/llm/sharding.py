"""Operator 8, sharding: a uniform shuffle into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch, table

#: Rows of one run of slots, which one task permutes.
RUN = 8192


def _draw(rng: np.random.Generator, sizes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Rows: sources of the given sizes; columns: targets. Exact margins; the law is that of a uniform shuffle."""
    out = np.zeros((len(sizes), len(room)), dtype=np.int64)
    left = room.astype(np.int64).copy()
    for i, n in enumerate(sizes):
        out[i] = rng.multivariate_hypergeometric(left, int(n), method="marginals")
        left -= out[i]
    return out


def uniform_shards(rows: DataFrame, shards: int = 16, seed: int = 8, run: int = RUN) -> DataFrame:
    """`rows` with shard (0 to shards - 1) and slot (gapless from 0 within a shard); counts differ by one at most.

    Input partitions are numbered as the rows are staged. The driver draws, for every partition, how many rows each
    shard gets (partitions x shards numbers); one task a shard deals its share to runs of `run` slots. Rows are then
    permuted within their partition, sent to the run that the matrix names, and permuted again within the run. Each
    step handles one partition or one run at a time, whatever a key or value holds, so equal rows and nulls are
    rows like any other; empty input gives no rows. Input columns shard and slot are replaced.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "shards")
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    row = F.struct(*names) if names else F.struct(F.lit(0).alias("none"))
    staged = scratch.put(
        rows.select(row.alias("r"))
        .withColumn("part", F.spark_partition_id())
        .withColumn("nth", F.monotonically_increasing_id())
    )
    # A partition is cut into cells of at most 8 runs, so that none is too large to be permuted in one task.
    cell = F.struct("part", F.floor((F.col("nth") - F.shiftleft(F.col("part").cast("long"), 33)) / (8 * run)).alias("piece"))
    staged = staged.withColumn("cell", F.xxhash64(cell))
    sizes = sorted(tuple(r) for r in staged.groupBy("cell").count().collect())
    total = sum(n for _, n in sizes)
    room = np.array([total // shards + (s < total % shards) for s in range(shards)])
    matrix = _draw(np.random.default_rng(seed), np.array([n for _, n in sizes], dtype=np.int64), room)
    dealt = [(int(c), s, int(k)) for (c, _), line in zip(sizes, matrix, strict=True) for s, k in enumerate(line) if k]

    def runs(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("cell")
        s, n = int(shard["shard"].iloc[0]), int(shard["k"].sum())
        own = np.array([min(run, n - at) for at in range(0, n, run)])
        m = _draw(np.random.default_rng([seed, s]), shard["k"].to_numpy(), own)
        i, j = np.nonzero(m)
        return pd.DataFrame({"cell": shard["cell"].to_numpy()[i], "shard": s, "run": j, "k": m[i, j]})

    sent = (
        spark.createDataFrame(dealt, "cell long, shard int, k long")
        .groupBy("shard")
        .applyInPandas(runs, "cell long, shard int, run int, k long")
    )
    # The cell's permuted rows go to its targets in order: the first k to the first, and so on.
    before = Window.partitionBy("cell").orderBy("shard", "run").rowsBetween(Window.unboundedPreceding, -1)
    sent = sent.withColumn("from", F.coalesce(F.sum("k").over(before), F.lit(0)))
    place = sent.select("cell", "shard", "run", F.explode(F.sequence(F.col("from") + 1, F.col("from") + F.col("k"))).alias("rank"))
    local = Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(seed), F.col("nth")), "nth")
    permuted = staged.withColumn("rank", F.row_number().over(local).cast("long"))
    again = Window.partitionBy("shard", "run").orderBy(F.xxhash64(F.lit(-1 - seed), F.col("nth")), "nth")
    # Spark cannot tell how many rows explode makes, and would broadcast them all.
    out = permuted.join(place.hint("merge"), ["cell", "rank"])
    slot = (F.col("run").cast("long") * run + F.row_number().over(again) - 1).alias("slot")
    return out.select(*[F.col("r")[c].alias(c) for c in names], "shard", slot)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return uniform_shards(sized).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
