"""A running total over a whole ordered table, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.reuse import keep

BUCKET = "_bucket"


def running_total(
    frame: DataFrame,
    weight: str,
    order: list[Column],
    partition: list[str],
    before: str,
    total: str,
) -> DataFrame:
    """Add the sum of ``weight`` over all earlier rows and over all rows of the partition.

    The rows are range-partitioned by the full order, so every task holds one contiguous,
    equally large stretch of it, however many rows share a partition value or a leading sort
    value. The stretches are kept, so that both branches see the same borders. One total per
    stretch then gives each stretch its starting sum, and the window only runs inside a stretch.

    ``order`` must be unique within a partition value.
    """
    spark = frame.sparkSession
    # An explicit count keeps the stretches as they were cut.
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stretches = frame.repartitionByRange(count, *[F.col(name) for name in partition], *order)
    rows = keep(stretches.withColumn(BUCKET, F.spark_partition_id()))

    key = [*partition, BUCKET]
    sums = rows.groupBy(*key).agg(F.sum(weight).alias("_sum"))
    whole = Window.partitionBy(*partition)
    earlier = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *key,
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_sum").over(whole).alias(total),
    )

    inside = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Stretches are contiguous, so there is at most one start per stretch and one more per
    # partition value: a small side whatever the number of rows.
    return (
        rows.join(F.broadcast(starts), key)
        .withColumn(before, F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_start", BUCKET)
    )
