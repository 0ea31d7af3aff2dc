"""Frames that several branches of a plan read."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_kept: list[DataFrame] = []


def keep(frame: DataFrame) -> DataFrame:
    """The frame, computed once, when it is first read, and held by the executors in memory or on their disks.

    Nothing runs while a plan is put together. What a lost executor held is computed again from the frame's
    input. All branches see the same partitions, also of a range partitioning, whose borders are drawn once.
    """
    kept = frame.persist(StorageLevel.MEMORY_AND_DISK)
    _kept.append(kept)
    return kept


def by_article(frame: DataFrame) -> DataFrame:
    """The frame, partitioned by article. With an explicit count the partitions stay as they are cut also when kept."""
    count = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(count, "article_key")


def release(spark: SparkSession) -> None:
    """Let go of everything that was kept in this session."""
    for frame in [f for f in _kept if f.sparkSession is spark]:
        frame.unpersist()
        _kept.remove(frame)
