"""Intermediate tables in the shared checkpoint folder.

A staged table cuts the lineage, is read by several consumers without recomputing its input,
and survives the loss of executors because it lies in the cluster's shared storage.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local session may go without the setting."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"Set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shelfwise-")
        spark.conf.set(SETTING, folder)
    return f"{folder}/{spark.sparkContext.applicationId}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once and return the frame that reads it back."""
    spark = frame.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
