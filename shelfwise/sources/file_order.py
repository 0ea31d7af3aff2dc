"""The order of lines in a log that does not carry one: by file, then by place in the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the place of a line in its file.
PLACE_BITS = 40


def with_file_order(frame: DataFrame, fmt: str, first: int = 0) -> DataFrame:
    """``frame``, as just read, with ``row_no``: number of its file, in order of paths from ``first`` on, and place in it.

    Parquet has the place of every row. Of a text file a task reads one block, or several files whole: a line's place
    is the block's first byte and the lines read before it, which are fewer than the block's bytes. Either way the
    order does not depend on how files are cut, and nothing is shuffled or sorted. ORC knows no such place: lines of
    one of its blocks keep the order in which they are read.
    """
    if "row_no" in frame.columns:
        return frame
    names = sorted(frame.inputFiles())
    if not names:
        return frame.withColumn("row_no", F.lit(None).cast("bigint"))
    spark: SparkSession = frame.sparkSession
    files = spark.createDataFrame([(name, first + n) for n, name in enumerate(names)], "_file string, _number bigint")
    if fmt == "parquet":
        place = F.col("_metadata.row_index")
    else:
        inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        place = F.col("_metadata.file_block_start") + inside
    placed = frame.withColumns({"_place": place, "_file": F.input_file_name()})
    number = F.shiftleft("_number", PLACE_BITS) + F.col("_place")
    return placed.join(files, "_file", "left").withColumn("row_no", number).drop("_file", "_number", "_place")
