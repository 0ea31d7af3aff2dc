"""Command line: one run over a movement log and a stock snapshot.

    spark-submit --py-files ... -m shelfwise --movements PATH --stock PATH --out PATH

``--stock`` is a dated file or Parquet folder, a folder of those whose newest is taken, or a table
with a ``snapshot_date``. The snapshot date comes from there unless ``--snapshot`` gives it.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from shelfwise.params import Params
from shelfwise.plans.publish import Target, publish
from shelfwise.sources.movements import read_movements
from shelfwise.sources.stock import open_stock


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shelfwise")
    parser.add_argument("--movements", required=True)
    parser.add_argument("--stock", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--format", default="parquet", choices=["parquet", "orc", "csv", "json"])
    parser.add_argument("--snapshot", type=date.fromisoformat, help="yyyy-mm-dd; a partition of the stock table")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName("shelfwise").getOrCreate()
    stock, day = open_stock(spark, args.stock, args.format, args.snapshot)
    params = Params(snapshot=day, generated_at=f"{datetime.now():%Y-%m-%d %H:%M:%S}")
    publish(read_movements(spark, args.movements, args.format), stock, params, Target(args.out))


if __name__ == "__main__":
    main()
