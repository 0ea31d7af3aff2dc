from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from shelfwise.operators.activity import line_activity  # noqa: E402
from shelfwise.operators.metrics import stock_by_article, stock_by_owner_article  # noqa: E402
from shelfwise.params import Params  # noqa: E402
from shelfwise.sources.columns import MOVEMENT_SCHEMA, STOCK_SCHEMA  # noqa: E402
from shelfwise.sources.movements import prepare_movements  # noqa: E402
from shelfwise.sources.stock import occupied_stock  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def params():
    return Params(snapshot=date(2026, 4, 17), generated_at="2026-04-17 10:00:00")


class World:
    """A movement log and a stock snapshot from short rows."""

    def __init__(self, spark, params, moves, stock):
        moved = [
            (kind, stamp if isinstance(stamp, datetime) else datetime.fromisoformat(stamp), article, text, qty, owner, n)
            for n, (kind, stamp, article, text, qty, owner) in enumerate(moves)
        ]
        held = [
            (name, owner, article, text, qty, place, "Ocupado", n, params.snapshot)
            for n, (name, owner, article, text, qty, place) in enumerate(stock)
        ]
        self.raw_movements = spark.createDataFrame(moved, MOVEMENT_SCHEMA)
        self.raw_stock = spark.createDataFrame(held, STOCK_SCHEMA)
        self.movements = prepare_movements(self.raw_movements, params)
        self.activity = line_activity(self.movements)
        occupied = occupied_stock(self.raw_stock)
        self.by_owner, self.by_article = stock_by_owner_article(occupied), stock_by_article(occupied)


@pytest.fixture(scope="session")
def world(spark, params):
    return lambda moves, stock: World(spark, params, moves, stock)


@pytest.fixture(scope="session")
def by_key():
    def collect(frame, *keys):
        return {tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]: row for row in frame.collect()}

    return collect
