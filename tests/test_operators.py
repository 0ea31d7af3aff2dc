import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators.gaps import fill_gaps
from shelfwise.operators.pareto import pareto
from shelfwise.operators.quantiles import exact_quantiles
from shelfwise.operators.running import running_total
from shelfwise.operators.staging import SETTING, stage, staging_root


def ranked(spark, params, rows, partition=False):
    frame = spark.createDataFrame(rows, "p string, k string, lines bigint, qty double")
    result = pareto(frame, params, ["k"], "lines", "qty", "abc", "pct", "acum", ["p"] if partition else None)
    return {(r.p, r.k): (r.abc, r.pct, r.acum) for r in result.collect()}


def full_sort(rows):
    """The rule, row by row."""
    found = {}
    for part in {row[0] for row in rows}:
        mine = sorted((r for r in rows if r[0] == part), key=lambda r: (-r[2], -r[3], r[1]))
        total, before = sum(r[2] for r in mine), 0
        for p, k, lines, _ in mine:
            if lines == 0:
                found[p, k] = ("D", 0.0, 0.0)
                continue
            abc = "A" if before * 100 < 80 * total else "B" if before * 100 < 95 * total else "C"
            before += lines
            found[p, k] = (abc, lines / total, before / total)
    return found


def test_pareto_boundary(spark, params):
    found = ranked(spark, params, [("", f"k{n}", 1, 1.0) for n in range(10)])
    assert [found["", f"k{n}"][0] for n in range(10)] == ["A"] * 8 + ["B"] * 2


def test_pareto_single_and_empty(spark, params):
    assert ranked(spark, params, [("", "k", 3, 1.0)]) == {("", "k"): ("A", 1.0, 1.0)}
    assert ranked(spark, params, []) == {}
    assert ranked(spark, params, [("", "k", 0, 0.0)]) == {("", "k"): ("D", 0.0, 0.0)}


@pytest.mark.parametrize("seed", range(3))
def test_pareto_equals_full_sort(spark, params, seed):
    """A third of the keys tie in lines and quantity; partitions differ widely in size."""
    rng = random.Random(seed)
    rows = []
    for n in range(1500):
        part = rng.choice(["q1", "q1", "q1", "q2", "q3"])
        tied = rng.random() < 0.34
        rows.append((part, f"k{n:05}", 1 if tied else rng.randint(0, 40), 1.0 if tied else float(rng.randint(-5, 30))))
    assert ranked(spark, params, rows, partition=True) == full_sort(rows)


def test_stretches_are_balanced_when_all_rows_tie(spark, params):
    """One value in all rows must not put all rows into one stretch."""
    frame = spark.range(4000).select(F.lit(1).cast("bigint").alias("w"), F.col("id").alias("k"))
    spread = frame.repartitionByRange(8, F.col("w").desc(), F.col("k")).groupBy(F.spark_partition_id()).count()
    assert max(row["count"] for row in spread.collect()) < 1500
    total = running_total(frame, "w", [F.col("w").desc(), F.col("k").asc()], [], "b", "t")
    assert [(r.b, r.t) for r in total.orderBy("k").collect()] == [(n, 4000) for n in range(4000)]


def quantile(spark, values, level):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    return exact_quantiles(frame, {"a": (F.col("v"), level), "b": (F.lit(None), level)}).first()


def test_quantile_interpolates(spark):
    found = quantile(spark, [1.0, 2.0, 3.0, 4.0, None], 0.75)
    assert (found.a, found.b) == (3.25, 0.0)
    assert quantile(spark, [], 0.75).a == 0.0
    assert quantile(spark, [7.0], 0.25).a == 7.0


@pytest.mark.parametrize("level", [0.25, 0.75])
def test_quantile_equals_numpy(spark, level):
    rng = random.Random(5)
    values = [1.0] * 400 + [round(rng.expovariate(0.1), 3) for _ in range(600)]
    assert quantile(spark, values, level).a == pytest.approx(np.quantile(values, level), abs=1e-12)


def test_fill_gaps(spark):
    from datetime import date

    rows = [("a", date(2025, 11, 1), 2, 5), ("a", date(2026, 2, 1), 3, 9), ("b", date(2026, 3, 1), 1, 1)]
    sparse = spark.createDataFrame(rows, "k string, m date, n bigint, c bigint")
    full = fill_gaps(sparse, ["k"], "m", F.lit(date(2026, 3, 1)), 1, {"n": F.lit(0).cast("bigint")})
    found = [tuple(row) for row in full.select("k", "m", "n", "c").orderBy("k", "m").collect()]
    assert found == [
        ("a", date(2025, 11, 1), 2, 5),
        ("a", date(2025, 12, 1), 0, 5),
        ("a", date(2026, 1, 1), 0, 5),
        ("a", date(2026, 2, 1), 3, 9),
        ("a", date(2026, 3, 1), 0, 9),
        ("b", date(2026, 3, 1), 1, 1),
    ]


def test_staging_uses_the_session_folder(spark):
    assert staging_root(spark).startswith(spark.conf.get(SETTING))
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert "Scan parquet" in staged._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    ).replace("FileScan parquet", "Scan parquet")
