"""A base that grows with the log, snapshots replaced whole, and the order of lines and of stored rows."""

from datetime import date

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shelfwise.operators.activity import daily_activity
from shelfwise.operators.metrics import stock_by_article
from shelfwise.plans import current, snapshots, temporality
from shelfwise.plans.incremental import DailyBase
from shelfwise.plans.publish import read_table, write_snapshot
from shelfwise.sources.movements import prepare_movements, read_movements
from shelfwise.sources.sample import SAMPLE, sample_movements, sample_stock
from shelfwise.sources.stock import occupied_stock


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_a_second_run_reads_only_new_files(spark, tmp_path):
    moves, log = sample_movements(spark, SMALL), tmp_path / "log"
    late = F.col("fecha_inicio") >= F.lit(date(2001, 9, 1)).cast("timestamp_ntz")
    moves.where(~late).repartition(3).write.parquet(str(log / "first"))
    base = DailyBase(str(tmp_path / "base"))
    with pytest.raises(FileNotFoundError):
        base.activity(spark, SAMPLE)
    assert len(base.update(spark, str(log), SAMPLE)) == 3 and base.update(spark, str(log), SAMPLE) == []
    moves.where(late).repartition(2).write.parquet(str(log / "new day"))
    new = base.update(spark, str(log), SAMPLE)
    assert len(new) == 2 and all("new" in name for name in new)
    # A batch that was written but not listed does not count.
    spark.read.parquet(f"{base.root}/dias/lote=1").write.partitionBy("dia").parquet(f"{base.root}/dias/lote=9")

    whole = daily_activity(prepare_movements(moves, SAMPLE))
    stock = stock_by_article(occupied_stock(sample_stock(spark, SMALL)))
    for build in (lambda a: current.current_article(a, stock, SAMPLE), temporality.monthly_actual):
        same(build(base.activity(spark, SAMPLE)), build(whole))

    # A file that is gone takes its lines with it: everything is read anew.
    gone = next((log / "first").glob("part-*.parquet"))
    gone.rename(tmp_path / "gone.parquet")
    assert len(base.update(spark, str(log), SAMPLE)) == 4
    rest = spark.read.option("recursiveFileLookup", True).parquet(str(log))
    same(temporality.monthly_actual(base.activity(spark, SAMPLE)), temporality.monthly_actual(daily_activity(prepare_movements(rest, SAMPLE))))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_lines_keep_the_order_of_their_files(spark, tmp_path, fmt):
    """Two unequal files, one name with a space, cut in several ways."""
    lines = [("PI", f"{1 + n % 28:02}/03/2026", f"a{n % 7}", f"text {n}", 1.0, "1") for n in range(700)]
    names = ["tipo_movimiento", "fecha_inicio", "articulo", "denominacion_articulo", "cantidad", "propietario"]
    folder = tmp_path / "log"
    folder.mkdir()
    for name, part in (("a 1", lines[:600]), ("b", lines[600:])):
        out = spark.createDataFrame(part, names).coalesce(1).write
        (out.option("header", True).csv if fmt == "csv" else out.parquet)(str(tmp_path / name))
        next((tmp_path / name).glob("part-*")).rename(folder / f"{name}.{fmt}")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "3k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = read_movements(spark, str(folder), fmt).orderBy("row_no").collect()
            assert [r.denominacion_articulo for r in rows] == [x[3] for x in lines], size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_a_failing_write_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("2001-10-31", n) for n in range(4)], "snapshot_date string, n int")
    write_snapshot(rows, path, SAMPLE)
    bad = rows.withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("n")).cast("int"))
    with pytest.raises(Exception, match="no"):
        write_snapshot(bad, path, SAMPLE)
    assert read_table(rows, path, SAMPLE).count() == 4 == spark.read.parquet(path).count()
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["snapshot_date=2001-10-31"]
    # A run that ended between its two renames.
    (tmp_path / "t" / "snapshot_date=2001-10-31").rename(tmp_path / "t" / ".antes-2001-10-31")
    assert read_table(rows, path, SAMPLE).count() == 4
    write_snapshot(rows.limit(1), path, SAMPLE)
    assert read_table(rows, path, SAMPLE).count() == 1


def test_rows_lie_in_the_order_they_were_given(spark, tmp_path):
    path, order = str(tmp_path / "t"), [F.col("n").desc()]
    rows = spark.range(5000).select(F.lit("2001-10-31").alias("snapshot_date"), ((F.col("id") * 7919) % 5000).alias("n")).repartition(6)
    write_snapshot(rows, path, SAMPLE, order)
    found = snapshots.read_in_order(spark, path, SAMPLE).orderBy("orden").collect()
    assert [r.n for r in found] == list(range(4999, -1, -1))
