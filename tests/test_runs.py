"""Sources, whole runs and the SQL checks."""

import json
import os
from dataclasses import replace
from datetime import date

import pytest
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as driver
from shelfwise.catalog import oracle
from shelfwise.catalog.queries import QUERIES
from shelfwise.operators.reuse import release
from shelfwise.plans import layouts, publish
from shelfwise.plans.kpis import report_order
from shelfwise.plans.publish import Target
from shelfwise.plans.snapshots import read_in_order
from shelfwise.sources.columns import require_columns
from shelfwise.sources.movements import prepare_movements, read_movements
from shelfwise.sources.sample import SAMPLE, sample_movements, sample_stock
from shelfwise.sources.stock import latest_stock_file, occupied_stock, open_stock, read_stock


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="log: cantidad; other: amount"):
        require_columns(log=(spark.range(1), {"A": "id", "B": "cantidad"}), fine=(spark.range(1), {"A": "id"}), other=(spark.range(1), {"C": "amount"}))
    with pytest.raises(ValueError, match="stock: art_y"):
        occupied_stock(spark.range(1))


def test_csv_with_spreadsheet_headers(spark, params, tmp_path):
    (tmp_path / "m.csv").write_text(
        "Tipo movimiento,Fecha inicio,Artículo,Denominación artículo,Cantidad,Propietario\n"
        "PI,31/03/2026,019080,VASO,12,7.0\nPI,2026-03-31,1,VASO,1,7\nCR,01/04/2026 10:30:00, 5.0 ,,x,nan\n"
        "PI,18/04/2026,1,VASO,1,7\nPI,01/04/2026, ,VASO,1,7\n",
        encoding="utf-8",
    )
    rows = prepare_movements(read_movements(spark, str(tmp_path / "m.csv"), "csv"), params).orderBy("row_no").collect()
    assert [(r.tipo_movimiento, r.article_key, r.owner_key, r.cantidad_movimiento, r.period_label) for r in rows] == [
        ("PI", "019080", "7", 12.0, "2026Q1"),
        ("CR", "5", None, 0.0, "2026Q2"),
    ]
    (tmp_path / "stock 17-04-2026.csv").write_text(
        "Denominación propietario,Propie.,Art._y,Denominación,Stock pal.,Ubicacion,Ocupacion\n"
        "Uno,7.0,019080,VASO,3.5,L1,Ocupado\nUno,7,1,VASO,3,L1,Libre\nUno,,1,VASO,3,L1,Ocupado\nUno,7,1,VASO,0,L1,Ocupado\n",
        encoding="utf-8",
    )
    held = occupied_stock(read_stock(spark, str(tmp_path / "stock 17-04-2026.csv"), "csv")).collect()
    assert [(r.owner_key, r.article_key, r.stock_actual) for r in held] == [("7", "019080", 3.5)]


def test_latest_stock_file(spark, tmp_path):
    for name, age in (("31-03-2026.csv", 5), ("a 30-04-2026.csv", 9), ("b 30-04-2026.csv", 1), ("movimientos.csv", 0)):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 - age * 1000,) * 2)
    path, day = latest_stock_file(spark, str(tmp_path))
    assert "b%2030-04-2026" in path or "b 30-04-2026" in path
    assert day == date(2026, 4, 30)
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "movimientos.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        latest_stock_file(spark, str(empty))


def test_open_stock_takes_parquet_folders_paths_and_tables(spark, tmp_path):
    stock = sample_stock(spark, SMALL).limit(5).drop("snapshot_date")
    for day in ("31-03-2026", "stock 17-04-2026"):
        stock.write.parquet(str(tmp_path / "many" / f"{day}.parquet"))
    for path in (tmp_path / "many", tmp_path / "many" / "stock 17-04-2026.parquet"):
        found, day = open_stock(spark, str(path))
        assert found.count() == 5 and day == date(2026, 4, 17)
    sample_stock(spark, SMALL).write.partitionBy("snapshot_date").parquet(str(tmp_path / "table"))
    found, day = open_stock(spark, str(tmp_path / "table"))
    assert found.count() > 0 and day == date(2001, 11, 30)
    assert [str(r.snapshot_date) for r in found.select("snapshot_date").distinct().collect()] == ["2001-11-30"]
    found, day = open_stock(spark, str(tmp_path / "table"), day=date(2001, 10, 31))
    assert found.count() > 0 and day == date(2001, 10, 31)


def test_a_run_without_rows_empties_its_snapshot(spark, tmp_path):
    rows = spark.createDataFrame([("2001-10-31", 1)], "snapshot_date string, n int")
    other = replace(SAMPLE, snapshot=date(2001, 9, 30))
    for frame, params in ((rows, SAMPLE), (rows, other), (rows.limit(0), SAMPLE)):
        publish.write_snapshot(frame, str(tmp_path / "t"), params)
    assert publish.read_table(rows, str(tmp_path / "t"), SAMPLE).count() == 0
    assert publish.read_table(rows, str(tmp_path / "t"), other).count() == 1


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Two runs of neighbouring snapshots into one target."""
    target = Target(str(tmp_path_factory.mktemp("published")))
    moves, stock = sample_movements(spark, SMALL), sample_stock(spark, SMALL).drop("snapshot_date")
    earlier = replace(SAMPLE, snapshot=date(2001, 9, 30), generated_at="2001-09-30 00:00:00")
    publish.publish(moves, stock, earlier, target)
    publish.publish(moves, stock, SAMPLE, target)
    return target


def document(spark, run, name):
    return json.loads(spark.read.text(f"{run.document(name)}/snapshot_date=2001-10-31").first().value)


def latest(spark, run, name):
    return spark.read.parquet(run.table(name)).where(F.col("snapshot_date") == "2001-10-31")


def test_published_tables(spark, run):
    for name, layout in {
        publish.OWNER_CURRENT: layouts.CURRENT_OWNER_ARTICLE,
        publish.ARTICLE_CURRENT: layouts.CURRENT_ARTICLE,
        publish.OWNER_HISTORY: layouts.OWNER_QUARTERLY,
        publish.ARTICLE_HISTORY: layouts.ARTICLE_QUARTERLY,
        publish.CHANGES: layouts.QUARTERLY_CHANGES,
        publish.TEMPORALITY: layouts.TEMPORALITY_ARTICLE,
        publish.TEMPORALITY_MONTHS: layouts.TEMPORALITY_MONTHLY,
        publish.TEMPORALITY_QUARTERS: layouts.TEMPORALITY_QUARTERLY,
        publish.DECISION: layouts.DECISION_ARTICLE,
    }.items():
        table = spark.read.parquet(run.table(name))
        assert sorted(table.columns) == sorted(layout), name
        # Both snapshots are kept, each with rows.
        assert {str(r.snapshot_date) for r in table.select("snapshot_date").distinct().collect()} == {
            "2001-09-30",
            "2001-10-31",
        }, name


def test_invariants(spark, run):
    abc, seasons = document(spark, run, publish.KPI_ABC), document(spark, run, publish.KPI_TEMPORALITY)
    total = abc["total_referencias_articulo"]
    for horizon in ("ytd", "30d"):
        assert sum(abc[f"referencias_{c}_{horizon}"] for c in ("A", "B", "C", "D", "recien_llegado")) == total
    stock = sum(abc[f"stock_{c}_ytd"] for c in ("A", "B", "C", "D", "recien_llegado"))
    assert stock == abc["stock_total_articulo"] == abc["stock_total_owner_article"]
    assert abc["articulos_flag_sobrestock"] == abc["articulos_flag_stock_alto_vs_uso_reciente"]
    assert abc["ultimo_trimestre_disponible"] == "2001Q4"
    assert [len(abc[f"top_10_articulos_{h}"]) for h in ("ytd", "30d")] == [10, 10]
    assert list(abc["top_10_articulos_ytd"][0]) == [
        "articulo", "descripcion", "lineas_pi_ytd", "cantidad_pi_ytd", "rotacion_final_ytd", "stock_actual_total"
    ]
    lines = [row["lineas_pi_ytd"] for row in abc["top_10_articulos_ytd"]]
    assert lines == sorted(lines, reverse=True)
    assert sum(seasons["conteo_temporalidad_clase"].values()) == total
    assert sum(seasons["conteo_acciones_recomendadas"].values()) == total
    actions = seasons["conteo_acciones_recomendadas"]
    assert seasons["numero_revisar_manualmente"] == actions.get("Revisar manualmente", 0)
    assert seasons["numero_candidatos_mantener"] == actions.get("Conviene mantener accesible", 0)
    assert seasons["proximos_meses_pico_detectados"] == sorted(seasons["proximos_meses_pico_detectados"])
    assert all(set(row) == {"articulo", "descripcion", "riesgo_mover_almacen", "accion_recomendada",
                            "peak_period_upcoming", "months_to_next_peak"}
               for row in seasons["top_riesgo_mala_decision_si_se_mueven"])


def test_a_run_and_the_single_query_agree(spark, run):
    """Daily sums and staged tables change nothing."""
    for table, name in ((publish.ARTICLE_CURRENT, "current_article"), (publish.DECISION, "decision_article")):
        single = driver.queries()[name](spark, SMALL)
        whole = latest(spark, run, table).withColumn("snapshot_date", F.lit("2001-10-31"))
        assert len(single.columns) == len(whole.columns)
        rounded = [
            F.round(c, 10).alias(c) if kind == "double" else F.col(c) for c, kind in single.dtypes
        ]
        assert single.exceptAll(whole.select(*rounded)).count() == 0
        assert single.count() == whole.count()


def test_same_run_twice_replaces_its_snapshot(spark, run):
    before = spark.read.parquet(run.table(publish.ARTICLE_CURRENT)).count()
    one = latest(spark, run, publish.ARTICLE_CURRENT).count()
    rows = latest(spark, run, publish.ARTICLE_CURRENT).withColumn("snapshot_date", F.lit("2001-10-31"))
    publish.write_snapshot(spark.createDataFrame(rows.collect(), rows.schema), run.table(publish.ARTICLE_CURRENT), SAMPLE)
    assert spark.read.parquet(run.table(publish.ARTICLE_CURRENT)).count() == before > one


@pytest.fixture(scope="module")
def checks():
    return oracle.statements(), connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_sql_check(spark, checks, name):
    statements, base = checks
    rows = driver.queries()[name](spark, SMALL).toPandas()
    assert differences(rows, base.execute(statements[name]).df()) is None
    release(spark)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_a_check():
    assert set(QUERIES) == set(oracle.statements())


def test_the_article_table_lies_in_report_order(spark, run):
    rows = read_in_order(spark, run.table(publish.ARTICLE_CURRENT), SAMPLE)
    stored = [r.articulo for r in rows.orderBy("orden").collect()]
    assert len(stored) > 10 and stored == [r.articulo for r in rows.orderBy(*report_order()).collect()]
