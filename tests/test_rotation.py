from shelfwise.operators.activity import daily_activity, quarterly_activity
from shelfwise.plans import quarterly
from shelfwise.plans.current import BY_ARTICLE, current_article, current_owner_article, rolling_detail, rotation
from shelfwise.operators.metrics import ARTICLE, OWNER_ARTICLE, article_dimension, owner_dimension

STOCK = [("Uno", "1", "x", "Equis", 5.0, "L1")]


def article(world, by_key, params, moves, stock=STOCK):
    w = world(moves, stock)
    return by_key(current_article(w.activity, w.by_article, params), "articulo")


def test_recent_arrival_inside(world, by_key, params):
    row = article(world, by_key, params, [("CR", "2026-04-04", "x", None, 1.0, "1")])["x"]
    assert row.rotacion_final_ytd == "Sin rotación, recién llegado"
    assert row.rotacion_final_30d == "Sin rotación 30d, recién llegado"
    assert row.criterio_rotacion_ytd == "Sin PI y con última entrada CR en los últimos 14 días"
    assert row.rotacion_abc_ytd == "D" and row.dias_desde_ultima_cr == 13


def test_recent_arrival_outside(world, by_key, params):
    row = article(world, by_key, params, [("CR", "2026-04-03 12:00", "x", None, 1.0, "1")])["x"]
    assert row.rotacion_final_ytd == row.rotacion_final_30d == "D"
    assert row.criterio_rotacion_ytd == "Sin líneas PI YTD 2026 y sin entrada CR en los últimos 14 días"


def test_last_instant_of_the_fourteenth_day_counts(world, by_key, params):
    row = article(world, by_key, params, [("CR", "2026-04-03 23:59:59.999999", "x", None, 1.0, "1")])["x"]
    assert row.rotacion_final_ytd == "Sin rotación, recién llegado"


def test_rolling_edges(world, by_key, params):
    moves = [
        ("PI", "2026-03-19 00:00", "x", None, 2.0, "1"),
        ("PI", "2026-03-18 23:59:59", "x", None, 4.0, "1"),
        ("PI", "2026-04-17 23:59:59", "x", None, 8.0, "1"),
        ("PI", "2026-04-18 00:00", "x", None, 16.0, "1"),
        ("PI", "2025-12-31 23:59:59", "x", None, 32.0, "1"),
    ]
    row = article(world, by_key, params, moves)["x"]
    assert (row.lineas_pi_30d, row.cantidad_pi_30d) == (2, 10.0)
    assert (row.lineas_pi_ytd, row.cantidad_pi_ytd) == (3, 14.0)
    assert row.cobertura_lineas_30d == 2.5 and row.cobertura_cantidad_30d == 0.5
    assert row.rotacion_final_ytd == "A" and row.criterio_rotacion_ytd == "Pareto ABC por líneas PI YTD 2026"


def test_no_recent_line_gives_no_coverage(world, by_key, params):
    row = article(world, by_key, params, [("PI", "2026-01-05", "x", None, 2.0, "1")])["x"]
    assert row.cobertura_lineas_30d is None and row.cobertura_cantidad_30d is None
    assert (row.inactivo_30d, row.inactivo_90d) == ("Sí", "Sí")


def test_ranking_covers_keys_out_of_stock(world, by_key, params):
    moves = [("PI", "2026-04-01", "y", None, 1.0, "1")] * 9 + [("PI", "2026-04-01", "x", None, 1.0, "1")]
    row = article(world, by_key, params, moves)["x"]
    assert (row.porcentaje_lineas_pi_ytd, row.porcentaje_acumulado_pi_ytd, row.rotacion_abc_ytd) == (0.1, 1.0, "B")


def test_owner_grain_ignores_lines_without_owner(world, by_key, params):
    w = world(
        [("PI", "2026-04-01", "x", "de lineas", 1.0, None), ("PI", "2026-04-02", "x", " texto ", 1.0, "1")],
        [("Uno", "1", "x", None, 5.0, "L1"), ("Uno", "1", "x", "nan", 5.0, "L2")],
    )
    owner = by_key(current_owner_article(w.activity, w.by_owner, params), "id_owner_article")["1|x"]
    assert owner.lineas_pi_ytd == 1 and owner.descripcion == "texto" and owner.ubicaciones_con_stock == 2
    assert owner.criterio_rotacion_ytd == "Pareto ABC por líneas PI 2026"
    whole = by_key(current_article(w.activity, w.by_article, params), "articulo")["x"]
    assert whole.lineas_pi_ytd == 2 and whole.descripcion == "de lineas" and whole.densidad_stock == 5.0


def test_daily_sums_give_the_same_table(world, by_key, params):
    moves = [
        ("PI", f"2026-0{m}-1{d} 0{h}:00", a, t, q, o)
        for m in (1, 3, 4)
        for d in (1, 5)
        for h in (3, 9)
        for a, t, q, o in (("x", "uno", 1.0, "1"), ("x", None, 2.0, None), ("y", "dos", 3.0, "2"))
    ] + [("CR", "2026-04-10 10:00", "y", "tres", 3.0, "2")]
    w = world(moves, [*STOCK, ("Dos", "2", "y", None, 3.0, "L9")])
    daily = daily_activity(w.movements)
    for build, stock in ((current_article, w.by_article), (current_owner_article, w.by_owner)):
        assert sorted(map(str, build(w.activity, stock, params).collect())) == sorted(
            map(str, build(daily, stock, params).collect())
        )


def test_flags(world, by_key, params):
    # Four quiet articles with stock 1..4: the upper quartile is 3.25.
    stock = [("Uno", "1", f"q{n}", "q", float(n), "L1") for n in (1, 2, 3, 4)]
    rows = article(world, by_key, params, [("PI", "2025-01-01", "q4", None, 1.0, "1")], stock)
    assert {k: r.flag_sobrestock for k, r in rows.items()} == {"q1": "No", "q2": "No", "q3": "No", "q4": "Sí"}
    assert all(r.flag_stock_alto_vs_uso_reciente == r.flag_sobrestock for r in rows.values())


def test_scattered_fast_article_is_to_be_moved_together(world, by_key, params):
    stock = [("Uno", "1", "x", "x", 1.0, f"L{n}") for n in range(5)]
    stock += [("Uno", "1", f"z{n}", "z", 50.0, place) for n in range(4) for place in ("A", "B")]
    rows = article(world, by_key, params, [("PI", "2026-04-01", "x", None, 1.0, "1")], stock)
    assert rows["x"].flag_reubicar == "Sí" and rows["z1"].flag_reubicar == "No"


def test_rolling_detail(world, params):
    w = world([("PI", "2026-04-01", "x", None, 1.0, "1")], STOCK)
    cut = rolling_detail(rotation(w.activity, w.by_article, BY_ARTICLE, params), BY_ARTICLE)
    assert len(cut.columns) == 17 and cut.first().lineas_pi_30d == 1


def test_first_text_goes_by_row_not_by_time(world, by_key, params):
    moves = [("PI", "2026-04-02", "x", "  ", 1.0, "1"), ("PI", "2026-04-03", "x", "b", 1.0, "1"), ("PI", "2026-04-01", "x", "a", 1.0, "1")]
    row = article(world, by_key, params, moves, [("Uno", "1", "x", None, 5.0, "L1")])["x"]
    assert row.descripcion == "b"


# --- quarters --------------------------------------------------------------------------------------


def quarters(w, params, keys):
    return quarterly.quarterly_rotation(w.activity, w.by_owner if len(keys) == 2 else w.by_article, keys, params)


def test_lines_without_owner_keep_their_row(world, by_key, params):
    w = world([("PI", "2026-01-10", "x", None, 1.0, None), ("CR", "2026-02-10", "x", None, 3.0, None)], [])
    table = quarterly.owner_quarterly(w.activity, w.by_owner, owner_dimension(w.activity, w.by_owner), params)
    rows = by_key(table, "period_label")
    assert set(rows) == {"2026Q1", "2026Q2"}
    first = rows["2026Q1"]
    assert first.owner_key is None and first.propietario is None and first.stock_actual_foto is None
    assert first.id_owner_article == "None|x" and first.lineas_pi_trimestre == 0
    assert first.rotacion_final_trimestre == "D" and str(first.ultima_cr_hasta_fin_trimestre) == "2026-02-10 00:00:00"


def test_stock_without_lines_is_in_the_current_quarter_only(world, by_key, params):
    w = world([("PI", "2025-07-10", "y", None, 1.0, "1")], STOCK)
    table = quarterly.article_quarterly(w.activity, w.by_article, article_dimension(w.activity, w.by_article), params)
    rows = by_key(table, "articulo", "period_label")
    assert [p for a, p in rows if a == "x"] == ["2026Q2"]
    assert sorted(p for a, p in rows if a == "y") == ["2025Q3", "2025Q4", "2026Q1", "2026Q2"]
    assert rows["y", "2025Q4"].criterio_rotacion_trimestre == (
        "Sin líneas PI en 2025Q4 y sin entrada CR en los últimos 14 días"
    )


def test_recent_arrival_looks_at_the_end_of_each_quarter(world, by_key, params):
    w = world(
        [
            ("CR", "2025-12-20", "x", None, 1.0, "1"),
            ("CR", "2026-03-10", "x", None, 1.0, "1"),
            ("CR", "2026-04-05", "x", None, 1.0, "1"),
        ],
        STOCK,
    )
    rows = by_key(quarters(w, params, ARTICLE), "period_label")
    late = "Sin rotación trimestre, recién llegado"
    assert [rows[q].rotacion_final_trimestre for q in ("2025Q4", "2026Q1", "2026Q2")] == [late, "D", late]
    assert [rows[q].lineas_cr_historico for q in ("2025Q4", "2026Q1", "2026Q2")] == [1, 2, 3]


def test_changes_over_a_gap(world, by_key, params):
    w = world(
        [("PI", "2025-07-10", "x", None, 1.0, "1"), ("PI", "2026-01-10", "x", None, 1.0, "1")],
        STOCK,
    )
    table = quarterly.article_quarterly(w.activity, w.by_article, article_dimension(w.activity, w.by_article), params)
    rows = by_key(quarterly.quarterly_changes(table), "period_label")
    assert [(q, rows[q].cambio_abc, rows[q].sentido_cambio) for q in sorted(rows)] == [
        ("2025Q3", "Nuevo", "Nuevo"),
        ("2025Q4", "Sin movimiento", "Sin movimiento"),
        ("2026Q1", "D -> A", "Mejora"),
        ("2026Q2", "Sin movimiento", "Sin movimiento"),
    ]


def test_universe_equals_rotation_rows(world, params):
    w = world(
        [("PI", "2025-07-10", "x", None, 1.0, "1"), ("CR", "2026-01-10", "y", None, 1.0, None), ("XX", "2024-01-01", "z", None, 1.0, "1")],
        STOCK,
    )
    for keys, stock in ((OWNER_ARTICLE, w.by_owner), (ARTICLE, w.by_article)):
        universe = quarterly.quarter_universe(w.activity, stock, keys, params).select(*keys, "period_label")
        rows = quarters(w, params, keys).select(*keys, "period_label")
        assert sorted(map(str, universe.collect())) == sorted(map(str, rows.collect()))


def test_sums_per_quarter_give_the_same_quarters(world, params):
    moves = [
        (kind, f"{y}-{m:02}-1{d}", a, t, q, o)
        for y in (2024, 2025)
        for m in (1, 2, 8)
        for d in (1, 7)
        for kind, a, t, q, o in (("PI", "x", "uno", 1.0, "1"), ("PI", "x", None, 2.0, None), ("CR", "y", "dos", 3.0, "2"))
    ]
    w = world(moves, STOCK)
    sums = quarterly_activity(w.movements)
    for build, stock, dimension in (
        (quarterly.owner_quarterly, w.by_owner, owner_dimension),
        (quarterly.article_quarterly, w.by_article, article_dimension),
    ):
        assert sorted(map(str, build(w.activity, stock, dimension(w.activity, stock), params).collect())) == sorted(
            map(str, build(sums, stock, dimension(sums, stock), params).collect())
        )
