"""The same results in plain SQL, for checking the Spark queries.

Written from the rules, step by step, with full sorts and calendar cross joins, where the
Spark plans work in single passes.
"""

from __future__ import annotations

import re

from shelfwise.catalog.contract import kind_of, shaped_sql
from shelfwise.catalog.queries import QUERIES
from shelfwise.params import (
    ACTION_KEEP,
    ACTION_OFF_SEASON,
    ACTION_REVIEW,
    ACTION_SECONDARY,
    CODE_KEEP,
    CODE_OFF_SEASON,
    CODE_REVIEW,
    CODE_SECONDARY,
    MONTHS,
    REASON_KEEP,
    REASON_OFF_SEASON,
    REASON_REVIEW,
    REASON_SECONDARY,
    WINDOW_KEEP,
    WINDOW_OFF_SEASON,
    WINDOW_REVIEW,
    WINDOW_SECONDARY,
)
from shelfwise.sources.sample import SAMPLE

DAY = f"DATE '{SAMPLE.snapshot}'"
NEXT = f"DATE '{SAMPLE.next_day}'"
YEAR = f"DATE '{SAMPLE.year_start}'"
ROLLING = f"DATE '{SAMPLE.rolling_start}'"
QUARTER = f"DATE '{SAMPLE.quarter_start}'"
MONTH = f"DATE '{SAMPLE.month_start}'"
AS_OF = "DATE '2000-07-01'"
STAMP = f"'{SAMPLE.snapshot_text}' AS snapshot_date, '{SAMPLE.generated_at}' AS generated_at"
BLANK = r"' ' || chr(9) || chr(10) || chr(13)"
NAMES = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"

OWNER = "owner_key, article_key"
ARTICLE = "article_key"


def bare(text: str) -> str:
    return f"trim({text}, {BLANK})"


def filled(text: str) -> str:
    return f"(CASE WHEN {bare(text)} <> '' AND lower({bare(text)}) <> 'nan' THEN {bare(text)} END)"


def key(text: str) -> str:
    t = filled(text)
    return f"(CASE WHEN regexp_full_match({t}, '[0-9]+\\.0') THEN left({t}, length({t}) - 2) ELSE {t} END)"


def first_text(text: str) -> str:
    t = filled(text)
    return f"arg_min({t}, {{'r': row_no, 't': {t}}}) FILTER (WHERE {t} IS NOT NULL)"


def on(left: str, right: str, keys: str) -> str:
    return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys.split(", "))


def pi(keys: str, first: str) -> str:
    owner = "AND owner_key IS NOT NULL" if "owner_key" in keys else ""
    return f"""SELECT {keys}, count(*) AS lineas_pi, sum(cantidad_movimiento) AS cantidad_pi,
        max(fecha_movimiento) AS ultima_pi, {first_text('descripcion_movimiento')} AS descripcion_pi
        FROM mov WHERE tipo_movimiento = 'PI' {owner} AND fecha_movimiento >= {first} AND fecha_movimiento < {NEXT}
        GROUP BY {keys}"""


def cr(keys: str, past: str) -> str:
    return f"""SELECT {keys}, count(*) AS lineas_cr_historico, sum(cantidad_movimiento) AS cantidad_cr_historico,
        max(fecha_movimiento) AS ultima_cr FROM mov WHERE tipo_movimiento = 'CR' AND fecha_movimiento < {past}
        GROUP BY {keys}"""


def ranked(source: str, keys: str, part: str = "", lines: str = "lineas_pi", qty: str = "cantidad_pi") -> str:
    by = f"PARTITION BY {part}" if part else ""
    return f"""SELECT *, {lines} / total AS pct, upto / total AS acum,
        CASE WHEN (upto - {lines}) * 100 < 80 * total THEN 'A' WHEN (upto - {lines}) * 100 < 95 * total THEN 'B'
        ELSE 'C' END AS abc
        FROM (SELECT *, sum({lines}) OVER ({by}) AS total,
            sum({lines}) OVER ({by} ORDER BY {lines} DESC, {qty} DESC, {keys} ROWS UNBOUNDED PRECEDING) AS upto
            FROM {source})"""


def recent(lines: str, last: str, reference: str) -> str:
    cutoff = f"(CAST({reference} AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND - INTERVAL 14 DAY)"
    return f"({lines} = 0 AND {last} IS NOT NULL AND {last} >= {cutoff})"


def final(abc: str, lines: str, arrived: str, text: str) -> str:
    return f"CASE WHEN {arrived} THEN '{text}' WHEN {lines} = 0 THEN 'D' ELSE {abc} END"


def days(stamp: str, reference: str = DAY) -> str:
    return f"date_diff('day', CAST({stamp} AS DATE), CAST({reference} AS DATE))"


def ratio(top: str, bottom: str) -> str:
    return f"(CASE WHEN {bottom} <> 0 THEN {top} / {bottom} END)"


def idle(stamp: str, limit: int) -> str:
    return f"CASE WHEN {stamp} IS NULL OR {days(stamp)} > {limit} THEN 'Sí' ELSE 'No' END"


def rotated(keys: str, stock: str, ytd: str, r30: str, crs: str, last: str, active: str, none: str) -> str:
    arrived = recent("lineas_pi_ytd", "ultima_cr", DAY)
    arrived30 = recent("lineas_pi_30d", "ultima_cr", DAY)
    return f"""SELECT *, {final('rotacion_abc_ytd', 'lineas_pi_ytd', arrived, 'Sin rotación, recién llegado')} AS rotacion_final_ytd,
        {final('rotacion_abc_30d', 'lineas_pi_30d', arrived30, 'Sin rotación 30d, recién llegado')} AS rotacion_final_30d,
        CASE WHEN {arrived} THEN 'Sin PI y con última entrada CR en los últimos 14 días'
             WHEN lineas_pi_ytd = 0 OR rotacion_abc_ytd = 'D' THEN '{none}' ELSE '{active}' END AS criterio_rotacion_ytd,
        {days('ultima_pi_ytd')} AS dias_desde_ultima_pi_ytd, {days('ultima_pi_30d')} AS dias_desde_ultima_pi_30d,
        {days('ultima_cr')} AS dias_desde_ultima_cr,
        {idle('ultima_pi_historica', 30)} AS inactivo_30d, {idle('ultima_pi_historica', 90)} AS inactivo_90d
        FROM (SELECT s.*, coalesce(y.lineas_pi, 0) AS lineas_pi_ytd, coalesce(y.cantidad_pi, 0) AS cantidad_pi_ytd,
            coalesce(y.pct, 0) AS porcentaje_lineas_pi_ytd, coalesce(y.acum, 0) AS porcentaje_acumulado_pi_ytd,
            coalesce(y.abc, 'D') AS rotacion_abc_ytd, y.ultima_pi AS ultima_pi_ytd, y.descripcion_pi,
            r.descripcion_pi AS descripcion_pi_30d,
            coalesce(r.lineas_pi, 0) AS lineas_pi_30d, coalesce(r.cantidad_pi, 0) AS cantidad_pi_30d,
            coalesce(r.pct, 0) AS porcentaje_lineas_pi_30d, coalesce(r.acum, 0) AS porcentaje_acumulado_pi_30d,
            coalesce(r.abc, 'D') AS rotacion_abc_30d, r.ultima_pi AS ultima_pi_30d,
            coalesce(c.lineas_cr_historico, 0) AS lineas_cr_historico,
            coalesce(c.cantidad_cr_historico, 0) AS cantidad_cr_historico, c.ultima_cr, h.ultima_pi_historica
            FROM {stock} s LEFT JOIN {ytd} y ON {on('s', 'y', keys)} LEFT JOIN {r30} r ON {on('s', 'r', keys)}
            LEFT JOIN {crs} c ON {on('s', 'c', keys)} LEFT JOIN {last} h ON {on('s', 'h', keys)})"""


def thresholds(stock: str, amount: str) -> str:
    return f"""SELECT coalesce(quantile_cont({amount}, 0.75) FILTER (WHERE {amount} > 0), 0) AS umbral_stock,
        coalesce(quantile_cont(CAST(ubicaciones_con_stock AS DOUBLE), 0.75) FILTER (WHERE {amount} > 0), 0) AS umbral_ubicaciones,
        coalesce(quantile_cont({amount} / ubicaciones_con_stock, 0.25) FILTER (WHERE ubicaciones_con_stock > 1), 0) AS umbral_densidad
        FROM {stock}"""


def current(rotation: str, limits: str, amount: str, identity: str) -> str:
    cover, cover_qty = ratio(amount, "lineas_pi_30d"), ratio(amount, "cantidad_pi_30d")
    density = ratio(amount, "ubicaciones_con_stock")
    over = f"""CASE WHEN {amount} >= umbral_stock AND rotacion_final_ytd IN ('C', 'D') AND inactivo_90d = 'Sí'
        THEN 'Sí' ELSE 'No' END"""
    return f"""SELECT *, {STAMP}, article_key AS articulo, {identity},
        coalesce(descripcion_stock, descripcion_pi) AS descripcion,
        {cover} AS cobertura_lineas_30d, {cover_qty} AS cobertura_cantidad_30d,
        {cover} AS indice_stock_vs_lineas_salida_30d, {cover_qty} AS indice_stock_vs_cantidad_salida_30d,
        ubicaciones_con_stock AS dispersion_stock, {density} AS densidad_stock,
        {over} AS flag_sobrestock, {over} AS flag_stock_alto_vs_uso_reciente,
        CASE WHEN rotacion_final_ytd IN ('A', 'B') AND ubicaciones_con_stock >= greatest(4, umbral_ubicaciones)
            AND coalesce({density}, 0) <= umbral_densidad THEN 'Sí' ELSE 'No' END AS flag_reubicar
        FROM {rotation}, {limits}"""


def quarter_pi(keys: str) -> str:
    owner = "AND owner_key IS NOT NULL" if "owner_key" in keys else ""
    return f"""SELECT {keys}, CAST(date_trunc('quarter', fecha_movimiento) AS DATE) AS trimestre, count(*) AS lineas_pi,
        sum(cantidad_movimiento) AS cantidad_pi, max(fecha_movimiento) AS ultima_pi FROM mov
        WHERE tipo_movimiento = 'PI' {owner} GROUP BY ALL"""


def universe(keys: str, stock: str) -> str:
    k = ", ".join(f"k.{name}" for name in keys.split(", "))
    return f"""SELECT DISTINCT {k}, q.trimestre, q.fin FROM quarters q JOIN
        (SELECT {keys}, min(fecha_movimiento) AS primera FROM mov WHERE tipo_movimiento IN ('PI', 'CR') GROUP BY {keys}) k
        ON k.primera < q.fin + 1
        UNION SELECT {keys}, trimestre, fin FROM {stock}, quarters WHERE trimestre = {QUARTER}"""


def quarterly(keys: str, universe_: str, pis: str, dimension: str, identity: str) -> str:
    k = ", ".join(f"u.{name}" for name in keys.split(", "))
    arrived = recent("lineas", "ultima", "fin")
    label = "(year(trimestre) || 'Q' || quarter(trimestre))"
    return f"""SELECT *, {label} AS period_label, year(trimestre) AS year, quarter(trimestre) AS quarter, {STAMP},
        article_key AS articulo, {identity}, lineas AS lineas_pi_trimestre,
        {final('abc', 'lineas', arrived, 'Sin rotación trimestre, recién llegado')} AS rotacion_final_trimestre,
        CASE WHEN {arrived} THEN 'Sin PI y con última entrada CR en los últimos 14 días'
            WHEN lineas = 0 THEN 'Sin líneas PI en ' || {label} || ' y sin entrada CR en los últimos 14 días'
            ELSE 'Pareto ABC por líneas PI del trimestre ' || {label} END AS criterio_rotacion_trimestre,
        ultima AS ultima_cr_hasta_fin_trimestre
        FROM (SELECT u.*, d.* EXCLUDE ({keys}), coalesce(p.lineas_pi, 0) AS lineas,
            coalesce(p.cantidad_pi, 0) AS cantidad_pi_trimestre, coalesce(p.pct, 0) AS porcentaje_lineas_pi_trimestre,
            coalesce(p.acum, 0) AS porcentaje_acumulado_pi_trimestre, coalesce(p.abc, 'D') AS rotacion_abc_trimestre,
            coalesce(p.abc, 'D') AS abc, p.ultima_pi AS ultima_pi_trimestre, c.ultima
            FROM {universe_} u LEFT JOIN {dimension} d ON {on('u', 'd', keys)}
            LEFT JOIN {pis} p ON {on('u', 'p', keys)} AND u.trimestre = p.trimestre
            LEFT JOIN (SELECT {k}, u.trimestre, max(fecha_movimiento) AS ultima FROM {universe_} u JOIN mov m
                ON {on('u', 'm', keys)} AND m.tipo_movimiento = 'CR' AND m.fecha_movimiento < u.fin + 1
                GROUP BY ALL) c ON {on('u', 'c', keys)} AND u.trimestre = c.trimestre)"""


def summary(source: str, rotation: str, stock: str, lines: str, qty: str, level: str = "", by: str = "", counted: str = "articulo") -> str:
    head = f"'{level}' AS analisis, " if level else ""
    part = f"PARTITION BY {by}" if by else ""
    also = f"{by}, " if by else ""
    return f"""SELECT {head}{also}rotacion, referencias, stock_total, lineas_pi, cantidad_pi,
        coalesce({ratio('stock_total', f'sum(stock_total) OVER ({part})')}, 0) AS porcentaje_stock,
        coalesce({ratio('referencias', f'sum(referencias) OVER ({part})')}, 0) AS porcentaje_referencias
        FROM (SELECT {also}{rotation} AS rotacion, count({counted}) AS referencias, coalesce(sum({stock}), 0) AS stock_total,
            sum({lines}) AS lineas_pi, sum({qty}) AS cantidad_pi FROM {source} GROUP BY ALL)"""


ORDER = """CASE {c} WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 WHEN 'Sin rotación, recién llegado' THEN 4
    WHEN 'Sin rotación 30d, recién llegado' THEN 4 WHEN 'Sin rotación trimestre, recién llegado' THEN 4
    WHEN 'D' THEN 5 ELSE 9 END"""
REPORT = f"{ORDER.format(c='rotacion_final_ytd')}, lineas_pi_ytd DESC, stock_actual_total DESC, articulo"


def top(source: str, order: str, where: str = "true") -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {order}, {REPORT}) AS puesto
        FROM {source} WHERE {where}) WHERE puesto <= 10"""


PEAK_NAMES = f"array_to_string([{NAMES}[n] for n in picos], ', ')"

STEPS: dict[str, str] = {
    # Inputs.
    "mov_raw": """SELECT
        CASE WHEN l_returnflag = 'A' THEN 'CR'
             WHEN l_partkey % 10 = 0 AND month(l_shipdate) NOT IN (4, 5, 6) THEN 'XX'
             WHEN l_partkey % 10 = 1 AND NOT (CAST(l_shipdate AS DATE) < DATE '1999-01-01' AND l_linenumber <= 4) THEN 'XX'
             WHEN l_partkey % 10 = 2 AND CAST(l_shipdate AS DATE) < DATE '2001-07-01' THEN 'XX'
             WHEN l_partkey % 10 = 5 AND l_returnflag <> 'R' THEN 'XX'
             ELSE 'PI' END AS tipo_movimiento,
        l_shipdate AS fecha_inicio,
        CAST(CASE WHEN l_partkey % 10 = 4 THEN l_partkey % 50 ELSE l_partkey END AS VARCHAR) AS articulo,
        p_name AS denominacion_articulo, l_quantity AS cantidad,
        CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS propietario,
        l_orderkey * 1000 + l_linenumber * 10 + r.i AS row_no
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey JOIN (VALUES (1), (2), (3), (4), (5), (6), (7), (8)) AS r(i)
        ON r.i <= CASE WHEN l_partkey % 10 = 3 AND l_linenumber = 1 THEN 8 ELSE 1 END""",
    "stock_raw": """SELECT r_name AS denominacion_propietario, CAST(n_regionkey AS VARCHAR) AS propie,
        CAST(CASE WHEN l_partkey % 10 = 4 THEN l_partkey % 50 ELSE l_partkey END AS VARCHAR) AS art_y,
        CASE WHEN l_partkey % 7 <> 0 THEN p_name END AS denominacion, l_quantity AS stock_pal, 'L' || CAST(l_orderkey % 97 AS VARCHAR) AS ubicacion,
        CASE WHEN l_linestatus = 'F' AND l_orderkey % 3 = 0 AND l_orderkey % 5 <> 0 THEN 'Ocupado' ELSE 'Libre' END AS ocupacion,
        l_orderkey * 1000 + l_linenumber * 10 AS row_no, last_day(CAST(l_shipdate AS DATE)) AS snapshot_date
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "mov": f"""SELECT tipo_movimiento, fecha_inicio AS fecha_movimiento, {key('propietario')} AS owner_key,
        {key('articulo')} AS article_key, denominacion_articulo AS descripcion_movimiento,
        coalesce(cantidad, 0) AS cantidad_movimiento, year(fecha_inicio) AS year, quarter(fecha_inicio) AS quarter,
        year(fecha_inicio) || 'Q' || quarter(fecha_inicio) AS period_label, row_no
        FROM mov_raw WHERE fecha_inicio < {NEXT} AND {key('articulo')} IS NOT NULL""",
    "occ": f"""SELECT {key('propie')} AS owner_key, {key('art_y')} AS article_key, denominacion_propietario,
        denominacion, coalesce(stock_pal, 0) AS stock_actual, ubicacion, row_no, snapshot_date FROM stock_raw
        WHERE ocupacion = 'Ocupado' AND stock_pal > 0 AND {key('propie')} IS NOT NULL AND {key('art_y')} IS NOT NULL""",
    "sto": f"""SELECT owner_key, article_key, {first_text('denominacion_propietario')} AS propietario,
        {first_text('denominacion')} AS descripcion_stock, sum(stock_actual) AS stock_actual,
        count(DISTINCT ubicacion) AS ubicaciones_con_stock FROM occ GROUP BY owner_key, article_key""",
    "sta": f"""SELECT article_key, {first_text('denominacion')} AS descripcion_stock,
        sum(stock_actual) AS stock_actual_total, count(DISTINCT ubicacion) AS ubicaciones_con_stock,
        count(DISTINCT owner_key) AS propietarios_distintos FROM occ GROUP BY article_key""",
    "dim_o": f"""SELECT coalesce(s.propietario, owner_key) AS propietario, owner_key, article_key, article_key AS articulo,
        coalesce(s.descripcion_stock, m.descripcion_movimiento) AS descripcion,
        coalesce(s.stock_actual, 0) AS stock_actual, coalesce(s.ubicaciones_con_stock, 0) AS ubicaciones_con_stock
        FROM (SELECT owner_key, article_key, {first_text('descripcion_movimiento')} AS descripcion_movimiento FROM mov
            WHERE owner_key IS NOT NULL GROUP BY owner_key, article_key) m FULL JOIN sto s USING (owner_key, article_key)""",
    "dim_a": f"""SELECT article_key, article_key AS articulo,
        coalesce(s.descripcion_stock, m.descripcion_movimiento) AS descripcion,
        coalesce(s.propietarios_distintos, m.propietarios_movimiento, 0) AS propietarios_distintos,
        coalesce(s.stock_actual_total, 0) AS stock_actual_total, coalesce(s.ubicaciones_con_stock, 0) AS ubicaciones_con_stock
        FROM (SELECT article_key, {first_text('descripcion_movimiento')} AS descripcion_movimiento,
            count(DISTINCT owner_key) AS propietarios_movimiento FROM mov GROUP BY article_key) m
        FULL JOIN sta s USING (article_key)""",
    # Current rotation.
    "ytd_a": pi(ARTICLE, YEAR),
    "ytd_o": pi(OWNER, YEAR),
    "r30_a": pi(ARTICLE, ROLLING),
    "r30_o": pi(OWNER, ROLLING),
    "ytd_a_abc": ranked("ytd_a", ARTICLE),
    "ytd_o_abc": ranked("ytd_o", OWNER),
    "r30_a_abc": ranked("r30_a", ARTICLE),
    "r30_o_abc": ranked("r30_o", OWNER),
    "cr_a": cr(ARTICLE, NEXT),
    "cr_o": cr(OWNER, NEXT),
    "last_a": "SELECT article_key, max(fecha_movimiento) AS ultima_pi_historica FROM mov WHERE tipo_movimiento = 'PI' GROUP BY 1",
    "last_o": """SELECT owner_key, article_key, max(fecha_movimiento) AS ultima_pi_historica FROM mov
        WHERE tipo_movimiento = 'PI' GROUP BY 1, 2""",
    "rot_a": rotated(
        ARTICLE, "sta", "ytd_a_abc", "r30_a_abc", "cr_a", "last_a",
        "Pareto ABC por líneas PI YTD 2001", "Sin líneas PI YTD 2001 y sin entrada CR en los últimos 14 días",
    ),
    "rot_o": rotated(
        OWNER, "sto", "ytd_o_abc", "r30_o_abc", "cr_o", "last_o",
        "Pareto ABC por líneas PI 2001", "Sin líneas PI 2001 y sin entrada CR en los últimos 14 días",
    ),
    "lim_a": thresholds("sta", "stock_actual_total"),
    "lim_o": thresholds("sto", "stock_actual"),
    "cur_a": current("rot_a", "lim_a", "stock_actual_total", "article_key AS id_article"),
    "cur_o": current("rot_o", "lim_o", "stock_actual", "owner_key || '|' || article_key AS id_owner_article"),
    # Quarters.
    "quarters": f"""SELECT CAST(t AS DATE) AS trimestre,
        least(CAST(t + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), {DAY}) AS fin
        FROM (SELECT unnest(generate_series(CAST((SELECT date_trunc('quarter', min(fecha_movimiento)) FROM mov) AS TIMESTAMP),
            CAST({QUARTER} AS TIMESTAMP), INTERVAL 3 MONTH)) AS t)""",
    "qpi_a": quarter_pi(ARTICLE),
    "qpi_o": quarter_pi(OWNER),
    "qpi_a_abc": ranked("qpi_a", ARTICLE, "trimestre"),
    "qpi_o_abc": ranked("qpi_o", OWNER, "trimestre"),
    "uni_a": universe(ARTICLE, "sta"),
    "uni_o": universe(OWNER, "sto"),
    "foto_a": """SELECT article_key, descripcion, propietarios_distintos, stock_actual_total AS stock_actual_total_foto,
        ubicaciones_con_stock AS ubicaciones_con_stock_foto FROM dim_a""",
    "foto_o": """SELECT owner_key, article_key, propietario, descripcion, stock_actual AS stock_actual_foto,
        ubicaciones_con_stock AS ubicaciones_con_stock_foto FROM dim_o""",
    "qua_a": quarterly(ARTICLE, "uni_a", "qpi_a_abc", "foto_a", "article_key AS id_article"),
    "qua_o": quarterly(
        OWNER, "uni_o", "qpi_o_abc", "foto_o", "coalesce(owner_key, 'None') || '|' || article_key AS id_owner_article"
    ),
    "changes": """SELECT *, CASE WHEN antes IS NULL THEN 'Nuevo' WHEN lineas_pi_trimestre = 0 THEN 'Sin movimiento'
            ELSE antes || ' -> ' || rotacion_final_trimestre END AS cambio_abc,
        CASE WHEN antes IS NULL THEN 'Nuevo' WHEN lineas_pi_trimestre = 0 THEN 'Sin movimiento'
            WHEN ahora_n > antes_n THEN 'Mejora' WHEN ahora_n < antes_n THEN 'Empeora' ELSE 'Se mantiene' END AS sentido_cambio
        FROM (SELECT *, antes AS rotacion_trimestre_anterior,
            CASE antes WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 ELSE 1 END AS antes_n,
            CASE rotacion_final_trimestre WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 ELSE 1 END AS ahora_n
            FROM (SELECT *, lag(rotacion_final_trimestre) OVER (PARTITION BY article_key ORDER BY trimestre) AS antes FROM qua_a))""",
    # Temporality.
    "m_act": """SELECT article_key, CAST(date_trunc('month', fecha_movimiento) AS DATE) AS mes, count(*) AS lineas_pi_mes,
        sum(cantidad_movimiento) AS cantidad_pi_mes FROM mov WHERE tipo_movimiento = 'PI' GROUP BY ALL""",
    "q_act": """SELECT article_key, CAST(date_trunc('quarter', fecha_movimiento) AS DATE) AS trimestre,
        count(*) AS lineas_pi_trimestre, sum(cantidad_movimiento) AS cantidad_pi_trimestre FROM mov
        WHERE tipo_movimiento = 'PI' GROUP BY ALL""",
    "m_full": f"""SELECT s.article_key, c.mes, year(c.mes) AS year, month(c.mes) AS month,
        coalesce(lineas_pi_mes, 0) AS lineas_pi_mes, coalesce(cantidad_pi_mes, 0) AS cantidad_pi_mes
        FROM sta s CROSS JOIN (SELECT CAST(unnest(generate_series(CAST((SELECT min(mes) FROM m_act) AS TIMESTAMP),
            CAST({MONTH} AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS mes) c
        LEFT JOIN m_act a ON a.article_key = s.article_key AND a.mes = c.mes""",
    "q_full": f"""SELECT s.article_key, c.trimestre, year(c.trimestre) AS year, quarter(c.trimestre) AS quarter,
        coalesce(lineas_pi_trimestre, 0) AS lineas_pi_trimestre, coalesce(cantidad_pi_trimestre, 0) AS cantidad_pi_trimestre
        FROM sta s CROSS JOIN (SELECT CAST(unnest(generate_series(CAST((SELECT min(trimestre) FROM q_act) AS TIMESTAMP),
            CAST({QUARTER} AS TIMESTAMP), INTERVAL 3 MONTH)) AS DATE) AS trimestre) c
        LEFT JOIN q_act a ON a.article_key = s.article_key AND a.trimestre = c.trimestre""",
    "hist": """SELECT article_key, min(fecha_movimiento) AS first_pi_date, max(fecha_movimiento) AS last_pi_date,
        count(DISTINCT year(fecha_movimiento)) AS years_with_activity, count(*) AS total_lineas_pi_historico,
        sum(cantidad_movimiento) AS total_cantidad_pi_historico,
        count(DISTINCT date_trunc('month', fecha_movimiento)) AS total_months_with_pi,
        count(DISTINCT date_trunc('quarter', fecha_movimiento)) AS total_quarters_with_pi
        FROM mov WHERE tipo_movimiento = 'PI' GROUP BY article_key""",
    "m_agg": """SELECT article_key, avg(lineas_pi_mes) AS lineas_media_mensual, avg(cantidad_pi_mes) AS cantidad_media_mensual,
        max(lineas_pi_mes) AS lineas_max_mes, max(cantidad_pi_mes) AS cantidad_max_mes FROM m_full GROUP BY article_key""",
    "q_agg": """SELECT article_key, avg(lineas_pi_trimestre) AS lineas_pi_trimestre_media,
        avg(cantidad_pi_trimestre) AS cantidad_pi_trimestre_media FROM q_full GROUP BY article_key""",
    "m_prof": """SELECT article_key, month, avg(lineas_pi_mes) AS lineas_mes_media, avg(cantidad_pi_mes) AS cantidad_mes_media,
        sum(lineas_pi_mes) AS lineas_mes_total, sum(cantidad_pi_mes) AS cantidad_mes_total,
        count(*) FILTER (WHERE lineas_pi_mes > 0) AS years_activo_mes FROM m_full GROUP BY article_key, month""",
    "q_prof": """SELECT article_key, quarter, avg(lineas_pi_trimestre) AS lineas_trimestre_media,
        avg(cantidad_pi_trimestre) AS cantidad_trimestre_media, sum(lineas_pi_trimestre) AS lineas_trimestre_total,
        sum(cantidad_pi_trimestre) AS cantidad_trimestre_total,
        count(*) FILTER (WHERE lineas_pi_trimestre > 0) AS years_activo_trimestre FROM q_full GROUP BY article_key, quarter""",
    "peak": f"""SELECT article_key, {NAMES}[arg_max(month, {{'a': lineas_mes_media, 'b': cantidad_mes_media, 'c': -month}})] AS mes_pico_lineas,
        {NAMES}[arg_max(month, {{'a': cantidad_mes_media, 'b': lineas_mes_media, 'c': -month}})] AS mes_pico_cantidad,
        max(lineas_mes_media) AS peak_month_mean FROM m_prof GROUP BY article_key""",
    "peak_q": """SELECT article_key, 'Q' || arg_max(quarter, {'a': lineas_trimestre_media, 'c': -quarter}) AS quarter_peak,
        max(lineas_trimestre_media) AS peak_quarter_mean FROM q_prof GROUP BY article_key""",
    "conc_m": """SELECT article_key, max(lineas_mes_total) AS top1, sum(lineas_mes_total) FILTER (WHERE n <= 2) AS top2
        FROM (SELECT *, row_number() OVER (PARTITION BY article_key ORDER BY lineas_mes_total DESC, month) AS n FROM m_prof)
        GROUP BY article_key""",
    "conc_q": """SELECT article_key, max(lineas_trimestre_total) AS top1, sum(lineas_trimestre_total) FILTER (WHERE n <= 2) AS top2
        FROM (SELECT *, row_number() OVER (PARTITION BY article_key ORDER BY lineas_trimestre_total DESC, quarter) AS n FROM q_prof)
        GROUP BY article_key""",
    "pk_m": """SELECT article_key, list(month ORDER BY month) AS picos, avg(recurrencia) AS monthly_peak_recurrence
        FROM (SELECT p.article_key, month, years_activo_mes / years_with_activity AS recurrencia, lineas_mes_media,
            lineas_media_mensual, lineas_mes_total FROM m_prof p JOIN hist USING (article_key) JOIN m_agg USING (article_key))
        WHERE lineas_mes_media >= lineas_media_mensual * CAST(1.25 AS DOUBLE) AND recurrencia >= 0.5 AND lineas_mes_total > 0
        GROUP BY article_key""",
    "pk_q": """SELECT article_key, list(quarter ORDER BY quarter) AS picos, avg(recurrencia) AS quarterly_peak_recurrence
        FROM (SELECT p.article_key, quarter, years_activo_trimestre / years_with_activity AS recurrencia, lineas_trimestre_media,
            lineas_pi_trimestre_media, lineas_trimestre_total FROM q_prof p JOIN hist USING (article_key) JOIN q_agg USING (article_key))
        WHERE lineas_trimestre_media >= lineas_pi_trimestre_media * CAST(1.2 AS DOUBLE) AND recurrencia >= 0.5 AND lineas_trimestre_total > 0
        GROUP BY article_key""",
    "cvs": """SELECT article_key, CASE WHEN count(*) > 1 THEN power(stddev_pop(lineas_pi_mes) / avg(lineas_pi_mes), 2) ELSE 0 END AS CV2
        FROM m_full WHERE lineas_pi_mes > 0 GROUP BY article_key""",
    "stat": f"""SELECT s.article_key, first_pi_date, last_pi_date, coalesce(years_with_activity, 0) AS years_with_activity,
        coalesce(total_months_with_pi, 0) AS total_months_with_pi, coalesce(total_quarters_with_pi, 0) AS total_quarters_with_pi,
        coalesce(total_lineas_pi_historico, 0) AS total_lineas_pi_historico,
        coalesce(total_cantidad_pi_historico, 0) AS total_cantidad_pi_historico,
        m_agg.* EXCLUDE (article_key), q_agg.* EXCLUDE (article_key), mes_pico_lineas, mes_pico_cantidad, quarter_peak,
        coalesce({ratio('conc_m.top1', 'total_lineas_pi_historico')}, 0) AS porcentaje_concentracion_top_1_mes,
        coalesce({ratio('conc_m.top2', 'total_lineas_pi_historico')}, 0) AS porcentaje_concentracion_top_2_meses,
        coalesce({ratio('conc_q.top1', 'total_lineas_pi_historico')}, 0) AS porcentaje_concentracion_top_1_trimestre,
        coalesce({ratio('conc_q.top2', 'total_lineas_pi_historico')}, 0) AS porcentaje_concentracion_top_2_trimestres,
        coalesce({ratio('conc_q.top1', 'total_lineas_pi_historico')}, 0) AS porcentaje_concentracion_top_trimestre,
        coalesce({ratio('peak_month_mean', 'lineas_media_mensual')}, 0) AS seasonality_index_monthly,
        coalesce({ratio('peak_quarter_mean', 'lineas_pi_trimestre_media')}, 0) AS seasonality_index_quarterly,
        coalesce(pk_m.picos, []) AS picos, coalesce(pk_q.picos, []) AS picos_q,
        coalesce(monthly_peak_recurrence, 0) AS monthly_peak_recurrence,
        coalesce(quarterly_peak_recurrence, 0) AS quarterly_peak_recurrence,
        coalesce(date_diff('month', first_pi_date, {DAY}) + 1, 0) AS months_observed,
        coalesce({ratio(f"(date_diff('month', first_pi_date, {DAY}) + 1)", 'total_months_with_pi')}, 0) AS ADI,
        coalesce(CV2, 0) AS CV2
        FROM sta s LEFT JOIN hist USING (article_key) LEFT JOIN m_agg USING (article_key) LEFT JOIN q_agg USING (article_key)
        LEFT JOIN peak USING (article_key) LEFT JOIN peak_q USING (article_key) LEFT JOIN conc_m USING (article_key)
        LEFT JOIN conc_q USING (article_key) LEFT JOIN pk_m USING (article_key) LEFT JOIN pk_q USING (article_key)
        LEFT JOIN cvs USING (article_key)""",
    "pat": f"""SELECT *, greatest(monthly_peak_recurrence, quarterly_peak_recurrence) AS recurrencia_estacional,
        nullif({PEAK_NAMES}, '') AS meses_pico_recurrentes,
        nullif(array_to_string(['Q' || n for n in picos_q], ', '), '') AS trimestres_pico_recurrentes,
        {NAMES}[((list_min([(n - 10 + 12) % 12 for n in picos]) + 9) % 12) + 1] AS peak_period_upcoming,
        list_min([(n - 10 + 12) % 12 for n in picos]) AS months_to_next_peak,
        'Q' || (((list_min([(n - 4 + 4) % 4 for n in picos_q]) + 3) % 4) + 1) AS next_peak_quarter,
        list_min([(n - 4 + 4) % 4 for n in picos_q]) AS quarters_to_next_peak,
        CASE WHEN total_lineas_pi_historico = 0 OR months_observed < 6 OR total_months_with_pi < 3
                THEN 'Nuevo / sin histórico suficiente'
            WHEN (last_pi_date IS NULL OR {days('last_pi_date')} > 365) AND total_months_with_pi <= 6 THEN 'Dormido'
            WHEN years_with_activity >= 2 AND ((seasonality_index_monthly >= CAST(1.6 AS DOUBLE)
                    AND porcentaje_concentracion_top_2_meses >= CAST(0.55 AS DOUBLE) AND monthly_peak_recurrence >= 0.5)
                OR (seasonality_index_quarterly >= CAST(1.4 AS DOUBLE)
                    AND porcentaje_concentracion_top_1_trimestre >= CAST(0.45 AS DOUBLE) AND quarterly_peak_recurrence >= 0.5))
                THEN 'Estacional'
            WHEN CV2 >= CAST(0.49 AS DOUBLE) THEN 'Errático'
            WHEN ADI >= CAST(1.32 AS DOUBLE) THEN 'Intermitente' ELSE 'Regular' END AS temporalidad_clase FROM stat""",
    "det": f"""SELECT *, {STAMP}, soon AS flag_pico_proximo, clase = 'Estacional' AS es_estacional, clase = 'Dormido' AS es_dormido,
        clase = 'Intermitente' AS es_intermitente, clase = 'Errático' AS es_erratico,
        clase = 'Estacional' AND rotacion_final_ytd IN ('C', 'D', 'Sin rotación, recién llegado') AS warning_rotacion_baja_pero_estacional,
        dormida AS warning_stock_dormido_real, dormida AS warning_stock_inmovilizado_sin_salida_reciente,
        (soon AND clase IN ('Estacional', 'Intermitente', 'Dormido'))
            OR ((rotacion_final_ytd ILIKE '%recién llegado%' OR rotacion_final_30d ILIKE '%recién llegado%')
                AND coalesce(dias_desde_ultima_cr, 9999) <= 30) AS warning_posible_reactivacion_proxima
        FROM (SELECT c.* EXCLUDE (snapshot_date, generated_at), p.* EXCLUDE (article_key), temporalidad_clase AS clase,
            coalesce(months_to_next_peak, 99) <= 2 AS soon,
            temporalidad_clase = 'Dormido' AND stock_actual_total > 0 AND inactivo_90d = 'Sí' AS dormida
            FROM cur_a c JOIN pat p USING (article_key))""",
    "act": f"""SELECT *, CASE
        WHEN clase IN ('Nuevo / sin histórico suficiente', 'Errático') THEN '{ACTION_REVIEW}'
        WHEN NOT es_estacional AND baja_ytd AND baja_30d AND inactivo_90d = 'Sí' AND recurrencia_estacional < CAST(0.4 AS DOUBLE)
            AND (flag_stock_alto_vs_uso_reciente = 'Sí' OR coalesce(indice_stock_vs_lineas_salida_30d, 0) >= 12) THEN '{ACTION_SECONDARY}'
        WHEN es_estacional AND baja_ytd AND baja_30d AND NOT soon THEN '{ACTION_OFF_SEASON}'
        WHEN rotacion_final_30d IN ('A', 'B') OR rotacion_final_ytd IN ('A', 'B') OR soon OR warning_posible_reactivacion_proxima
            THEN '{ACTION_KEEP}'
        ELSE '{ACTION_REVIEW}' END AS accion_recomendada,
        CASE WHEN es_estacional OR warning_rotacion_baja_pero_estacional OR rotacion_final_30d IN ('A', 'B') OR clase = 'Regular'
            OR warning_posible_reactivacion_proxima THEN 'Alto' WHEN es_dormido AND NOT soon THEN 'Bajo' ELSE 'Medio' END AS riesgo_mover_almacen
        FROM (SELECT *, rotacion_final_ytd IN ('C', 'D', 'Sin rotación, recién llegado') AS baja_ytd,
            rotacion_final_30d IN ('C', 'D', 'Sin rotación 30d, recién llegado') AS baja_30d FROM det)""",
    "dec": f"""SELECT *, total_lineas_pi_historico AS lineas_pi_historico,
        CASE accion_recomendada WHEN '{ACTION_KEEP}' THEN '{CODE_KEEP}' WHEN '{ACTION_SECONDARY}' THEN '{CODE_SECONDARY}'
            WHEN '{ACTION_OFF_SEASON}' THEN '{CODE_OFF_SEASON}' ELSE '{CODE_REVIEW}' END AS accion_recomendada_codigo,
        CASE accion_recomendada WHEN '{ACTION_KEEP}' THEN '{REASON_KEEP}' WHEN '{ACTION_SECONDARY}' THEN '{REASON_SECONDARY}'
            WHEN '{ACTION_OFF_SEASON}' THEN '{REASON_OFF_SEASON}' ELSE '{REASON_REVIEW}' END AS motivo_recomendacion,
        CASE accion_recomendada WHEN '{ACTION_KEEP}' THEN '{WINDOW_KEEP}' WHEN '{ACTION_SECONDARY}' THEN '{WINDOW_SECONDARY}'
            WHEN '{ACTION_OFF_SEASON}' THEN CASE WHEN coalesce(peak_period_upcoming, next_peak_quarter) IS NULL
                THEN 'Fuera de temporada; revisar antes del siguiente pico'
                ELSE '{WINDOW_OFF_SEASON}' || coalesce(peak_period_upcoming, next_peak_quarter) END
            ELSE '{WINDOW_REVIEW}' END AS ventana_reubicacion_recomendada,
        CASE riesgo_mover_almacen WHEN 'Alto' THEN 'Alta' WHEN 'Bajo' THEN 'Baja' ELSE 'Media' END AS prioridad_revision,
        accion_recomendada = '{ACTION_SECONDARY}' AS es_candidato_mover,
        accion_recomendada = '{ACTION_OFF_SEASON}' AS es_candidato_mover_fuera_temporada,
        accion_recomendada = '{ACTION_KEEP}' AS es_candidato_mantener FROM act""",
}

PICOS = "array_to_string([CAST(n AS VARCHAR) for n in {c}], ',') AS picos"
RANK = "pct AS porcentaje_lineas_pi_ytd, acum AS porcentaje_acumulado_pi_ytd, abc AS rotacion"
QRANK = """lineas_pi AS lineas_pi_trimestre, cantidad_pi AS cantidad_pi_trimestre, abc AS rotacion_abc_trimestre,
    pct AS porcentaje_lineas_pi_trimestre, acum AS porcentaje_acumulado_pi_trimestre"""
CLASSES = {"A": "A", "B": "B", "C": "C", "D": "D"}


def _kpi_abc() -> str:
    ytd = CLASSES | {"recien_llegado": "Sin rotación, recién llegado"}
    rolling = CLASSES | {"recien_llegado": "Sin rotación 30d, recién llegado"}
    cells = [f"count(*) FILTER (WHERE rotacion_final_ytd = '{v}') AS referencias_{k}_ytd" for k, v in ytd.items()]
    cells += [
        f"coalesce(sum(stock_actual_total) FILTER (WHERE rotacion_final_ytd = '{v}'), 0) AS stock_{k}_ytd"
        for k, v in ytd.items()
    ]
    cells += [f"count(*) FILTER (WHERE rotacion_final_30d = '{v}') AS referencias_{k}_30d" for k, v in rolling.items()]
    cells += [
        f"count(*) FILTER (WHERE {f} = 'Sí') AS articulos_{f}"
        for f in ("flag_sobrestock", "flag_stock_alto_vs_uso_reciente", "flag_reubicar")
    ]
    return f"""SELECT {STAMP}, (SELECT count(*) FROM cur_o) AS total_referencias_owner_article,
        (SELECT sum(stock_actual) FROM cur_o) AS stock_total_owner_article, count(*) AS total_referencias_articulo,
        sum(stock_actual_total) AS stock_total_articulo, {', '.join(cells)},
        (SELECT max(year(trimestre) || 'Q' || quarter(trimestre)) FROM uni_a) AS ultimo_trimestre_disponible FROM cur_a"""


def _kpi_temporality() -> str:
    patterns = {
        "regulares": "Regular",
        "estacionales": "Estacional",
        "intermitentes": "Intermitente",
        "dormidos": "Dormido",
        "erraticos": "Errático",
        "nuevos_sin_historico_suficiente": "Nuevo / sin histórico suficiente",
    }
    cells = [f"count(*) FILTER (WHERE clase = '{v}') AS numero_articulos_{k}" for k, v in patterns.items()]
    flags = {
        "candidatos_mover": "es_candidato_mover",
        "candidatos_mantener": "es_candidato_mantener",
        "candidatos_mover_fuera_temporada": "es_candidato_mover_fuera_temporada",
        "revisar_manualmente": f"accion_recomendada = '{ACTION_REVIEW}'",
        "pico_proximo": "soon",
        "posible_reactivacion_proxima": "warning_posible_reactivacion_proxima",
    }
    cells += [f"count(*) FILTER (WHERE {v}) AS numero_{k}" for k, v in flags.items()]
    return f"SELECT {STAMP}, {', '.join(cells)} FROM dec"


def _cells(body: str, columns: list[str], path: str = "''") -> str:
    """A row for each of the columns of each row: path, and the value as text or number."""
    cells = []
    for name in columns:
        number = kind_of(name) in ("int", "bigint", "double")
        text, size = ("NULL::VARCHAR", f"{name}::DOUBLE") if number else (f"{name}::VARCHAR", "NULL::DOUBLE")
        cells.append(f"{{'ruta': {path} || '{name}', 'texto': {text}, 'numero': {size}}}")
    return f"SELECT unnest([{', '.join(cells)}], recursive := true) FROM ({body}) AS one"


def _list(name: str, body: str, columns: str) -> str:
    return _cells(body, columns.split(), f"'{name}[' || (puesto - 1) || '].'")


def _counts(name: str, column: str, source: str) -> str:
    return f"SELECT '{name}.' || {column}, NULL, count(*)::DOUBLE FROM {source} GROUP BY {column}"


def _values(name: str, column: str, source: str) -> str:
    return f"""SELECT '{name}[' || (row_number() OVER (ORDER BY v) - 1) || ']', v, NULL
        FROM (SELECT DISTINCT {column} AS v FROM {source} WHERE {column} IS NOT NULL)"""


RESULTS: dict[str, str] = {
    "movements_clean": "SELECT * FROM mov",
    "stock_occupied": "SELECT * FROM occ",
    "latest_snapshot": "SELECT * FROM occ WHERE snapshot_date = (SELECT max(snapshot_date) FROM stock_raw)",
    "snapshot_date_from_name": """SELECT nombre, TRY_CAST(regexp_replace(regexp_extract(nombre, '[0-9]{2}-[0-9]{2}-[0-9]{4}'),
        '([0-9]{2})-([0-9]{2})-([0-9]{4})', '\\3-\\2-\\1') AS DATE) AS fecha_foto
        FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d-%m-%Y') || '.xlsx'
            WHEN 1 THEN 'stock ' || strftime(o_orderdate, '%d-%m-%Y') || ' v2.xlsx'
            WHEN 2 THEN '31-02-' || year(o_orderdate) || '.xlsx' ELSE 'movimientos.xlsx' END AS nombre FROM orders)""",
    "filter_movement_type": "SELECT * FROM mov WHERE tipo_movimiento IN ('PI', 'CR')",
    "pi_window_30d": f"SELECT * FROM mov WHERE tipo_movimiento = 'PI' AND CAST(fecha_movimiento AS DATE) BETWEEN {ROLLING} AND {DAY}",
    "pi_window_ytd": f"SELECT * FROM mov WHERE tipo_movimiento = 'PI' AND CAST(fecha_movimiento AS DATE) BETWEEN {YEAR} AND {DAY}",
    "normalize_keys": f"""SELECT articulo, {key('articulo')} AS article_key FROM (SELECT CASE l_linenumber
        WHEN 1 THEN '  0' || l_partkey || chr(9) WHEN 2 THEN l_partkey || '.0'
        WHEN 3 THEN CASE WHEN l_partkey % 2 = 0 THEN 'NaN' ELSE ' nan ' END WHEN 4 THEN '   '
        WHEN 5 THEN 'A' || l_partkey || '.0' WHEN 6 THEN l_partkey || '.00' END AS articulo FROM lineitem)""",
    "parse_dates": """SELECT CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%d/%m/%Y')
        WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y %H:%M:%S') WHEN 3 THEN strftime(l_shipdate, '%Y-%m-%d')
        WHEN 4 THEN '31/02/' || year(l_shipdate) WHEN 5 THEN CASE l_orderkey % 4 WHEN 0 THEN 'sin fecha'
            WHEN 1 THEN strftime(l_shipdate, '%-d/%-m/%Y') WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y %H:%M')
            ELSE strftime(l_shipdate, '%d/%m/%Y 8:05:09') END END AS texto,
        CASE WHEN l_linenumber = 1 THEN date_trunc('day', l_shipdate) WHEN l_linenumber = 2 THEN date_trunc('second', l_shipdate)
        WHEN l_linenumber = 5 THEN CASE l_orderkey % 4 WHEN 1 THEN date_trunc('day', l_shipdate)
            WHEN 2 THEN date_trunc('minute', l_shipdate)
            WHEN 3 THEN date_trunc('day', l_shipdate) + INTERVAL 8 HOUR + INTERVAL 5 MINUTE + INTERVAL 9 SECOND END
        END AS fecha_movimiento FROM lineitem""",
    "coerce_quantities": """SELECT texto, CASE WHEN regexp_matches(texto, '[A-Za-z]') THEN 0
        ELSE coalesce(TRY_CAST(texto AS DOUBLE), 0) END AS cantidad FROM (SELECT CASE l_linenumber
        WHEN 1 THEN n WHEN 2 THEN n || '.5' WHEN 3 THEN '-' || n WHEN 4 THEN n || ' uds' WHEN 5 THEN
            CASE l_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN n || 'd' WHEN 2 THEN n || 'F' ELSE '0x' || n || 'p3' END END AS texto
        FROM (SELECT l_linenumber, l_orderkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS n FROM lineitem))""",
    "days_since_last": f"""SELECT article_key, {days("max(fecha_movimiento) FILTER (WHERE tipo_movimiento = 'PI')")} AS dias_desde_ultima_pi_historica,
        {days("max(fecha_movimiento) FILTER (WHERE tipo_movimiento = 'CR')")} AS dias_desde_ultima_cr FROM mov GROUP BY article_key""",
    "month_labels": f"""SELECT article_key, array_to_string([{NAMES}[n] for n in m], ', ') AS meses,
        array_to_string(['Q' || n for n in q], ', ') AS trimestres, {NAMES}[m[1]] AS primer_mes, 'Q' || q[1] AS primer_trimestre
        FROM (SELECT article_key, list_sort(list(DISTINCT month(fecha_movimiento))) AS m,
            list_sort(list(DISTINCT quarter(fecha_movimiento))) AS q FROM mov GROUP BY article_key)""",
    "daily_activity": f"""SELECT owner_key, article_key, tipo_movimiento AS tipo, {filled('descripcion_movimiento')} AS texto,
        count(*) AS lineas, sum(cantidad_movimiento) AS cantidad, min(fecha_movimiento) AS primera,
        max(fecha_movimiento) AS ultima, min(row_no) AS fila FROM mov
        GROUP BY owner_key, article_key, tipo_movimiento, CAST(fecha_movimiento AS DATE), {filled('descripcion_movimiento')}""",
    "pi_metrics_article": "SELECT * FROM ytd_a",
    "pi_metrics_owner_article": "SELECT * FROM ytd_o",
    "cr_metrics_article": "SELECT * FROM cr_a",
    "cr_metrics_owner_article": "SELECT * FROM cr_o",
    "cr_as_of": cr(OWNER, AS_OF),
    "last_pi_article": "SELECT * FROM last_a",
    "last_pi_owner_article": "SELECT * FROM last_o",
    "first_description": f"SELECT article_key, {first_text('descripcion_movimiento')} AS descripcion_movimiento FROM mov GROUP BY 1",
    "active_keys": f"""SELECT DISTINCT owner_key, article_key FROM mov WHERE tipo_movimiento IN ('PI', 'CR')
        AND fecha_movimiento < {AS_OF}""",
    "stock_owner_article": "SELECT * FROM sto",
    "stock_article": "SELECT * FROM sta",
    "owner_dim": "SELECT * FROM dim_o",
    "article_dim": "SELECT * FROM dim_a",
    "stock_thresholds": "SELECT * FROM lim_a",
    "stock_thresholds_owner_article": "SELECT * FROM lim_o",
    "pi_by_quarter": "SELECT * FROM q_act",
    "pareto_article_ytd": f"SELECT *, {RANK} FROM ytd_a_abc",
    "pareto_article_30d": f"SELECT *, {RANK} FROM r30_a_abc",
    "pareto_owner_article_ytd": f"SELECT *, {RANK} FROM ytd_o_abc",
    "pareto_owner_article_30d": f"SELECT *, {RANK} FROM r30_o_abc",
    "pareto_article_quarter": f"SELECT article_key, trimestre, {QRANK} FROM qpi_a_abc",
    "pareto_owner_article_quarter": f"SELECT owner_key, article_key, trimestre, {QRANK} FROM qpi_o_abc",
    "rotation_article_ytd": "SELECT * FROM rot_a",
    "rotation_owner_article_ytd": "SELECT * FROM rot_o",
    "current_article": "SELECT * FROM cur_a",
    "current_owner_article": "SELECT * FROM cur_o",
    "stock_flags_article": "SELECT * FROM cur_a",
    "stock_flags_owner_article": "SELECT * FROM cur_o",
    "coverage_article": "SELECT * FROM cur_a",
    "inactivity_article": "SELECT * FROM cur_a",
    "recent_arrival_flag": """SELECT *, rotacion_final_ytd ILIKE '%recién llegado%' OR rotacion_final_30d ILIKE '%recién llegado%'
        AS es_recien_llegado FROM cur_a""",
    "detail_30d_article": "SELECT * REPLACE (coalesce(descripcion_stock, descripcion_pi_30d) AS descripcion) FROM cur_a",
    "detail_30d_owner_article": "SELECT * REPLACE (coalesce(descripcion_stock, descripcion_pi_30d) AS descripcion) FROM cur_o",
    "quarter_universe_article": """SELECT *, year(trimestre) AS year, quarter(trimestre) AS quarter,
        year(trimestre) || 'Q' || quarter(trimestre) AS period_label FROM uni_a""",
    "quarter_universe_owner_article": """SELECT *, year(trimestre) AS year, quarter(trimestre) AS quarter,
        year(trimestre) || 'Q' || quarter(trimestre) AS period_label FROM uni_o""",
    "cr_as_of_quarter": f"""SELECT k.owner_key, k.article_key, k.trimestre, count(*) AS lineas_cr_historico,
        sum(m.cantidad_movimiento) AS cantidad_cr_historico, max(m.fecha_movimiento) AS ultima_cr
        FROM (SELECT DISTINCT owner_key, article_key, CAST(date_trunc('quarter', fecha_movimiento) AS DATE) AS trimestre FROM mov
            WHERE tipo_movimiento IN ('PI', 'CR') UNION SELECT owner_key, article_key, {QUARTER} FROM sto) k
        JOIN mov m ON {on('k', 'm', OWNER)} AND m.tipo_movimiento = 'CR' AND m.fecha_movimiento < k.trimestre + INTERVAL 3 MONTH
        GROUP BY ALL""",
    "owner_quarterly": "SELECT * FROM qua_o",
    "article_quarterly": "SELECT * FROM qua_a",
    "quarterly_changes": "SELECT * FROM changes",
    "class_ranks": f"""SELECT rotacion_final_trimestre, CASE rotacion_final_trimestre WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2
        ELSE 1 END AS rango, {ORDER.format(c='rotacion_final_trimestre')} AS orden, count(*) AS articulos FROM qua_a GROUP BY ALL""",
    "monthly_actual": "SELECT * FROM m_act",
    "quarterly_actual": "SELECT * FROM q_act",
    "monthly_dense": "SELECT *, article_key AS articulo, strftime(mes, '%Y-%m') AS period_label FROM m_full",
    "quarterly_dense": "SELECT *, article_key AS articulo, year || 'Q' || quarter AS period_label FROM q_full",
    "pi_history": "SELECT * FROM hist",
    "activity_counts": "SELECT * FROM hist",
    "monthly_stats": "SELECT * FROM m_agg",
    "quarterly_stats": "SELECT * FROM q_agg",
    "month_profile": "SELECT * FROM m_prof",
    "quarter_profile": "SELECT * FROM q_prof",
    "peak_period": "SELECT * FROM stat",
    "concentration": "SELECT * FROM stat",
    "seasonality_index": "SELECT * FROM stat",
    "peak_months": f"SELECT article_key, {PICOS.format(c='picos')}, monthly_peak_recurrence FROM stat",
    "peak_quarters": f"SELECT article_key, {PICOS.format(c='picos_q')}, quarterly_peak_recurrence FROM stat",
    "cv2": "SELECT * FROM stat",
    "adi": "SELECT * FROM stat",
    "next_peak": f"""SELECT article_key, {PICOS.format(c='picos')}, peak_period_upcoming, months_to_next_peak, next_peak_quarter,
        quarters_to_next_peak FROM pat""",
    "demand_pattern": "SELECT * FROM pat",
    "temporality_article": "SELECT * FROM det",
    "temporality_monthly": f"""SELECT f.*, {STAMP}, article_key AS articulo, article_key AS id_article, s.descripcion_stock AS descripcion,
        strftime(mes, '%Y-%m') AS period_label, coalesce({ratio('lineas_pi_mes', 'lineas_media_mensual')}, 0) AS indice_vs_media,
        list_contains(picos, month) AS es_mes_pico FROM m_full f JOIN stat USING (article_key) JOIN sta s USING (article_key)""",
    "temporality_quarterly": f"""SELECT f.*, {STAMP}, article_key AS articulo, article_key AS id_article, s.descripcion_stock AS descripcion,
        year || 'Q' || quarter AS period_label,
        coalesce({ratio('lineas_pi_trimestre', 'lineas_pi_trimestre_media')}, 0) AS indice_vs_media,
        list_contains(picos_q, quarter) AS es_trimestre_pico FROM q_full f JOIN stat USING (article_key) JOIN sta s USING (article_key)""",
    "temporality_warnings": "SELECT * FROM det",
    "warehouse_decision": "SELECT * FROM dec",
    "decision_article": "SELECT * FROM dec",
    "summary_current": """SELECT rotacion_final_ytd AS rotacion, count(articulo) AS referencias, sum(stock_actual) AS stock_total,
        sum(lineas_pi_ytd) AS lineas_pi_ytd FROM cur_o GROUP BY 1""",
    "summary_article_ytd": summary("cur_a", "rotacion_final_ytd", "stock_actual_total", "lineas_pi_ytd", "cantidad_pi_ytd"),
    "summary_30d": summary("cur_o", "rotacion_final_30d", "stock_actual", "lineas_pi_30d", "cantidad_pi_30d", "owner-articulo")
    + " UNION ALL "
    + summary("cur_a", "rotacion_final_30d", "stock_actual_total", "lineas_pi_30d", "cantidad_pi_30d", "articulo_unico"),
    "summary_quarterly": summary(
        "qua_o", "rotacion_final_trimestre", "stock_actual_foto", "lineas_pi_trimestre", "cantidad_pi_trimestre",
        "owner-articulo", "period_label", "CASE WHEN owner_key IS NOT NULL THEN articulo END",
    )
    + " UNION ALL "
    + summary(
        "qua_a", "rotacion_final_trimestre", "stock_actual_total_foto", "lineas_pi_trimestre", "cantidad_pi_trimestre",
        "articulo_unico", "period_label",
    ),
    "top10_ytd": top("cur_a", "lineas_pi_ytd DESC, cantidad_pi_ytd DESC, stock_actual_total DESC"),
    "top10_30d": top("cur_a", "lineas_pi_30d DESC, cantidad_pi_30d DESC, stock_actual_total DESC"),
    "top10_seasonal": top("det", "recurrencia_estacional DESC, seasonality_index_quarterly DESC", "clase = 'Estacional'"),
    "top10_dormant": top("dec", "stock_actual_total DESC, lineas_pi_historico", "dormida"),
    "top10_risk": top(
        "dec", "months_to_next_peak ASC NULLS LAST, stock_actual_total DESC", "riesgo_mover_almacen = 'Alto'"
    ),
    "kpi_abc_scalars": _kpi_abc(),
    "kpi_temporality_scalars": _kpi_temporality(),
    "count_by_pattern": "SELECT temporalidad_clase, count(*) AS articulos FROM pat GROUP BY 1",
    "count_by_action": "SELECT accion_recomendada, count(*) AS articulos FROM dec GROUP BY 1",
}
_TOP = "articulo descripcion"
RESULTS["kpi_abc"] = " UNION ALL ".join(
    [
        _cells(RESULTS["kpi_abc_scalars"], QUERIES["kpi_abc_scalars"][0]),
        _list("top_10_articulos_ytd", RESULTS["top10_ytd"], f"{_TOP} lineas_pi_ytd cantidad_pi_ytd rotacion_final_ytd stock_actual_total"),
        _list("top_10_articulos_30d", RESULTS["top10_30d"], f"{_TOP} lineas_pi_30d cantidad_pi_30d rotacion_final_30d stock_actual_total"),
    ]
)
RESULTS["kpi_temporality"] = " UNION ALL ".join(
    [
        _cells(RESULTS["kpi_temporality_scalars"], QUERIES["kpi_temporality_scalars"][0]),
        _counts("conteo_temporalidad_clase", "temporalidad_clase", "pat"),
        _counts("conteo_acciones_recomendadas", "accion_recomendada", "dec"),
        _list("top_estacionales", RESULTS["top10_seasonal"], f"{_TOP} recurrencia_estacional seasonality_index_quarterly peak_period_upcoming"),
        _list("top_dormidos", RESULTS["top10_dormant"], f"{_TOP} stock_actual_total accion_recomendada warning_stock_dormido_real"),
        _list(
            "top_riesgo_mala_decision_si_se_mueven",
            RESULTS["top10_risk"],
            f"{_TOP} riesgo_mover_almacen accion_recomendada peak_period_upcoming months_to_next_peak",
        ),
        _values("proximos_meses_pico_detectados", "peak_period_upcoming", "dec"),
        _values("proximos_trimestres_pico_detectados", "next_peak_quarter", "dec"),
    ]
)


def _needed(text: str) -> list[str]:
    """The steps a statement reads, directly or through other steps, in their order."""
    found: set[str] = set()
    waiting = [text]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        new = [name for name in STEPS if name in words and name not in found]
        found.update(new)
        waiting.extend(STEPS[name] for name in new)
    return [name for name in STEPS if name in found]


def statement(name: str) -> str:
    body = RESULTS[name]
    steps = ", ".join(f"{step} AS ({STEPS[step]})" for step in _needed(body))
    return (f"WITH {steps} " if steps else "") + shaped_sql(body, QUERIES[name][0])


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES if name in RESULTS}
