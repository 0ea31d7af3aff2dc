"""Rotation per calendar quarter and its changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.labels import class_rank
from shelfwise.functions.time import quarter_label, quarter_start
from shelfwise.operators.activity import inbound, outbound
from shelfwise.operators.gaps import expand, with_spans
from shelfwise.operators.metrics import ARTICLE, OWNER_ARTICLE
from shelfwise.operators.pareto import pareto
from shelfwise.operators.rotation import criteria, final_class, recent_arrival
from shelfwise.params import (
    CHANGE_DOWN,
    CHANGE_IDLE,
    CHANGE_NEW,
    CHANGE_SAME,
    CHANGE_UP,
    CRITERIA_QUARTER_ACTIVE,
    CRITERIA_QUARTER_IDLE,
    RECENT_QUARTER,
    Params,
)
from shelfwise.plans.common import stamped, with_ids
from shelfwise.plans.layouts import ARTICLE_QUARTERLY, OWNER_QUARTERLY, QUARTERLY_CHANGES

QUARTER = "trimestre"


def quarter_activity(activity: DataFrame, stock: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """Outbound and inbound sums per key and quarter with any line, plus the stock keys in the
    current quarter.

    An outbound line without an owner gives its key a row, but no line, at owner grain.
    """
    counted = outbound() & F.col("owner_key").isNotNull() if "owner_key" in keys else outbound()
    moved = activity.where(outbound() | inbound()).select(
        *keys,
        quarter_start(F.col("primera")).alias(QUARTER),
        F.when(counted, F.col("lineas")).alias("pi"),
        F.when(counted, F.col("cantidad")).alias("pi_cantidad"),
        F.when(counted, F.col("ultima")).alias("pi_ultima"),
        F.when(inbound(), F.col("lineas")).alias("cr"),
        F.when(inbound(), F.col("cantidad")).alias("cr_cantidad"),
        F.when(inbound(), F.col("ultima")).alias("cr_ultima"),
    )
    stocked = stock.select(*keys, F.lit(params.quarter_start).alias(QUARTER))
    return (
        moved.unionByName(stocked, allowMissingColumns=True)
        .groupBy(*keys, QUARTER)
        .agg(
            F.coalesce(F.sum("pi"), F.lit(0)).alias("lineas_pi_trimestre"),
            F.coalesce(F.sum("pi_cantidad"), F.lit(0.0)).alias("cantidad_pi_trimestre"),
            F.max("pi_ultima").alias("ultima_pi_trimestre"),
            F.coalesce(F.sum("cr"), F.lit(0)).alias("lineas_cr_historico"),
            F.coalesce(F.sum("cr_cantidad"), F.lit(0.0)).alias("cantidad_cr_historico"),
            F.max("cr_ultima").alias("ultima_cr"),
        )
    )


def inbound_so_far(quarters: DataFrame, keys: list[str]) -> DataFrame:
    """Turn inbound sums per quarter into sums and last date up to the end of the quarter."""
    so_far = Window.partitionBy(*keys).orderBy(QUARTER).rowsBetween(Window.unboundedPreceding, 0)
    return quarters.withColumns(
        {
            "lineas_cr_historico": F.sum("lineas_cr_historico").over(so_far),
            "cantidad_cr_historico": F.sum("cantidad_cr_historico").over(so_far),
            "ultima_cr": F.max("ultima_cr").over(so_far),
        }
    )


def quarter_universe(activity: DataFrame, stock: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """Every key in every quarter from its first line on; stock keys in the current quarter."""
    first = (
        activity.where(outbound() | inbound())
        .select(*keys, quarter_start(F.col("primera")).alias(QUARTER))
        .unionByName(stock.select(*keys, F.lit(params.quarter_start).alias(QUARTER)))
        .groupBy(*keys)
        .agg(F.min(QUARTER).alias(QUARTER))
    )
    step = F.expr("INTERVAL 3 MONTH")
    return first.withColumn(
        QUARTER, F.explode(F.sequence(F.col(QUARTER), F.lit(params.quarter_start), step))
    ).withColumns(period_columns())


def period_columns() -> dict:
    return {
        "year": F.year(QUARTER),
        "quarter": F.quarter(QUARTER),
        "period_label": quarter_label(F.col(QUARTER)),
    }


def latest_quarter(activity: DataFrame, stock: DataFrame, params: Params) -> DataFrame:
    """The last quarter of the universe, if there is any: every key reaches the current one."""
    some = activity.select(F.lit(params.quarter_start).alias(QUARTER)).limit(1)
    return some.union(stock.select(F.lit(params.quarter_start)).limit(1)).withColumns(period_columns())


def ranked_quarters(quarters: DataFrame, keys: list[str], params: Params, shares: bool = True) -> DataFrame:
    return pareto(
        quarters,
        params,
        keys,
        "lineas_pi_trimestre",
        "cantidad_pi_trimestre",
        "rotacion_abc_trimestre",
        "porcentaje_lineas_pi_trimestre",
        "porcentaje_acumulado_pi_trimestre" if shares else None,
        partition=[QUARTER],
    )


def quarterly_rotation(
    activity: DataFrame, stock: DataFrame, keys: list[str], params: Params, dimension: DataFrame | None = None, shares: bool = True
) -> DataFrame:
    """All quarters in one query: sums per key and quarter, ranking, running inbound, gaps.

    A key has a row for each quarter with a line and the span of quarters that it stands for. Ranking, windows and the
    join with ``dimension`` see only those; the quarters between are made at the very end. Without ``shares`` the
    cumulative share, and with it the order of all keys, is left out.
    """
    ranked = ranked_quarters(quarter_activity(activity, stock, keys, params), keys, params, shares)
    spans = with_spans(inbound_so_far(ranked, keys), keys, QUARTER, F.lit(params.quarter_start), 3)
    if dimension is not None:
        spans = spans.join(dimension, keys, "left")
    blank = {
        "lineas_pi_trimestre": F.lit(0).cast("bigint"),
        "cantidad_pi_trimestre": F.lit(0.0),
        "porcentaje_lineas_pi_trimestre": F.lit(0.0),
        "porcentaje_acumulado_pi_trimestre": F.lit(0.0),
        "rotacion_abc_trimestre": F.lit("D"),
        "ultima_pi_trimestre": F.lit(None).cast("timestamp_ntz"),
    }
    full = expand(spans, QUARTER, 3, {name: value for name, value in blank.items() if name in spans.columns}).withColumns(period_columns())

    reference = F.least(F.date_add(F.add_months(QUARTER, 3), -1), F.lit(params.snapshot))
    lines = F.col("lineas_pi_trimestre")
    recent = recent_arrival(lines, F.col("ultima_cr"), reference, params)
    final = final_class(F.col("rotacion_abc_trimestre"), lines, recent, RECENT_QUARTER)

    def about(text: str):
        before, after = text.format(q="\0", n=params.recent_days).split("\0")
        return F.concat(F.lit(before), F.col("period_label"), F.lit(after))

    return full.withColumns(
        {
            "rotacion_final_trimestre": final,
            "criterio_rotacion_trimestre": criteria(
                final, recent, about(CRITERIA_QUARTER_ACTIVE), about(CRITERIA_QUARTER_IDLE), params
            ),
        }
    ).withColumnRenamed("ultima_cr", "ultima_cr_hasta_fin_trimestre")


def _published(
    activity: DataFrame, stock: DataFrame, dimension: DataFrame, keys: list[str], amount: str, layout: list[str], params: Params, shares: bool
) -> DataFrame:
    # The dimension holds no key without an owner: such rows find no match and keep null
    # descriptions and stock, which is what they should show.
    named = dimension.drop("articulo").withColumnsRenamed(
        {amount: f"{amount}_foto", "ubicaciones_con_stock": "ubicaciones_con_stock_foto"}
    )
    rotation = quarterly_rotation(activity, stock, keys, params, named, shares)
    table = stamped(with_ids(rotation), params)
    return table.select(*[name for name in layout if name in table.columns])


def owner_quarterly(activity: DataFrame, stock: DataFrame, dimension: DataFrame, params: Params, shares: bool = True) -> DataFrame:
    return _published(activity, stock, dimension, OWNER_ARTICLE, "stock_actual", OWNER_QUARTERLY, params, shares)


def article_quarterly(activity: DataFrame, stock: DataFrame, dimension: DataFrame, params: Params, shares: bool = True) -> DataFrame:
    return _published(activity, stock, dimension, ARTICLE, "stock_actual_total", ARTICLE_QUARTERLY, params, shares)


def quarterly_changes(quarterly: DataFrame) -> DataFrame:
    """Class of each article against its own previous quarter."""
    by_article = Window.partitionBy("article_key").orderBy("year", "quarter")
    before, now = F.col("rotacion_trimestre_anterior"), F.col("rotacion_final_trimestre")
    idle = F.col("lineas_pi_trimestre") == 0
    return (
        quarterly.withColumn("rotacion_trimestre_anterior", F.lag("rotacion_final_trimestre").over(by_article))
        .withColumns(
            {
                "cambio_abc": F.when(before.isNull(), CHANGE_NEW)
                .when(idle, CHANGE_IDLE)
                .otherwise(F.concat(before, F.lit(" -> "), now)),
                "sentido_cambio": F.when(before.isNull(), CHANGE_NEW)
                .when(idle, CHANGE_IDLE)
                .when(class_rank(now) > class_rank(before), CHANGE_UP)
                .when(class_rank(now) < class_rank(before), CHANGE_DOWN)
                .otherwise(CHANGE_SAME),
            }
        )
        .select(*QUARTERLY_CHANGES)
    )
