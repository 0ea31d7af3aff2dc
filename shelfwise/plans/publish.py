"""One run: nine tables, the audit tables and two documents for one snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.activity import daily_activity
from shelfwise.operators.metrics import (
    article_dimension,
    owner_dimension,
    stock_by_article,
    stock_by_owner_article,
    stock_places,
    text_sums,
)
from shelfwise.operators.reuse import release
from shelfwise.operators.staging import stage
from shelfwise.params import Params
from shelfwise.plans import current, decision, kpis, quarterly, summaries, temporality
from shelfwise.plans.common import stamped
from shelfwise.plans.snapshots import in_report_order, recover, replace_snapshot
from shelfwise.sources.movements import prepare_movements
from shelfwise.sources.stock import occupied_stock

# Names of the published tables and documents.
OWNER_CURRENT = "stock_abc_actual_owner_article"
ARTICLE_CURRENT = "stock_abc_actual_article"
OWNER_HISTORY = "stock_abc_historico_trimestral_owner_article"
ARTICLE_HISTORY = "stock_abc_historico_trimestral_article"
CHANGES = "stock_abc_cambios_trimestrales"
TEMPORALITY = "stock_abc_temporalidad_article"
TEMPORALITY_MONTHS = "stock_abc_temporalidad_monthly_article"
TEMPORALITY_QUARTERS = "stock_abc_temporalidad_quarterly_article"
DECISION = "stock_abc_decision_almacen_article"
KPI_ABC = "stock_abc_resumen_kpis"
KPI_TEMPORALITY = "stock_abc_resumen_temporalidad"


@dataclass(frozen=True)
class Target:
    """Where a run writes."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/parquet/{name}"

    def audit(self, name: str) -> str:
        return f"{self.root}/auditoria/{name}"

    def document(self, name: str) -> str:
        return f"{self.root}/json/{name}"


def write_snapshot(frame: DataFrame, path: str, params: Params, order: list[Column] | None = None) -> None:
    """Replace this snapshot's folder, also by no rows, and leave other snapshots alone; stored in ``order``, if given.

    The folder's name holds the snapshot; ``read_table`` puts the column back in its place.
    """
    rows = in_report_order(frame, order) if order else frame
    replace_snapshot(frame.sparkSession, path, params, rows.drop("snapshot_date").write.parquet)


def read_table(like: DataFrame, path: str, params: Params) -> DataFrame:
    """This snapshot of a published table, in its published column order and types."""
    recover(like.sparkSession, path, params)
    whole = like.sparkSession.read.schema(like.schema).parquet(path)
    return whole.where(F.col("snapshot_date") == params.snapshot_text).select(*like.columns)


def write_document(document: DataFrame, path: str, params: Params) -> None:
    """One line of JSON per snapshot."""
    replace_snapshot(document.sparkSession, path, params, kpis.as_json(document).coalesce(1).write.text)


def publish(movements: DataFrame, stock: DataFrame, params: Params, target: Target) -> None:
    """Write everything a run publishes. The log is scanned once, into daily sums."""
    publish_from(daily_activity(prepare_movements(movements, params)), stock, params, target)


def publish_from(daily: DataFrame, stock: DataFrame, params: Params, target: Target) -> None:
    """The same from daily sums, of a log or of a base that grows with it (``incremental``).

    Each published table is written once and read back by the tables built on it.
    """
    activity = stage(daily, "activity")
    by_text = stage(text_sums(activity, params), "texts")
    places = stage(stock_places(occupied_stock(stock)), "places")
    by_owner = stage(stock_by_owner_article(places), "stock_owner")
    by_article = stage(stock_by_article(places), "stock_article")

    def put(name: str, frame: DataFrame, *order: Column) -> DataFrame:
        write_snapshot(frame, target.table(name), params, [*order])
        return read_table(frame, target.table(name), params)

    turned_owner = stage(current.rotation(by_text, by_owner, current.BY_OWNER, params), "turned_owner")
    turned_article = stage(current.rotation(by_text, by_article, current.BY_ARTICLE, params), "turned_article")
    owners = put(
        OWNER_CURRENT, current.current(turned_owner, by_owner, current.BY_OWNER, params), *kpis.report_order("stock_actual", "owner_key")
    )
    articles = put(ARTICLE_CURRENT, current.current(turned_article, by_article, current.BY_ARTICLE, params), *kpis.report_order())

    owner_quarters = put(
        OWNER_HISTORY,
        quarterly.owner_quarterly(activity, by_owner, owner_dimension(activity, by_owner), params),
    )
    article_quarters = put(
        ARTICLE_HISTORY,
        quarterly.article_quarterly(activity, by_article, article_dimension(activity, by_article), params),
    )
    put(CHANGES, quarterly.quarterly_changes(article_quarters))

    monthly = stage(temporality.monthly_actual(activity), "monthly")
    detail = stage(
        decision.with_decision(temporality.temporality_detail(articles, monthly.repartition("article_key"), params), params), "detail"
    )
    put(TEMPORALITY, temporality.temporality_article(detail, params))
    put(TEMPORALITY_MONTHS, temporality.temporality_monthly(detail, monthly, params))
    put(TEMPORALITY_QUARTERS, temporality.temporality_quarterly(detail, monthly, params))
    put(DECISION, decision.decision_article(detail, params))

    audits = {
        "detalle_30d_owner_article": current.rolling_detail(turned_owner, current.BY_OWNER),
        "detalle_30d_article": current.rolling_detail(turned_article, current.BY_ARTICLE),
        "resumen": summaries.in_class_order(summaries.summary_current(owners)),
        "resumen_article": summaries.in_class_order(summaries.summary_article_ytd(articles)),
        "resumen_30d": summaries.in_class_order(summaries.summary_30d(owners, articles), "analisis"),
        "resumen_trimestral": summaries.in_class_order(
            summaries.summary_quarterly(owner_quarters, article_quarters), "analisis", "period_label"
        ),
    }
    for name, frame in audits.items():
        write_snapshot(stamped(frame, params), target.audit(name), params)

    write_document(kpis.kpi_abc(owners, articles, article_quarters, params), target.document(KPI_ABC), params)
    write_document(kpis.kpi_temporality(detail, params), target.document(KPI_TEMPORALITY), params)
    release(daily.sparkSession)
