"""The registered queries: each runs an operator or a plan over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.catalog.contract import shaped
from shelfwise.functions.labels import class_order, class_rank, month_name, month_names, quarter_name, quarter_names
from shelfwise.functions.text import bare_key, is_recent_arrival, normalize_key, number_or_zero
from shelfwise.functions.time import days_since, parse_stamp, within
from shelfwise.operators import metrics
from shelfwise.operators.activity import daily_activity, inbound, line_activity, outbound, quarterly_activity, windowed_activity
from shelfwise.operators.metrics import ARTICLE, OWNER_ARTICLE
from shelfwise.operators.pareto import pareto
from shelfwise.operators.reuse import by_article, keep
from shelfwise.operators.rotation import stock_thresholds
from shelfwise.plans import current, decision, kpis, layouts, quarterly, summaries, temporality
from shelfwise.sources.movements import prepare_movements
from shelfwise.sources.sample import SAMPLE, sample_movements, sample_stock, table
from shelfwise.sources.stock import latest_snapshot, occupied_stock, snapshot_date_from_name
from pyspark.sql.types import StringType

# A day in the past for the operators that take one.
AS_OF = date(2000, 7, 1)


class Inputs:
    """Movements, stock and the tables built on them, each made when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.params = spark, folder, SAMPLE

    @cached_property
    def movements(self) -> DataFrame:
        return prepare_movements(sample_movements(self.spark, self.folder), self.params)

    @cached_property
    def activity(self) -> DataFrame:
        return line_activity(self.movements)

    @cached_property
    def occupied(self) -> DataFrame:
        return occupied_stock(sample_stock(self.spark, self.folder))

    @cached_property
    def owner_stock(self) -> DataFrame:
        return metrics.stock_by_owner_article(self.occupied)

    @cached_property
    def article_stock(self) -> DataFrame:
        return metrics.stock_by_article(self.occupied)

    # Kept inputs of the plans that read them more than once: the log and the snapshot are read once a query.

    @cached_property
    def places(self) -> DataFrame:
        return keep(metrics.stock_places(self.occupied))

    @cached_property
    def owner_held(self) -> DataFrame:
        return keep(metrics.stock_by_owner_article(self.places))

    @cached_property
    def article_held(self) -> DataFrame:
        return keep(metrics.stock_by_article(self.places))

    @cached_property
    def quarter_sums(self) -> DataFrame:
        return keep(quarterly_activity(self.movements))

    @cached_property
    def by_text(self) -> DataFrame:
        return keep(metrics.text_sums(self.activity, self.params))

    @cached_property
    def windows(self) -> DataFrame:
        """Of articles alone, partitioned by them: what is made of it is not shuffled again."""
        return keep(by_article(windowed_activity(self.movements, self.params, ARTICLE)))

    def current_owner(self, shares: bool = False) -> DataFrame:
        return current.current_owner_article(self.by_text, self.owner_held, self.params, shares)

    def current_article(self, shares: bool = False) -> DataFrame:
        return current.current_article(self.by_text, self.article_held, self.params, shares)

    def owner_quarterly(self, shares: bool = False) -> DataFrame:
        sums, held = self.quarter_sums, self.owner_held
        return quarterly.owner_quarterly(sums, held, metrics.owner_dimension(sums, held), self.params, shares)

    def article_quarterly(self, shares: bool = False) -> DataFrame:
        sums, held = self.quarter_sums, self.article_held
        return quarterly.article_quarterly(sums, held, metrics.article_dimension(sums, held), self.params, shares)

    @cached_property
    def monthly(self) -> DataFrame:
        # Read twice by every consumer: for the start of the calendar and for the sums.
        return keep(by_article(temporality.monthly_actual(self.activity)))

    @cached_property
    def profiles(self) -> DataFrame:
        return temporality.with_profiles(self.article_held.select("article_key"), self.monthly, self.params)

    @cached_property
    def statistics(self) -> DataFrame:
        return temporality.with_statistics(self.profiles, self.params)

    @cached_property
    def stock_names(self) -> DataFrame:
        """Stock articles as the calendar tables want them."""
        article = F.col("article_key")
        return self.article_held.select(
            article.alias("id_article"), article.alias("articulo"), article, F.col("descripcion_stock").alias("descripcion")
        )

    @cached_property
    def detail(self) -> DataFrame:
        """Current table and months from one base: the log is summed once."""
        self.monthly = keep(temporality.monthly_actual(self.windows))
        table = current.current_article(self.windows, self.article_held, self.params, shares=False)
        return temporality.temporality_detail(table, self.monthly, self.params)

    @cached_property
    def decided(self) -> DataFrame:
        return decision.with_decision(self.detail, self.params)


QUERIES: dict[str, tuple[list[str], Callable[[Inputs], DataFrame]]] = {}


def query(name: str, columns: str | list[str]):
    """Register a query with its output columns."""
    listed = columns.split() if isinstance(columns, str) else columns

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = (listed, build)
        return build

    return register


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    columns, build = QUERIES[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return shaped(build(Inputs(spark, folder)), columns)

    return run


# --- sources, filters, scalars ---------------------------------------------------------------

MOVEMENT_COLUMNS = (
    "tipo_movimiento fecha_movimiento owner_key article_key descripcion_movimiento cantidad_movimiento "
    "year quarter period_label row_no"
)
STOCK_COLUMNS = "owner_key article_key denominacion_propietario denominacion stock_actual ubicacion row_no"


@query("movements_clean", MOVEMENT_COLUMNS)
def _(i):
    return i.movements


@query("stock_occupied", STOCK_COLUMNS)
def _(i):
    return i.occupied


@query("latest_snapshot", STOCK_COLUMNS)
def _(i):
    return occupied_stock(latest_snapshot(sample_stock(i.spark, i.folder)))


@query("snapshot_date_from_name", "nombre fecha_foto")
def _(i):
    order = table(i.spark, i.folder, "orders")
    day, kind = F.date_format("o_orderdate", "dd-MM-yyyy"), F.col("o_orderkey") % 4
    name = (
        F.when(kind == 0, F.concat(day, F.lit(".xlsx")))
        .when(kind == 1, F.concat(F.lit("stock "), day, F.lit(" v2.xlsx")))
        .when(kind == 2, F.concat(F.lit("31-02-"), F.year("o_orderdate").cast("string"), F.lit(".xlsx")))
        .otherwise(F.lit("movimientos.xlsx"))
    )
    return order.select(name.alias("nombre")).withColumn("fecha_foto", snapshot_date_from_name(F.col("nombre")))


@query("filter_movement_type", MOVEMENT_COLUMNS)
def _(i):
    return i.movements.where(F.col("tipo_movimiento").isin("PI", "CR"))


@query("pi_window_30d", MOVEMENT_COLUMNS)
def _(i):
    p = i.params
    window = within(F.col("fecha_movimiento"), p.rolling_start, p.next_day)
    return i.movements.where((F.col("tipo_movimiento") == "PI") & window)


@query("pi_window_ytd", MOVEMENT_COLUMNS)
def _(i):
    p = i.params
    window = within(F.col("fecha_movimiento"), p.year_start, p.next_day)
    return i.movements.where((F.col("tipo_movimiento") == "PI") & window)


@query("normalize_keys", "articulo article_key")
def _(i):
    line = table(i.spark, i.folder, "lineitem")
    part, number = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    raw = (
        F.when(number == 1, F.concat(F.lit("  0"), part, F.lit("\t")))
        .when(number == 2, F.concat(part, F.lit(".0")))
        .when(number == 3, F.when(F.col("l_partkey") % 2 == 0, "NaN").otherwise(" nan "))
        .when(number == 4, F.lit("   "))
        .when(number == 5, F.concat(F.lit("A"), part, F.lit(".0")))
        .when(number == 6, F.concat(part, F.lit(".00")))
    )
    keyed = line.select(raw.alias("articulo")).withColumn("bare", bare_key(F.col("articulo")))
    return keyed.withColumn("article_key", normalize_key(F.col("bare")))


@query("parse_dates", "texto fecha_movimiento")
def _(i):
    line = table(i.spark, i.folder, "lineitem")
    day, number, order = F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_orderkey") % 4
    raw = (
        F.when(number == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(number == 2, F.date_format(day, "dd/MM/yyyy HH:mm:ss"))
        .when(number == 3, F.date_format(day, "yyyy-MM-dd"))
        .when(number == 4, F.concat(F.lit("31/02/"), F.year(day).cast("string")))
        .when((number == 5) & (order == 0), F.lit("sin fecha"))
        .when((number == 5) & (order == 1), F.date_format(day, "d/M/yyyy"))
        .when((number == 5) & (order == 2), F.date_format(day, "dd/MM/yyyy HH:mm"))
        .when((number == 5) & (order == 3), F.date_format(day, "dd/MM/yyyy '8:05:09'"))
    )
    return line.select(raw.alias("texto")).withColumn("fecha_movimiento", parse_stamp(F.col("texto"), StringType()))


@query("coerce_quantities", "texto cantidad")
def _(i):
    line = table(i.spark, i.folder, "lineitem")
    number, size = F.col("l_linenumber"), F.col("l_quantity").cast("bigint").cast("string")
    order = F.col("l_orderkey") % 4
    raw = (
        F.when(number == 1, size)
        .when(number == 2, F.concat(size, F.lit(".5")))
        .when(number == 3, F.concat(F.lit("-"), size))
        .when(number == 4, F.concat(size, F.lit(" uds")))
        .when((number == 5) & (order == 0), F.lit(""))
        .when((number == 5) & (order == 1), F.concat(size, F.lit("d")))
        .when((number == 5) & (order == 2), F.concat(size, F.lit("F")))
        .when(number == 5, F.concat(F.lit("0x"), size, F.lit("p3")))
    )
    return line.select(raw.alias("texto")).withColumn("cantidad", number_or_zero(F.col("texto")))


@query("days_since_last", "article_key dias_desde_ultima_pi_historica dias_desde_ultima_cr")
def _(i):
    day = F.lit(i.params.snapshot)
    last = i.activity.groupBy("article_key").agg(
        F.max(F.when(outbound(), F.col("ultima"))).alias("pi"), F.max(F.when(inbound(), F.col("ultima"))).alias("cr")
    )
    return last.select(
        "article_key",
        days_since(day, F.col("pi")).alias("dias_desde_ultima_pi_historica"),
        days_since(day, F.col("cr")).alias("dias_desde_ultima_cr"),
    )


@query("month_labels", "article_key meses trimestres primer_mes primer_trimestre")
def _(i):
    sets = i.activity.groupBy("article_key").agg(
        F.array_sort(F.collect_set(F.month("primera"))).alias("m"),
        F.array_sort(F.collect_set(F.quarter("primera"))).alias("q"),
    )
    return sets.select(
        "article_key",
        month_names(F.col("m")).alias("meses"),
        quarter_names(F.col("q")).alias("trimestres"),
        month_name(F.element_at("m", 1)).alias("primer_mes"),
        quarter_name(F.element_at("q", 1)).alias("primer_trimestre"),
    )


# --- aggregates --------------------------------------------------------------------------------


@query("daily_activity", "owner_key article_key tipo texto lineas cantidad primera ultima fila")
def _(i):
    return daily_activity(i.movements)


PI_COLUMNS = "article_key lineas_pi cantidad_pi ultima_pi descripcion_pi"
CR_COLUMNS = "article_key lineas_cr_historico cantidad_cr_historico ultima_cr"


@query("pi_metrics_article", PI_COLUMNS)
def _(i):
    return metrics.pi_metrics(i.activity, ARTICLE, i.params.year_start, i.params.next_day)


@query("pi_metrics_owner_article", "owner_key " + PI_COLUMNS)
def _(i):
    return metrics.pi_metrics(i.activity, OWNER_ARTICLE, i.params.year_start, i.params.next_day)


@query("cr_metrics_article", CR_COLUMNS)
def _(i):
    return metrics.cr_metrics(i.activity, ARTICLE, i.params.next_day)


@query("cr_metrics_owner_article", "owner_key " + CR_COLUMNS)
def _(i):
    return metrics.cr_metrics(i.activity, OWNER_ARTICLE, i.params.next_day)


@query("cr_as_of", "owner_key " + CR_COLUMNS)
def _(i):
    return metrics.cr_metrics(i.activity, OWNER_ARTICLE, AS_OF)


@query("last_pi_article", "article_key ultima_pi_historica")
def _(i):
    return metrics.last_pi(i.activity, ARTICLE, i.params.next_day)


@query("last_pi_owner_article", "owner_key article_key ultima_pi_historica")
def _(i):
    return metrics.last_pi(i.activity, OWNER_ARTICLE, i.params.next_day)


@query("first_description", "article_key descripcion_movimiento")
def _(i):
    return metrics.first_descriptions(i.activity, ARTICLE)


@query("active_keys", "owner_key article_key")
def _(i):
    return metrics.active_keys(i.activity, OWNER_ARTICLE, AS_OF)


@query("stock_owner_article", "owner_key article_key propietario descripcion_stock stock_actual ubicaciones_con_stock")
def _(i):
    return i.owner_stock


@query(
    "stock_article", "article_key descripcion_stock stock_actual_total ubicaciones_con_stock propietarios_distintos"
)
def _(i):
    return i.article_stock


@query("owner_dim", "propietario owner_key article_key articulo descripcion stock_actual ubicaciones_con_stock")
def _(i):
    return metrics.owner_dimension(i.activity, i.owner_stock)


@query(
    "article_dim",
    "article_key articulo descripcion propietarios_distintos stock_actual_total ubicaciones_con_stock",
)
def _(i):
    return metrics.article_dimension(i.activity, i.article_stock)


@query("stock_thresholds", "umbral_stock umbral_ubicaciones umbral_densidad")
def _(i):
    return stock_thresholds(i.article_stock, "stock_actual_total", i.params)


@query("stock_thresholds_owner_article", "umbral_stock umbral_ubicaciones umbral_densidad")
def _(i):
    return stock_thresholds(i.owner_stock, "stock_actual", i.params)


@query("pi_by_quarter", "article_key trimestre lineas_pi_trimestre cantidad_pi_trimestre")
def _(i):
    return i.activity.where(outbound()).groupBy("article_key", F.trunc("primera", "QUARTER").alias("trimestre")).agg(
        F.sum("lineas").alias("lineas_pi_trimestre"), F.sum("cantidad").alias("cantidad_pi_trimestre")
    )


# --- Pareto ------------------------------------------------------------------------------------

RANK_COLUMNS = "rotacion porcentaje_lineas_pi_ytd porcentaje_acumulado_pi_ytd"


def _register_pareto(name: str, keys: list[str], first: str) -> None:
    columns = [*keys, "lineas_pi", "cantidad_pi", *RANK_COLUMNS.split()]

    @query(name, columns)
    def _(i):
        measured = metrics.pi_metrics(i.activity, keys, getattr(i.params, first), i.params.next_day)
        return pareto(measured, i.params, keys, "lineas_pi", "cantidad_pi", *RANK_COLUMNS.split())


_register_pareto("pareto_article_ytd", ARTICLE, "year_start")
_register_pareto("pareto_article_30d", ARTICLE, "rolling_start")
_register_pareto("pareto_owner_article_ytd", OWNER_ARTICLE, "year_start")
_register_pareto("pareto_owner_article_30d", OWNER_ARTICLE, "rolling_start")

QUARTER_RANK = (
    "trimestre lineas_pi_trimestre cantidad_pi_trimestre rotacion_abc_trimestre porcentaje_lineas_pi_trimestre "
    "porcentaje_acumulado_pi_trimestre"
).split()


def _register_quarter_pareto(name: str, keys: list[str], stock: str) -> None:
    @query(name, [*keys, *QUARTER_RANK])
    def _(i):
        quarters = quarterly.quarter_activity(i.activity, getattr(i, stock), keys, i.params)
        ranked = quarterly.ranked_quarters(quarters, keys, i.params)
        return ranked.where(F.col("lineas_pi_trimestre") > 0)


_register_quarter_pareto("pareto_article_quarter", ARTICLE, "article_stock")
_register_quarter_pareto("pareto_owner_article_quarter", OWNER_ARTICLE, "owner_stock")

# --- current -----------------------------------------------------------------------------------


@query(
    "rotation_article_ytd",
    "article_key stock_actual_total lineas_pi_ytd rotacion_abc_ytd rotacion_final_ytd criterio_rotacion_ytd "
    "ultima_cr dias_desde_ultima_pi_ytd",
)
def _(i):
    return current.rotation(i.activity, i.article_stock, current.BY_ARTICLE, i.params, shares=False)


@query(
    "rotation_owner_article_ytd",
    "owner_key article_key stock_actual lineas_pi_ytd rotacion_abc_ytd rotacion_final_ytd criterio_rotacion_ytd "
    "ultima_cr dias_desde_ultima_pi_ytd",
)
def _(i):
    return current.rotation(i.activity, i.owner_stock, current.BY_OWNER, i.params, shares=False)


@query("current_article", layouts.CURRENT_ARTICLE)
def _(i):
    return i.current_article(shares=True)


@query("current_owner_article", layouts.CURRENT_OWNER_ARTICLE)
def _(i):
    return i.current_owner(shares=True)


FLAG_COLUMNS = "stock rotacion_final_ytd flag_sobrestock flag_stock_alto_vs_uso_reciente flag_reubicar"


@query("stock_flags_article", ["article_key", "stock_actual_total", *FLAG_COLUMNS.split()[1:]])
def _(i):
    return i.current_article()


@query("stock_flags_owner_article", ["owner_key", "article_key", "stock_actual", *FLAG_COLUMNS.split()[1:]])
def _(i):
    return i.current_owner()


@query(
    "coverage_article",
    "article_key stock_actual_total ubicaciones_con_stock cobertura_lineas_30d cobertura_cantidad_30d "
    "indice_stock_vs_lineas_salida_30d indice_stock_vs_cantidad_salida_30d dispersion_stock densidad_stock",
)
def _(i):
    return i.current_article()


@query("inactivity_article", "article_key inactivo_30d inactivo_90d")
def _(i):
    return current.inactivity(i.activity, i.article_stock, current.BY_ARTICLE, i.params)


@query("recent_arrival_flag", "article_key rotacion_final_ytd rotacion_final_30d es_recien_llegado")
def _(i):
    recent = is_recent_arrival(F.col("rotacion_final_ytd")) | is_recent_arrival(F.col("rotacion_final_30d"))
    return i.current_article().withColumn("es_recien_llegado", recent)


@query("detail_30d_article", " ".join(layouts.ROLLING_ARTICLE))
def _(i):
    rolling = current.rotation(i.activity, i.article_stock, current.BY_ARTICLE, i.params, horizons=("30d",))
    return current.rolling_detail(rolling, current.BY_ARTICLE)


@query("detail_30d_owner_article", " ".join(layouts.ROLLING_OWNER_ARTICLE))
def _(i):
    rolling = current.rotation(i.activity, i.owner_stock, current.BY_OWNER, i.params, horizons=("30d",))
    return current.rolling_detail(rolling, current.BY_OWNER)


# --- quarterly ---------------------------------------------------------------------------------

UNIVERSE = "trimestre year quarter period_label"


@query("quarter_universe_article", "article_key " + UNIVERSE)
def _(i):
    return quarterly.quarter_universe(i.activity, i.article_stock, ARTICLE, i.params)


@query("quarter_universe_owner_article", "owner_key article_key " + UNIVERSE)
def _(i):
    return quarterly.quarter_universe(i.activity, i.owner_stock, OWNER_ARTICLE, i.params)


@query("cr_as_of_quarter", "owner_key article_key trimestre lineas_cr_historico cantidad_cr_historico ultima_cr")
def _(i):
    quarters = quarterly.quarter_activity(i.activity, i.owner_stock, OWNER_ARTICLE, i.params)
    return quarterly.inbound_so_far(quarters, OWNER_ARTICLE).where(F.col("lineas_cr_historico") > 0)


@query("owner_quarterly", layouts.OWNER_QUARTERLY)
def _(i):
    return i.owner_quarterly(shares=True)


@query("article_quarterly", layouts.ARTICLE_QUARTERLY)
def _(i):
    return i.article_quarterly(shares=True)


@query("quarterly_changes", layouts.QUARTERLY_CHANGES)
def _(i):
    return quarterly.quarterly_changes(i.article_quarterly())


@query("class_ranks", "rotacion_final_trimestre rango orden articulos")
def _(i):
    rotation = F.col("rotacion_final_trimestre")
    return (
        i.article_quarterly().groupBy(rotation)
        .agg(F.count("*").alias("articulos"))
        .withColumns({"rango": class_rank(rotation), "orden": class_order(rotation)})
    )


# --- temporality -------------------------------------------------------------------------------


@query("monthly_actual", "article_key mes lineas_pi_mes cantidad_pi_mes")
def _(i):
    return temporality.monthly_actual(i.activity)


@query("quarterly_actual", "article_key trimestre lineas_pi_trimestre cantidad_pi_trimestre")
def _(i):
    return temporality.quarterly_actual(temporality.monthly_actual(i.activity))


@query("monthly_dense", "articulo year month period_label lineas_pi_mes cantidad_pi_mes")
def _(i):
    return temporality.monthly_dense(i.stock_names, i.monthly, i.params)


@query("quarterly_dense", "articulo year quarter period_label lineas_pi_trimestre cantidad_pi_trimestre")
def _(i):
    return temporality.quarterly_dense(i.stock_names, i.monthly, i.params)


@query(
    "pi_history",
    "article_key first_pi_date last_pi_date years_with_activity total_lineas_pi_historico "
    "total_cantidad_pi_historico",
)
def _(i):
    history = temporality.article_history(i.monthly)
    return history.withColumnsRenamed(
        {"lineas_mes": "total_lineas_pi_historico", "cantidad_mes": "total_cantidad_pi_historico"}
    )


@query("activity_counts", "article_key total_months_with_pi total_quarters_with_pi")
def _(i):
    history = temporality.article_history(i.monthly)
    return history.withColumnsRenamed(
        {"activos_mes": "total_months_with_pi", "activos_trimestre": "total_quarters_with_pi"}
    )


@query("monthly_stats", "article_key lineas_media_mensual cantidad_media_mensual lineas_max_mes cantidad_max_mes")
def _(i):
    return i.statistics


@query("quarterly_stats", "article_key lineas_pi_trimestre_media cantidad_pi_trimestre_media")
def _(i):
    return i.statistics


def _profile_rows(i, period: str, number: str) -> DataFrame:
    rows = i.profiles.select("article_key", F.explode(f"perfil_{period}").alias("p"))
    return rows.select(
        "article_key",
        F.col("p.n").alias(number),
        F.col("p.lineas_media").alias(f"lineas_{period}_media"),
        F.col("p.cantidad_media").alias(f"cantidad_{period}_media"),
        F.col("p.lineas_total").alias(f"lineas_{period}_total"),
        F.col("p.cantidad_total").alias(f"cantidad_{period}_total"),
        F.col("p.activos").alias(f"years_activo_{period}"),
    )


@query(
    "month_profile",
    "article_key month lineas_mes_media cantidad_mes_media lineas_mes_total cantidad_mes_total years_activo_mes",
)
def _(i):
    return _profile_rows(i, "mes", "month")


@query(
    "quarter_profile",
    "article_key quarter lineas_trimestre_media cantidad_trimestre_media lineas_trimestre_total "
    "cantidad_trimestre_total years_activo_trimestre",
)
def _(i):
    return _profile_rows(i, "trimestre", "quarter")


@query("peak_period", "article_key mes_pico_lineas mes_pico_cantidad quarter_peak")
def _(i):
    return i.statistics.select(
        "article_key",
        month_name(F.col("mes_pico_numero")).alias("mes_pico_lineas"),
        month_name(F.col("mes_pico_cantidad_numero")).alias("mes_pico_cantidad"),
        quarter_name(F.col("trimestre_pico_numero")).alias("quarter_peak"),
    )


@query(
    "concentration",
    "article_key porcentaje_concentracion_top_1_mes porcentaje_concentracion_top_2_meses "
    "porcentaje_concentracion_top_1_trimestre porcentaje_concentracion_top_2_trimestres",
)
def _(i):
    return i.statistics


@query("seasonality_index", "article_key seasonality_index_monthly seasonality_index_quarterly")
def _(i):
    return i.statistics


def _listed(name: str):
    return F.array_join(F.transform(name, lambda n: n.cast("string")), ",")


@query("peak_months", "article_key picos monthly_peak_recurrence")
def _(i):
    return i.statistics.withColumn("picos", _listed("peak_months"))


@query("peak_quarters", "article_key picos quarterly_peak_recurrence")
def _(i):
    return i.statistics.withColumn("picos", _listed("peak_quarters"))


@query("cv2", "article_key CV2")
def _(i):
    return i.statistics


@query("adi", "article_key months_observed ADI")
def _(i):
    return i.statistics


@query(
    "next_peak",
    "article_key picos peak_period_upcoming months_to_next_peak next_peak_quarter quarters_to_next_peak",
)
def _(i):
    return temporality.with_pattern(i.statistics, i.params).withColumn("picos", _listed("peak_months"))


@query("demand_pattern", "article_key temporalidad_clase ADI CV2 recurrencia_estacional")
def _(i):
    return temporality.with_pattern(i.statistics, i.params)


@query("temporality_article", layouts.TEMPORALITY_ARTICLE)
def _(i):
    return temporality.temporality_article(i.detail, i.params)


@query("temporality_monthly", layouts.TEMPORALITY_MONTHLY)
def _(i):
    stats = i.statistics.join(i.stock_names, "article_key")
    return temporality.temporality_monthly(stats, i.monthly, i.params)


@query("temporality_quarterly", layouts.TEMPORALITY_QUARTERLY)
def _(i):
    stats = i.statistics.join(i.stock_names, "article_key")
    return temporality.temporality_quarterly(stats, i.monthly, i.params)


@query(
    "temporality_warnings",
    "article_key temporalidad_clase flag_pico_proximo warning_rotacion_baja_pero_estacional "
    "warning_stock_dormido_real warning_stock_inmovilizado_sin_salida_reciente "
    "warning_posible_reactivacion_proxima",
)
def _(i):
    return i.detail


@query(
    "warehouse_decision",
    "article_key riesgo_mover_almacen accion_recomendada accion_recomendada_codigo motivo_recomendacion "
    "ventana_reubicacion_recomendada prioridad_revision es_candidato_mover es_candidato_mover_fuera_temporada "
    "es_candidato_mantener",
)
def _(i):
    return i.decided


@query("decision_article", layouts.DECISION_ARTICLE)
def _(i):
    return decision.decision_article(i.decided, i.params)


# --- summaries, top lists, documents -------------------------------------------------------------

SUMMARY = "rotacion referencias stock_total lineas_pi cantidad_pi porcentaje_stock porcentaje_referencias"


@query("summary_current", "rotacion referencias stock_total lineas_pi_ytd")
def _(i):
    return summaries.summary_current(i.current_owner())


@query("summary_article_ytd", SUMMARY)
def _(i):
    return summaries.summary_article_ytd(i.current_article())


@query("summary_30d", "analisis " + SUMMARY)
def _(i):
    return summaries.summary_30d(i.current_owner(), i.current_article())


@query("summary_quarterly", "analisis period_label " + SUMMARY)
def _(i):
    return summaries.summary_quarterly(i.owner_quarterly(), i.article_quarterly())


@query(
    "top10_ytd",
    "puesto articulo descripcion lineas_pi_ytd cantidad_pi_ytd rotacion_final_ytd stock_actual_total",
)
def _(i):
    return kpis.top_ytd(i.current_article(), i.params)


@query(
    "top10_30d",
    "puesto articulo descripcion lineas_pi_30d cantidad_pi_30d rotacion_final_30d stock_actual_total",
)
def _(i):
    return kpis.top_30d(i.current_article(), i.params)


@query(
    "top10_seasonal",
    "puesto articulo descripcion recurrencia_estacional seasonality_index_quarterly peak_period_upcoming",
)
def _(i):
    return kpis.top_seasonal(i.detail, i.params)


@query(
    "top10_dormant",
    "puesto articulo descripcion stock_actual_total accion_recomendada warning_stock_dormido_real",
)
def _(i):
    return kpis.top_dormant(i.decided, i.params)


@query(
    "top10_risk",
    "puesto articulo descripcion riesgo_mover_almacen accion_recomendada peak_period_upcoming months_to_next_peak",
)
def _(i):
    return kpis.top_risk(i.decided, i.params)


KPI_ABC = (
    "snapshot_date generated_at total_referencias_owner_article total_referencias_articulo "
    "stock_total_owner_article stock_total_articulo referencias_A_ytd referencias_B_ytd referencias_C_ytd "
    "referencias_D_ytd referencias_recien_llegado_ytd stock_A_ytd stock_B_ytd stock_C_ytd stock_D_ytd "
    "stock_recien_llegado_ytd referencias_A_30d referencias_B_30d referencias_C_30d referencias_D_30d "
    "referencias_recien_llegado_30d articulos_flag_sobrestock articulos_flag_stock_alto_vs_uso_reciente "
    "articulos_flag_reubicar ultimo_trimestre_disponible"
)


def _universe(i) -> DataFrame:
    return quarterly.latest_quarter(i.by_text, i.article_held, i.params)


@query("kpi_abc_scalars", KPI_ABC)
def _(i):
    return kpis.kpi_abc_scalars(i.current_owner(), i.current_article(), _universe(i), i.params)


@query(
    "kpi_temporality_scalars",
    "snapshot_date generated_at numero_articulos_regulares numero_articulos_estacionales "
    "numero_articulos_intermitentes numero_articulos_dormidos numero_articulos_erraticos "
    "numero_articulos_nuevos_sin_historico_suficiente numero_candidatos_mover numero_candidatos_mantener "
    "numero_candidatos_mover_fuera_temporada numero_revisar_manualmente numero_pico_proximo "
    "numero_posible_reactivacion_proxima",
)
def _(i):
    return kpis.temporality_scalars(i.decided, i.params)


@query("count_by_pattern", "temporalidad_clase articulos")
def _(i):
    return kpis.count_by(temporality.with_pattern(i.statistics, i.params), "temporalidad_clase")


@query("count_by_action", "accion_recomendada articulos")
def _(i):
    return kpis.count_by(i.decided, "accion_recomendada")


DOCUMENT = "ruta texto numero"


@query("kpi_abc", DOCUMENT)
def _(i):
    owners, articles = keep(i.current_owner()), keep(i.current_article())
    document = kpis.kpi_abc(owners, articles, _universe(i), i.params)
    return kpis.shredded(kpis.as_json(document), document.schema)


@query("kpi_temporality", DOCUMENT)
def _(i):
    document = kpis.kpi_temporality(keep(i.decided), i.params)
    return kpis.shredded(kpis.as_json(document), document.schema)
