"""Run parameters and the fixed values of the published contract."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# Movement and stock codes.
OUTBOUND = "PI"
INBOUND = "CR"
OCCUPIED = "Ocupado"

# yes/no text.
YES = "Sí"
NO = "No"

# Month and quarter names.
MONTHS = [
    "Enero",
    "Febrero",
    "Marzo",
    "Abril",
    "Mayo",
    "Junio",
    "Julio",
    "Agosto",
    "Septiembre",
    "Octubre",
    "Noviembre",
    "Diciembre",
]
QUARTERS = ["Q1", "Q2", "Q3", "Q4"]

# Rotation classes.
RECENT_MARK = "recién llegado"
RECENT_YTD = "Sin rotación, recién llegado"
RECENT_30D = "Sin rotación 30d, recién llegado"
RECENT_QUARTER = "Sin rotación trimestre, recién llegado"

# Criteria texts ({y} year, {q} quarter label, {n} recent days).
CRITERIA_RECENT = "Sin PI y con última entrada CR en los últimos {n} días"
CRITERIA_OWNER_ACTIVE = "Pareto ABC por líneas PI {y}"
CRITERIA_OWNER_IDLE = "Sin líneas PI {y} y sin entrada CR en los últimos {n} días"
CRITERIA_ARTICLE_ACTIVE = "Pareto ABC por líneas PI YTD {y}"
CRITERIA_ARTICLE_IDLE = "Sin líneas PI YTD {y} y sin entrada CR en los últimos {n} días"
CRITERIA_QUARTER_ACTIVE = "Pareto ABC por líneas PI del trimestre {q}"
CRITERIA_QUARTER_IDLE = "Sin líneas PI en {q} y sin entrada CR en los últimos {n} días"

# Quarter-over-quarter change texts.
CHANGE_NEW = "Nuevo"
CHANGE_IDLE = "Sin movimiento"
CHANGE_UP = "Mejora"
CHANGE_DOWN = "Empeora"
CHANGE_SAME = "Se mantiene"

# Demand patterns.
PATTERN_NEW = "Nuevo / sin histórico suficiente"
PATTERN_DORMANT = "Dormido"
PATTERN_SEASONAL = "Estacional"
PATTERN_ERRATIC = "Errático"
PATTERN_INTERMITTENT = "Intermitente"
PATTERN_REGULAR = "Regular"

# Warehouse actions, their codes, reasons and time windows.
ACTION_KEEP = "Conviene mantener accesible"
ACTION_SECONDARY = "Candidato a revisar para almacén secundario"
ACTION_OFF_SEASON = "Candidato a mover fuera de temporada"
ACTION_REVIEW = "Revisar manualmente"
CODE_KEEP = "mantener_accesible"
CODE_SECONDARY = "revisar_almacen_secundario"
CODE_OFF_SEASON = "mover_fuera_temporada"
CODE_REVIEW = "revisar_manualmente"
REASON_KEEP = (
    "Actividad actual relevante, entrada reciente o pico próximo esperado; "
    "conviene mantenerlo accesible para no tensionar la operativa."
)
REASON_SECONDARY = (
    "Baja rotación actual, sin actividad reciente ni patrón estacional fuerte, "
    "con stock alto relativo a salidas recientes; conviene revisar si puede vivir "
    "mejor en almacén secundario."
)
REASON_OFF_SEASON = (
    "SKU estacional con rotación baja fuera de temporada y recurrencia suficiente "
    "para planificar su retorno antes del siguiente pico."
)
REASON_REVIEW = "Patrón ambiguo o poco robusto; conviene contraste manual."
WINDOW_KEEP = "Sin movimiento recomendado por ahora"
WINDOW_SECONDARY = "Revisable en el ciclo actual si no hay restricciones operativas"
WINDOW_OFF_SEASON = "Fuera de temporada; reponer 1-2 meses antes de "
WINDOW_OFF_SEASON_OPEN = "Fuera de temporada; revisar antes del siguiente pico"
WINDOW_REVIEW = "Revisión manual en próximo ciclo mensual"

# Risk and priority.
RISK_HIGH, RISK_MEDIUM, RISK_LOW = "Alto", "Medio", "Bajo"
PRIORITY_HIGH, PRIORITY_MEDIUM, PRIORITY_LOW = "Alta", "Media", "Baja"


@dataclass(frozen=True)
class Params:
    """One run: a snapshot day, its stamp, and every threshold of the rules."""

    snapshot: date
    generated_at: str

    recent_days: int = 14
    rolling_days: int = 30
    inactive_days: tuple[int, int] = (30, 90)

    # Pareto limits in percent of all lines, compared as integers.
    limit_a: int = 80
    limit_b: int = 95

    stock_quantile: float = 0.75
    density_quantile: float = 0.25
    min_locations: int = 4

    peak_month_factor: float = 1.25
    peak_quarter_factor: float = 1.20
    peak_recurrence: float = 0.5
    peak_soon_months: int = 2

    min_months_observed: int = 6
    min_active_months: int = 3
    dormant_days: int = 365
    dormant_max_months: int = 6
    seasonal_years: int = 2
    seasonal_index_month: float = 1.6
    seasonal_top2_months: float = 0.55
    seasonal_index_quarter: float = 1.4
    seasonal_top_quarter: float = 0.45
    erratic_cv2: float = 0.49
    intermittent_adi: float = 1.32

    high_stock_index: float = 12
    low_recurrence: float = 0.4

    top_n: int = 10

    @property
    def snapshot_text(self) -> str:
        return self.snapshot.isoformat()

    @property
    def next_day(self) -> date:
        return self.snapshot + timedelta(days=1)

    @property
    def year_start(self) -> date:
        return date(self.snapshot.year, 1, 1)

    @property
    def rolling_start(self) -> date:
        return self.snapshot - timedelta(days=self.rolling_days - 1)

    @property
    def quarter(self) -> int:
        return (self.snapshot.month - 1) // 3 + 1

    @property
    def month_start(self) -> date:
        return self.snapshot.replace(day=1)

    @property
    def quarter_start(self) -> date:
        return date(self.snapshot.year, 3 * self.quarter - 2, 1)
