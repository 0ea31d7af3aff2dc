"""Output columns and types of the registered queries.

Spark and SQL results are brought to the same names and types; doubles to 10 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

DECIMALS = 10

SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}

# Types by column name; a column has one type wherever it appears. Others are text.
_BY_TYPE = {
    "int": "year quarter month puesto dias_desde_ultima_pi_ytd dias_desde_ultima_pi_30d dias_desde_ultima_cr "
    "dias_desde_ultima_pi_historica mes_numero trimestre_numero rango orden",
    "bigint": "row_no lineas lineas_pi lineas_pi_ytd lineas_pi_30d lineas_pi_trimestre lineas_pi_mes "
    "lineas_cr_historico lineas_pi_historico ubicaciones_con_stock ubicaciones_con_stock_foto dispersion_stock "
    "propietarios_distintos propietarios_movimiento referencias articulos years_with_activity "
    "total_months_with_pi total_quarters_with_pi total_lineas_pi_historico lineas_max_mes months_observed "
    "lineas_mes_total lineas_trimestre_total years_activo_mes years_activo_trimestre meses_calendario fila "
    "total_referencias_owner_article total_referencias_articulo "
    "referencias_A_ytd referencias_B_ytd referencias_C_ytd referencias_D_ytd referencias_recien_llegado_ytd "
    "referencias_A_30d referencias_B_30d referencias_C_30d referencias_D_30d referencias_recien_llegado_30d "
    "articulos_flag_sobrestock articulos_flag_stock_alto_vs_uso_reciente articulos_flag_reubicar "
    "numero_articulos_regulares numero_articulos_estacionales numero_articulos_intermitentes "
    "numero_articulos_dormidos numero_articulos_erraticos numero_articulos_nuevos_sin_historico_suficiente "
    "numero_candidatos_mover numero_candidatos_mantener numero_candidatos_mover_fuera_temporada "
    "numero_revisar_manualmente numero_pico_proximo numero_posible_reactivacion_proxima",
    "double": "cantidad cantidad_movimiento cantidad_pi cantidad_pi_ytd cantidad_pi_30d cantidad_pi_trimestre "
    "cantidad_pi_mes cantidad_cr_historico stock_actual stock_actual_total stock_actual_foto "
    "stock_actual_total_foto stock_total densidad_stock porcentaje_stock porcentaje_referencias "
    "porcentaje_lineas_pi_ytd porcentaje_acumulado_pi_ytd porcentaje_lineas_pi_30d "
    "porcentaje_acumulado_pi_30d porcentaje_lineas_pi_trimestre porcentaje_acumulado_pi_trimestre "
    "cobertura_lineas_30d cobertura_cantidad_30d indice_stock_vs_lineas_salida_30d "
    "indice_stock_vs_cantidad_salida_30d umbral_stock umbral_ubicaciones umbral_densidad "
    "total_cantidad_pi_historico lineas_media_mensual cantidad_media_mensual cantidad_max_mes "
    "lineas_pi_trimestre_media cantidad_pi_trimestre_media porcentaje_concentracion_top_trimestre "
    "porcentaje_concentracion_top_1_mes porcentaje_concentracion_top_2_meses "
    "porcentaje_concentracion_top_1_trimestre porcentaje_concentracion_top_2_trimestres "
    "seasonality_index_monthly seasonality_index_quarterly recurrencia_estacional monthly_peak_recurrence "
    "quarterly_peak_recurrence ADI CV2 months_to_next_peak quarters_to_next_peak indice_vs_media "
    "lineas_mes_media cantidad_mes_media cantidad_mes_total lineas_trimestre_media cantidad_trimestre_media "
    "cantidad_trimestre_total stock_A_ytd stock_B_ytd stock_C_ytd stock_D_ytd stock_recien_llegado_ytd "
    "stock_total_owner_article stock_total_articulo numero",
    "date": "mes trimestre fecha fecha_foto dia",
    "timestamp_ntz": "fecha_movimiento ultima_pi ultima_pi_ytd ultima_pi_30d ultima_pi_trimestre "
    "ultima_pi_historica ultima_cr ultima_cr_hasta_fin_trimestre first_pi_date last_pi_date primera ultima",
    "boolean": "es_mes_pico es_trimestre_pico es_estacional es_dormido es_intermitente es_erratico "
    "flag_pico_proximo warning_rotacion_baja_pero_estacional warning_stock_dormido_real "
    "warning_stock_inmovilizado_sin_salida_reciente warning_posible_reactivacion_proxima "
    "es_candidato_mover es_candidato_mover_fuera_temporada es_candidato_mantener es_recien_llegado",
}
TYPES = {name: kind for kind, names in _BY_TYPE.items() for name in names.split()}


def kind_of(column: str) -> str:
    return TYPES.get(column, "string")


def shaped(frame: DataFrame, columns: list[str]) -> DataFrame:
    """The Spark result in contract form."""

    def cell(name: str) -> str:
        kind = kind_of(name)
        value = f"CAST({name} AS {kind})"
        if kind == "double":
            # Rounding makes a decimal of every number; a whole one, as most are, needs none (and no minus before a 0).
            value = f"CASE WHEN {value} = rint({value}) THEN {value} + 0.0D ELSE round({value}, {DECIMALS}) END"
        return f"{value} AS {name}"

    return frame.selectExpr(*[cell(name) for name in columns])


def shaped_sql(body: str, columns: list[str]) -> str:
    """The select list and source of the SQL result in contract form."""

    def cell(name: str) -> str:
        kind = kind_of(name)
        value = f'CAST("{name}" AS {SQL_TYPES[kind]})'
        return f'round({value}, {DECIMALS}) AS "{name}"' if kind == "double" else f'{value} AS "{name}"'

    return f"SELECT {', '.join(cell(name) for name in columns)} FROM ({body}) AS result"
