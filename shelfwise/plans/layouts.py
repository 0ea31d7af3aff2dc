"""Fixed column layouts of the nine published tables (fixed values, in published order)."""

CURRENT_OWNER_ARTICLE = """
snapshot_date generated_at id_owner_article propietario owner_key articulo article_key descripcion
stock_actual ubicaciones_con_stock
lineas_pi_ytd cantidad_pi_ytd porcentaje_lineas_pi_ytd porcentaje_acumulado_pi_ytd
rotacion_abc_ytd rotacion_final_ytd criterio_rotacion_ytd ultima_pi_ytd dias_desde_ultima_pi_ytd
ultima_cr dias_desde_ultima_cr lineas_cr_historico cantidad_cr_historico
lineas_pi_30d cantidad_pi_30d porcentaje_lineas_pi_30d porcentaje_acumulado_pi_30d
rotacion_abc_30d rotacion_final_30d ultima_pi_30d dias_desde_ultima_pi_30d
cobertura_lineas_30d cobertura_cantidad_30d
indice_stock_vs_lineas_salida_30d indice_stock_vs_cantidad_salida_30d
inactivo_30d inactivo_90d dispersion_stock densidad_stock
flag_sobrestock flag_stock_alto_vs_uso_reciente flag_reubicar
""".split()

CURRENT_ARTICLE = """
snapshot_date generated_at id_article articulo article_key descripcion propietarios_distintos
stock_actual_total ubicaciones_con_stock
lineas_pi_ytd cantidad_pi_ytd porcentaje_lineas_pi_ytd porcentaje_acumulado_pi_ytd
rotacion_abc_ytd rotacion_final_ytd criterio_rotacion_ytd ultima_pi_ytd dias_desde_ultima_pi_ytd
ultima_cr dias_desde_ultima_cr lineas_cr_historico cantidad_cr_historico
lineas_pi_30d cantidad_pi_30d porcentaje_lineas_pi_30d porcentaje_acumulado_pi_30d
rotacion_abc_30d rotacion_final_30d ultima_pi_30d dias_desde_ultima_pi_30d
cobertura_lineas_30d cobertura_cantidad_30d
indice_stock_vs_lineas_salida_30d indice_stock_vs_cantidad_salida_30d
inactivo_30d inactivo_90d dispersion_stock densidad_stock
flag_sobrestock flag_stock_alto_vs_uso_reciente flag_reubicar
""".split()

OWNER_QUARTERLY = """
period_label year quarter snapshot_date generated_at
id_owner_article propietario owner_key articulo article_key descripcion
lineas_pi_trimestre cantidad_pi_trimestre
porcentaje_lineas_pi_trimestre porcentaje_acumulado_pi_trimestre
rotacion_abc_trimestre rotacion_final_trimestre criterio_rotacion_trimestre
ultima_pi_trimestre ultima_cr_hasta_fin_trimestre
stock_actual_foto ubicaciones_con_stock_foto
""".split()

ARTICLE_QUARTERLY = """
period_label year quarter snapshot_date generated_at
id_article articulo article_key descripcion propietarios_distintos
lineas_pi_trimestre cantidad_pi_trimestre
porcentaje_lineas_pi_trimestre porcentaje_acumulado_pi_trimestre
rotacion_abc_trimestre rotacion_final_trimestre criterio_rotacion_trimestre
ultima_pi_trimestre ultima_cr_hasta_fin_trimestre
stock_actual_total_foto ubicaciones_con_stock_foto
""".split()

QUARTERLY_CHANGES = """
period_label year quarter snapshot_date generated_at
id_article articulo article_key descripcion
rotacion_trimestre_anterior rotacion_final_trimestre cambio_abc sentido_cambio
lineas_pi_trimestre cantidad_pi_trimestre propietarios_distintos stock_actual_total_foto
""".split()

TEMPORALITY_MONTHLY = """
snapshot_date generated_at id_article articulo article_key descripcion
year month period_label lineas_pi_mes cantidad_pi_mes indice_vs_media es_mes_pico
""".split()

TEMPORALITY_QUARTERLY = """
snapshot_date generated_at id_article articulo article_key descripcion
year quarter period_label lineas_pi_trimestre cantidad_pi_trimestre indice_vs_media es_trimestre_pico
""".split()

TEMPORALITY_ARTICLE = """
snapshot_date generated_at id_article articulo article_key descripcion
first_pi_date last_pi_date years_with_activity total_months_with_pi total_quarters_with_pi
total_lineas_pi_historico total_cantidad_pi_historico
lineas_media_mensual cantidad_media_mensual lineas_max_mes cantidad_max_mes
mes_pico_lineas mes_pico_cantidad
lineas_pi_trimestre_media cantidad_pi_trimestre_media quarter_peak
porcentaje_concentracion_top_trimestre
porcentaje_concentracion_top_1_mes porcentaje_concentracion_top_2_meses
porcentaje_concentracion_top_1_trimestre porcentaje_concentracion_top_2_trimestres
seasonality_index_monthly seasonality_index_quarterly recurrencia_estacional
meses_pico_recurrentes trimestres_pico_recurrentes ADI CV2
temporalidad_clase es_estacional es_dormido es_intermitente es_erratico
peak_period_upcoming months_to_next_peak flag_pico_proximo
warning_rotacion_baja_pero_estacional warning_stock_dormido_real
warning_stock_inmovilizado_sin_salida_reciente warning_posible_reactivacion_proxima
""".split()

DECISION_ARTICLE = """
snapshot_date generated_at id_article articulo article_key descripcion
rotacion_final_ytd rotacion_final_30d stock_actual_total ultima_cr dias_desde_ultima_cr
cobertura_lineas_30d cobertura_cantidad_30d
indice_stock_vs_lineas_salida_30d indice_stock_vs_cantidad_salida_30d
inactivo_30d inactivo_90d flag_sobrestock flag_stock_alto_vs_uso_reciente
lineas_pi_historico years_with_activity temporalidad_clase
seasonality_index_quarterly recurrencia_estacional
riesgo_mover_almacen accion_recomendada accion_recomendada_codigo motivo_recomendacion
ventana_reubicacion_recomendada prioridad_revision
es_estacional es_dormido es_intermitente es_erratico
es_candidato_mover es_candidato_mover_fuera_temporada es_candidato_mantener
peak_period_upcoming months_to_next_peak flag_pico_proximo
warning_rotacion_baja_pero_estacional warning_stock_dormido_real
warning_stock_inmovilizado_sin_salida_reciente warning_posible_reactivacion_proxima
""".split()

# Columns of the 30-day audit tables.
_ROLLING = """
ubicaciones_con_stock lineas_pi_30d cantidad_pi_30d porcentaje_lineas_pi_30d porcentaje_acumulado_pi_30d
rotacion_abc_30d rotacion_final_30d ultima_pi_30d dias_desde_ultima_pi_30d ultima_cr dias_desde_ultima_cr
lineas_cr_historico cantidad_cr_historico
""".split()
ROLLING_OWNER_ARTICLE = ["propietario", "owner_key", "articulo", "descripcion", "stock_actual", *_ROLLING]
ROLLING_ARTICLE = ["articulo", "descripcion", "propietarios_distintos", "stock_actual_total", *_ROLLING]
