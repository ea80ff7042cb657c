"""Registered queries: profiling, missing values, features and the six climate analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from horavento.functions.temporal import one_hot, temporal_features
from horavento.operators import analysis as A
from horavento.plans.common import READINGS_SQL, READINGS_TS_SQL, register, rounded
from horavento.schemas import TARGETS
from horavento.sources.tables import orders_readings, readings, readings_with_ts


@register("profile", f"""WITH {READINGS_SQL}
SELECT count(*) AS n_registros, CAST(7 AS INTEGER) AS n_colunas,
       count(DISTINCT estacao) AS n_estacoes FROM readings""")
def q_profile(spark, sf):
    return A.profile(readings(spark, sf))


@register("value_counts", f"""WITH {READINGS_SQL}
SELECT estacao, count(*) AS n FROM readings GROUP BY estacao""")
def q_value_counts(spark, sf):
    return A.value_counts(readings(spark, sf), "estacao")


@register("period", f"""WITH {READINGS_TS_SQL}
SELECT estacao, min(ts) AS inicio, max(ts) AS fim,
       CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 86400) AS BIGINT) AS dias
FROM readings_ts GROUP BY estacao""")
def q_period(spark, sf):
    return A.period(readings_with_ts(spark, sf), "ts", by="estacao")


def _missing_sql(by: bool) -> str:
    key = "estacao, " if by else ""
    grp = " GROUP BY estacao" if by else ""
    parts = [f"""SELECT {key}'{c}' AS coluna, CAST(count_if({c} IS NULL) AS BIGINT) AS faltantes,
  round_even(CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 2) AS percentual,
  count(*) AS total FROM readings{grp}""" for c in TARGETS]
    return f"WITH {READINGS_SQL}\n" + "\nUNION ALL\n".join(parts)


@register("missing_report", _missing_sql(False))
def q_missing_report(spark, sf):
    return A.missing_report(readings(spark, sf))


@register("missing_by_station", _missing_sql(True))
def q_missing_by_station(spark, sf):
    return A.missing_report(readings(spark, sf), by="estacao")


@register("temporal_features", f"""WITH {READINGS_TS_SQL}
SELECT id, estacao, data, hora, ts,
  CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes,
  CAST(day(ts) AS INTEGER) AS dia, CAST(dayofyear(ts) AS INTEGER) AS dia_ano,
  CAST(isodow(ts) - 1 AS INTEGER) AS dia_semana,
  round(sin(2 * pi() * hora / 24.0), 6) AS hora_sin, round(cos(2 * pi() * hora / 24.0), 6) AS hora_cos,
  round(sin(2 * pi() * month(ts) / 12.0), 6) AS mes_sin, round(cos(2 * pi() * month(ts) / 12.0), 6) AS mes_cos
FROM readings_ts""")
def q_temporal_features(spark, sf):
    r = readings(spark, sf).select("id", "estacao", "data",
                                   F.format_string("%02d00 UTC", "hora").alias("hora"))
    df = temporal_features(r, "data", "hora")  # parses the raw "HHMM UTC" text (F1)
    return rounded(df.select("id", "estacao", "data", "hora", "ts", "ano", "mes", "dia", "dia_ano",
                             "dia_semana", "hora_sin", "hora_cos", "mes_sin", "mes_cos"))


@register("one_hot_station", f"""WITH {READINGS_SQL}
SELECT id, {", ".join(f"CAST(coalesce(estacao = '{v}', false) AS INTEGER) AS estacao_{v}"
                     for v in ["click", "error", "purchase", "signup", "view"])}
FROM readings""")
def q_one_hot_station(spark, sf):
    df = one_hot(readings(spark, sf).select("id", "estacao"), "estacao")
    return df.drop("estacao")


@register("treatment_metadata", f"""WITH {READINGS_TS_SQL}
SELECT estacao, count(*) AS n_registros, min(ts) AS inicio, max(ts) AS fim,
  CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 86400) AS BIGINT) AS dias,
  CAST(count_if(temperatura IS NULL) AS BIGINT) AS faltantes_temperatura,
  CAST(count_if(umidade IS NULL) AS BIGINT) AS faltantes_umidade,
  CAST(count_if(velocidade_vento IS NULL) AS BIGINT) AS faltantes_velocidade_vento,
  CAST(3 AS INTEGER) AS n_alvos
FROM readings_ts GROUP BY estacao""")
def q_treatment_metadata(spark, sf):
    return A.flatten_treatment_metadata(A.treatment_metadata(readings_with_ts(spark, sf)))


HOURLY_SQL = """hourly AS (SELECT estacao, hora, avg(temperatura) AS temperatura, avg(umidade) AS umidade,
  avg(velocidade_vento) AS velocidade_vento FROM readings GROUP BY estacao, hora)"""


@register("hourly_profile", f"""WITH {READINGS_SQL}, {HOURLY_SQL}
SELECT estacao, hora, round(temperatura, 6) AS temperatura, round(umidade, 6) AS umidade,
  round(velocidade_vento, 6) AS velocidade_vento FROM hourly""")
def q_hourly_profile(spark, sf):
    return rounded(A.hourly_profile(readings(spark, sf)))


@register("extreme_hours", f"""WITH {READINGS_SQL}, {HOURLY_SQL},
hot AS (SELECT estacao, hora, row_number() OVER (PARTITION BY estacao ORDER BY temperatura DESC, hora) AS rn
        FROM hourly WHERE temperatura IS NOT NULL),
dry AS (SELECT estacao, hora, row_number() OVER (PARTITION BY estacao ORDER BY umidade ASC, hora) AS rn
        FROM hourly WHERE umidade IS NOT NULL)
SELECT hot.estacao, hot.hora AS hora_pico_calor, dry.hora AS hora_mais_seca
FROM hot JOIN dry ON hot.estacao = dry.estacao WHERE hot.rn = 1 AND dry.rn = 1""")
def q_extreme_hours(spark, sf):
    return A.extreme_hours(A.hourly_profile(readings(spark, sf)))


@register("six_hour_snapshot", f"""WITH {READINGS_SQL}, {HOURLY_SQL}
SELECT estacao, hora, round(temperatura, 6) AS temperatura, round(umidade, 6) AS umidade,
  round(velocidade_vento, 6) AS velocidade_vento FROM hourly WHERE hora IN (0, 6, 12, 18)""")
def q_six_hour_snapshot(spark, sf):
    return rounded(A.six_hour_snapshot(A.hourly_profile(readings(spark, sf))))


@register("monthly_pivot", "SELECT o_orderstatus AS estacao, " + ", ".join(
    f"round(avg(CASE WHEN month(o_orderdate) = {m} THEN o_totalprice END), 6) AS m{m:02d}"
    for m in range(1, 13)) + " FROM orders GROUP BY o_orderstatus")
def q_monthly_pivot(spark, sf):
    return rounded(A.monthly_pivot(orders_readings(spark, sf)))


@register("five_number", f"""WITH {READINGS_SQL}
SELECT estacao, round(min(temperatura), 6) AS minimo,
  round(quantile_cont(temperatura, 0.25), 6) AS q1, round(quantile_cont(temperatura, 0.5), 6) AS mediana,
  round(quantile_cont(temperatura, 0.75), 6) AS q3, round(max(temperatura), 6) AS maximo
FROM readings WHERE temperatura IS NOT NULL GROUP BY estacao""")
def q_five_number(spark, sf):
    return rounded(A.five_number(readings(spark, sf)))


@register("describe_all", f"WITH {READINGS_SQL}\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS coluna, count({c}) AS contagem, round(avg({c}), 6) AS media,
  round(stddev_samp({c}), 6) AS desvio, round(min({c}), 6) AS minimo,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS maximo FROM readings"""
    for c in TARGETS))
def q_describe_all(spark, sf):
    return rounded(A.describe_all(readings(spark, sf), TARGETS))


@register("temp_humidity_corr", f"""WITH {READINGS_SQL}
SELECT estacao, round(corr(temperatura, umidade), 6) AS correlacao FROM readings GROUP BY estacao""")
def q_temp_humidity_corr(spark, sf):
    return rounded(A.temp_humidity_corr(readings(spark, sf)))


@register("correlation_matrix", f"WITH {READINGS_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS coluna_a, '{b}' AS coluna_b, round(corr({a}, {b}), 6) AS r FROM readings"
    for a in TARGETS for b in TARGETS))
def q_correlation_matrix(spark, sf):
    return rounded(A.correlation_matrix(readings(spark, sf)))


WIND_CASE = """CASE WHEN velocidade_vento < 0.5 THEN 'Calmo' WHEN velocidade_vento < 3.3 THEN 'Brisa Leve'
  WHEN velocidade_vento < 5.5 THEN 'Brisa Moderada' WHEN velocidade_vento >= 5.5 THEN 'Vento Forte'
  ELSE 'Desconhecido' END"""


@register("wind_category", f"""WITH {READINGS_SQL}
SELECT id, velocidade_vento, {WIND_CASE} AS categoria_vento FROM readings""")
def q_wind_category(spark, sf):
    return readings(spark, sf).select("id", "velocidade_vento",
                                      A.wind_category("velocidade_vento").alias("categoria_vento"))


@register("wind_share", f"""WITH {READINGS_SQL}, cat AS (SELECT estacao, {WIND_CASE} AS c FROM readings)
SELECT estacao, """ + ", ".join(
    f"round(CAST(count_if(c = '{name}') AS DOUBLE) * 100.0 / count(*), 6) AS {slug}"
    for name, slug in [("Calmo", "calmo"), ("Brisa Leve", "brisa_leve"),
                       ("Brisa Moderada", "brisa_moderada"), ("Vento Forte", "vento_forte"),
                       ("Desconhecido", "desconhecido")]) + " FROM cat GROUP BY estacao")
def q_wind_share(spark, sf):
    return rounded(A.wind_share(readings(spark, sf)))


@register("risk_hours", f"""WITH {READINGS_SQL}
SELECT estacao, CAST(count_if(umidade < 20) AS BIGINT) AS horas_secura_extrema,
  CAST(count_if(temperatura > 35) AS BIGINT) AS horas_calor_extremo,
  CAST(count_if(velocidade_vento > 5.5) AS BIGINT) AS horas_vento_forte
FROM readings GROUP BY estacao""")
def q_risk_hours(spark, sf):
    return A.risk_hours(readings(spark, sf))
