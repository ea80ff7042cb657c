"""Registered queries: treated dataset, station selection, model versions,
interaction features and the written outputs (P1, M1, F11, F12, F27, O4, O5,
S13, M9, K1, K2, K4, K7, K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from horavento.functions.temporal import station_slug
from horavento.functions.telemetry import interactions
from horavento.operators import analysis as A
from horavento.operators import filters as P
from horavento.operators import windows as W
from horavento.operators.forecast import prediction_rmse
from horavento.operators.impute import assemble_features
from horavento.plans.common import READINGS_SQL, READINGS_TS_SQL, register, rounded
from horavento.plans.model_queries import PRED_SQL, _pred
from horavento.schemas import TARGETS
from horavento.session import scratch_path
from horavento.sources import sinks as K
from horavento.sources.tables import discover_stations, load_table, readings

STATIONS = ["click", "error", "purchase", "signup", "view"]


@register("treated_dataset", f"""WITH {READINGS_TS_SQL}
SELECT id, data, temperatura, umidade, velocidade_vento,
  CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes, CAST(day(ts) AS INTEGER) AS dia,
  hora, CAST(dayofyear(ts) AS INTEGER) AS dia_ano, CAST(isodow(ts) - 1 AS INTEGER) AS dia_semana,
  round(sin(2 * pi() * hora / 24.0), 6) AS hora_sin, round(cos(2 * pi() * hora / 24.0), 6) AS hora_cos,
  round(sin(2 * pi() * month(ts) / 12.0), 6) AS mes_sin, round(cos(2 * pi() * month(ts) / 12.0), 6) AS mes_cos,
  """ + ", ".join(f"CAST(coalesce(estacao = '{v}', false) AS INTEGER) AS estacao_{v}" for v in STATIONS)
    + " FROM readings_ts")
def q_treated_dataset(spark, sf):
    r = readings(spark, sf)
    df, _ = assemble_features(r, stations=[s.estacao for s in discover_stations(r).collect()])
    return rounded(P.select_final(df))


@register("discover_stations", f"WITH {READINGS_SQL}\nSELECT DISTINCT estacao FROM readings ORDER BY estacao")
def q_discover_stations(spark, sf):
    return discover_stations(readings(spark, sf))


@register("limit_stations", f"""WITH {READINGS_SQL}
SELECT * FROM readings WHERE estacao IN (SELECT DISTINCT estacao FROM readings ORDER BY estacao LIMIT 3)""")
def q_limit_stations(spark, sf):
    return W.limit_stations(readings(spark, sf), 3)


@register("latest_version", """WITH v AS (SELECT event_type AS nome, event_id AS versao, ts AS criado_em,
  value AS metrica FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY nome ORDER BY versao DESC) AS rn FROM v)
SELECT nome, versao, criado_em, metrica FROM r WHERE rn = 1""")
def q_latest_version(spark, sf):
    v = load_table(spark, sf, "events").select(
        F.col("event_type").alias("nome"), F.col("event_id").alias("versao"),
        F.col("ts").alias("criado_em"), F.col("value").alias("metrica"))
    return W.latest_version(v, "nome", "versao")


@register("interactions", f"""WITH {READINGS_SQL}
SELECT id, round(temperatura * umidade, 6) AS temp_x_umid, round(temperatura * velocidade_vento, 6) AS temp_x_vento,
  round(umidade * velocidade_vento, 6) AS umid_x_vento FROM readings""")
def q_interactions(spark, sf):
    return rounded(interactions(readings(spark, sf)).select("id", "temp_x_umid", "temp_x_vento", "umid_x_vento"))


@register("station_slug", """SELECT c_custkey, c_mktsegment || ' ' || c_name AS nome,
  regexp_replace(c_mktsegment || ' ' || c_name || '/' || c_mktsegment, '[ /]', '_', 'g') AS slug FROM customer""")
def q_station_slug(spark, sf):
    """F12 over every customer: display name -> file-safe name."""
    c = load_table(spark, sf, "customer").select(
        "c_custkey", F.concat_ws(" ", "c_mktsegment", "c_name").alias("nome"), "c_mktsegment")
    return c.select("c_custkey", "nome",
                    station_slug(F.concat(F.col("nome"), F.lit("/"), F.col("c_mktsegment"))).alias("slug"))


@register("prediction_rmse", f"""WITH {PRED_SQL}
SELECT estacao, round(sqrt(avg(erro_predicao * erro_predicao)), 6) AS rmse, round(avg(erro_absoluto), 6) AS erro_medio,
  round(max(erro_absoluto), 6) AS erro_maximo, round(min(erro_absoluto), 6) AS erro_minimo
FROM pred GROUP BY estacao""")
def q_prediction_rmse(spark, sf):
    return rounded(prediction_rmse(_pred(spark, sf), "estacao"))


@register("export_snapshot", f"""WITH {READINGS_SQL}
SELECT id, estacao, data, temperatura, umidade, velocidade_vento, CAST(NULL AS DOUBLE) AS sensacao_termica,
  CAST(NULL AS TIMESTAMP) AS created_at FROM readings""")
def q_export_snapshot(spark, sf):
    """K4: a snapshot written under the shared folder and read back."""
    out = K.export_snapshot(readings(spark, sf), scratch_path(spark, "export"), "20240201T000000")
    return spark.read.parquet(out).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@register("database_stats", f"""WITH {READINGS_SQL}
SELECT count(*) AS total, min(data) AS primeira_data, max(data) AS ultima_data FROM readings""")
def q_database_stats(spark, sf):
    """Table summary printed with each export: rows and first / last date."""
    return A.database_stats(readings(spark, sf))


@register("write_treated", f"""WITH {READINGS_SQL}
SELECT id, estacao, data, hora, temperatura, umidade, velocidade_vento FROM readings""")
def q_write_treated(spark, sf):
    """K1: readings written per station (partition directories) and read back."""
    path = scratch_path(spark, "treated")
    K.write_treated(readings(spark, sf), path)
    return spark.read.parquet(path).select("id", "estacao", "data", "hora", *TARGETS)


@register("write_report", f"""WITH {READINGS_SQL}
SELECT estacao, CAST(count_if(umidade < 20) AS BIGINT) AS horas_secura_extrema,
  CAST(count_if(temperatura > 35) AS BIGINT) AS horas_calor_extremo,
  CAST(count_if(velocidade_vento > 5.5) AS BIGINT) AS horas_vento_forte
FROM readings GROUP BY estacao""")
def q_write_report(spark, sf):
    """K8: all analysis tables written side by side; the risk table read back."""
    paths = K.write_report(readings(spark, sf), scratch_path(spark, "report"))
    return spark.read.parquet(paths["risco"])


@register("write_stats_json", f"WITH {READINGS_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS coluna, count({c}) AS contagem FROM readings" for c in TARGETS))
def q_write_stats_json(spark, sf):
    """K7: describe() statistics as JSON lines, read back as JSON."""
    path = scratch_path(spark, "stats-json")
    K.write_stats_json(readings(spark, sf).select(*TARGETS), path)
    return spark.read.schema("coluna string, contagem long").json(path)


@register("write_telemetry", f"""WITH {READINGS_TS_SQL},
n AS (SELECT estacao, row_number() OVER (PARTITION BY estacao ORDER BY epoch_ms(ts), id) AS rn FROM readings_ts)
SELECT estacao, CAST(floor((rn - 1) / 500) AS BIGINT) AS lote, CAST(count(*) AS INTEGER) AS n_pontos
FROM n GROUP BY 1, 2""")
def q_write_telemetry(spark, sf):
    """K6: payload batches of 500 points as JSON lines, read back."""
    from horavento.sources.tables import readings_with_ts
    path = scratch_path(spark, "telemetry")
    K.write_telemetry(readings_with_ts(spark, sf), path, 500)
    j = spark.read.schema("estacao string, lote long, pontos array<struct<ts:long,values:map<string,double>>>") \
        .json(path)
    return j.select("estacao", "lote", F.size("pontos").alias("n_pontos"))


@register("write_imputed", f"""WITH {READINGS_SQL}
SELECT id, data, hora, temperatura, umidade, velocidade_vento, estacao, 'Modelo_Leve' AS modelo FROM readings""")
def q_write_imputed(spark, sf):
    """K2 + S9: per station x model parquet and CSV, the CSV read back with
    the result reader and its station / model taken from the path."""
    from horavento.sources.station_files import read_results_csv
    path = scratch_path(spark, "imputed")
    K.write_imputed(readings(spark, sf).withColumn("modelo", F.lit("Modelo_Leve")), path)
    back = read_results_csv(spark, f"{path}/csv")
    return back.select("id", "data", "hora", *TARGETS,
                       F.regexp_extract("arquivo", "estacao=([^/]+)", 1).alias("estacao"),
                       F.regexp_extract("arquivo", "modelo=([^/]+)", 1).alias("modelo"))


@register("by_station", f"""WITH {READINGS_SQL}
SELECT * FROM readings WHERE estacao IN ('click', 'view')""")
def q_by_station(spark, sf):
    return P.by_station(readings(spark, sf), ["click", "view"])


@register("with_header", f"""WITH {READINGS_SQL},
codes AS (SELECT estacao, 'A' || CAST(300 + dense_rank() OVER (ORDER BY estacao) AS VARCHAR) AS codigo_estacao
          FROM (SELECT DISTINCT estacao FROM readings))
SELECT r.estacao, r.data, lpad(CAST(r.hora AS VARCHAR), 2, '0') || '00 UTC' AS hora, r.temperatura,
  c.codigo_estacao, 'PE' AS estado
FROM readings r JOIN codes c ON r.estacao = c.estacao""")
def q_with_header(spark, sf):
    """Raw rows joined with their file's header metadata by file path."""
    from horavento.operators.joins import with_header
    from horavento.plans.file_queries import raw_files
    from horavento.sources.station_files import header_wide, read_station_csv, read_station_header
    path = raw_files(spark, sf)
    rows = read_station_csv(spark, path)
    head = header_wide(read_station_header(spark, path)).select("arquivo", "codigo_estacao", "estado")
    return with_header(rows, head, "arquivo").select("estacao", "data", "hora", "temperatura",
                                                     "codigo_estacao", "estado")


@register("value_map_nulls", f"""WITH {READINGS_SQL}
SELECT id, CAST(3 AS INTEGER) AS n_chaves,
  CAST((temperatura IS NULL) AS INTEGER) + CAST((umidade IS NULL) AS INTEGER)
  + CAST((velocidade_vento IS NULL) AS INTEGER) AS n_nulos FROM readings""")
def q_value_map_nulls(spark, sf):
    """telemetry map keeping NULL values (one entry per measure)."""
    from horavento.functions.telemetry import value_map
    m = readings(spark, sf).select("id", value_map(TARGETS, keep_nulls=True).alias("m"))
    return m.select("id", F.size("m").alias("n_chaves"),
                    F.size(F.filter(F.map_values("m"), lambda v: v.isNull())).alias("n_nulos"))


@register("radiation_features", """SELECT event_id AS id, round(ln(1 + value), 6) AS radiacao_log,
  CAST(hour(ts) AS INTEGER) AS hora_dia FROM events""")
def q_radiation_features(spark, sf):
    """log(1 + radiation) and hour of day (event value as radiation)."""
    from horavento.functions.temporal import hour_of_day, radiation_log
    e = load_table(spark, sf, "events")
    return rounded(e.select(F.col("event_id").alias("id"), radiation_log("value").alias("radiacao_log"),
                            hour_of_day("ts").alias("hora_dia")))


@register("name_contains", """SELECT event_id AS id FROM events WHERE user_id % 3 <> 0""")
def q_name_contains(spark, sf):
    """Result names holding ``_Modelo_`` (names derived from the events)."""
    from horavento.plans.text_queries import _result_name
    t = load_table(spark, sf, "events").select(F.col("event_id").alias("id"), _result_name().alias("filename"))
    return P.name_contains(t, "_Modelo_").select("id")
