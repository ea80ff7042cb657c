"""Registered queries: masks, mean fill, scores, prediction frames, sequences, telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from horavento.functions.telemetry import to_long, value_map
from horavento.functions.temporal import epoch_ms
from horavento.operators import analysis as A
from horavento.operators import filters as P
from horavento.operators import impute as M
from horavento.operators import windows as W
from horavento.operators.forecast import prediction_frame
from horavento.plans.common import READINGS_SQL, READINGS_TS_SQL, readings_cte, register, rounded
from horavento.schemas import TARGETS
from horavento.sources.tables import readings, readings_with_ts, telemetry_readings

MASK_SQL = f"""{READINGS_SQL},
long AS (""" + "\n  UNION ALL ".join(
    f"SELECT id, estacao, '{c}' AS alvo, {c} AS real FROM readings WHERE {c} IS NOT NULL"
    for c in TARGETS) + """),
ranked AS (SELECT *, row_number() OVER (PARTITION BY estacao, alvo
    ORDER BY md5(concat_ws('|', '42', alvo, CAST(id AS VARCHAR)))) AS rn,
  count(*) OVER (PARTITION BY estacao, alvo) AS n FROM long),
mask AS (SELECT estacao, alvo, id, real FROM ranked WHERE rn <= floor(CAST(n AS DOUBLE) * 0.1)),
masked AS (SELECT r.id, r.estacao, """ + ", ".join(
    f"CASE WHEN EXISTS (SELECT 1 FROM mask m WHERE m.id = r.id AND m.alvo = '{c}') THEN NULL ELSE r.{c} END AS {c}"
    for c in TARGETS) + """ FROM readings r),
means AS (SELECT estacao, """ + ", ".join(f"avg({c}) AS mu_{c}" for c in TARGETS) + """ FROM masked GROUP BY estacao),
filled AS (SELECT m.id, m.estacao, """ + ", ".join(f"coalesce(m.{c}, mu.mu_{c}) AS {c}" for c in TARGETS) + """
  FROM masked m JOIN means mu ON m.estacao = mu.estacao),
pairs AS (SELECT k.estacao, k.alvo, k.id, k.real, CASE k.alvo """ + " ".join(
    f"WHEN '{c}' THEN f.{c}" for c in TARGETS) + """ END AS imputado
  FROM mask k JOIN filled f ON k.id = f.id),
scores AS (SELECT estacao, 'media' AS modelo, alvo, sqrt(avg((real - imputado) * (real - imputado))) AS rmse,
  avg(abs(real - imputado)) AS mae,
  1 - sum((real - imputado) * (real - imputado)) / (var_pop(real) * count(real)) AS r2, count(*) AS n
  FROM pairs GROUP BY estacao, alvo)"""


def _mask(spark, sf):
    return M.mask_cells(readings(spark, sf))


def _masked(spark, sf, plan=None):
    r = readings(spark, sf).select("id", "estacao", *TARGETS)
    return M.apply_mask(r, plan=plan or M.MaskPlan(r))


def _filled(spark, sf):
    return M.mean_fill(_masked(spark, sf))


def _pairs(spark, sf):
    r = readings(spark, sf).select("id", "estacao", *TARGETS)
    plan = M.MaskPlan(r)
    return M.mean_fill_pairs(M.mask_cells(r, plan=plan), M.apply_mask(r, plan=plan))


def _scores(spark, sf):
    return A.score(_pairs(spark, sf).withColumn("modelo", F.lit("media")))


@register("mask_cells", f"WITH {MASK_SQL}\nSELECT * FROM mask")
def q_mask_cells(spark, sf):
    return _mask(spark, sf)


@register("masked_pairs", f"WITH {MASK_SQL}\nSELECT estacao, alvo, id, real, round(imputado, 6) AS imputado FROM pairs")
def q_masked_pairs(spark, sf):
    return rounded(_pairs(spark, sf).select("estacao", "alvo", "id", "real", "imputado"))


@register("mean_fill", f"WITH {MASK_SQL}\nSELECT id, estacao, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in TARGETS) + " FROM filled")
def q_mean_fill(spark, sf):
    return rounded(_filled(spark, sf))


@register("score", f"""WITH {MASK_SQL}
SELECT estacao, modelo, alvo, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2, n FROM scores""")
def q_score(spark, sf):
    return rounded(_scores(spark, sf))


@register("score_macro", f"""WITH {MASK_SQL}
SELECT estacao, modelo, round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae, round(avg(r2), 6) AS r2
FROM scores GROUP BY estacao, modelo""")
def q_score_macro(spark, sf):
    return rounded(A.score_macro(_scores(spark, sf)))


@register("score_summary", f"""WITH {MASK_SQL}
SELECT modelo, alvo, """ + ", ".join(
    f"round(avg({m}), 6) AS {m}_media, round(stddev_pop({m}), 6) AS {m}_desvio" for m in ("rmse", "mae", "r2"))
    + " FROM scores GROUP BY modelo, alvo")
def q_score_summary(spark, sf):
    return rounded(A.score_summary(_scores(spark, sf)))


@register("scatter_points", f"""WITH {MASK_SQL},
b AS (SELECT estacao, alvo, least(min(real), min(imputado)) AS lo, greatest(max(real), max(imputado)) AS hi
      FROM pairs GROUP BY estacao, alvo)
SELECT p.estacao, p.alvo, p.id, p.real, round(p.imputado, 6) AS imputado,
  round(b.lo, 6) AS limite_inferior, round(b.hi, 6) AS limite_superior
FROM pairs p JOIN b ON p.estacao = b.estacao AND p.alvo = b.alvo""")
def q_scatter_points(spark, sf):
    return rounded(M.scatter_points(_pairs(spark, sf).select("estacao", "alvo", "id", "real", "imputado")))


PRED_SQL = f"""{READINGS_SQL},
mu AS (SELECT estacao, avg(temperatura) AS m FROM readings GROUP BY estacao),
pred AS (SELECT r.id, r.estacao, r.temperatura AS temperatura_real, mu.m AS temperatura_prevista,
  r.temperatura - mu.m AS erro_predicao, abs(r.temperatura - mu.m) AS erro_absoluto
  FROM readings r JOIN mu ON r.estacao = mu.estacao WHERE r.temperatura IS NOT NULL)"""


def _pred(spark, sf):
    r = readings(spark, sf).select("id", "estacao", "temperatura")
    mu = r.groupBy("estacao").agg(F.avg("temperatura").alias("temperatura_prevista"))
    base = r.where(F.col("temperatura").isNotNull()).join(mu, "estacao") \
        .withColumnRenamed("temperatura", "temperatura_real")
    return prediction_frame(base)


@register("prediction_frame", f"""WITH {PRED_SQL}
SELECT id, estacao, temperatura_real, round(temperatura_prevista, 6) AS temperatura_prevista,
  round(erro_predicao, 6) AS erro_predicao, round(erro_absoluto, 6) AS erro_absoluto FROM pred""")
def q_prediction_frame(spark, sf):
    return rounded(_pred(spark, sf).select("id", "estacao", "temperatura_real", "temperatura_prevista",
                                           "erro_predicao", "erro_absoluto"))


@register("abs_error_stats", f"""WITH {PRED_SQL}
SELECT estacao, round(avg(erro_absoluto), 6) AS erro_medio, round(max(erro_absoluto), 6) AS erro_maximo,
  round(min(erro_absoluto), 6) AS erro_minimo FROM pred GROUP BY estacao""")
def q_abs_error_stats(spark, sf):
    return rounded(A.abs_error_stats(_pred(spark, sf), by="estacao"))


@register("residual_histogram", f"""WITH {PRED_SQL}
SELECT CAST(floor(erro_predicao / 10.0) * 10.0 AS DOUBLE) AS faixa_inicio, count(*) AS n
FROM pred GROUP BY 1""")
def q_residual_histogram(spark, sf):
    return A.residual_histogram(_pred(spark, sf), width=10.0)


@register("binned_heatmap", f"""WITH {READINGS_SQL}
SELECT CAST(floor(temperatura / 50.0) * 50.0 AS DOUBLE) AS faixa_temperatura,
  CAST(floor(umidade / 10.0) * 10.0 AS DOUBLE) AS faixa_umidade, count(*) AS n,
  round(avg(temperatura), 6) AS temperatura_media
FROM readings WHERE temperatura IS NOT NULL AND umidade IS NOT NULL GROUP BY 1, 2""")
def q_binned_heatmap(spark, sf):
    return rounded(A.binned_heatmap(readings(spark, sf)))


@register("hourly_index", f"""WITH {READINGS_SQL}
SELECT id, estacao, TIMESTAMP '2024-01-01 00:00:00'
  + to_hours(row_number() OVER (PARTITION BY estacao ORDER BY id) - 1) AS ts_sintetico FROM readings""")
def q_hourly_index(spark, sf):
    r = readings(spark, sf).select("id", "estacao")
    return W.attach_hourly_index(r, "2024-01-01 00:00:00").select("id", "estacao", "ts_sintetico")


@register("rolling_mean_null_station", f"""WITH {READINGS_SQL},
r AS (SELECT id, CASE WHEN id % 3 > 0 THEN estacao END AS estacao, temperatura FROM readings)
SELECT estacao, id, row_number() OVER w AS rn, temperatura,
  round(avg(temperatura) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS temp_media_3h
FROM r WINDOW w AS (PARTITION BY estacao ORDER BY id)""")
def q_rolling_mean_null_station(spark, sf):
    r = readings(spark, sf).withColumn("estacao", F.when(F.col("id") % 3 > 0, F.col("estacao")))
    return rounded(W.rolling_mean(r, 3, rows_per_bucket=500))


@register("rolling_mean", f"""WITH {READINGS_SQL}
SELECT estacao, id, row_number() OVER w AS rn, temperatura,
  round(avg(temperatura) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS temp_media_3h
FROM readings WINDOW w AS (PARTITION BY estacao ORDER BY id)""")
def q_rolling_mean(spark, sf):
    return rounded(W.rolling_mean(readings(spark, sf), 3))


@register("lag_diff", f"""WITH {READINGS_SQL}
SELECT estacao, id, row_number() OVER w AS rn, temperatura,
  round(temperatura - lag(temperatura) OVER w, 6) AS temp_diff
FROM readings WINDOW w AS (PARTITION BY estacao ORDER BY id)""")
def q_lag_diff(spark, sf):
    return rounded(W.lag_diff(readings(spark, sf)))


@register("telemetry_points", f"""WITH {READINGS_TS_SQL},
p AS (SELECT id, estacao, epoch_ms(ts) AS ts_ms, CAST((temperatura IS NOT NULL) AS INTEGER)
  + CAST((umidade IS NOT NULL) AS INTEGER) + CAST((velocidade_vento IS NOT NULL) AS INTEGER) AS n_valores,
  temperatura, umidade, velocidade_vento FROM readings_ts)
SELECT * FROM p WHERE n_valores > 0""")
def q_telemetry_points(spark, sf):
    r = readings_with_ts(spark, sf)
    pts = r.select("id", "estacao", epoch_ms("ts").alias("ts_ms"), value_map(TARGETS).alias("values"))
    pts = P.nonempty_points(pts)
    return pts.select("id", "estacao", "ts_ms", F.size("values").alias("n_valores"),
                      *[F.try_element_at("values", F.lit(c)).alias(c) for c in TARGETS])


@register("telemetry_batches", f"""WITH {READINGS_TS_SQL},
n AS (SELECT estacao, epoch_ms(ts) AS ts_ms,
  row_number() OVER (PARTITION BY estacao ORDER BY epoch_ms(ts), id) AS rn FROM readings_ts)
SELECT estacao, CAST(floor((rn - 1) / 500) AS BIGINT) AS lote, count(*) AS n_pontos,
  min(ts_ms) AS ts_ms_inicio, max(ts_ms) AS ts_ms_fim, CAST(count(*) AS INTEGER) AS payload_tamanho
FROM n GROUP BY 1, 2""")
def q_telemetry_batches(spark, sf):
    b = W.telemetry_batches(readings_with_ts(spark, sf), 500)
    return b.select("estacao", "lote", "n_pontos", "ts_ms_inicio", "ts_ms_fim",
                    F.size("payload").alias("payload_tamanho"))


@register("to_long", f"WITH {READINGS_SQL}\n" + "\nUNION ALL ".join(
    f"SELECT id, estacao, '{c}' AS chave, {c} AS valor FROM readings" for c in TARGETS))
def q_to_long(spark, sf):
    return to_long(readings(spark, sf), ["id", "estacao"], TARGETS)


TELEMETRY_SQL = readings_cte("tele", keep_ts=True) + """,
tlong AS (""" + "\n  UNION ALL ".join(
    f"SELECT estacao, ts, '{c}' AS chave, {c} AS valor FROM tele WHERE {c} IS NOT NULL" for c in TARGETS) + ")"


@register("telemetry_stats", f"""WITH {TELEMETRY_SQL}
SELECT estacao, chave, date_trunc('hour', ts) AS hora_inicio, round(avg(valor), 6) AS media,
  min(valor) AS minimo, max(valor) AS maximo, count(*) AS n
FROM tlong WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-02-01 00:00:00'
GROUP BY 1, 2, 3""")
def q_telemetry_stats(spark, sf):
    from horavento.streaming.stats import telemetry_stats
    return rounded(telemetry_stats(telemetry_readings(spark, sf), TARGETS,
                                   "2024-01-01 00:00:00", "2024-02-01 00:00:00", "1 hour"))


@register("dashboard_series", f"""WITH {TELEMETRY_SQL}
SELECT estacao, chave, date_trunc('hour', ts) AS hora_inicio, round(avg(valor), 6) AS media
FROM tlong WHERE ts > (SELECT max(ts) FROM tele) - INTERVAL 7 DAY
GROUP BY 1, 2, 3""")
def q_dashboard_series(spark, sf):
    from horavento.streaming.stats import dashboard_series
    return rounded(dashboard_series(telemetry_readings(spark, sf), TARGETS))


@register("rollup_series", f"""WITH {TELEMETRY_SQL},
b AS (SELECT *, '1 day' AS intervalo, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS inicio FROM tlong
  UNION ALL SELECT *, '7 days' AS intervalo, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS inicio FROM tlong)
SELECT estacao, chave, intervalo, inicio, round(avg(valor), 6) AS media, min(valor) AS minimo,
  max(valor) AS maximo, count(*) AS n FROM b GROUP BY 1, 2, 3, 4""")
def q_rollup_series(spark, sf):
    """A stream keeps hourly states, day and week series read them alone."""
    from horavento.session import scratch_path
    from horavento.sources.tables import readings_from_events
    from horavento.streaming.rollup import read_rollup, rollup_stream, series
    from horavento.streaming.stats import events_stream
    root = scratch_path(spark, "rollup")
    rollup_stream(readings_from_events(events_stream(spark, sf), keep_ts=True), root, scratch_path(spark, "rollup-ckpt"), TARGETS)
    states = read_rollup(spark, root)
    both = [series(states, i).withColumn("intervalo", F.lit(i)) for i in ("1 day", "7 days")]
    return rounded(both[0].unionByName(both[1]))
