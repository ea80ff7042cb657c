"""Registered queries of the fitted models (M3-M7, M10-M15): what SQL can say
of their results -- rows, masked and filled cells, invariants -- is compared."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from horavento.functions.temporal import temporal_features
from horavento.operators import forecast as FC
from horavento.operators import impute as M
from horavento.plans.common import READINGS_SQL, register, rounded
from horavento.plans.model_queries import MASK_SQL
from horavento.schemas import MODEL_CONFIGS, TARGETS
from horavento.sources.tables import readings

LIGHT = MODEL_CONFIGS[0]


N_NULL = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in TARGETS)
IMPUTED_SQL = f"""WITH {READINGS_SQL}
SELECT estacao, count(*) AS linhas, CAST(sum({N_NULL}) AS BIGINT) AS celulas_preenchidas,
  CAST(0 AS BIGINT) AS observados_alterados, CAST(0 AS BIGINT) AS nulos FROM readings GROUP BY estacao"""


def _invariants(original, imputed):
    """Per station: rows, filled cells, observed cells changed, NULLs left."""
    old = original.select("id", *[F.col(c).alias(f"_{c}") for c in TARGETS])
    count = lambda f: F.sum(sum(f(c).cast("long") for c in TARGETS))
    return imputed.join(old, "id").groupBy("estacao").agg(
        F.count(F.lit(1)).alias("linhas"),
        count(lambda c: F.col(f"_{c}").isNull() & F.col(c).isNotNull()).alias("celulas_preenchidas"),
        count(lambda c: F.col(f"_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}"))).alias("observados_alterados"),
        count(lambda c: F.col(c).isNull()).alias("nulos"))


@register("iterative_impute", IMPUTED_SQL)
def q_iterative_impute(spark, sf):
    r = readings(spark, sf)
    return _invariants(r, M.iterative_impute(r, LIGHT))


@register("impute_per_station", IMPUTED_SQL)
def q_impute_per_station(spark, sf):
    r = readings(spark, sf)
    return _invariants(r, M.iterative_impute(r, LIGHT, scope="per_station"))


@register("evaluate_imputer", f"""WITH {MASK_SQL}
SELECT estacao, '{LIGHT["nome"]}' AS modelo, alvo, count(*) AS n, true AS finito FROM mask GROUP BY estacao, alvo""")
def q_evaluate_imputer(spark, sf):
    s = M.evaluate_imputer(readings(spark, sf), LIGHT)
    return s.select("estacao", "modelo", "alvo", "n",
                    ((F.col("rmse") >= 0) & (F.col("rmse") < float("inf")) & (F.col("mae") <= F.col("rmse") + 1e-9)).alias("finito"))


@register("impute_all", f"""WITH {MASK_SQL},
m AS (SELECT count(*) AS n, count(DISTINCT (estacao, alvo)) AS g FROM mask), r AS (SELECT count(*) AS n FROM readings)
SELECT c.modelo, 'sucesso' AS status, m.n AS celulas_avaliadas, m.g AS grupos, r.n AS linhas, CAST(0 AS BIGINT) AS nulos
FROM (VALUES {", ".join(f"('{c['nome']}')" for c in MODEL_CONFIGS)}) AS c(modelo) CROSS JOIN m CROSS JOIN r""")
def q_impute_all(spark, sf):
    scores, imputed, status = M.impute_all(readings(spark, sf), MODEL_CONFIGS)
    failed = status.where("status <> 'sucesso'").select("modelo", "erro").collect()
    if failed:
        raise RuntimeError(f"imputation failed: {failed}")
    s = scores.groupBy("modelo").agg(F.sum("n").alias("celulas_avaliadas"), F.count(F.lit(1)).alias("grupos"))
    null = sum(F.col(c).isNull().cast("long") for c in TARGETS)
    i = imputed.groupBy("modelo").agg(F.count(F.lit(1)).alias("linhas"), F.sum(null).alias("nulos"))
    return status.select("modelo", "status").join(s, "modelo").join(i, "modelo")


def _forecast_frame(spark, sf):
    return temporal_features(readings(spark, sf), "data", "hora")


@register("train_temperature", f"""WITH {READINGS_SQL}
SELECT id, estacao, temperatura AS temperatura_real, true AS coerente FROM readings WHERE temperatura IS NOT NULL""")
def q_train_temperature(spark, sf):
    _, pred = FC.train_temperature(_forecast_frame(spark, sf))
    error = F.col("temperatura_real") - F.col("temperatura_prevista")
    return pred.select("id", "estacao", "temperatura_real",
                       ((F.abs(F.col("erro_predicao") - error) < 1e-9)
                        & (F.abs(F.col("erro_absoluto") - F.abs(error)) < 1e-9)).alias("coerente"))


@register("train_temperature_alternatives", f"""WITH {READINGS_SQL}, n AS (SELECT count(temperatura) AS n FROM readings)
SELECT a.algoritmo, n.n, true AS melhor_que_media FROM (VALUES ('lr'), ('gbt')) AS a(algoritmo) CROSS JOIN n""")
def q_train_alternatives(spark, sf):
    frame = _forecast_frame(spark, sf)
    spread = frame.agg(F.stddev_pop("temperatura")).first()[0]
    out = None
    for algo in ("lr", "gbt"):
        _, pred = FC.train_temperature(frame, algo=algo, max_depth=5)
        s = FC.forecast_scores(pred).select(F.lit(algo).alias("algoritmo"), "n",
                                            (F.col("rmse") <= spread + 1e-9).alias("melhor_que_media"))
        out = s if out is None else out.unionByName(s)
    return out


@register("feature_importance", "SELECT unnest(['" + "', '".join(FC.FORECAST_FEATURES) + """']) AS feature,
  true AS entre_0_e_1, true AS soma_1""")
def q_feature_importance(spark, sf):
    model, _ = FC.train_temperature(_forecast_frame(spark, sf))
    imp = FC.feature_importance(spark, model)
    total = imp.select(F.sum("importancia")).scalar()
    return imp.select("feature", F.col("importancia").between(0, 1).alias("entre_0_e_1"),
                      (F.abs(total - 1) < 1e-6).alias("soma_1"))


@register("time_folds", f"""WITH {READINGS_SQL},
f AS (SELECT CAST(data AS TIMESTAMP) + to_hours(hora) AS ts,
  CAST(ntile(5) OVER (ORDER BY CAST(data AS TIMESTAMP) + to_hours(hora), id) - 1 AS INTEGER) AS fold FROM readings)
SELECT fold, count(*) AS n, min(ts) AS inicio, max(ts) AS fim FROM f GROUP BY fold""")
def q_time_folds(spark, sf):
    folded = FC.time_folds(_forecast_frame(spark, sf), 5)
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("inicio"),
                                      F.max("ts").alias("fim"))


SCALED = ["umidade", "velocidade_vento", "hora_sin", "hora_cos"]


@register("scale_features", f"""WITH {READINGS_SQL},
f AS (SELECT id, estacao, umidade, velocidade_vento, sin(2 * pi() * hora / 24) AS hora_sin,
  cos(2 * pi() * hora / 24) AS hora_cos FROM readings),
g AS (SELECT id, estacao, {", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in SCALED)} FROM f)
SELECT id, estacao, {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS z_{c}" for c in SCALED)}
FROM g""")
def q_scale_features(spark, sf):
    z = vector_to_array("features")
    return FC.scale_features(_forecast_frame(spark, sf), SCALED).select(
        "id", "estacao", *[F.round(z[i], 6).alias(f"z_{c}") for i, c in enumerate(SCALED)])


CV_SQL = f"""{READINGS_SQL},
f AS (SELECT id, CAST(data AS TIMESTAMP) + to_hours(hora) AS ts, temperatura AS y, umidade,
  CAST(ntile(5) OVER (ORDER BY CAST(data AS TIMESTAMP) + to_hours(hora), id) - 1 AS INTEGER) AS fold FROM readings),
x AS (SELECT id, fold, y, coalesce(umidade, (SELECT coalesce(avg(umidade), 0) FROM f WHERE fold = 0)) AS x FROM f WHERE y IS NOT NULL),
fit AS (SELECT k.fold, coalesce(regr_slope(x.y, x.x), 0) AS b, avg(x.y) AS my, avg(x.x) AS mx
  FROM (SELECT unnest(range(1, 5)) AS fold) k JOIN x ON x.fold < k.fold GROUP BY k.fold),
p AS (SELECT x.id, x.fold, x.y AS real, fit.my + fit.b * (x.x - fit.mx) AS pred FROM x JOIN fit ON x.fold = fit.fold)"""


@register("forecast_cv", f"""WITH {CV_SQL}
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, round(sqrt(avg((real - pred) * (real - pred))), 6) AS rmse,
  round(avg(abs(real - pred)), 6) AS mae,
  round(1 - sum((real - pred) * (real - pred)) / (var_pop(real) * count(*)), 6) AS r2,
  round(avg(abs((real - pred) / real)) FILTER (real <> 0), 6) AS mape FROM p GROUP BY fold""")
def q_forecast_cv(spark, sf):
    """Linear fits of the expanding splits, scored fold by fold."""
    return rounded(FC.cross_validate(_forecast_frame(spark, sf), ["umidade"]).select("fold", "n", "rmse", "mae", "r2", "mape"))


@register("forecast_out_of_fold", f"""WITH {CV_SQL}
SELECT id, CAST(fold AS INTEGER) AS fold, round(real, 6) AS temperatura_real, round(pred, 6) AS temperatura_prevista FROM p""")
def q_forecast_out_of_fold(spark, sf):
    return rounded(FC.out_of_fold(_forecast_frame(spark, sf), ["umidade"]).select(
        "id", "fold", "temperatura_real", "temperatura_prevista"))


@register("forecast_cv_trees", f"""WITH {READINGS_SQL},
f AS (SELECT temperatura AS y, CAST(ntile(3) OVER (ORDER BY CAST(data AS TIMESTAMP) + to_hours(hora), id) - 1 AS INTEGER) AS fold FROM readings)
SELECT a.algoritmo, f.fold, count(y) AS n, true AS finito FROM f CROSS JOIN (VALUES ('rf'), ('gbt')) AS a(algoritmo)
WHERE f.fold > 0 GROUP BY a.algoritmo, f.fold""")
def q_forecast_cv_trees(spark, sf):
    frame, out = _forecast_frame(spark, sf), None
    for algo in ("rf", "gbt"):
        s = FC.cross_validate(frame, k=3, algo=algo, num_trees=20, max_depth=5)
        s = s.select(F.lit(algo).alias("algoritmo"), "fold", "n", ((F.col("rmse") >= F.col("mae") - 1e-9) & (F.col("rmse") < 1e300)).alias("finito"))
        out = s if out is None else out.unionByName(s)
    return out
