"""Temperature regression, prediction frames and temporal folds."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.functions.telemetry import residuals
from horavento.operators.analysis import abs_error_stats, score
from horavento.operators.forest import Layout, coded, grow, packed, reader, spark_model, value_cuts, value_source
from horavento.operators.windows import sequence_number
from horavento.schemas import RANDOM_STATE
from horavento.session import materialize

FORECAST_FEATURES = ["umidade", "velocidade_vento", "hora", "mes", "dia_ano", "hora_sin", "hora_cos"]

#: tasks a core that a fit is dealt over
FIT_TASKS = 2
#: rows of a task of a forest's fit, at most
TASK_ROWS = 1 << 20


def prediction_frame(df: DataFrame, real: str = "temperatura_real",
                     pred: str = "temperatura_prevista") -> DataFrame:
    """Predicted vs actual with residual and absolute residual."""
    return residuals(df, real, pred)


def prediction_rmse(frame: DataFrame, by=None) -> DataFrame:
    """RMSE and absolute-error statistics of a prediction frame."""
    e = F.col("erro_predicao")
    g = frame.groupBy(*([by] if isinstance(by, str) else list(by or [])))
    return g.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg("erro_absoluto").alias("erro_medio"),
                 F.max("erro_absoluto").alias("erro_maximo"), F.min("erro_absoluto").alias("erro_minimo"))


def scale_features(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Assemble and standardise features (M15); missing values take the mean
    of their column, so every row is kept.  No row, no row."""
    from horavento.operators.impute import mean_fill
    if df.isEmpty():
        return df.withColumn(out, F.lit(None).cast(VectorUDT()))
    filled = mean_fill(df, cols, None)
    va = VectorAssembler(inputCols=cols, outputCol="_raw", handleInvalid="keep")
    sc = StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True)
    return Pipeline(stages=[va, sc]).fit(filled).transform(filled).drop("_raw")


def train_temperature(df: DataFrame, features: list[str] = FORECAST_FEATURES,
                      label: str = "temperatura", algo: str = "rf", seed: int = RANDOM_STATE,
                      num_trees: int = 100, max_depth: int = 10):
    """Hourly temperature regressor (M10, M11): random forest (100 trees,
    depth 10, seed 42), linear regression or boosted trees.

    Returns ``(model, predictions)`` where predictions hold the prediction
    frame columns for the training rows with a label; without any such row the
    model is None and the frame empty.  ``out_of_fold`` predicts rows that the
    model has not seen."""
    from horavento.operators.impute import mean_fill
    # missing feature cells take their station mean (M2) so no row is lost
    gaps = [c for c in features if c in ("temperatura", "umidade", "velocidade_vento")]
    filled = mean_fill(df, gaps, "estacao") if gaps and "estacao" in df.columns else df
    data = filled.where(F.col(label).isNotNull())
    pipeline = _regressor(features, label, algo, seed, num_trees, max_depth)
    if data.isEmpty():
        empty = data.withColumnRenamed(label, "temperatura_real").withColumn("temperatura_prevista", F.lit(None).cast("double"))
        return None, prediction_frame(empty)
    columns, tasks = data.columns, FIT_TASKS * df.sparkSession.sparkContext.defaultParallelism
    sources, values = [], []
    if algo == "rf":
        data, sources, values = coded(data, features, max_depth)
        data = data.select(*columns, *[s.column for s in sources])
    # the fit reads the rows many times: written once, over all cores whatever files they came in
    data = materialize(data.repartition(tasks), "forecast-data")
    model = _forest_fit(pipeline, data, features, label, sources, values) if algo == "rf" else pipeline.fit(data.select(columns))
    return model, _predicted(model, data.select(columns), label)


def _forest_fit(pipeline: Pipeline, data: DataFrame, features: list[str], label: str, sources: list, values: list[str]) -> PipelineModel:
    """What ``pipeline.fit`` gives for a random forest, grown by ``forest``: a
    node may split by one of a third of the features, as Spark ML has it."""
    va, est = pipeline.getStages()
    trees, depth = est.getNumTrees(), est.getMaxDepth()
    rows = data.select(F.col(label).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in values], *[s.column for s in sources])
    layout = Layout(["_y", *values], [s.column for s in sources], [])
    n, middle = rows.agg(F.count(F.lit(1)), F.avg("_y")).first()
    if n > rows.rdd.getNumPartitions() * TASK_ROWS:
        rows = rows.repartition(-(-n // TASK_ROWS))
    blocks = materialize(packed(rows, layout, []), "forecast-blocks")
    cuts = value_cuts(blocks, layout, values)
    sources = sources + [value_source(c, features.index(c), cuts[c]) for c in values]
    grown = grow(blocks, layout, sources, reader("_y", sources), middle, trees, depth, est.getSeed(),
                 subset=len(features) if trees == 1 else math.ceil(len(features) / 3))
    thresholds = [None] * len(features)
    for s in sources:
        for f, c in zip(s.features, [s.cuts] if s.cuts is not None else s.thresholds):
            thresholds[f] = c
    return PipelineModel([va, spark_model(est, grown, thresholds, data.sparkSession)])


def _regressor(features: list[str], label: str, algo: str, seed: int, num_trees: int, max_depth: int) -> Pipeline:
    va = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep")
    if algo == "rf":
        est = RandomForestRegressor(featuresCol="_x", labelCol=label, predictionCol="_p",
                                    numTrees=num_trees, maxDepth=max_depth, seed=seed)
    elif algo == "gbt":
        est = GBTRegressor(featuresCol="_x", labelCol=label, predictionCol="_p",
                           maxDepth=max_depth, seed=seed)
    elif algo == "lr":
        est = LinearRegression(featuresCol="_x", labelCol=label, predictionCol="_p")
    else:
        raise ValueError(f"unknown algorithm {algo}")
    return Pipeline(stages=[va, est])


def _predicted(model, data: DataFrame, label: str) -> DataFrame:
    pred = model.transform(data).withColumnRenamed(label, "temperatura_real") \
        .withColumnRenamed("_p", "temperatura_prevista").drop("_x")
    return prediction_frame(pred)


def feature_importance(spark: SparkSession, model, features: list[str] = FORECAST_FEATURES) -> DataFrame:
    """Feature importance ranking of a fitted tree model (M12); one value per
    feature, so the vector is small by construction."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    imp = stage.featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importancia double") \
        .orderBy(F.desc("importancia"), "feature")


def time_folds(df: DataFrame, k: int = 5, ts: str = "ts", id_col: str = "id") -> DataFrame:
    """Assign each row to one of ``k`` time-ordered folds of equal size, the
    first ones a row larger where the rows don't divide evenly (M13).

    The rows are numbered by ``sequence_number``, so no global sort or
    single-partition window is needed; fold i of an expanding split trains on
    folds < i."""
    numbered = sequence_number(df, None, [ts, id_col], out="_rn")
    total = df.count()
    small, large = total // k, total % k
    at = F.col("_rn") - 1
    edge = large * (small + 1)
    fold = F.when(at < edge, F.floor(at / (small + 1))).otherwise(F.lit(large) + F.floor((at - edge) / max(1, small)))
    return numbered.withColumn("fold", fold.cast("int")).drop("_rn")


def expanding_split(folded: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    """Train on folds before ``i``, test on fold ``i``."""
    return folded.where(F.col("fold") < i), folded.where(F.col("fold") == i)


def _first_fold_fill(folded: DataFrame, features: list[str]) -> DataFrame:
    """Missing feature cells -> mean of the column in the first fold (0 if it
    has none), the only rows that every model may know of."""
    means = folded.where("fold = 0").agg(*[F.avg(c).alias(c) for c in features]).first()
    return folded.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(means[c] or 0.0))) for c in features})


def fold_coefficients(filled: DataFrame, features: list[str], label: str, k: int) -> dict[int, np.ndarray]:
    """Least-squares coefficients (intercept first) of every expanding split.

    The sums of products of a fold are the normal equations of its rows, so
    those of folds 0 .. i-1 are a prefix sum: one aggregate with one row per
    fold serves all k - 1 fits.  Columns are centred first, on their means in
    the first fold with a label.  Of several solutions (a constant or repeated feature) the one with
    the smallest coefficients is taken."""
    rows = filled.where(F.col(label).isNotNull())
    middle = rows.groupBy("fold").agg(*[F.avg(c).alias(c) for c in [*features, label]]).orderBy("fold").first()
    if middle is None:
        return {}
    centred = [F.lit(1.0)] + [F.col(c) - F.lit(float(middle[c])) for c in [*features, label]]
    size = len(centred)
    cells = [(a, b) for a in range(size) for b in range(a, size)]
    sums = rows.groupBy("fold").agg(*[F.sum(centred[a] * centred[b]).alias(f"s{a}_{b}") for a, b in cells]).collect()
    out, gram = {}, np.zeros((size, size))
    by_fold = {r["fold"]: r for r in sums}
    for i in range(1, k):
        for a, b in cells:
            if i - 1 in by_fold:
                gram[a, b] += by_fold[i - 1][f"s{a}_{b}"]
                gram[b, a] = gram[a, b]
        if gram[0, 0] == 0:
            continue
        n, mean = gram[0, 0], gram[0, 1:] / gram[0, 0]
        cov = gram[1:, 1:] - n * np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
        scale[scale <= 1e-9 * np.sqrt(np.diag(gram)[1:-1] + 1e-300)] = np.inf  # a constant feature takes no part
        slope = np.linalg.pinv(cov[:-1, :-1] / np.outer(scale, scale), hermitian=True) @ (cov[:-1, -1] / scale) / scale
        at = np.array([float(middle[c]) for c in features]) + mean[:-1]
        out[i] = np.concatenate(([float(middle[label]) + mean[-1] - slope @ at], slope))
    return out


def out_of_fold(df: DataFrame, features: list[str] = FORECAST_FEATURES, label: str = "temperatura", k: int = 5,
                algo: str = "lr", seed: int = RANDOM_STATE, num_trees: int = 100, max_depth: int = 10,
                ts: str = "ts", id_col: str = "id") -> DataFrame:
    """Prediction frame of every labelled row of folds 1 .. k-1, each from a
    model that was fitted on the folds before its own (M10, M11, M13).

    The linear fits of all folds come from one aggregate; forests and boosted
    trees are k - 1 distributed fits.  A row whose earlier folds hold no label
    has no prediction; an empty table gives an empty frame."""
    folded = materialize(time_folds(df, k, ts, id_col), "forecast-folds")
    data = _first_fold_fill(folded, features)
    later = data.where(F.col(label).isNotNull() & (F.col("fold") > 0))
    if algo == "lr":
        value = F.lit(None).cast("double")
        for i, coef in fold_coefficients(data, features, label, k).items():
            line = F.lit(float(coef[0]))
            for c, w in zip(features, coef[1:]):
                line = line + F.col(c) * F.lit(float(w))
            value = F.when(F.col("fold") == i, line).otherwise(value)
        return prediction_frame(later.withColumn("temperatura_prevista", value).withColumnRenamed(label, "temperatura_real"))
    out = None
    for i in range(1, k):
        train, test = data.where((F.col("fold") < i) & F.col(label).isNotNull()), later.where(F.col("fold") == i)
        if train.isEmpty():
            part = prediction_frame(test.withColumn("temperatura_prevista", F.lit(None).cast("double"))
                                    .withColumnRenamed(label, "temperatura_real"))
        else:
            part = _predicted(_regressor(features, label, algo, seed, num_trees, max_depth).fit(train), test, label)
        out = part if out is None else out.unionByName(part)
    return out


def cross_validate(df: DataFrame, features: list[str] = FORECAST_FEATURES, label: str = "temperatura", k: int = 5,
                   algo: str = "lr", **more) -> DataFrame:
    """RMSE, MAE, R2 and MAPE per fold of an expanding split."""
    return forecast_scores(out_of_fold(df, features, label, k, algo, **more), by="fold")


def holdout(df: DataFrame, features: list[str] = FORECAST_FEATURES, label: str = "temperatura", share: float = 0.2,
            algo: str = "rf", seed: int = RANDOM_STATE, num_trees: int = 100, max_depth: int = 10):
    """``(model, predictions)``: fitted on the earlier part of the time range,
    predicting the last ``share`` of the rows (M10, M11)."""
    k = max(2, round(1 / share))
    data = _first_fold_fill(materialize(time_folds(df, k), "forecast-holdout"), features).where(F.col(label).isNotNull())
    train, test = expanding_split(data, k - 1)
    if train.isEmpty():
        return None, prediction_frame(test.withColumn("temperatura_prevista", F.lit(None).cast("double"))
                                      .withColumnRenamed(label, "temperatura_real"))
    model = _regressor(features, label, algo, seed, num_trees, max_depth).fit(train)
    return model, _predicted(model, test, label)


def forecast_scores(pred: DataFrame, by=None) -> DataFrame:
    """RMSE / MAE / R2 / MAPE of a prediction frame."""
    p = pred.withColumnRenamed("temperatura_real", "real").withColumnRenamed("temperatura_prevista", "imputado")
    return score(p, by=by or [], mape=True)


__all__ = ["prediction_frame", "prediction_rmse", "scale_features", "train_temperature",
           "feature_importance", "time_folds", "expanding_split", "forecast_scores",
           "abs_error_stats", "out_of_fold", "cross_validate", "holdout", "fold_coefficients"]
