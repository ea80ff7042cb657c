"""Expanding splits against least squares on the same rows, and awkward input."""

import random

import numpy as np

from horavento.operators import forecast as FC
from horavento.operators.analysis import missing_report, score

SCHEMA = "id long, ts timestamp, temperatura double, a double, b double"


def frame(spark, n, seed=1, constant=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.gauss(50, 5), rng.gauss(-3, 1)
        y = None if rng.random() < 0.1 else 1000 + 2 * a - b + rng.gauss(0, 1)
        rows.append((i, i * 3600, y, 7.0 if constant else (None if rng.random() < 0.1 else a), b))
    return rows, spark.createDataFrame(rows, SCHEMA.replace("timestamp", "long")).selectExpr(
        "id", "timestamp_seconds(ts) AS ts", "temperatura", "a", "b")


def expected(rows, k):
    """(id -> prediction) by numpy on the rows of the earlier folds."""
    n = len(rows)
    small, large = divmod(n, k)
    sizes = [small + (i < large) for i in range(k)]
    ends = np.cumsum([0] + sizes)
    known = [r[3] for r in rows[:ends[1]] if r[3] is not None]
    fill = sum(known) / len(known) if known else 0.0
    x = np.array([[1.0, fill if r[3] is None else r[3], r[4]] for r in rows])
    out = {}
    for i in range(1, k):
        train = [j for j in range(ends[i]) if rows[j][2] is not None]
        coef = np.linalg.lstsq(x[train], np.array([rows[j][2] for j in train]), rcond=None)[0]
        out.update({rows[j][0]: (i, x[j] @ coef) for j in range(ends[i], ends[i + 1]) if rows[j][2] is not None})
    return out


def test_linear_out_of_fold_equals_numpy(spark):
    rows, df = frame(spark, 203)
    want = expected(rows, 5)
    got = {r.id: (r.fold, r.temperatura_prevista) for r in FC.out_of_fold(df, ["a", "b"]).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-6 for i in want)


def test_constant_feature_takes_no_part(spark):
    rows, df = frame(spark, 90, constant=True)
    want = expected(rows, 3)
    got = {r.id: r.temperatura_prevista for r in FC.out_of_fold(df, ["a", "b"], k=3).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i][1]) < 1e-6 for i in want)


def test_no_row_sees_its_own_fold(spark):
    """Later labels change no earlier prediction."""
    _, df = frame(spark, 100)
    cut = df.selectExpr("id", "ts", "if(id < 60, temperatura, -9e9 * id) AS temperatura", "a", "b")
    for algo in ("lr", "rf"):
        one, two = (
            {r.id: r.temperatura_prevista for r in FC.out_of_fold(d, ["a", "b"], algo=algo, num_trees=3, max_depth=3).collect()}
            for d in (df, cut))
        assert all(abs(one[i] - two[i]) < 1e-6 for i in one if i < 60)


def test_scores_per_fold_and_holdout(spark):
    _, df = frame(spark, 150)
    s = {r.fold: r for r in FC.cross_validate(df, ["a", "b"], k=3).collect()}
    assert set(s) == {1, 2} and all(r.rmse < 4 and r.r2 > 0.7 and 0 < r.mape < 1 for r in s.values())
    model, pred = FC.holdout(df, ["a", "b"], share=0.25, algo="rf", num_trees=10, max_depth=5)
    assert model is not None and {r.fold for r in pred.select("fold").distinct().collect()} == {3}
    assert pred.count() == df.where("id >= 113 AND temperatura IS NOT NULL").count()


def test_empty_and_unlabelled_tables(spark):
    _, df = frame(spark, 12)
    none = df.where("false")
    blank = df.selectExpr("id", "ts", "cast(null AS double) AS temperatura", "a", "b")
    for algo in ("lr", "rf", "gbt"):
        assert FC.out_of_fold(none, ["a", "b"], algo=algo).collect() == []
        assert FC.out_of_fold(blank, ["a", "b"], algo=algo).collect() == []
        assert FC.cross_validate(none, ["a", "b"], algo=algo).collect() == []
    model, pred = FC.holdout(none, ["a", "b"])
    assert model is None and pred.collect() == []
    model, pred = FC.train_temperature(none, ["a", "b"])
    assert model is None and pred.collect() == [] and "erro_absoluto" in pred.columns
    scaled = FC.scale_features(none, ["a", "b"])
    assert scaled.collect() == [] and "features" in scaled.columns
    late = df.selectExpr("id", "ts", "if(id > 8, temperatura, null) AS temperatura", "a", "b")
    assert all(r.temperatura_prevista is None for r in FC.out_of_fold(late, ["a", "b"], k=2, algo="rf").collect() if r.fold == 1)


def test_scores_of_one_row_or_a_constant_have_no_r2(spark):
    rows = [("a", "m", "t", 1.0, 2.0), ("b", "m", "t", 3.0, 3.0), ("b", "m", "t", 3.0, 4.0), ("c", "m", "t", 1.0, 1.0), ("c", "m", "t", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "estacao string, modelo string, alvo string, real double, imputado double")
    got = {r.estacao: (r.rmse, r.mae, r.r2, r.n) for r in score(df).collect()}
    assert got == {"a": (1.0, 1.0, None, 1), "b": (0.5 ** 0.5, 0.5, None, 2), "c": (0.0, 0.0, 1.0, 2)}
    assert score(df.where("false")).collect() == []


def test_missing_report_of_an_empty_table(spark):
    df = spark.createDataFrame([], "estacao string, temperatura double, umidade double, velocidade_vento double")
    assert {(r.faltantes, r.percentual, r.total) for r in missing_report(df).collect()} == {(0, None, 0)}


def test_training_uses_all_cores_whatever_the_layout(spark):
    from pyspark.sql import functions as F
    from horavento.operators import forecast as FC
    rows = spark.range(0, 300, 1, 1).select("id", F.lit("a").alias("estacao"), (F.col("id") % 24).cast("double").alias("temperatura"),
                                            (F.col("id") % 7).cast("double").alias("umidade"))
    model, pred = FC.train_temperature(rows, ["umidade"], num_trees=2, max_depth=2)
    assert len(pred.inputFiles()) > 1 and pred.count() == 300
