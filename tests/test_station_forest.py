"""Forests of all stations in one job: split rule, independence, gain."""

import random

import pytest
from pyspark.sql import functions as F

from horavento.operators import impute as M
from horavento.operators.station_forest import grow, predict

SCHEMA = "id long, estacao string, data string, hora int, temperatura double, umidade double, velocidade_vento double"
LIGHT = {"nome": "L", "n_estimators": 4, "max_depth": 2, "max_iter": 1}


def readings(seed, sizes, gap=0.1):
    rng, rows = random.Random(seed), []
    for name, n in sizes.items():
        for i in range(n):
            hour = i % 24
            t = 20 + 8 * (hour in range(8, 18)) + rng.gauss(0, 0.5)
            u = 90 - 2 * t + rng.gauss(0, 1)
            w = 3 + (hour > 12) + rng.gauss(0, 0.3)
            cells = [None if rng.random() < gap else v for v in (t, u, w)]
            rows.append((len(rows), name, f"2024-{1 + i // 24 % 12:02d}-{1 + i // 288 % 28:02d}", hour, *cells))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).withColumn("data", F.to_date("data")).repartition(parts)


def values(df):
    return {r.id: (r.temperatura, r.umidade, r.velocidade_vento) for r in df.collect()}


def near(a, b):
    return a.keys() == b.keys() and all(abs(x - y) < 1e-6 for i in a for x, y in zip(a[i], b[i]))


def test_a_station_is_imputed_as_if_alone(spark):
    rows = readings(1, {"a": 150, "b": 90, None: 60})
    whole = M.iterative_impute(frame(spark, rows), LIGHT, scope="per_station")
    got = values(whole)
    for name in (None,):
        alone = values(M.iterative_impute(frame(spark, [r for r in rows if r[1] == name], 1), LIGHT, scope="per_station"))
        assert near(alone, {i: got[i] for i in alone})
    known = {r[0]: r[4:] for r in rows}
    assert all(k is None or k == v for i in got for k, v in zip(known[i], got[i]))
    assert all(v is not None for row in got.values() for v in row) and set(whole.columns) >= {"id", "estacao", "data", "hora"}


def test_beats_the_station_mean(spark):
    full = readings(2, {"a": 400, "b": 200}, gap=0)
    rng = random.Random(3)
    holes = [(r[0], r[1], r[2], r[3], *[None if rng.random() < 0.15 else v for v in r[4:]]) for r in full]
    got = values(M.iterative_impute(frame(spark, holes), LIGHT, scope="per_station"))
    mean = values(M.mean_fill(frame(spark, holes)))
    error = lambda fill, k: sum((fill[r[0]][k] - r[4 + k]) ** 2 for r, h in zip(full, holes) if h[4 + k] is None)
    assert all(error(got, k) < 0.7 * error(mean, k) for k in range(3))


@pytest.mark.parametrize("min_leaf,min_split", [(5, 10), (30, 60)])
def test_split_rule(spark, min_leaf, min_split):
    """Every split leaves enough drawn rows, and the values are node means."""
    rng = random.Random(5)
    rows = [(i, "s", [rng.random(), rng.random()], 0.0) for i in range(100)]
    rows = [(i, s, x, 10 * (x[0] > 0.5) + rng.gauss(0, 1)) for i, s, x, _ in rows]
    df = spark.createDataFrame(rows, "id long, estacao string, x array<double>, y double")
    m = grow(df, "estacao", 3, 3, 7, min_leaf=min_leaf, min_split=min_split).first()
    from horavento.operators.station_forest import BINS, _draws
    size = 16
    for t in range(3):
        draws = {r.id: r.w for r in df.select("id", _draws("id", F.lit(t), 7).alias("w")).collect()}
        here = {1: [r for r in rows if draws[r[0]]]}
        for node in range(1, 8):
            f = m["_feature"][t * size + node]
            at = here.get(node, [])
            weight = lambda part: sum(draws[r[0]] for r in part)
            if at:
                assert abs(m["_value"][t * size + node] - sum(draws[r[0]] * r[3] for r in at) / weight(at)) < 1e-9
            if f is None:
                continue
            lo, hi = m["_lo"][f], m["_hi"][f]
            bin_of = lambda r: min(BINS - 1, int((r[2][f] - lo) / (hi - lo) * BINS))
            left = [r for r in at if bin_of(r) <= m["_cut"][t * size + node]]
            right = [r for r in at if bin_of(r) > m["_cut"][t * size + node]]
            assert weight(at) >= min_split and min(weight(left), weight(right)) >= min_leaf
            here[2 * node], here[2 * node + 1] = left, right
        assert m["_feature"][t * size + 1] == 0  # the informative feature parts the root


def test_small_and_empty_tables(spark):
    assert M.iterative_impute(frame(spark, []), LIGHT, scope="per_station").collect() == []
    rows = readings(6, {"a": 40}) + [(900, "one", "2024-01-01", 0, 5.0, None, None), (901, "none", "2024-01-01", 0, None, None, None),
                                     (902, "flat", "2024-01-01", 0, 1.0, 2.0, 3.0), (903, "flat", "2024-01-01", 1, None, 2.0, 3.0)]
    got = values(M.iterative_impute(frame(spark, rows), LIGHT, scope="per_station"))
    assert len(got) == 44 and all(v is not None for row in got.values() for v in row)
    assert got[900][0] == 5.0 and abs(got[903][0] - 1.0) < 1e-9
    scores = M.evaluate_imputer(frame(spark, rows), LIGHT, scope="per_station").collect()
    assert scores and all(r.rmse is not None for r in scores)


def test_groups_without_a_tree_predict_null(spark):
    df = spark.createDataFrame([(1, "a", [1.0], 2.0)], "id long, estacao string, x array<double>, y double")
    model = grow(df.where("false"), "estacao", 2, 2, 1)
    assert [r.p for r in predict(df, model, "estacao", 2, 2, "p").collect()] == [None]


@pytest.mark.parametrize("cells", [None, 1])
def test_level_sums_are_shuffled_as_sums(spark, monkeypatch, cells):
    """A slice of rows goes into the shuffle as one row per cell, not one per
    row, tree and feature, and the forest does not depend on the slices."""
    from horavento.operators import station_forest as S
    rows = [(i, [None, "a", "b"][i % 3], [float(i % 7), float(i % 5)], float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, estacao string, x array<double>, y double").repartition(2)
    if cells:
        monkeypatch.setattr(S, "CELLS", cells)
    made = []
    monkeypatch.setattr(S, "_level_sums", lambda *a, run=S._level_sums: made.append(run(*a)) or made[-1])
    got = {r.estacao: r.asDict() for r in grow(df, "estacao", 2, 2, 3).collect()}
    assert len(got) == 3 and [d.agg(F.count(F.lit(1))).first()[0] for d in made][0] <= 3 * 2 * (7 + 5)
    assert any("MapInArrow" in d._jdf.queryExecution().executedPlan().toString() for d in made)
    other = {r.estacao: r.asDict() for r in grow(df.repartition(5), "estacao", 2, 2, 3).collect()}
    assert all(got[k][c] == other[k][c] for k in got for c in ("_feature", "_cut", "_lo", "_hi"))


@pytest.mark.parametrize("scope", ["pooled", "per_station"])
def test_rounds_use_all_cores_whatever_the_layout(spark, monkeypatch, scope):
    monkeypatch.setattr(M, "DEALT_ROWS", 20)
    out = M.iterative_impute(frame(spark, readings(8, {"a": 120, "b": 80}), 1), LIGHT, scope=scope)
    assert len(out.inputFiles()) > 1 and out.count() == 200


def test_all_configurations_share_one_mask(spark, monkeypatch):
    made, plan = [], M.MaskPlan
    monkeypatch.setattr(M, "MaskPlan", lambda *a: made.append(a) or plan(*a))
    df = frame(spark, readings(9, {"a": 120, "b": 80}))
    configs = [LIGHT, {**LIGHT, "nome": "bad", "n_estimators": 0}, {**LIGHT, "nome": "M", "max_iter": 2}]
    scores, imputed, status = M.impute_all(df, configs)
    assert len(made) == 1
    assert [(r.modelo, r.status) for r in status.collect()] == [("L", "sucesso"), ("bad", "erro"), ("M", "sucesso")]
    assert {r.modelo: r["count"] for r in imputed.groupBy("modelo").count().collect()} == {"L": 200, "M": 200}
    alone = M.evaluate_imputer(df, LIGHT).select("estacao", "alvo", "n")
    assert sorted(alone.collect()) == sorted(scores.where("modelo = 'L'").select("estacao", "alvo", "n").collect())
