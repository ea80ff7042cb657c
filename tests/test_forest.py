"""Forests over all rows: splits against a plain search, cuts, blocks, the Spark ML model."""

import random

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from horavento.operators import forecast as FC
from horavento.operators import forest as G
from horavento.operators import impute as M
from horavento.session import materialize

SCHEMA = "id long, estacao string, a double, hora int, y double"


def table(spark, n, parts=3, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, hour = rng.random(), i % 24
        rows.append((i, rng.choice(["p", "q", None]), a if i % 11 else None, hour, 10 * (a > 0.5) + (hour > 12) + rng.gauss(0, 0.2)))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(parts)


def grown(df, monkeypatch=None, **more):
    features = ["a", "hora"]
    coded, sources, values = G.coded(df, features, 3, "estacao")
    layout = G.Layout(["y", *values], [s.column for s in sources], [])
    blocks = materialize(G.packed(coded, layout, ["id", "estacao", "hora"]), "test-blocks")
    cuts = G.value_cuts(blocks, layout, values)
    sources = sources + [G.value_source(c, features.index(c), cuts[c]) for c in values]
    return blocks, layout, sources, G.grow(blocks, layout, sources, G.reader("y", sources), 5.0, 3, 3, 7, **more)


def test_every_split_is_the_best_of_a_plain_search(spark, monkeypatch):
    monkeypatch.setattr(G, "SLICE", 50)
    _, df = table(spark, 400)
    blocks, layout, sources, forest = grown(df, min_leaf=5)
    held = [(k, h) for b in blocks.toArrow().to_batches() for k, h in layout.blocks(b)]
    keys, y = np.concatenate([k for k, _ in held]), np.concatenate([h["y"] for _, h in held])
    codes = np.concatenate([np.stack([s.code(h[s.column]) for s in sources]) for _, h in held], axis=1)
    assert len(set(keys.tolist())) == 400 and {s.column for s in sources} == {"_s0", "_s_hot", "a"}
    bins = {f: s.feature_bins(j)[c] for s, c in zip(sources, codes) for j, f in enumerate(s.features)}
    assert set(bins) == {0, 1, 2, 3, 4}
    for t, tree in enumerate(forest.trees):
        w = G.draws(keys, 7, 0)[:, t].astype(float)
        at, todo = {0: w > 0}, [0]
        while todo:
            node = todo.pop(0)
            here = at[node]
            assert abs(tree.value[node] - (w * y)[here].sum() / w[here].sum()) < 1e-9
            error = lambda m: (w * (y - (w * y)[m].sum() / w[m].sum()) ** 2)[m].sum()  # noqa: B023,E731
            best = max([error(here) - error(here & (bins[f] <= c)) - error(here & (bins[f] > c)) for f in bins for c in range(bins[f].max())
                        if min(w[here & (bins[f] <= c)].sum(), w[here & (bins[f] > c)].sum()) >= 5], default=0.0)
            f = tree.feature[node]
            if f < 0:
                assert best < 1e-9 or node >= len(tree.feature) - 8
                continue
            left = here & (bins[f] <= tree.cut[node])
            assert abs(tree.stats[node, 3] - best) < 1e-6 and min(w[left].sum(), w[here & ~left].sum()) >= 5
            at[tree.child[node]], at[tree.child[node] + 1] = left, here & ~left
            todo += [tree.child[node], tree.child[node] + 1]
    assert {0, 1} <= {int(f) for t in forest.trees for f in t.feature}


def test_cuts_follow_the_values(spark, monkeypatch):
    assert G.spread_cuts(np.array([1.0, 2.0, 5.0]), np.array([1, 1, 1])).tolist() == [1.5, 3.5]
    many = G.spread_cuts(np.arange(1000.0), np.ones(1000))
    assert len(many) == G.BINS - 1 and np.ptp(np.diff(many)) <= 1
    df = spark.range(5000).select((F.col("id") % 5000).cast("double").alias("v"), F.when(F.col("id") == 17, 9.0).otherwise(1.0).alias("rare"),
                                  F.when(F.col("id") > 2, F.lit(None)).otherwise(F.col("id") * 1.0).alias("few"))
    layout = G.Layout(["v", "rare", "few"], [], [])
    cuts = G.value_cuts(materialize(G.packed(df.repartition(4), layout, []), "test-cuts"), layout, layout.doubles)
    assert cuts["rare"].tolist() == [5.0] and cuts["few"].tolist() == [0.5, 1.5]
    assert len(cuts["v"]) == 31 and all(abs(c - 5000 * (i + 1) / 32) < 60 for i, c in enumerate(cuts["v"]))


def test_families_of_many_combinations_stand_alone(spark, monkeypatch):
    rows = [(i, "p", None, i % 24, float(i % 24)) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"mes": F.col("id") % 7, "dia": F.col("id") % 5})
    whole = G.coded(df, ["hora", "mes", "dia"], 3)
    monkeypatch.setattr(G, "CELLS", 8)
    apart = G.coded(df, ["hora", "mes", "dia"], 3)
    monkeypatch.setattr(G, "COMBINATIONS", 3)
    none = G.coded(df, ["hora", "mes", "dia"], 3)
    assert [s.codes for s in whole[1]] == [24, 35] and [s.features for s in apart[1]] == [[0], [1], [2]]
    assert (whole[2], apart[2], none[1], none[2]) == ([], [], [], ["hora", "mes", "dia"])
    assert whole[0].count() == apart[0].count() == 200


def test_the_model_is_a_spark_ml_forest(spark):
    _, df = table(spark, 600)
    model, pred = FC.train_temperature(df.withColumnRenamed("y", "temperatura"), ["a", "hora"], num_trees=8, max_depth=4)
    forest = model.stages[-1]
    assert forest.getNumTrees == 8 and forest.getMaxDepth() == 4 and max(t.depth for t in forest.trees) <= 4
    importance = forest.featureImportances.toArray()
    assert abs(importance.sum() - 1) < 1e-9 and importance[0] > 0.8
    assert pred.count() == 600 and FC.prediction_rmse(pred).first().rmse < 3
    assert set(pred.columns) & {"_s0", "_y", "first"} == set()
    one = model.transform(df.withColumn("a", F.lit(0.9)).limit(1)).first()["_p"]
    assert 8 < one < 12


def test_rows_go_to_the_workers_in_blocks(spark, monkeypatch):
    """A level reads a few blocks, not a row at a time, and no forest is fitted by Spark ML."""
    from pyspark.ml.regression import RandomForestRegressor
    monkeypatch.setattr(RandomForestRegressor, "fit", None)
    seen, run = [], M.grow_pooled
    monkeypatch.setattr(M, "grow_pooled", lambda blocks, *a: seen.append(blocks.count()) or run(blocks, *a))
    rows = [(i, "pq"[i % 2], "2024-01-01", i % 24, None if i % 9 == 0 else float(i % 24), 5.0 * (i % 3), None if i % 13 == 0 else 1.0 * (i % 5))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, estacao string, data string, hora int, temperatura double, umidade double, velocidade_vento double") \
        .withColumn("data", F.to_date("data"))
    out = M.iterative_impute(df, {"nome": "t", "n_estimators": 5, "max_depth": 5, "max_iter": 2})
    assert len(seen) == 4 and max(seen) <= 8
    got = {r.id: r for r in out.collect()}
    assert len(got) == 3000 and all(r.temperatura == rows[i][4] for i, r in got.items() if rows[i][4] is not None)
    assert sum((got[i].temperatura - i % 24) ** 2 for i in got if i % 9 == 0) / 334 < 2
    assert {"ts", "dia_ano", "estacao_vetor"} <= set(out.columns)


def test_explicit_features_and_vectors(spark):
    rows = [(i, "p", float(i % 8) if i % 6 else None, 1.0, 2.0, float(i % 8)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, estacao string, temperatura double, umidade double, velocidade_vento double, k double")
    df = VectorAssembler(inputCols=["k", "umidade"], outputCol="v").transform(df)
    out = M.iterative_impute(df, {"nome": "t", "n_estimators": 4, "max_depth": 4, "max_iter": 1}, features=["v"])
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == 300 and all(abs(r.temperatura - r.k) < 0.6 and r.v[0] == r.k for r in got)
