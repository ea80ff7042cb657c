"""Properties of merges, masks, numbering, batches, shares and imputation."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from horavento.operators import analysis as A
from horavento.operators import impute as M
from horavento.operators import windows as W
from horavento.operators.merge import merge_readings
from horavento.schemas import MODEL_CONFIGS, READING_KEY, TARGETS
from horavento.sources.tables import load_table, readings, readings_with_ts
from tests.conftest import SF001


def test_merge_is_idempotent(spark):
    r = readings(spark, SF001)
    stored = W.latest_per_key(r.where(F.dayofmonth("data") <= 20), READING_KEY, ["id"])
    inc = r.where(F.dayofmonth("data") >= 11)
    once = merge_readings(stored, inc, order=["id"], now="2024-03-01 00:00:00")
    twice = merge_readings(once.drop("acao"), inc, order=["id"], now="2024-03-01 00:00:00")
    cols = READING_KEY + TARGETS
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())
    assert twice.where(F.col("acao") == "inserido").count() == 0


def test_mask_sizes_exact(spark):
    r = readings(spark, SF001)
    mask = M.mask_cells(r)
    got = {(x.estacao, x.alvo): x["count"] for x in mask.groupBy("estacao", "alvo").count().collect()}
    long = r.select("estacao", F.explode(F.array(*[F.struct(F.lit(t).alias("alvo"), F.col(t).alias("v"))
                                                   for t in TARGETS])).alias("e"))
    n = {(x.estacao, x.alvo): x["count"] for x in long.where(F.col("e.v").isNotNull())
         .groupBy("estacao", F.col("e.alvo").alias("alvo")).count().collect()}
    for k, total in n.items():
        assert got.get(k, 0) == math.floor(total * 0.1)


def test_mask_is_seeded_and_stable(spark):
    r = readings(spark, SF001)
    a = sorted(M.mask_cells(r, seed=42).collect())
    b = sorted(M.mask_cells(r.repartition(7), seed=42).collect())
    c = sorted(M.mask_cells(r, seed=7).collect())
    assert a == b and a != c


def test_sequence_number_matches_row_number(spark):
    r = readings(spark, SF001).select("id", "estacao")
    ours = W.sequence_number(r, "estacao", ["id"], rows_per_bucket=7)
    ref = r.withColumn("rn", F.row_number().over(Window.partitionBy("estacao").orderBy("id")))
    assert sorted(ours.collect()) == sorted(ref.select("id", "estacao", "rn").collect())
    desc = W.sequence_number(r, "estacao", ["id"], rows_per_bucket=5, descending=True)
    ref_d = r.withColumn("rn", F.row_number().over(Window.partitionBy("estacao").orderBy(F.desc("id"))))
    assert sorted(desc.collect()) == sorted(ref_d.select("id", "estacao", "rn").collect())


def test_batches_cover_rows_once(spark):
    r = readings_with_ts(spark, SF001)
    b = W.telemetry_batches(r, 50)
    assert b.agg(F.sum("n_pontos")).first()[0] == r.count()
    assert b.agg(F.max("n_pontos")).first()[0] <= 50
    ids = b.select(F.explode("payload.rn")).count()
    assert ids == r.count()


def test_wind_shares_sum_to_100(spark):
    for row in A.wind_share(readings(spark, SF001)).collect():
        assert math.isclose(sum(v for k, v in row.asDict().items() if k != "estacao"), 100.0, rel_tol=1e-9)


def test_latest_per_key_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), (None, 3, 3.0), (None, 4, 4.0)],
                               "estacao string, id long, v double")
    out = sorted(W.latest_per_key(df, ["estacao"], ["id"]).collect(), key=lambda r: r.id)
    assert [(r.estacao, r.id) for r in out] == [("a", 2), (None, 3), (None, 4)]


def test_iterative_impute_fills_and_keeps_observed(spark):
    r = readings(spark, SF001)
    out = M.iterative_impute(r, MODEL_CONFIGS[0]).select("id", *[F.col(t).alias(f"o_{t}") for t in TARGETS])
    assert out.count() == r.count()
    for t in TARGETS:
        assert out.where(F.col(f"o_{t}").isNull()).count() == 0
    j = r.join(out, "id")
    for t in TARGETS:
        assert j.where(F.col(t).isNotNull() & (F.col(t) != F.col(f"o_{t}"))).count() == 0


def test_imputer_beats_mean_on_dependent_data(spark):
    """Temperature derived from lineitem's quantity and discount (a known
    dependence); the forest must beat the per-group mean on masked cells."""
    li = load_table(spark, SF001, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                   "l_extendedprice", "l_shipdate"), F.col("l_returnflag"), F.col("l_shipdate"),
        F.col("l_quantity") * 10 + F.col("l_discount") * 100, F.col("l_quantity"), F.col("l_discount"))
    df = li.toDF("id", "estacao", "ts", "temperatura", "umidade", "velocidade_vento") \
        .withColumn("data", F.col("ts").cast("date")).withColumn("hora", F.hour("ts")).drop("ts")
    mask = M.mask_cells(df, ["temperatura"])
    masked = M.apply_mask(df, ["temperatura"])
    imputed = M.iterative_impute(masked, {"nome": "t", "n_estimators": 10, "max_depth": 5, "max_iter": 2})
    mean = M.mean_fill(masked, TARGETS)
    s_rf = A.score(M.masked_pairs_long(mask, imputed).withColumn("modelo", F.lit("rf")), by=[])
    s_mu = A.score(M.masked_pairs_long(mask, mean).withColumn("modelo", F.lit("mu")), by=[])
    assert s_rf.first().rmse < 0.5 * s_mu.first().rmse


def test_time_folds_are_ordered(spark):
    from horavento.operators.forecast import time_folds
    f = time_folds(readings_with_ts(spark, SF001), 4)
    rows = sorted(f.groupBy("fold").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).collect())
    assert [r.fold for r in rows] == [0, 1, 2, 3]
    for x, y in zip(rows, rows[1:]):
        assert x.b <= y.a


def test_exact_quantiles_equal_percentile(spark):
    from horavento.operators.quantiles import exact_quantiles
    r = readings(spark, SF001).withColumn("const", F.lit(3.0)) \
        .withColumn("coarse", F.floor(F.col("temperatura") / 50) * 50)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    for col in ("temperatura", "const", "coarse"):
        for size in (7, None):
            for by in ("estacao", None):
                got = exact_quantiles(r, col, probs, by, rows_per_bucket=size)
                g = r.where(F.col(col).isNotNull())
                g = g.groupBy(by) if by else g.groupBy()
                want = g.agg(*[F.percentile(col, p).alias(f"q_{i}") for i, p in enumerate(probs)])
                key = [by] if by else []
                a = {tuple(x[k] for k in key): [x[f"q_{i}"] for i in range(len(probs))] for x in got.collect()}
                b = {tuple(x[k] for k in key): [x[f"q_{i}"] for i in range(len(probs))] for x in want.collect()}
                assert a.keys() == b.keys()
                for k in a:
                    for u, v in zip(a[k], b[k]):
                        assert math.isclose(u, v, rel_tol=1e-12, abs_tol=1e-9), (col, size, by, k)


def test_row_lags_match_window_across_buckets(spark):
    r = readings(spark, SF001).select("id", "estacao", "temperatura")
    ours = W.rolling_mean(r, 3)
    w = Window.partitionBy("estacao").orderBy("id")
    ref = r.select("estacao", "id", F.avg("temperatura").over(w.rowsBetween(-2, 0)).alias("m"),
                   (F.col("temperatura") - F.lag("temperatura").over(w)).alias("d"))
    small = W.row_lags(r, "estacao", ["id"], "temperatura", 4, rows_per_bucket=3)
    ref4 = r.select("id", *[F.lag("temperatura", d).over(w).alias(f"l{d}") for d in (1, 2, 3)])
    a = {x.id: (x._lag1, x._lag2, x._lag3) for x in small.collect()}
    b = {x.id: (x.l1, x.l2, x.l3) for x in ref4.collect()}
    assert a == b
    m = {x.id: x.m for x in ref.collect()}
    for x in ours.collect():
        assert (x.temp_media_3h is None and m[x.id] is None) or math.isclose(x.temp_media_3h, m[x.id], rel_tol=1e-9)
    d = {x.id: x.d for x in ref.collect()}
    for x in W.lag_diff(r).collect():
        assert (x.temp_diff is None and d[x.id] is None) or math.isclose(x.temp_diff, d[x.id], rel_tol=1e-9)


def test_per_station_scope(spark):
    r = readings(spark, SF001).where(F.col("estacao").isin("click", "view"))
    cfg = {"nome": "t", "n_estimators": 3, "max_depth": 2, "max_iter": 1}
    out = M.iterative_impute(r, cfg, scope="per_station")
    assert out.count() == r.count()
    assert not any(c.startswith("estacao_") for c in out.columns)
    for t in TARGETS:
        assert out.where(F.col(t).isNull()).count() == 0


def test_hot_station_is_split_into_bounded_buckets(spark):
    """One station with ~60% of the rows is cut into ranges of about
    ``rows_per_bucket`` rows, and numbering stays exact."""
    from horavento.operators.windows import _bucketize
    r = readings(spark, SF001).withColumn(
        "estacao", F.when(F.col("estacao").isin("click", "view", "error"), "hot").otherwise(F.col("estacao")))
    n_hot = r.where(F.col("estacao") == "hot").count()
    assert n_hot > 0.5 * r.count()
    b = _bucketize(r, ["estacao"], ["id"], 100, False)
    sizes = [x["count"] for x in b.where(F.col("estacao") == "hot").groupBy("_sb").count().collect()]
    assert len(sizes) >= n_hot // 100 and max(sizes) <= 200
    ours = W.sequence_number(r, "estacao", ["id"], rows_per_bucket=100)
    ref = r.withColumn("rn", F.row_number().over(Window.partitionBy("estacao").orderBy("id")))
    assert sorted(ours.select("id", "rn").collect()) == sorted(ref.select("id", "rn").collect())


def test_outliers_and_equal_keys_do_not_fill_a_range(spark):
    """One stray early key, and one order value for all rows: ranges stay even."""
    from horavento.operators.windows import _bucketize
    rows = spark.range(20_000).selectExpr("'a' AS estacao", "id", "IF(id = 0, -1000000000000, id + 1000) AS k", "1 AS same")
    for order in (["k", "id"], ["same", "id"]):
        sizes = [x["count"] for x in _bucketize(rows, ["estacao"], order, 1000, False).groupBy("_sb").count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 2_000
    ours = W.sequence_number(rows, "estacao", ["same", "id"], rows_per_bucket=1000)
    assert ours.where("rn <> id + 1").count() == 0


def test_lags_of_a_null_station(spark):
    r = readings(spark, SF001).select("id", F.when(F.col("id") % 3 > 0, F.col("estacao")).alias("estacao"), "temperatura")
    w = Window.partitionBy("estacao").orderBy("id")
    want = {x.id: x.l for x in r.select("id", F.lag("temperatura").over(w).alias("l")).collect()}
    got = {x.id: x._lag1 for x in W.row_lags(r, "estacao", ["id"], "temperatura", 2, rows_per_bucket=5).collect()}
    assert got == want


def test_tail_of_any_size(spark):
    r = readings_with_ts(spark, SF001)
    for n in (3, 1001):
        w = Window.partitionBy("estacao").orderBy(F.desc("ts"), F.desc("id"))
        want = r.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
        assert sorted(x.id for x in W.tail_per_key(r, n).collect()) == sorted(x.id for x in want.collect())


def test_many_ranges_do_not_make_many_tasks(spark):
    """The ranges of one task are cut by position: no task per range."""
    from horavento.operators.windows import _bucketize
    rows = spark.range(20_000).selectExpr("IF(id % 3 > 0, 'a', NULL) AS estacao", "id", "CAST(id % 11 AS DOUBLE) AS temperatura")
    most, tasks = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranges", "")
    sizes = [x["count"] for x in _bucketize(rows, ["estacao"], ["id"], 10, False).groupBy("_sb").count().collect()]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tasks.getJobIdsForGroup("ranges") for s in tasks.getJobInfo(j).stageIds]
    assert max(tasks.getStageInfo(s).numTasks for s in stages if tasks.getStageInfo(s)) <= most + 8
    assert sum(sizes) == 20_000 and max(sizes) <= 10
    ours = {r.id: (r.rn, r._lag1, r._lag2) for r in W.row_lags(rows, "estacao", ["id"], "temperatura", 3, 10).collect()}
    w = Window.partitionBy("estacao").orderBy("id")
    want = rows.select("id", F.row_number().over(w), F.lag("temperatura").over(w), F.lag("temperatura", 2).over(w))
    assert ours == {r[0]: tuple(r[1:]) for r in want.collect()}
