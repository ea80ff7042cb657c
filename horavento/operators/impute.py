"""Masked evaluation and iterative imputation.

* ``mask_cells`` picks exactly ``floor(n * ratio)`` known cells per station
  and target in a seeded hash order (``md5(seed|target|id)``): deterministic,
  partition-independent and reproducible in any SQL engine.  Selection uses
  a histogram of the hash prefix, with more buckets the more cells there are,
  and only one bucket per group is ranked.
* ``iterative_impute`` is round-robin regression imputation: start from the
  per-station mean, then for each round and target grow a random forest
  (``forest``) on the rows where the target was observed and overwrite only
  the missing cells.  Each round is written to the shared checkpoint folder,
  which cuts the lineage and survives executor loss; within a round the
  forests grown so far fill the missing cells as the rows are read.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from horavento.functions.telemetry import to_long
from horavento.functions.temporal import one_hot, station_slug, temporal_features
from horavento.operators.analysis import score
from horavento.operators.forest import Layout, Source, coded, grow as grow_pooled, packed, value_cuts, value_source
from horavento.operators.station_forest import grow, predict
from horavento.schemas import (
    EVALUATION_RATIO, MIN_SAMPLES_LEAF, MIN_SAMPLES_SPLIT, MODEL_CONFIGS, RANDOM_STATE, TARGETS, TEMPORAL_FEATURES,
)
from horavento.session import materialize


def hash_order(seed: int, target, id_col: str = "id"):
    """Seeded, engine-independent hash text for a (target, id) cell."""
    t = F.lit(target) if isinstance(target, str) else target
    return F.md5(F.concat_ws("|", F.lit(str(seed)), t, F.col(id_col).cast("string")))


#: cells ranked per group, about: the hash buckets are made this small
MASK_BUCKET_ROWS = 4096


def _masked_long(df: DataFrame, targets: list[str], seed: int, by: str) -> DataFrame:
    """Known cells in long form with their seeded hash order key."""
    long = to_long(df, ["id", by], targets, "alvo", "real").where(F.col("real").isNotNull())
    h = hash_order(seed, F.col("alvo"))
    return long.withColumn("_h", h) \
        .withColumn("_h60", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long"))


def _mask_cuts(long: DataFrame, ratio: float, by: str) -> DataFrame:
    """Per (group, target): the bucket holding the k-th cell and how many of
    its cells are still to mask.  Built from one partial aggregate."""
    keys = [by, "alvo"]
    counts = long.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w_all = Window.partitionBy(*keys)
    w_cum = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("_tot", F.sum("_n").over(w_all)).withColumn("_cum", F.sum("_n").over(w_cum))
    k = F.floor(F.col("_tot").cast("double") * F.lit(float(ratio))).cast("long")
    return cum.withColumn("_k", k) \
        .where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_n") < F.col("_k"))) \
        .select(*keys, F.col("_b").alias("_cut"), (F.col("_k") - (F.col("_cum") - F.col("_n"))).alias("_rest"))


def _edge(tagged: DataFrame, by: str) -> DataFrame:
    """Exact ranking inside the cut bucket only."""
    at = tagged.where(F.col("_b") == F.col("_cut"))
    w = Window.partitionBy(by, "alvo").orderBy("_h60", "_h")
    return at.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.col("_rest"))


#: imputations of ``impute_all`` at a time
FITS = 6
#: rows of a task, at least, where that needs fewer tasks than cores
DEALT_ROWS = 25_000
#: rows of a task, at most
TASK_ROWS = 1 << 20


class MaskPlan:
    """The hashed long cells and the per-group cut table of one mask.

    Building both once and sharing them between ``mask_cells`` and
    ``apply_mask`` gives one plan with identical subtrees, so Spark reuses
    their exchanges instead of recomputing them."""

    def __init__(self, df: DataFrame, targets: list[str] = TARGETS, ratio: float = EVALUATION_RATIO,
                 seed: int = RANDOM_STATE, by: str = "estacao"):
        self.targets, self.seed, self.by = list(targets), seed, by
        # every branch reads this one copy: the cells are hashed once
        long = materialize(_masked_long(df, self.targets, seed, by), "mask-cells")
        self.shift = 60 - min(44, max(4, (long.count() // MASK_BUCKET_ROWS).bit_length()))
        self.long = long.withColumn("_b", F.shiftright("_h60", self.shift))
        # one row per (group, target), read by every branch: computed once
        self.cuts = materialize(_mask_cuts(self.long, ratio, by), "mask-cuts")
        cuts = self.cuts.withColumnsRenamed({by: "_g", "alvo": "_t"})
        self.tagged = self.long.join(cuts, F.col(by).eqNullSafe(F.col("_g")) & (F.col("alvo") == F.col("_t")),
                                     "inner").drop("_g", "_t")
        self._edge = None

    def edge(self) -> DataFrame:
        """Masked cells of the cut buckets (a few per group), computed once."""
        if self._edge is None:
            self._edge = materialize(_edge(self.tagged, self.by).select(self.by, "alvo", "id", "real"),
                                     "mask-edge")
        return self._edge


def mask_cells(df: DataFrame, targets: list[str] = TARGETS, ratio: float = EVALUATION_RATIO,
               seed: int = RANDOM_STATE, by: str = "estacao", plan: MaskPlan | None = None) -> DataFrame:
    """Exactly ``floor(n * ratio)`` known cells per (station, target), chosen
    in seeded hash order (W2, T13).  Returns ``(estacao, alvo, id, real)``.

    The hash is uniform, so its leading bits cut every group into buckets of
    near-equal size, about ``MASK_BUCKET_ROWS`` cells for a group that holds
    them all.  One partial aggregate counts cells per (group, target, bucket);
    a running sum over that small table finds, per group, the bucket where the
    ``k``-th cell falls.  Cells in earlier buckets are masked outright; only
    the cells of that one bucket are ranked exactly."""
    plan = plan or MaskPlan(df, targets, ratio, seed, by)
    by = plan.by
    # the cut table has one row per (group, target): joined without shuffling the cells
    below = plan.tagged.where(F.col("_b") < F.col("_cut")).select(by, "alvo", "id", "real")
    return below.unionByName(plan.edge())


def apply_mask(df: DataFrame, targets: list[str] = TARGETS, ratio: float = EVALUATION_RATIO,
               seed: int = RANDOM_STATE, by: str = "estacao", plan: MaskPlan | None = None) -> DataFrame:
    """The readings with the ``mask_cells`` cells blanked, computed row-wise.

    Each cell's hash bucket is compared with its group's cut (a small table
    pivoted to one row per station and joined by station); only rows with a
    cell inside a cut bucket are matched against the exact edge ranking by id.  The readings themselves are never
    shuffled."""
    plan = plan or MaskPlan(df, targets, ratio, seed, by)
    targets, by, seed = plan.targets, plan.by, plan.seed
    edge = plan.edge() \
        .groupBy("id").agg(*[F.max(F.when(F.col("alvo") == t, F.lit(True))).alias(f"_e_{t}")
                             for t in targets])
    wide_cuts = plan.cuts.groupBy(by).agg(
        *[F.max(F.when(F.col("alvo") == t, F.col("_cut"))).alias(f"_c_{t}") for t in targets])
    bucket = {t: F.shiftright(F.conv(F.substring(hash_order(seed, t), 1, 15), 16, 10).cast("long"),
                              plan.shift) for t in targets}
    tagged = df.join(wide_cuts.withColumnRenamed(by, "_g"), F.col(by).eqNullSafe(F.col("_g")), "left").drop("_g").withColumns({f"_b_{t}": bucket[t] for t in targets})
    at_edge = F.lit(False)
    for t in targets:
        at_edge = at_edge | (F.col(t).isNotNull() & (F.col(f"_b_{t}") == F.col(f"_c_{t}")))
    common = tagged.where(~at_edge)
    rare = tagged.where(at_edge).join(edge, "id", "left")
    for t in targets:
        common = common.withColumn(f"_e_{t}", F.lit(None).cast("boolean"))

    def cell(c):
        if c not in targets:
            return F.col(c)
        hit = (F.col(f"_b_{c}") < F.col(f"_c_{c}")) | F.coalesce(F.col(f"_e_{c}"), F.lit(False))
        return F.when(F.col(c).isNotNull() & hit, F.lit(None).cast("double")).otherwise(F.col(c)).alias(c)

    def blank(frame):
        return frame.select(*[cell(c) for c in df.columns])
    return blank(common).unionByName(blank(rare))


def mean_fill_pairs(mask: DataFrame, masked: DataFrame, targets: list[str] = TARGETS,
                    by: str = "estacao") -> DataFrame:
    """Masked truth paired with the mean-fill value of its cell: the station
    mean of the unmasked values, joined by (station, target) -- a small side."""
    means = materialize(masked.groupBy(by).agg(*[F.avg(t).alias(t) for t in targets])
                        .unpivot([by], targets, "alvo", "imputado"), "mean-fill-pairs")
    means = means.withColumnsRenamed({by: "_g", "alvo": "_t"})
    return mask.join(means, F.col(by).eqNullSafe(F.col("_g")) & (F.col("alvo") == F.col("_t")), "inner").drop("_g", "_t")


def mean_fill(df: DataFrame, targets: list[str] = TARGETS, by: str | None = "estacao",
              fallback: dict[str, float] | None = None) -> DataFrame:
    """Missing cells -> mean of the observed values of the group (M2); a group
    without any takes the overall mean, and a measure without any value its
    ``fallback``, 0 by default."""
    if by:
        # one row per station: written once and broadcast, so a hot station is not shuffled
        means = materialize(
            df.groupBy(by).agg(*[F.avg(t).alias(f"_mu_{t}") for t in targets]), "mean-fill")
        j = df.join(means.withColumnRenamed(by, "_g"), F.col(by).eqNullSafe(F.col("_g")), "left").drop("_g")
    else:
        # overall means are scalar subqueries: computed once, inlined as values
        j = df.withColumns({f"_mu_{t}": df.select(F.avg(t)).scalar() for t in targets})
    overall = {t: df.select(F.avg(t)).scalar() for t in targets}
    return j.select(*[F.coalesce(F.col(c), F.col(f"_mu_{c}"), overall[c], F.lit((fallback or {}).get(c) or 0.0)).alias(c) if c in targets else F.col(c)
                      for c in df.columns])


def assemble_features(df: DataFrame, by: str = "estacao", stations: list[str] | None = None,
                      pooled: bool = True) -> tuple[DataFrame, list[str]]:
    """Ten temporal features plus the station when pooled (M1, T15): one 0/1
    column per name of an explicit ``stations`` list, else one sparse vector
    column ``<by>_vetor`` for any number of stations (NULL is its last slot)."""
    out = temporal_features(df, "data", "hora")
    feats = list(TEMPORAL_FEATURES)
    if pooled and stations is not None:
        out = one_hot(out, by, stations)
        feats += sorted(f"{by}_{s}" for s in stations)
    elif pooled:
        index = StringIndexer(inputCol=by, outputCol=f"{by}_indice", handleInvalid="keep", stringOrderType="alphabetAsc")
        slots = OneHotEncoder(inputCol=f"{by}_indice", outputCol=f"{by}_vetor", dropLast=False, handleInvalid="keep")
        out = Pipeline(stages=[index, slots]).fit(out).transform(out).drop(f"{by}_indice")
        feats.append(f"{by}_vetor")
    return out, feats


def _dealt(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows over all cores, whatever files or row groups they came in: the
    rounds keep the layout of the first table.  A few ``rows`` are dealt over
    fewer tasks of ``DEALT_ROWS``, very many over more of ``TASK_ROWS``."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores if rows is None else max(1, min(cores, -(-rows // DEALT_ROWS)), rows // TASK_ROWS))


def _persist_round(df: DataFrame, tag: str) -> DataFrame:
    """Write a round to the shared checkpoint folder and read it back."""
    return materialize(df, tag)


def iterative_impute(df: DataFrame, config: dict, targets: list[str] = TARGETS,
                     features: list[str] | None = None, by: str = "estacao",
                     seed: int = RANDOM_STATE, scope: str = "pooled",
                     fallback: dict[str, float] | None = None) -> DataFrame:
    """Round-robin random-forest imputation (M3, M4).

    Targets are visited fewest-missing first; observed cells never change;
    every missing cell gets a value.  ``scope="pooled"`` fits one model per
    target and round over all stations with station one-hots;
    ``scope="per_station"`` reproduces the reference's split: one imputer per
    station, without one-hots (T15), each in its own order of targets; all
    stations' forests of a step are grown in one job (``station_forest``).
    A split of the pooled forests leaves MIN_SAMPLES_LEAF rows on both sides
    and so needs MIN_SAMPLES_SPLIT, twice as many, without being told."""
    if scope == "per_station":
        return _impute_stations(df, config, targets, by, seed)
    own = features is None
    rows, features = assemble_features(df, by, pooled=False) if own else (df, list(features))
    rows, features, vectors = _scalars(rows, features)
    plain = df.columns if own else rows.columns
    miss = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(t).isNull()).alias(t) for t in targets],
                  *[F.avg(F.col(t).cast("double")).alias(f"_mu_{t}") for t in targets]).first()
    order = sorted(targets, key=lambda t: (miss[t], targets.index(t)))
    # nothing missing, or nothing to learn from: the mean stays
    order = [t for t in order if miss[t] > 0 and miss["_n"] - miss[t] >= 2]
    flags = {t: f"_miss_{t}" for t in targets}
    rows, sources, values = coded(rows, features, int(config["max_depth"]), by if own else None) if order else (rows, [], [])
    cur = mean_fill(rows.withColumns({flags[t]: F.col(t).isNull() for t in targets}), targets, by, fallback)
    cur = _dealt(cur.select(*plain, *flags.values(), *[c for c in values if c not in plain], *[s.column for s in sources]), miss["_n"])
    kind = cur.select(*plain).schema
    layout = Layout(list(targets) + values, [s.column for s in sources], list(flags.values()))
    if order:
        cur = _persist_round(packed(cur, layout, [c for c in plain if c not in targets]), "impute-init")
    for rnd in range(int(config["max_iter"]) if order else 0):
        cuts, fills = value_cuts(cur, layout, layout.doubles), []
        for t in order:
            others = [c for c in targets if c != t]
            # the numbers of the features: the other targets, the features, the stations
            at = [value_source(c, i, cuts[c]) for i, c in enumerate(others)]
            at += [replace(s, features=[f + len(others) for f in s.features]) for s in sources]
            at += [value_source(c, len(others) + features.index(c), cuts[c]) for c in values]
            forest = grow_pooled(cur, layout, at, _reading(t, at, list(fills)), miss[f"_mu_{t}"],
                                 int(config["n_estimators"]), int(config["max_depth"]), seed + rnd, MIN_SAMPLES_LEAF)
            fills.append((t, forest))
        # one write per round: bounded lineage, restartable after executor loss
        if rnd + 1 < int(config["max_iter"]):
            cur = _persist_round(cur.mapInArrow(_filling(layout, fills), cur.schema), f"impute-r{rnd}")
        else:
            cur = cur.mapInArrow(_filling(layout, fills, kind.names), kind)
    if order and int(config["max_iter"]) < 1:
        cur = cur.mapInArrow(_filling(layout, [], kind.names), kind)
    out = _persist_round(cur.select(*plain), "impute-rows")
    for c, n in vectors.items():
        out = out.withColumn(c, array_to_vector(F.array(*[F.col(f"_{c}_{i}") for i in range(n)]))).drop(*[f"_{c}_{i}" for i in range(n)])
    return assemble_features(out, by)[0] if own else out.select(*df.columns)


def _scalars(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str], dict[str, int]]:
    """Vector columns as one column per slot, and how many each has."""
    vectors, plain = {}, []
    for c in [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]:
        slots = vector_to_array(c)
        first = df.where(F.col(c).isNotNull()).select(F.size(slots).alias("n")).first()
        vectors[c] = first["n"] if first else 0
        df = df.withColumns({f"_{c}_{i}": F.get(slots, F.lit(i)) for i in range(vectors[c])}).drop(c)
    for c in features:
        plain += [f"_{c}_{i}" for i in range(vectors[c])] if c in vectors else [c]
    return df, plain, vectors


def _filled(held: dict[str, np.ndarray], fills) -> dict[str, np.ndarray]:
    """The columns of a block after the forests of ``fills``, in this order,
    gave the missing cells their values."""
    held = dict(held)
    for t, forest in fills:
        at = np.flatnonzero(held[f"_miss_{t}"])
        if len(at):
            column = held[t].copy()
            column[at] = forest.predictor()(np.stack([s.code(held[s.column][at]) for s in forest.sources]))
            held[t] = column
    return held


def _reading(label: str, sources: list[Source], fills):
    """``read`` of a forest that learns ``label`` from the rows that have it,
    after the ``fills`` of its round."""
    def read(keys, held):
        at = np.flatnonzero(~held[f"_miss_{label}"])
        held = _filled(held, fills)
        return keys[at], held[label][at], np.stack([s.code(held[s.column][at]) for s in sources])
    return read


def _filling(layout: Layout, fills, columns: list[str] | None = None):
    """Blocks with the missing cells of a round's targets filled, or, with
    ``columns``, their rows."""
    def run(batches):
        for batch in batches:
            for i, (_, held) in enumerate(layout.blocks(batch)):
                held = _filled(held, fills)
                if columns is None:
                    flat = np.concatenate([held[c] for c in layout.doubles]).tobytes()
                    one = batch.slice(i, 1)
                    yield one.set_column(one.schema.get_field_index("doubles"), "doubles", pa.array([flat], pa.binary()))
                else:
                    rest = pa.ipc.open_stream(batch["rest"][i].as_buffer()).read_all().combine_chunks()
                    yield pa.RecordBatch.from_arrays([rest[c].combine_chunks() if c in rest.column_names else pa.array(held[c]) for c in columns], columns)
    return run


def _impute_stations(df: DataFrame, config: dict, targets: list[str], by: str, seed: int) -> DataFrame:
    """One imputer per station, all in the same jobs.

    Each station visits its targets fewest-missing first; step ``s`` grows the
    forests of every station's s-th target at once.  A station without any
    value of a target keeps the overall mean, one whose known rows were never
    drawn its own mean."""
    trees, depth = int(config["n_estimators"]), int(config["max_depth"])
    rows, features = assemble_features(df, by, pooled=False)
    flags = {t: f"_miss_{t}" for t in targets}
    counts = df.groupBy(by).agg(*[F.count_if(F.col(t).isNull()).alias(t) for t in targets])
    order = F.transform(F.array_sort(F.array(*[F.struct(F.col(t).alias("n"), F.lit(i).alias("i")) for i, t in enumerate(targets)])),
                        lambda s: s["i"])
    order = materialize(counts.select(F.col(by).alias("_g"), order.alias("_order")), "impute-order")
    cur = mean_fill(rows.withColumns({flags[t]: F.col(t).isNull() for t in targets}), targets, by)
    cur = _persist_round(_dealt(cur.join(order, F.col(by).eqNullSafe(F.col("_g")), "left").drop("_g")), "impute-init")
    for rnd in range(int(config["max_iter"])):
        for s in range(len(targets)):
            step = F.get("_order", F.lit(s))
            pick = lambda cols: F.element_at(F.array(*cols), step + 1)
            others = F.filter(F.array(*[F.col(t).cast("double") for t in targets]), lambda v, i: i != step)
            cur = cur.withColumns({"_x": F.concat(others, F.array(*[F.col(f).cast("double") for f in features])),
                                   "_blank": pick([F.col(flags[t]) for t in targets])})
            train = cur.where(~F.col("_blank")).select("id", by, "_x", pick([F.col(t) for t in targets]).alias("_label"))
            model = grow(train, by, trees, depth, seed + rnd, "_x", "_label")
            cur = predict(cur, model, by, trees, depth, "_pred", "_x")
            cur = cur.withColumns({t: F.when(F.col("_blank") & (step == i), F.coalesce("_pred", t)).otherwise(F.col(t))
                                   for i, t in enumerate(targets)}).drop("_x", "_blank", "_pred")
            # the next step reads it several times
            cur = _persist_round(cur, f"impute-r{rnd}s{s}")
    return cur.drop("_order", *flags.values())


def masked_pairs_long(truth: DataFrame, imputed: DataFrame, targets: list[str] = TARGETS) -> DataFrame:
    """Masked truth joined with the imputed value of the same cell."""
    imp = to_long(imputed, ["id"], targets, "alvo", "imputado")
    return truth.join(imp, ["id", "alvo"], "inner")


def masked_frame(df: DataFrame, targets: list[str] = TARGETS, by: str = "estacao",
                 ratio: float = EVALUATION_RATIO, seed: int = RANDOM_STATE) -> tuple[DataFrame, DataFrame]:
    """The mask and the readings without its cells, each written once: an
    imputation reads them many times, and every configuration the same ones."""
    plan = MaskPlan(df, targets, ratio, seed, by)
    mask = _persist_round(mask_cells(df, plan=plan), "mask")
    return mask, _persist_round(_dealt(apply_mask(df, plan=plan)), "masked")


def evaluate_imputer(df: DataFrame, config: dict, targets: list[str] = TARGETS,
                     by: str = "estacao", ratio: float = EVALUATION_RATIO,
                     seed: int = RANDOM_STATE, scope: str = "pooled",
                     frame: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Mask, impute, score on the masked cells (M5): long scores.  ``frame``
    is the ``masked_frame`` of ``df`` where it is at hand."""
    mask, masked = frame or masked_frame(df, targets, by, ratio, seed)
    imputed = iterative_impute(masked, config, targets, by=by, seed=seed, scope=scope)
    pairs = masked_pairs_long(mask, imputed, targets)
    return score(pairs.withColumn("modelo", F.lit(config["nome"])), by=(by, "modelo", "alvo"))


def impute_final(df: DataFrame, config: dict, targets: list[str] = TARGETS,
                 by: str = "estacao", seed: int = RANDOM_STATE, scope: str = "pooled") -> DataFrame:
    """Refit on the original data and impute it."""
    out = iterative_impute(df, config, targets, by=by, seed=seed, scope=scope)
    return out.select("id", by, "data", "hora", *targets).withColumn("modelo", F.lit(config["nome"]))


def impute_all(df: DataFrame, configs: list[dict] = MODEL_CONFIGS, targets: list[str] = TARGETS,
               by: str = "estacao", seed: int = RANDOM_STATE, scope: str = "pooled"):
    """Every configuration: scores, final imputation and a status row each;
    a failing configuration is recorded, not fatal (M7).

    Returns ``(scores, imputed, status)`` DataFrames."""
    spark = df.sparkSession
    try:  # one copy of the rows and one mask for all; where they fail, so does every configuration
        df = _persist_round(_dealt(df), "readings")
        frame, broken = masked_frame(df, targets, by, seed=seed), None
    except Exception as e:
        frame, broken = None, e

    def timed(work):
        t0 = time.time()
        if broken is not None:
            return None, str(broken), time.time() - t0
        try:
            return work(), None, time.time() - t0
        except Exception as e:  # isolate the failing configuration
            return None, str(e), time.time() - t0

    def scored(cfg):
        return timed(lambda: _persist_round(evaluate_imputer(df, cfg, targets, by, seed=seed, scope=scope, frame=frame), "scores"))

    def filled(cfg):
        return timed(lambda: impute_final(df, cfg, targets, by, seed, scope))

    # the jobs of one fit are short and follow each other: several fits fill the cores
    with ThreadPoolExecutor(FITS) as pool:
        run = lambda f, cfg: pool.submit(inheritable_thread_target(spark)(f), cfg)
        started = {k: (run(scored, configs[k]), run(filled, configs[k]))
                   for k in sorted(range(len(configs)), key=lambda k: -configs[k]["max_iter"])}
        done = [[f.result() for f in started[k]] for k in range(len(configs))]
    scores, imputed, status = [], [], []
    for cfg, ((s, e1, t1), (f, e2, t2)) in zip(configs, done):
        error = e1 if e1 is not None else e2
        if error is None:
            scores.append(s)
            imputed.append(f)
        status.append((cfg["nome"], "sucesso" if error is None else "erro", error, t1 + t2))
    st = spark.createDataFrame(status, "modelo string, status string, erro string, duracao_segundos double")
    from functools import reduce
    sc = reduce(DataFrame.unionByName, scores) if scores else None
    im = reduce(DataFrame.unionByName, imputed) if imputed else None
    return sc, im, st


def run_records(scores: DataFrame, experiment: str = "Imputacao_por_Estacao",
                configs: list[dict] = MODEL_CONFIGS, counts: DataFrame | None = None,
                durations: DataFrame | None = None, n_features: int = len(TEMPORAL_FEATURES),
                ratio: float = EVALUATION_RATIO) -> DataFrame:
    """One run-log row per (station, model): tags, params and metrics maps
    built from the long scores (M8).

    ``counts`` (``estacao, n_records``) and ``durations`` (``modelo,
    duracao_segundos``) add what the scores don't hold.  The metrics are those
    of every target, their averages and the duration; the tags repeat them
    under names that end in the station's file name."""
    cfg = F.create_map(*[x for c in configs for x in (F.lit(c["nome"]), F.to_json(F.struct(
        F.lit(c["n_estimators"]).alias("n_estimators"), F.lit(c["max_depth"]).alias("max_depth"),
        F.lit(c["max_iter"]).alias("max_iter"))))])
    kinds = ("rmse", "mae", "r2")
    m = scores.select("estacao", "modelo", *kinds, F.explode(F.array(*[
        F.struct(F.concat(F.col("alvo"), F.lit(f"_{k}")).alias("k"), F.col(k).cast("double").alias("v"))
        for k in kinds])).alias("e"))
    g = m.groupBy("estacao", "modelo").agg(F.collect_list("e").alias("e"), *[F.avg(k).alias(f"avg_{k}") for k in kinds])
    named = [F.struct(F.lit(f"avg_{k}").alias("k"), F.col(f"avg_{k}").alias("v")) for k in kinds]
    if durations is not None:
        g = g.join(durations.select("modelo", "duracao_segundos"), "modelo", "left")
        named.append(F.struct(F.lit("duration_seconds").alias("k"), F.col("duracao_segundos").alias("v")))
    g = g.withColumn("metrics", F.map_from_entries(F.concat("e", F.array(*named))))
    params = [F.lit("min_samples_split"), F.lit(str(MIN_SAMPLES_SPLIT)), F.lit("min_samples_leaf"), F.lit(str(MIN_SAMPLES_LEAF)),
              F.lit("evaluation_ratio"), F.lit(str(ratio)), F.lit("n_features"), F.lit(str(n_features)),
              F.lit("station_name"), F.col("estacao")]
    if counts is not None:
        c = counts.select(F.col("estacao").alias("_e"), "n_records")
        g = g.join(c, F.col("estacao").eqNullSafe(F.col("_e")), "left")
        params += [F.lit("n_records"), F.col("n_records").cast("string")]
    start, station = F.current_timestamp(), station_slug("estacao")
    measured = F.transform_values(F.map_from_entries(F.transform(F.map_entries("metrics"), lambda e: F.struct(
        F.concat_ws("_", e["key"], station), e["value"]))), lambda k, v: v.cast("string"))
    tags = F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in (
        "station_name", F.col("estacao"), "model_type", F.col("modelo"), "experiment_type", "imputation",
        "method", "IterativeImputer", "estimator", "RandomForestRegressor")])
    return g.select(
        F.md5(F.concat_ws("|", "estacao", "modelo")).alias("run_id"),
        F.concat_ws("_", "estacao", "modelo", F.date_format(start, "yyyyMMdd_HHmmss")).alias("run_name"),
        F.lit(experiment).alias("experiment"), start.alias("start_time"), F.map_concat(tags, measured).alias("tags"),
        F.map_concat(F.create_map(*params), F.from_json(F.try_element_at(cfg, F.col("modelo")), "map<string,string>")).alias("params"),
        "metrics")


def scatter_points(pairs: DataFrame, by=("estacao", "alvo")) -> DataFrame:
    """Real vs imputed points with the min / max diagonal bounds of their
    group (M16): bounds are a grouped aggregate joined back."""
    by = list(by)
    pairs = materialize(pairs, "scatter-pairs")  # read twice below: computed once
    b = pairs.groupBy(*by).agg(F.least(F.min("real"), F.min("imputado")).alias("limite_inferior"),
                               F.greatest(F.max("real"), F.max("imputado")).alias("limite_superior"))
    return pairs.join(b, by, "inner")
