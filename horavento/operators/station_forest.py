"""Random forests of all groups, grown level by level in one job (M3, M4).

Every group (station) has its own forest, and all grow together: a level of
all trees of all groups is one aggregate over (group, tree, node, feature,
bin), summed within slices of about ``SLICE`` rows before it is shuffled.  The
rows are never gathered by group, so a hot station is as cheap as any other,
and the driver holds no name and no model.

A feature is cut into ``BINS`` bins of equal width between the group's
smallest and largest value, so a forest depends on its group's rows alone and
on no partitioning.  Bootstrap counts are Poisson(1) draws from a hash of the
row's id and the tree.  A split needs ``min_split`` rows in the node and
``min_leaf`` on each side, counted with their draws, and takes the largest
reduction of the squared error (to six decimals, so that the order of a sum
decides nothing; ties: the smaller feature number, then bin).
Nodes are numbered as in a heap: root 1, children 2i and 2i + 1.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from horavento.schemas import MIN_SAMPLES_LEAF, MIN_SAMPLES_SPLIT
from horavento.session import materialize

BINS = 64
#: rows summed together in a task, about
SLICE = 100_000
#: cells of one tree that a task sums without numbering them
CELLS = 1 << 21
#: cumulative Poisson(1) probabilities: a row is drawn as often as its number exceeds one
_POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(8)]


def _draws(id_col: str, tree: Column, seed: int) -> Column:
    u = F.pmod(F.xxhash64(F.col(id_col), tree, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    out = F.lit(0)
    for c in _POISSON:
        out = out + (u >= c).cast("int")
    return out


def _binned(x: str) -> Column:
    """Bin numbers of the feature array, from the group's ``_lo`` and ``_hi``."""
    def one(v: Column, i: Column) -> Column:
        lo, hi = F.get("_lo", i), F.get("_hi", i)
        return F.coalesce(F.least(F.greatest(F.floor(F.try_divide(v - lo, hi - lo) * BINS), F.lit(0)), F.lit(BINS - 1)), F.lit(0)).cast("int")

    return F.transform(x, one)


def _descend(bins: Column, trees: int, size: int, levels: int) -> Column:
    """The node of every tree that a row has reached after ``levels``."""
    nodes = F.array(*[F.lit(1)] * trees)
    for _ in range(levels):
        def step(node: Column, t: Column) -> Column:
            at = t * size + node
            return F.when(F.get("_feature", at).isNull(), node).otherwise(
                2 * node + (F.get(bins, F.get("_feature", at)) > F.get("_cut", at)).cast("int"))
        nodes = F.transform(nodes, step)
    return nodes


def _summed(by: pa.Array, y: np.ndarray, draws: np.ndarray, nodes: np.ndarray, bins: np.ndarray, first: int) -> pa.RecordBatch:
    """Drawn rows and label sums per (group, tree, node, feature, bin) of some
    rows; nodes before ``first`` are done with.  One cell number holds the
    whole key, and only the cells that occur are kept."""
    named = by.dictionary_encode(null_encoding="encode")
    group, width = named.indices.to_numpy(zero_copy_only=False).astype(np.int64), bins.shape[1]
    feature = np.arange(width) * BINS
    cells, counts, sums = [], [], []
    for t in range(nodes.shape[1]):
        at = np.flatnonzero((nodes[:, t] >= first) & (draws[:, t] > 0))
        w = draws[at, t].astype(np.float64)
        # the (group, node) pairs that occur, numbered
        pair, place = np.unique(group[at] * (2 * first) + nodes[at, t], return_inverse=True)
        cell, seen = ((place * (width * BINS))[:, None] + feature + bins[at]).ravel(), None
        if len(pair) * width * BINS > CELLS:  # many small groups: number the cells that occur
            seen, cell = np.unique(cell, return_inverse=True)
        n = np.bincount(cell, np.repeat(w, width))
        total = np.bincount(cell, np.repeat(w * y[at], width))
        if seen is None:
            seen = np.flatnonzero(n)
            n, total = n[seen], total[seen]
        p, rest = pair[seen // (width * BINS)], seen % (width * BINS)
        cells.append(np.stack([p // (2 * first), np.full(len(seen), t), p % (2 * first), rest // BINS, rest % BINS]))
        counts.append(n.astype(np.int64))
        sums.append(total)
    g, *keys = np.concatenate(cells, axis=1)
    return pa.RecordBatch.from_arrays(
        [named.dictionary.take(pa.array(g)), *[pa.array(k.astype(np.int32)) for k in keys], pa.array(np.concatenate(counts)),
         pa.array(np.concatenate(sums))], ["g", "tree", "node", "feature", "bin", "n", "s"])


def _level_sums(at: DataFrame, by: str, first: int) -> DataFrame:
    """``n`` and ``s`` per (group, tree, node, feature, bin) of the rows with
    their draws ``_w``, nodes ``_node`` and bins ``_b``, one value a tree or feature."""
    def grid(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def run(batches):
        held, have = [], 0
        for batch in batches:
            held, have = held + [batch], have + batch.num_rows
            if have >= SLICE:
                yield slice_sums(held)
                held, have = [], 0
        if have:
            yield slice_sums(held)

    def slice_sums(held):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=None)[0]
        y = rows.column(1).to_numpy(zero_copy_only=False)
        return _summed(rows.column(0), y, grid(rows.column(2)), grid(rows.column(3)), grid(rows.column(4)), first)

    kind = at.schema[by].dataType.simpleString()
    part = at.select(F.col(by).alias("g"), "_y", "_w", "_node", "_b").mapInArrow(
        run, f"g {kind}, tree int, node int, feature int, bin int, n long, s double")
    return (part.groupBy("g", "tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
            .withColumnRenamed("g", by))


def _with_group(df: DataFrame, side: DataFrame, by: str) -> DataFrame:
    """``side`` has one row per group; NULL is a group of its own."""
    return df.join(side.withColumnRenamed(by, "_g"), F.col(by).eqNullSafe(F.col("_g")), "left").drop("_g")


def grow(rows: DataFrame, by: str, trees: int, depth: int, seed: int, x: str = "x", y: str = "y", id_col: str = "id",
         min_leaf: int = MIN_SAMPLES_LEAF, min_split: int = MIN_SAMPLES_SPLIT) -> DataFrame:
    """One row per group: ranges of the features and, indexed by tree * size +
    node, the split feature, the last bin of the left side and the node's
    mean.  ``rows`` holds the feature array ``x`` (no NULL) and the label."""
    size = 2 << depth
    first = rows.select(F.size(x).alias("n")).first()
    each = [F.get(x, F.lit(i)) for i in range(first.n if first else 0)]
    ends = lambda f: F.array(*[f(v) for v in each]).cast("array<double>").alias("_hi" if f is F.max else "_lo")
    edges = materialize(rows.groupBy(by).agg(ends(F.min), ends(F.max)), "forest-ranges")
    draws = F.array(*[_draws(id_col, F.lit(t), seed) for t in range(trees)])
    data = materialize(_with_group(rows, edges, by).select(by, F.col(y).cast("double").alias("_y"), draws.alias("_w"), _binned(x).alias("_b")),
                       "forest-bins")
    model = edges.withColumns({"_feature": F.array().cast("array<int>"), "_cut": F.array().cast("array<int>"),
                               "_value": F.array().cast("array<double>")})
    splits = values = None
    for level in range(depth):
        at = _with_group(data, model.drop("_lo", "_hi"), by).withColumn("_node", _descend(F.col("_b"), trees, size, level))
        keys = [by, "tree", "node"]
        bins = materialize(_level_sums(at, by, 1 << level), "forest-level")
        one = Window.partitionBy(*keys, "feature")
        up_to = one.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        c = bins.select("*", F.sum("n").over(up_to).alias("nl"), F.sum("s").over(up_to).alias("sl"),
                        F.sum("n").over(one).alias("nt"), F.sum("s").over(one).alias("st"))
        if level == 0:
            values = c.where("feature = 0").groupBy(*keys).agg((F.max("st") / F.max("nt")).alias("value"))
        nr, sr = F.col("nt") - F.col("nl"), F.col("st") - F.col("sl")
        gain = F.col("sl") * F.col("sl") / F.col("nl") + sr * sr / nr - F.col("st") * F.col("st") / F.col("nt")
        fit = c.where((F.col("nt") >= min_split) & (F.col("nl") >= min_leaf) & (nr >= min_leaf)).withColumn("gain", F.round(gain, 6)).where("gain > 0")
        best = materialize(fit.groupBy(*keys).agg(F.max_by(
            F.struct("feature", "bin", (F.col("sl") / F.col("nl")).alias("left"), (sr / nr).alias("right")),
            F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("b")).select(*keys, "b.*"), "forest-splits")
        splits = best if splits is None else splits.unionByName(best)
        for side, shift in (("left", 0), ("right", 1)):
            values = values.unionByName(best.select(by, "tree", (2 * F.col("node") + shift).alias("node"), F.col(side).alias("value")))
        model = _dense(edges, splits, values, by, trees, size)
    return materialize(model, "forest-model")


def _dense(edges: DataFrame, splits: DataFrame, values: DataFrame, by: str, trees: int, size: int) -> DataFrame:
    """The trees of a group as arrays of trees * size cells."""
    cell = F.col("tree") * size + F.col("node")
    every = F.sequence(F.lit(0), F.lit(trees * size - 1))
    at = lambda m, kind: F.transform(every, lambda i: F.try_element_at(m, i).cast(kind))
    s = splits.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct(cell, "feature"))).alias("_f"),
                               F.map_from_entries(F.collect_list(F.struct(cell, "bin"))).alias("_c"))
    v = values.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct(cell, "value"))).alias("_v"))
    joined = _with_group(_with_group(edges, s, by), v, by)
    return materialize(joined.select(by, "_lo", "_hi", at(F.col("_f"), "int").alias("_feature"), at(F.col("_c"), "int").alias("_cut"),
                                     at(F.col("_v"), "double").alias("_value")), "forest-dense")


def predict(rows: DataFrame, model: DataFrame, by: str, trees: int, depth: int, out: str, x: str = "x") -> DataFrame:
    """``rows`` with the mean of their group's trees; NULL where the group has
    no tree (no row was drawn)."""
    size = 2 << depth
    j = _with_group(rows, model, by).withColumn("_b", _binned(x))
    j = j.withColumn("_node", _descend(F.col("_b"), trees, size, depth))
    found = F.filter(F.transform("_node", lambda n, t: F.get("_value", t * size + n)), lambda v: v.isNotNull())
    total = F.aggregate(found, F.lit(0.0), lambda a, v: a + v)
    return j.withColumn(out, F.try_divide(total, F.size(found).cast("double"))).drop("_lo", "_hi", "_feature", "_cut", "_value", "_b", "_node")
