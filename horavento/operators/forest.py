"""Random forests over all rows of a table, grown level by level.

The rows are written once as blocks of about ``SLICE`` rows (``packed``), whose
columns are arrays in binary form: a row by itself costs several times more on
its way to a Python worker than its sums.  A level of all trees is one job.
Every task sums its blocks into counts and label sums per (tree, node, code);
the sums of all tasks meet per tree and ``BLOCK`` nodes, where the splits are
chosen, and only those come to the driver.  A task holds some blocks and the
sums of a level, whatever the number of rows.

Features come from *sources*, each of which gives a row one code:

* a value source is one column, cut into at most ``BINS`` bins;
* a coded source is several features that occur in few combinations (the
  hour with its sine and cosine, the parts of a date): one sum per combination
  serves them all;
* a one-hot source is one 0/1 feature per code (the station).

Candidate cuts are those of Spark ML: every middle of two values where there
are at most ``BINS`` values, else about equal numbers of rows between cuts.
Bootstrap counts are Poisson(1) draws from a hash of the row's number and the
tree.  A split needs ``min_leaf`` drawn rows on both sides and takes
the largest reduction of the squared error (ties: the first feature, then the
lowest cut) among the features drawn for its node.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from horavento.session import scratch_path

BINS = 32
#: rows of a block, about: they are written, read and summed together
SLICE = 1 << 14
#: rows of a task that are put in order together
RANKED = 1 << 20
#: nodes of a tree whose splits are chosen together
BLOCK = 64
#: order statistics of ``RANKED`` rows of a value source that its cuts are chosen from
GRID = 1023
#: combinations of a coded source, at most
COMBINATIONS = 1 << 16
#: sums of a coded source in a level, about; beyond them its features stand alone
CELLS = 1 << 18
#: features that go together, as ``temporal_features`` makes them
FAMILIES = (("hora", "hora_sin", "hora_cos"), ("ano", "mes", "dia", "dia_ano", "dia_semana", "mes_sin", "mes_cos"))

_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(9)])
#: bootstrap count of 16 random bits
_DRAWS = np.searchsorted(_POISSON, (np.arange(1 << 16) + 0.5) / (1 << 16), side="right").astype(np.uint8)
_MASK = (1 << 64) - 1


@dataclass
class Source:
    """Codes of one column and the bins that they stand for."""
    column: str
    #: numbers of the features
    features: list[int]
    #: a value source's cuts; a code is the number of cuts below the value
    cuts: np.ndarray | None = None
    #: a coded source's bins, codes x features; None if one-hot
    bins: np.ndarray | None = None
    codes: int = 0
    #: a coded source's cuts, feature by feature
    thresholds: list[np.ndarray] | None = None

    def code(self, column: np.ndarray) -> np.ndarray:
        if self.cuts is not None:
            return np.searchsorted(self.cuts, column, side="left").astype(np.intp)
        return column.astype(np.intp)

    def feature_bins(self, j: int) -> np.ndarray:
        """Bin of the source's ``j``-th feature for every code."""
        if self.cuts is not None:
            return np.arange(self.codes)
        return (np.arange(self.codes) == j).astype(np.int64) if self.bins is None else self.bins[:, j]


@dataclass
class Tree:
    """Nodes in the order they were made: the root, then the levels."""
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    #: drawn rows, label sum and sum of squares, both of the centred label, and the gain of the split
    stats: np.ndarray


@dataclass
class Layout:
    """Columns of a block: doubles, codes and flags; other columns of its rows
    are kept as they are, in ``rest``."""
    doubles: list[str]
    codes: list[str]
    flags: list[str]

    def needed(self) -> list[str]:
        return ["doubles", "codes", "flags"]

    def blocks(self, batch):
        """Row numbers and columns by name of every block."""
        for i in range(batch.num_rows):
            held: dict[str, np.ndarray] = {}
            for kind, names, of in (("doubles", self.doubles, np.float64), ("codes", self.codes, np.int32), ("flags", self.flags, np.bool_)):
                if names:
                    flat = np.frombuffer(batch[kind][i].as_buffer(), dtype=of)
                    held |= zip(names, flat.reshape(len(names), -1))
            n = len(next(iter(held.values())))
            yield np.arange(n, dtype=np.uint64) + np.uint64(batch["first"][i].as_py()), held


def packed(df: DataFrame, layout: Layout, rest: list[str]) -> DataFrame:
    """``df`` as blocks of rows, numbered; to be written before it is read."""
    def run(batches):
        first = TaskContext.get().partitionId() << 40
        for table in slices(batches):
            flat = lambda names, of: np.concatenate(
                [table[c].to_numpy().astype(of) for c in names] or [np.zeros(0, of)]).tobytes()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.select(rest).schema) as out:
                out.write_table(table.select(rest))
            kept = [flat(layout.doubles, np.float64), flat(layout.codes, np.int32), flat(layout.flags, np.bool_), sink.getvalue().to_pybytes()]
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), *[pa.array([k], pa.binary()) for k in kept]],
                                             ["first", "doubles", "codes", "flags", "rest"])
            first += table.num_rows

    columns = dict.fromkeys([*rest, *layout.doubles, *layout.codes, *layout.flags])
    return df.select(*columns).mapInArrow(run, "first long, doubles binary, codes binary, flags binary, rest binary")


def value_source(column: str, feature: int, cuts: np.ndarray) -> Source:
    return Source(column, [feature], cuts=cuts, codes=len(cuts) + 1)


def spread_cuts(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Cuts between the ascending ``values``, as Spark ML chooses them."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    stride = counts.sum() / bins
    held, want, out = float(counts[0]), stride, []
    for i in range(1, len(values)):
        before, held = held, held + float(counts[i])
        if abs(before - want) < abs(held - want):
            out.append(middle[i - 1])
            want += stride
    return np.array(out)


def value_cuts(blocks: DataFrame, layout: Layout, columns: list[str]) -> dict[str, np.ndarray]:
    """Cuts of every column from its values over all rows: exact counts of
    every ``RANKED`` rows that hold few values, else their order statistics."""
    if not columns:
        return {}

    def run(batches):
        held, have = {c: [] for c in columns}, 0
        for batch in batches:
            for _, block in layout.blocks(batch):
                for c in columns:
                    held[c].append(block[c])
                have += len(block[columns[0]])
                if have >= RANKED:
                    yield summary(held)
                    held, have = {c: [] for c in columns}, 0
        if have:
            yield summary(held)

    def summary(held):
        out = []
        for c in columns:
            v = np.concatenate(held[c])
            v = np.sort(v[~np.isnan(v)])
            first = np.flatnonzero(np.diff(v, prepend=-np.inf) != 0) if len(v) else np.array([], dtype=int)
            if len(first) <= GRID:
                kinds, n = v[first], np.diff(np.append(first, len(v))).astype(np.float64)
            else:
                kinds, n = v[(np.arange(GRID) * len(v) + len(v) // 2) // GRID], np.full(GRID, len(v) / GRID)
            out.append((kinds, n))
        return pa.RecordBatch.from_arrays([pa.array(range(len(columns)), pa.int32()), *[pa.array([o[i].tobytes() for o in out], pa.binary()) for i in (0, 1)]],
                                          ["column", "kinds", "n"])

    found = blocks.select("first", *layout.needed()).mapInArrow(run, "column int, kinds binary, n binary").toArrow().to_pydict()
    cuts = {}
    for i, c in enumerate(columns):
        of = lambda k: np.concatenate([np.zeros(0), *[np.frombuffer(v) for j, v in zip(found["column"], found[k]) if j == i]])  # noqa: B023,E731
        kinds, place = np.unique(of("kinds"), return_inverse=True)
        cuts[c] = spread_cuts(kinds, np.bincount(place, of("n"), len(kinds)))
    return cuts


def coded(df: DataFrame, features: list[str], depth: int, one_hot: str | None = None) -> tuple[DataFrame, list[Source], list[str]]:
    """``df`` with the codes of the families among its ``features`` (and of the
    column ``one_hot``, whose features come last), their sources, and the features left."""
    sources, left = [], list(features)
    for k, family in enumerate(FAMILIES):
        names = [c for c in family if c in features and c in df.columns]
        numbers = [c.cast("double") for c in map(F.col, names)]
        found = df.groupBy(*[n.alias(f"_v{i}") for i, n in enumerate(numbers)]).agg(F.count(F.lit(1)).alias("n")) \
            .limit(COMBINATIONS + 1).toArrow() if names else None
        if found is None or not 0 < found.num_rows <= COMBINATIONS:
            continue
        at, n = [features.index(c) for c in names], found["n"].to_numpy()
        cuts, bins = [], []
        for i in range(len(names)):
            v = found[f"_v{i}"].to_numpy()
            here = ~np.isnan(v)
            kinds, place = np.unique(v[here], return_inverse=True)
            cuts.append(spread_cuts(kinds, np.bincount(place, n[here], len(kinds))))
            bins.append(np.searchsorted(cuts[-1], v, side="left"))
        kinds, place = np.unique(np.stack(bins, axis=1), axis=0, return_inverse=True)
        if len(kinds) << max(0, depth - 1) <= CELLS:
            columns = {f"_s{k}": place.ravel()}
            sources.append(Source(f"_s{k}", at, bins=kinds, codes=len(kinds), thresholds=cuts))
        else:
            columns = {f"_s{k}_{i}": b for i, b in enumerate(bins)}
            sources += [Source(f"_s{k}_{i}", [at[i]], bins=np.arange(len(cuts[i]) + 1)[:, None], codes=len(cuts[i]) + 1, thresholds=[cuts[i]]) for i in range(len(names))]
        table = found.drop_columns(["n"])
        for c, v in columns.items():
            table = table.append_column(c, pa.array(v.astype(np.int32)))
        side = df.sparkSession.createDataFrame(table)
        same = F.lit(True)
        for i, number in enumerate(numbers):
            same = same & number.eqNullSafe(F.col(f"_v{i}"))
        df = df.join(side, same, "left").drop(*[f"_v{i}" for i in range(len(names))])
        left = [c for c in left if c not in names]
    if one_hot is not None:
        kind = df.schema[one_hot].dataType
        names = df.select(F.col(one_hot).alias("_g")).distinct().orderBy("_g").toArrow()
        names = names.append_column("_s_hot", pa.array(np.arange(names.num_rows, dtype=np.int32)))
        side = df.sparkSession.createDataFrame(names).withColumn("_g", F.col("_g").cast(kind))
        df = df.join(side, F.col(one_hot).eqNullSafe(F.col("_g")), "left").drop("_g")
        if names.num_rows:
            sources.append(Source("_s_hot", list(range(len(features), len(features) + names.num_rows)), codes=names.num_rows))
    return df, sources, left


def _mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """64 random bits a key (splitmix64)."""
    z = keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt & _MASK)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def draws(keys: np.ndarray, seed: int, four: int) -> np.ndarray:
    """Bootstrap counts of the trees ``4 * four`` to ``4 * four + 3``, a row each key."""
    salt = int(_mix(np.array([seed & _MASK], dtype=np.uint64), four + 1)[0])
    return _DRAWS[_mix(keys, salt).view(np.uint16).reshape(-1, 4)]


class _Walk:
    """A tree as tables: where a node's rows with a code go."""

    def __init__(self, tree: Tree, sources: list[Source]):
        width = max(s.codes for s in sources)
        at = {f: (k, j) for k, s in enumerate(sources) for j, f in enumerate(s.features)}
        n, self.width, self.child = len(tree.feature), width, tree.child.astype(np.intp)
        self.source, right = np.zeros(n, dtype=np.intp), np.zeros((n, width), dtype=np.intp)
        for i in np.flatnonzero(tree.feature >= 0):
            self.source[i], j = at[int(tree.feature[i])]
            bins = sources[self.source[i]].feature_bins(j)
            right[i, :len(bins)] = bins > tree.cut[i]
        self.right = right.ravel()

    def __call__(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The node of every row after some levels; ``codes`` is sources x rows."""
        rows = codes.shape[1]
        if levels == 0:
            return np.zeros(rows, dtype=np.intp)
        flat, at = codes.ravel(), np.arange(rows)
        node = self.child[0] + self.right.take(codes[self.source[0]])
        for _ in range(levels - 1):
            code = flat.take(self.source.take(node) * rows + at)
            node = self.child.take(node) + self.right.take(node * self.width + code)
        return node


@dataclass
class Forest:
    sources: list[Source]
    trees: list[Tree]
    depth: int

    def predictor(self) -> Callable[[np.ndarray], np.ndarray]:
        """Mean of the trees for codes, sources x rows."""
        walks = [(_Walk(t, self.sources), t.value) for t in self.trees]

        def mean(codes):
            total = np.zeros(codes.shape[1])
            for walk, value in walks:
                total += value.take(walk(codes, self.depth))
            return total / len(walks)
        return mean


def slices(batches, rows: int = 0):
    """The batches put together into tables of about ``rows``."""
    held, have = [], 0
    for batch in batches:
        held, have = held + [batch], have + batch.num_rows
        if have >= (rows or SLICE):
            yield pa.Table.from_batches(held).combine_chunks()
            held, have = [], 0
    if have:
        yield pa.Table.from_batches(held).combine_chunks()


def _level(layout, sources, trees, slots, read, middle, seed, level, squares):
    """Task of a level: the sums of its rows, one row per (tree, block of nodes)."""
    def run(batches):
        walks = [_Walk(t, sources) if live is not None else None for t, live in zip(trees, slots)]
        held: list[list[np.ndarray] | None] = [None] * len(trees)
        for keys, y, codes in (read(*block) for batch in batches for block in layout.blocks(batch)):
            y = y - middle
            for four in range(0, len(trees), 4):
                if all(w is None for w in walks[four:four + 4]):
                    continue
                drawn = np.ascontiguousarray(draws(keys, seed, four // 4).T)
                for t in range(four, min(four + 4, len(trees))):
                    if walks[t] is None:
                        continue
                    w = drawn[t - four]
                    at = np.flatnonzero(w != 0)
                    here = codes.take(at, axis=1)
                    # nodes that are done with share the last slot
                    slot, n = slots[t].take(walks[t](here, level)), int(slots[t].max()) + 1
                    w = w.take(at).astype(np.float64)
                    wy = w * y.take(at)
                    wyy = wy * y.take(at)
                    sums = [np.bincount(slot, wyy, n)]
                    for s, code in zip(sources, here):
                        cell = slot * s.codes + code
                        sums += [np.bincount(cell, v, n * s.codes) for v in ((w, wy, wyy) if squares else (w, wy))]
                    if held[t] is None:
                        held[t] = sums
                    else:
                        for a, b in zip(held[t], sums):
                            a += b
        part = TaskContext.get().partitionId()
        for t, sums in enumerate(held):
            if sums is None:
                continue
            n = int(slots[t].max())
            for b in range(0, n, BLOCK):
                size = min(BLOCK, n - b)
                cut = [a.reshape(len(sums[0]), -1)[b:b + size].ravel() for a in sums]
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([b // BLOCK], pa.int32()), pa.array([part], pa.int32()),
                                                  pa.array([np.concatenate(cut).tobytes()], pa.binary())], ["tree", "block", "part", "sums"])
    return run


def _chosen(seed: int, tree: int, level: int, slots: int, features: int, subset: int) -> np.ndarray:
    """Which features a node may split by, slots x features."""
    if subset >= features:
        return np.ones((slots, features), dtype=bool)
    order = np.random.default_rng([seed & _MASK, tree, level]).random((slots, features)).argsort(axis=1)
    return order < subset


def _splits(sources, allowed, min_leaf, squares, sums: np.ndarray, size: int):
    """The best split of every node of a block: feature (-1: none), cut, gain
    and the sums of the node and of its left side."""
    width = 3 if squares else 2
    q, sums = sums[:size], sums[size:]
    held, at = [], 0
    for s in sources:
        n = size * s.codes
        held.append(sums[at:at + width * n].reshape(width, size, s.codes))
        at += width * n
    w, total = held[0][0].sum(axis=1), held[0][1].sum(axis=1)
    features = allowed.shape[1]
    best, cut = np.full((features, size), -np.inf), np.zeros((features, size), dtype=np.int64)
    left = np.zeros((features, 3, size))
    with np.errstate(all="ignore"):
        for s, have in zip(sources, held):
            for j, f in enumerate(s.features):
                bins = s.feature_bins(j)
                order = np.argsort(bins, kind="stable")
                kinds, first = np.unique(bins[order], return_index=True)
                if len(kinds) < 2:
                    continue
                if s.cuts is None and s.bins is None:  # the rows without the code are on the left
                    up = (have.sum(axis=2) - have[:, :, j])[:, :, None]
                else:
                    up = np.cumsum(np.add.reduceat(have[:, :, order], first, axis=2), axis=2)[:, :, :-1]
                wl, sl = up[0], up[1]
                wr, sr = w[:, None] - wl, total[:, None] - sl
                gain = sl * sl / wl + sr * sr / wr - (total * total / w)[:, None]
                gain = np.where((wl >= min_leaf) & (wr >= min_leaf) & (gain > 0) & allowed[:, f, None], gain, -np.inf)
                top = gain.argmax(axis=1)
                rows = np.arange(size)
                best[f], cut[f] = gain[rows, top], kinds[top]
                left[f, :width] = up[:, rows, top]
        most = best.max(axis=0)
        # sums of one set of rows differ by their order: equal gains go to the first feature
        feature = (best >= most - 1e-9 * np.abs(most)).argmax(axis=0)
        rows = np.arange(size)
        # what is left of a constant label by rounding is no gain
        feature_or_none = np.where(np.isfinite(most) & (most > 1e-12 * q), feature, -1)
    return feature_or_none, cut[feature, rows], best[feature, rows], np.stack([w, total, q]), left[feature, :, rows].T


_FOUND = "tree int, slot int, feature int, cut int, gain double, w double, s double, q double, wl double, sl double, ql double"


def _best(sources, slots, features, subset, min_leaf, seed, level, squares):
    """Reducer of a level: the sums of all tasks for a block of nodes, its splits."""
    def run(key, table):
        tree, block = key[0].as_py(), key[1].as_py()
        table = table.sort_by("part")  # the order of a sum decides nothing
        sums = np.zeros(len(table["sums"][0].as_py()) // 8)
        for blob in table["sums"]:
            sums += np.frombuffer(blob.as_buffer(), dtype=np.float64)
        n = int(slots[tree].max())
        first, size = block * BLOCK, min(BLOCK, n - block * BLOCK)
        allowed = _chosen(seed, tree, level, n, features, subset)[first:first + size]
        feature, cut, gain, node, left = _splits(sources, allowed, min_leaf, squares, sums, size)
        full = lambda v: pa.array(np.full(size, v, dtype=np.int32))
        columns = [full(tree), pa.array((first + np.arange(size)).astype(np.int32)), pa.array(feature.astype(np.int32)), pa.array(cut.astype(np.int32)),
                   *[pa.array(np.asarray(v, dtype=np.float64)) for v in (gain, *node, *left)]]
        return pa.Table.from_arrays(columns, names=["tree", "slot", "feature", "cut", "gain", "w", "s", "q", "wl", "sl", "ql"])
    return run


def grow(blocks: DataFrame, layout: Layout, sources: list[Source], read: Callable, middle: float, trees: int, depth: int, seed: int,
         min_leaf: int = 1, subset: int | None = None) -> Forest:
    """The forest of the ``packed`` rows.  ``read`` turns the row numbers and
    columns of a block into row numbers, labels and codes (sources x rows) of
    the rows to learn from; ``middle`` is a number near the labels' mean,
    ``subset`` the features drawn for a node (all if None)."""
    if trees < 1:
        raise ValueError(f"a forest of {trees} trees")
    features = 1 + max(f for s in sources for f in s.features)
    subset = subset or features
    blocks = blocks.select("first", *layout.needed())
    grown = [Tree(np.array([-1]), np.array([0]), np.array([0]), np.array([middle]), np.zeros((1, 4))) for _ in range(trees)]
    live: list[np.ndarray] = [np.array([0])] * trees  # nodes of the level, by slot
    for level in range(depth):
        squares = level == depth - 1  # the last nodes are summed by nobody else
        slots: list[np.ndarray | None] = []
        for t in range(trees):
            slot = np.full(len(grown[t].feature), len(live[t]), dtype=np.intp)
            slot[live[t]] = np.arange(len(live[t]))
            # the last number is that of no node; the root has no node beside it
            slots.append(np.append(slot, len(live[t])) if len(live[t]) else None)
        part = blocks.mapInArrow(_level(layout, sources, grown, slots, read, middle, seed, level, squares), "tree int, block int, part int, sums binary")
        found = part.groupBy("tree", "block").applyInArrow(_best(sources, slots, features, subset, min_leaf, seed, level, squares), _FOUND).toArrow()
        order = np.lexsort((found["slot"].to_numpy(), found["tree"].to_numpy()))
        f = {c: found[c].to_numpy()[order] for c in found.column_names}
        for t in range(trees):
            lo, hi = np.searchsorted(f["tree"], [t, t + 1])
            if lo == hi:  # no node left, or no row drawn
                live[t] = np.array([], dtype=np.int64)
                continue
            live[t] = _extend(grown[t], live[t], {c: v[lo:hi] for c, v in f.items()}, middle)
        if not any(len(x) for x in live):
            break
    drawn = [t for t in grown if t.stats[0, 0] > 0]
    return Forest(sources, drawn or grown[:1], depth)


def _extend(tree: Tree, nodes: np.ndarray, f: dict[str, np.ndarray], middle: float) -> np.ndarray:
    """Put the splits of a level into the tree; the numbers of its new nodes."""
    tree.stats[nodes, 0], tree.stats[nodes, 1], tree.stats[nodes, 2] = f["w"], f["s"], f["q"]
    with np.errstate(all="ignore"):
        tree.value[nodes] = np.where(f["w"] > 0, middle + f["s"] / f["w"], middle)
    at = np.flatnonzero(f["feature"] >= 0)
    split, count = nodes[at], len(tree.feature)
    tree.feature[split], tree.cut[split], tree.stats[split, 3] = f["feature"][at], f["cut"][at], f["gain"][at]
    tree.child[split] = count + 2 * np.arange(len(at))
    left = np.stack([f["wl"][at], f["sl"][at], f["ql"][at]], axis=1)
    both = np.stack([left, np.stack([f["w"][at], f["s"][at], f["q"][at]], axis=1) - left], axis=1).reshape(-1, 3)
    new = count + np.arange(len(both))
    tree.feature, tree.cut = np.append(tree.feature, np.full(len(new), -1)), np.append(tree.cut, np.zeros(len(new), dtype=np.int64))
    tree.child = np.append(tree.child, new)  # a leaf leads to itself
    tree.value = np.append(tree.value, middle + both[:, 1] / both[:, 0])
    tree.stats = np.concatenate([tree.stats, np.column_stack([both, np.zeros(len(new))])])
    return new


def reader(label: str, sources: list[Source]) -> Callable:
    """``read`` of ``grow`` for blocks whose every row has a label."""
    def read(keys, held):
        return keys, held[label], np.stack([s.code(held[s.column]) for s in sources])
    return read


def spark_model(estimator, forest: Forest, cuts: list[np.ndarray], spark):
    """The forest as the Spark ML model that ``estimator`` would give: ``cuts``
    holds the thresholds of every feature.  Parameters and metadata are those
    of a fit on one row; only the nodes are replaced."""
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import RandomForestRegressionModel
    estimator = estimator.copy({estimator.numTrees: len(forest.trees)})
    one = spark.createDataFrame([(Vectors.dense([0.0] * len(cuts)), 0.0)], [estimator.getFeaturesCol(), estimator.getLabelCol()])
    path = scratch_path(spark, "forest-model")
    estimator.fit(one).write().save(path)
    whole = lambda c: np.concatenate([c(t) for t in forest.trees])
    sizes = [len(t.feature) for t in forest.trees]
    feature, cut, child, stats = whole(lambda t: t.feature), whole(lambda t: t.cut), whole(lambda t: t.child), whole(lambda t: t.stats)
    value, inner = whole(lambda t: t.value), whole(lambda t: t.feature) >= 0
    middle = value[0] - stats[0, 1] / max(stats[0, 0], 1.0)
    n, s, q = stats[:, 0], stats[:, 1], stats[:, 2]
    with np.errstate(all="ignore"):
        impurity = np.where(n > 0, np.maximum(q / n - (s / n) ** 2, 0.0), 0.0)
        gain = np.where(inner, stats[:, 3] / n, -1.0)
    # sums of the label itself
    raw = np.stack([n, s + n * middle, q + 2 * middle * s + n * middle * middle], axis=1)
    lists = lambda flat, ends: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.float64)))
    ints = lambda v: pa.array(np.asarray(v).astype(np.int32))
    thresholds = np.array([cuts[f][c] for f, c in zip(feature[inner], cut[inner])], dtype=np.float64)
    split = pa.StructArray.from_arrays([ints(feature), lists(thresholds, np.concatenate([[0], np.cumsum(inner)])), ints(np.full(len(n), -1))],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    node = pa.StructArray.from_arrays(
        [ints(np.concatenate([np.arange(k) for k in sizes])), pa.array(value), pa.array(impurity), lists(raw.ravel(), 3 * np.arange(len(n) + 1)),
         pa.array(np.rint(n).astype(np.int64)), pa.array(gain), ints(np.where(inner, child, -1)), ints(np.where(inner, child + 1, -1)), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    table = pa.Table.from_arrays([ints(np.repeat(np.arange(len(sizes)), sizes)), node], names=["treeID", "nodeData"])
    spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)
