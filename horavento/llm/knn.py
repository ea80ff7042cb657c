"""Exact top-k by integer inner product as a Voronoi join.

1. At most ``MAX_PIVOTS`` pivots (distinct vectors, by a hash of vec_id) cut
   the data into cells; every vector goes to its nearest pivot.
2. A cell's summary is its count and radius.  For a query q and a cell with
   pivot p and radius r, every member's product lies in q.p -+ |q| r.  The
   lower ends and counts give a bound that the k-th best product of q
   certainly reaches; q is sent only to the cells whose upper end reaches it.
3. Cells are dealt in blocks of about ``BLOCK`` rows, queries in chunks of
   about ``CHUNK`` rows, and a cell's rows go to the chunks that have queries
   for it; each (cell, block, chunk) is solved by one exact matrix product and passes on its k best per query that reach the bound.
4. A window per query merges those lists.

Only pivots and summaries (a bounded number of rows) reach the driver.

Defined cases: null vectors, vectors with null or non-finite components and
rows without vec_id take no part; vectors of different lengths take no part
with one another; a query's own vec_id is never its answer; a repeated query
is answered once (of different vectors of one id the smallest asks), repeated
candidates each count; components beyond 63 bits and products beyond them are
held at the ends of a long, all smaller ones are exact; ties go to the smaller
vec_id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from horavento.llm.common import about, map_batches, register, table
from horavento.session import materialize

K, EVERY = 5, 50
MAX_PIVOTS, ROWS_PER_CELL = 256, 1000
BLOCK, CHUNK = 4096, 8192


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=np.int64)


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v`` with v = floor(scale * x), for the rows that take part."""
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    top = float(1 << 63)
    cut = lambda e: (F.when(scale * e >= top, F.lit((1 << 63) - 1)).when(scale * e <= -top, F.lit(1 - (1 << 63)))
                     .otherwise(F.floor(scale * F.when(F.abs(scale * e) < top, e))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    return (rows.where("vec_id IS NOT NULL AND size(x) > 0").where(F.forall("x", fine))
            .select("vec_id", F.transform("x", cut).alias("v")))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products of whole numbers, exact: in doubles or longs where
    these hold every sum, else in Python's integers."""
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    if top < 2 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if top < 2 ** 62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    return np.clip(q.astype(object) @ x.astype(object).T, 1 - (1 << 63), (1 << 63) - 1).astype(np.int64)


def _solve(dim_rows: DataFrame, dim: int, count: int, k: int, every: int) -> DataFrame:
    """The top k among the vectors of one length."""
    want = max(4, min(MAX_PIVOTS, count // ROWS_PER_CELL))
    picked = about(dim_rows, 4 * want, "vec_id").select("v").collect()
    picked = picked or dim_rows.select("v").limit(want).collect()
    pivots = np.array([list(v) for v in dict.fromkeys(tuple(r.v) for r in picked)][:want], dtype=np.float64)
    weight = (pivots ** 2).sum(axis=1)

    def assign(batch: pa.RecordBatch) -> dict | None:
        x = _matrix(batch.column(1)).astype(np.float64)
        if not len(x):
            return None
        cell = (weight - 2 * (x @ pivots.T)).argmin(axis=1)
        return {"vec_id": batch.column(0), "v": batch.column(1), "cell": cell,
                "far": np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))}

    cells = materialize(map_batches(dim_rows, assign, "vec_id long, v array<long>, cell int, far double"), "knn-cells")
    summary = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect()
    n, radius = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots))
    for s in summary:
        n[s.cell], radius[s.cell] = s.n, s.r
    blocks = np.maximum(1, -(-n // BLOCK))
    chunks = max(1, -(-(count // every + 1) // CHUNK))

    def route(batch: pa.RecordBatch):
        """The cells that may hold one of a query's k best."""
        q = _matrix(batch.column(1)).astype(np.float64)
        if not len(q):
            return None
        middle = q @ pivots.T
        reach = np.sqrt((q ** 2).sum(axis=1))[:, None] * (radius * (1 + 1e-9) + 1e-9 * np.sqrt(weight)) + 1e-6
        order = np.argsort(-(middle - reach), axis=1, kind="stable")
        # k members beside the rows of the query's own id, wherever these lie
        own = batch.column(2).to_numpy()[:, None]
        held = np.cumsum(n[order], axis=1) >= k + own
        at = np.where(held[:, -1], held.argmax(axis=1), -1)
        low = np.take_along_axis(middle - reach, order, axis=1)
        bound = np.where(at >= 0, low[np.arange(len(q)), at], -np.inf)
        row, cell = np.nonzero((middle + reach >= bound[:, None]) & (n > 0))
        take = pa.array(row)
        return {"vec_id": batch.column(0).take(take), "v": batch.column(1).take(take), "cell": cell, "bound": bound[row]}

    queries = dim_rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own"))
    block_of = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)
    sent = materialize(map_batches(queries, route, "vec_id long, v array<long>, cell int, bound double")
                       .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")), "knn-routed")
    routed = sent.withColumn("block", F.explode(F.sequence(F.lit(0), block_of - 1)))
    asked_by = sent.groupBy("cell").agg(F.collect_set("chunk").alias("chunks"))  # a row per pivot
    # blocks are dealt row by row, so equal vectors and equal ids spread too
    data = (cells.select("vec_id", "v", "cell", F.pmod(F.monotonically_increasing_id(), block_of).cast("int").alias("block"))
            .join(F.broadcast(asked_by), "cell").withColumn("chunk", F.explode("chunks")).drop("chunks"))

    def local(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        ids = right["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], _matrix(right["v"].combine_chunks())[order]
        asked, q = left["vec_id"].to_numpy(), _matrix(left["v"].combine_chunks())
        bound, out = left["bound"].to_numpy(), []
        for a in range(0, len(q), 512):
            s = _products(q[a:a + 512], x)
            own = asked[a:a + 512, None] == ids
            fit = ~own & (s >= bound[a:a + 512, None])
            low = np.where(fit, s, np.iinfo(np.int64).min)
            if low.shape[1] > k:
                fit &= low >= np.partition(low, -k, axis=1)[:, -k][:, None]
            i, j = np.nonzero(fit)
            o = np.lexsort((j, -s[i, j], i))
            i, j = i[o], j[o]
            first = np.searchsorted(i, i, "left")
            keep = np.arange(len(i)) - first < k
            i, j = i[keep], j[keep]
            out.append(pa.table({"query_id": asked[a + i], "vec_id": ids[j], "score": s[i, j]}))
        return pa.concat_tables(out)

    key = ["cell", "block", "chunk"]
    near = routed.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(local, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of every vector whose
    vec_id is divisible by ``every``, among all others."""
    rows = materialize(integer_vectors(vectors), "knn-vectors")
    out = None
    for size in rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect():
        part = _solve(rows.where(F.size("v") == size.d), size.d, size.n, k, every)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else vectors.sparkSession.createDataFrame(
        [], "query_id long, rank int, vec_id long, score long")


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@register("op7_knn", OP7_SQL)
def op7_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
