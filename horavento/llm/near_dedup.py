"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts makes, per document, the shingle set's size and
   128-bit fingerprint, ``BANDS`` band keys of ``ROWS`` minima each, and the
   signature: the low ``BITS`` bits of every minimum, packed into longs.
2. Documents with equal sets form one class (partial aggregate by
   fingerprint); only one node per class goes on, so copies are never paired.
3. Candidates: in a band bucket every node meets the bucket's smallest node.
   The collision-corrected similarity of the packed signatures (XOR, fold,
   bit count) drops clear non-matches; the rest are confirmed on full sets.
4. What this star leaves open is the pairs of a bucket that lie in different
   components by then.  In buckets of up to ``BUCKET`` nodes they are joined
   under the same size and signature conditions.  The nodes of larger buckets
   meet by prefix filtering instead, which is exact: under any common order of
   shingles, sets of this similarity share one of their first few, with enough
   left behind it.  The order puts shingles that are frequent in a bounded
   sample last, so a passage that many documents share brings none together.
5. Union-find over the confirmed links; smallest doc_id names the component.

Defined cases: null or wordless text has the empty set and stays alone; rows
that share a doc_id are one node; a null doc_id has a null component and is
kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm.common import about, map_batches, mix, only_likely, packed_similarity, register, shingle_set, table, text_column
from horavento.llm.components import connected_components
from horavento.session import materialize

#: five words unless the caller says otherwise
SHINGLE, PERCENT = 5, 80
#: misses a pair of similarity 0.8 with probability (1 - 0.8^5)^32 = 3e-6
BANDS, ROWS, BITS = 32, 5, 4
#: pairs are confirmed from this estimate on: five standard errors below 0.8
SLACK = 0.17
#: the open pairs of larger buckets are found by prefix filtering
BUCKET = 64
#: documents whose shingles are counted for its order, and shingles put last
ORDER_SAMPLE, ORDER_LAST = 500, 100_000
_K = BANDS * ROWS
_LONGS = _K * BITS // 64
_rng = np.random.default_rng(20240607)
_A = _rng.integers(0, 1 << 32, _K, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, _K, dtype=np.uint32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def minima(h: np.ndarray) -> np.ndarray:
    """The ``BANDS * ROWS`` minima of a non-empty set of 64-bit hashes, in
    bounded blocks."""
    x, out = (h >> np.uint64(32)).astype(np.uint32), np.full(_K, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(out, (x[i:i + 1024, None] * _A + _B).min(axis=0), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = _BAND.copy()
        for col in m.reshape(BANDS, ROWS).T:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + col)
        return key.view(np.int64)


def packed(m: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of each (remixed) minimum, in ``_LONGS`` longs."""
    low = (mix(m.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).reshape(_LONGS, 64 // BITS)
    shift = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(low << shift, axis=1).view(np.int64)


def sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n, f1, f2, bands, sig`` per row (bands and sig empty for the
    empty set)."""
    def fn(batch: pa.RecordBatch) -> dict:
        n, f1, f2, bands, sigs = [], [], [], [], []
        with np.errstate(over="ignore"):
            for t in text_column(batch, "text"):
                h = shingle_set(t, shingle)
                n.append(len(h))
                f1.append(int(mix(h).sum(dtype=np.uint64).view(np.int64)) if len(h) else 0)
                f2.append(int(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64))
                          if len(h) else 0)
                m = minima(h) if len(h) else None
                bands.append([] if m is None else band_keys(m))
                sigs.append([] if m is None else packed(m))
        return {"doc_id": batch.column(0), "n": n, "f1": f1, "f2": f2, "bands": bands, "sig": sigs}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                       fn, "doc_id long, n long, f1 long, f2 long, bands array<long>, sig array<long>")


def _possible(nu, nv, su, sv, percent: int):
    """False for pairs whose sizes exclude the threshold or whose signatures
    make it all but impossible."""
    return (F.least(nu, nv) * 100 >= F.greatest(nu, nv) * percent) & (packed_similarity(su, sv, _K, BITS) >= percent / 100 - SLACK)


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets meet the threshold.  Sizes and
    signatures filter first, then the two texts come together pair by pair
    (linear in the pairs; a hot node's text is sent once per pair)."""
    a = nodes.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("sig").alias("su"))
    b = nodes.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("sig").alias("sv"))
    likely = (pairs.join(a, "u").join(b, "v")
              .where(_possible(F.col("nu"), F.col("nv"), F.col("su"), F.col("sv"), percent))
              .select("u", "v").distinct())
    likely = materialize(likely, "near-pairs")
    ends = likely.select(F.col("u").alias("doc_id")).unionByName(likely.select(F.col("v").alias("doc_id"))).distinct()
    # the bit table keeps the texts of most other documents out of the shuffle
    all_texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    likely_ends = only_likely(all_texts, F.xxhash64("doc_id"), ends.select(F.xxhash64("doc_id").alias("k")))
    texts = materialize(likely_ends.join(ends, "doc_id", "left_semi"), "near-texts")
    both = (likely.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu")), "u")
            .join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv")), "v"))

    def fn(batch: pa.RecordBatch) -> dict:
        last, keep = {}, []

        def of(t):
            if t not in last:
                if len(last) > 7:
                    last.pop(next(iter(last)))
                last[t] = shingle_set(t, shingle)
            return last[t]

        for x, y in zip(text_column(batch, "tu"), text_column(batch, "tv")):
            s, t = of(x), of(y)
            common = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(common > 0 and 100 * common >= percent * (len(s) + len(t) - common))
        mask = pa.array(keep, pa.bool_())
        return {c: batch.column(batch.schema.get_field_index(c)).filter(mask) for c in ("u", "v")}

    return map_batches(both.select("u", "v", "tu", "tv"), fn, "u long, v long").distinct()


def _pairs_by_key(rows: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` of nodes that share a ``key``, lie in different
    components and may meet the threshold.  ``at`` is the key's place in the
    node's order (0 where there is none): at the first key two sets share, the
    rest of each bounds what they have in common."""
    side = lambda x: rows.select(F.col("key").alias("k" + x), *[F.col(c).alias(c + x) for c in ("node", "n", "c", "at", "sig")])
    enough = lambda x: (F.col("n" + x) - F.col("at" + x)) * (100 + percent) >= (F.col("nu") + F.col("nv")) * percent
    return (side("u").join(side("v"), (F.col("ku") == F.col("kv")) & (F.col("nodeu") < F.col("nodev"))
                           & (F.col("cu") != F.col("cv")) & enough("u") & enough("v")
                           & _possible(F.col("nu"), F.col("nv"), F.col("sigu"), F.col("sigv"), percent))
            .select(F.col("nodeu").alias("u"), F.col("nodev").alias("v")))


def _prefixes(docs: DataFrame, hot: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``hot`` with a row per ``key`` and its place ``at``: the first
    n - ceil(percent * n) + 1 shingles of the node's set in an order common to
    all."""
    rows = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    texts = materialize(only_likely(rows, F.xxhash64("node"), hot.select(F.xxhash64("node").alias("k")))
                        .join(hot.select("node"), "node", "left_semi"), "near-hot-texts")

    def count(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, shingle) for t in text_column(batch, "text")]
        h, c = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0, np.int64))
        return {"h": h.view(np.int64), "c": c}

    sample = about(texts, ORDER_SAMPLE, "node").select("text")
    last = (map_batches(sample, count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 2")
            .orderBy(F.desc("c"), "h").limit(ORDER_LAST).collect())
    late = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r.h for r in last], dtype=np.int64).view(np.uint64)))

    def first(batch: pa.RecordBatch) -> dict:
        keys = []
        for t in text_column(batch, "text"):
            h = shingle_set(t, shingle)
            n = len(h) + (-percent * len(h) // 100) + 1
            place = np.minimum(np.searchsorted(late.value, h), max(0, len(late.value) - 1))
            common = late.value[place] == h if len(late.value) else np.zeros(len(h), dtype=bool)
            keys.append(np.concatenate([h[~common], h[common]])[:n].view(np.int64))
        return {"node": batch.column(0), "keys": keys}

    found = map_batches(texts.select("node", "text"), first, "node long, keys array<long>")
    return materialize(found.select("node", F.posexplode("keys").alias("at", "key")).distinct().join(hot, "node"), "near-prefix")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    rows = materialize(sketches(docs, shingle), "near-sketch")
    # one node per distinct set; the other columns are functions of the set
    nodes = materialize(
        rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2", "n")
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "near-nodes")
    banded = nodes.select("node", "n", F.explode("bands").alias("key"))
    heads = banded.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head <> last")
    shared = materialize(banded.join(heads.select("key", "head"), "key"), "near-buckets")
    star = shared.where("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v")).distinct()
    # rows of one doc_id with different texts are one node
    same = (rows.where("n > 0 AND doc_id IS NOT NULL").join(nodes.select("f1", "f2", "n", "node"), ["f1", "f2", "n"])
            .where("doc_id <> node").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
            .where("a <> b"))
    same = same.select(F.col("a").alias("u"), F.col("doc_id").alias("v")).unionByName(
        same.select(F.col("b").alias("u"), F.col("doc_id").alias("v")))
    first = materialize(_confirmed(star, docs, nodes, shingle, percent).unionByName(same), "near-links")
    joined = connected_components(first, "near-round1")

    # what the star left open: pairs of a bucket in different components
    comp = shared.join(joined, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("c"))
    split = (comp.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where("lo <> hi").select("key", "m"))
    open_ = materialize(comp.join(split, "key").join(nodes.select("node", "sig"), "node"), "near-open")
    rest = _pairs_by_key(open_.where(F.col("m") <= BUCKET).withColumn("at", F.lit(0)), percent)
    hot = materialize(open_.where(F.col("m") > BUCKET).select("node", "n", "c", "sig").dropDuplicates(["node"]), "near-hot")
    if not hot.isEmpty():
        rest = rest.unionByName(_pairs_by_key(_prefixes(docs, hot, shingle, percent), percent))
    rest = rest.distinct().join(star, ["u", "v"], "left_anti")
    links = first.unionByName(_confirmed(rest, docs, nodes, shingle, percent))
    found = connected_components(links, "near-round2")

    ids = nodes.select("f1", "f2", "n", "node").join(found, "node", "left").select(
        "f1", "f2", "n", F.coalesce("component", "node").alias("component"))
    out = rows.select("doc_id", "n", "f1", "f2").join(ids, ["f1", "f2", "n"], "left")
    # a doc_id without a node of its own text takes its other rows' component
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with all columns, one document of each group of near copies
    (the smallest doc_id)."""
    gone = (near_duplicates(docs, shingle, percent).where("NOT kept")
            .select(F.col("doc_id").alias("__gone")).distinct())
    # a document that is both kept and dropped cannot be: kept depends on doc_id and component alone
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


OP10_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + least(len(w), 4)), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT u AS a, v AS b FROM e UNION SELECT r.a, e.v FROM r JOIN e ON r.b = e.u),
c AS (SELECT doc_id, least(doc_id, coalesce((SELECT min(b) FROM r WHERE a = doc_id), doc_id)) AS component_id FROM d)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id"""


@register("op10_near_dedup", OP10_SQL)
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
