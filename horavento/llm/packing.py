"""Packing into optimal length buckets.

The global histogram of token counts (one partial aggregate) goes to a dynamic
programme that chooses the bucket boundaries with the least total padding;
inside each bucket every sequence is padded to the boundary, so a batch of the
token budget holds ``budget // boundary`` sequences.

The histogram has a bounded number of bins: every count up to ``EXACT`` has
its own, longer ones share bins no wider than 1/2048 of their length.  Batches
form inside shards of a bucket of about ``SHARD_ROWS`` rows, dealt by a hash,
so no bucket, however full, is numbered in one task; only the last batch of a
shard may be partly filled.

Defined cases: null or wordless text has 0 tokens and is packed into the first
bucket; a document over the budget makes a batch of its own; repeated rows are
packed each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from horavento.llm.common import register, table
from horavento.session import materialize

BUCKETS, BUDGET = 12, 32_768
EXACT, SHARD_ROWS = 4096, 16_384


def n_words(text: Column) -> Column:
    """Tokens as words between ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The at most ``buckets`` upper bounds, taken from the sorted distinct
    ``lengths``, that minimise the sum of ``bound - length`` over all rows.

    ``best[j]`` is the least padding of the first ``j`` lengths with one more
    bucket per round.  The best last cut never moves left as ``j`` grows, so
    each round is solved by halving: O(buckets * n log n)."""
    n = len(lengths)
    if not n:
        return []
    size = np.array(lengths, dtype=np.int64)
    rows = np.concatenate(([0], np.cumsum(np.array(counts, dtype=np.int64))))
    tokens = np.concatenate(([0], np.cumsum(size * np.array(counts, dtype=np.int64))))
    best, cuts = size * rows[1:] - tokens[1:], []
    best = np.concatenate(([0], best))
    for _ in range(min(buckets, n) - 1):
        new, cut = np.empty(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        new[0] = 0
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            cost = best[i] + size[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            k = int(cost.argmin())
            new[j], cut[j] = cost[k], i[k]
            todo += [(lo, j - 1, a, int(i[k])), (j + 1, hi, int(i[k]), b)]
        best = new
        cuts.append(cut)
    out, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(size[j - 1]))
        j = int(cut[j])
    if j:
        out.append(int(size[j - 1]))
    return sorted(set(out))


def histogram(lengths: DataFrame) -> tuple[list[int], list[int]]:
    """Longest length and row count of every bin, in order."""
    n = F.col("n_tokens")
    width = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))) - 11, F.lit(0)))
    bin_ = F.when(n <= EXACT, n).otherwise((F.ceil(n / width) * width).cast("long"))
    rows = lengths.groupBy(bin_.alias("bin")).agg(F.max("n_tokens").alias("n"), F.count(F.lit(1)).alias("c")) \
        .orderBy("bin").collect()
    return [r.n for r in rows], [r.c for r in rows]


PACKED = "doc_id long, n_tokens long, bucket int, bucket_len long, batch_id string, slot int, padding long"


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, tokens: Column | None = None) -> DataFrame:
    """``doc_id, n_tokens, bucket, bucket_len, batch_id, slot, padding`` per
    row; ``tokens`` is the token count (words by default)."""
    tokens = n_words(F.col("text").cast("string")) if tokens is None else tokens
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), tokens.alias("n_tokens"))
                       .withColumn("uid", F.monotonically_increasing_id()), "pack-lengths")
    lengths, counts = histogram(rows)
    if not lengths:
        return docs.sparkSession.createDataFrame([], PACKED)
    bounds = boundaries(lengths, counts, buckets)
    held = np.zeros(len(bounds), dtype=np.int64)
    np.add.at(held, np.searchsorted(bounds, lengths), counts)
    bucket, bound, shards, fits = F.lit(None), F.lit(None), F.lit(None), F.lit(None)
    for k in reversed(range(len(bounds))):
        here = F.col("n_tokens") <= bounds[k]
        bucket = F.when(here, F.lit(k)).otherwise(bucket)
        bound = F.when(here, F.lit(bounds[k]).cast("long")).otherwise(bound)
        shards = F.when(here, F.lit(int(-(-held[k] // SHARD_ROWS)))).otherwise(shards)
        fits = F.when(here, F.lit(max(1, budget // max(1, bounds[k])))).otherwise(fits)
    rows = rows.select("doc_id", "n_tokens", "uid", bucket.cast("int").alias("bucket"), bound.alias("bucket_len"),
                       F.pmod(F.xxhash64("doc_id", "uid"), shards).cast("int").alias("shard"), fits.alias("fits"))
    at = F.row_number().over(W.partitionBy("bucket", "shard").orderBy("doc_id", "uid")) - 1
    return rows.withColumn("at", at).select(
        "doc_id", "n_tokens", "bucket", "bucket_len",
        F.concat_ws("-", "bucket", "shard", F.floor(F.col("at") / F.col("fits")).cast("string")).alias("batch_id"),
        F.pmod("at", "fits").cast("int").alias("slot"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))


@register("op6_pack")
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
