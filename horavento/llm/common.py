"""Helpers shared by the training-data operators: word hashing, typed Arrow
mapping and the table readers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a ``(spark, sf_dir) -> DataFrame`` query, with DuckDB SQL if any."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *cols) -> DataFrame:
    """Round-robin ``df`` over the session's shuffle partitions, or deal it by
    ``cols``: evens out a few large or very unequal input splits before
    CPU-bound work."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols) if cols else df.repartition(n)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict | None],
                schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to one dict of
    columns (or several, as an iterator); the dicts are cast to ``schema``."""
    spark = df.sparkSession
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = fn(batch)
            if out is None:
                continue
            for cols in ([out] if isinstance(out, dict) else out):
                arrays = []
                for f in arrow:
                    c = cols[f.name]
                    if isinstance(c, (pa.Array, pa.ChunkedArray)):
                        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
                        arrays.append(c if c.type == f.type else c.cast(f.type))
                    else:
                        arrays.append(pa.array(c, type=f.type))
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


# --- words of a text as 64-bit numbers --------------------------------------

U = np.uint64
SPACES = b" \t\n\x0b\x0c\r"
#: lower-cases A-Z only, leaves every other byte
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two multiply-xorshift rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * _M1
        x = (x ^ (x >> U(27))) * _M2
        return x ^ (x >> U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            steps = np.full(size, base, dtype=U)
            steps[0] = 1
            have = np.cumprod(steps, dtype=U)
        _powers[base] = have
    return have


def word_hashes(data: bytes, is_word: np.ndarray) -> np.ndarray:
    """64-bit hashes of the maximal runs of word bytes in ``data``, in order.

    The hash is a polynomial in the bytes of the word (prefix sums over the
    whole buffer, so no Python object per word), finalised by ``mix``.  The
    buffer is worked through in pieces cut between words."""
    out, at, piece = [], 0, 1 << 19
    while at < len(data):
        end = min(len(data), at + piece)
        if end < len(data):
            tail = np.frombuffer(data, np.uint8, count=end - at, offset=at)
            gaps = np.flatnonzero(~is_word[tail[-4096:]])
            if len(gaps):
                end = end - len(tail[-4096:]) + int(gaps[-1]) + 1
            else:
                while end < len(data) and is_word[data[end]]:
                    end += 1
        out.append(_hash_piece(np.frombuffer(data, np.uint8, count=end - at, offset=at), is_word))
        at = end
    if not out:
        return np.empty(0, dtype=U)
    return out[0] if len(out) == 1 else np.concatenate(out)


def _hash_piece(b: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    return spans_hashed(b, is_word)[0]


def spans_hashed(b: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the maximal runs of word bytes in ``b``."""
    n = len(b)
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = is_word[b]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, dtype=U), starts, ends
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, dtype=U)
        np.cumsum(_BYTE_VALUE[b] * _power(_BASE, n)[:n], out=total[1:])
        h = (total[ends] - total[starts]) * _power(_INV, n)[starts]
        return mix(h + (ends - starts).astype(U)), starts, ends


IS_SPACE_WORD = np.ones(256, dtype=bool)
IS_SPACE_WORD[list(SPACES)] = False


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a text
    (words between ASCII white space, A-Z lower-cased); with fewer words the
    whole sequence is one shingle, without words the set is empty."""
    if not text:
        return np.empty(0, dtype=U)
    w = word_hashes(text.encode("utf-8", "surrogatepass").translate(LOWER), IS_SPACE_WORD)
    if not len(w):
        return w
    k = min(size, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, U(k), dtype=U)
        for i in range(k):
            h = h * U(_BASE) + w[i:len(w) - k + 1 + i]
            h ^= h >> U(29)
        return np.unique(mix(h))


def about(df: DataFrame, rows: int, *keys) -> DataFrame:
    """About ``rows`` rows of ``df``, at most twice as many: the share chosen
    by a hash of ``keys``.  No partition passes on more than its share."""
    part = min(1.0, rows / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int(part * (1 << 30))).limit(2 * rows)


def text_column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that clash (case-insensitively) with result names."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed_similarity(a: Column, b: Column, slots: int, bits: int) -> Column:
    """Collision-corrected similarity of two packed signatures (arrays of
    longs with ``slots`` slots of ``bits`` bits): the share of equal slots,
    less what unequal minima agree on by chance.  XOR, fold, count bits."""
    ones = int("".join(["0" * (bits - 1) + "1"] * (64 // bits)), 2)
    ones = F.lit(ones - (1 << 64) if ones >= 1 << 63 else ones).cast("long")
    unequal = F.lit(0)
    for i in range(slots * bits // 64):
        x = a[i].bitwiseXOR(b[i])
        fold = x
        for s in range(1, bits):
            fold = fold.bitwiseOR(F.shiftrightunsigned(x, s))
        unequal = unequal + F.bit_count(fold.bitwiseAND(ones))
    chance = 1.0 / (1 << bits)
    return (1 - unequal / F.lit(float(slots)) - chance) / (1 - chance)


#: cells of the bit table of ``flagged``, 64 bits each
CELLS = 1 << 17


def flagged(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``df`` with boolean ``__likely``, false only if the long ``key`` is
    surely not in the single long column of ``keys``: a table of at most
    ``CELLS`` 64-bit masks (some megabytes, the same for any input) is
    broadcast and the key's bit looked up."""
    k = F.col(keys.columns[0])
    cell = lambda c: F.pmod(c, F.lit(CELLS))
    bit = lambda c: F.pmod(F.shiftright(c, 40), F.lit(64)).cast("int")
    masks = (keys.select(cell(k).alias("__cell"), bit(k).alias("__bit"))
             .groupBy("__cell").agg(F.expr("bit_or(shiftleft(1L, __bit))").alias("__mask")))
    return (df.withColumn("__cell", cell(key)).withColumn("__bit", bit(key))
            .join(F.broadcast(masks), "__cell", "left")
            .withColumn("__likely", F.expr("(shiftrightunsigned(coalesce(__mask, 0L), __bit) & 1L) = 1"))
            .drop("__cell", "__bit", "__mask"))


def only_likely(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    return flagged(df, key, keys).where("__likely").drop("__likely")
