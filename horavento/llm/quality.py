"""Quality classifier: random Fourier features of document statistics, ridge
regression from partition-summed normal equations, isotonic calibration.

1. One pass over the texts gives ``STATISTICS`` numbers per document.
2. The labelled rows (at most about ``MAX_LABELLED``, by a hash of doc_id)
   are standardised, mapped to ``FEATURES`` random cosines (a Gaussian kernel)
   and summed to the normal equations per partition; the driver adds
   ``PARTS`` matrices of fixed size and solves them.
3. Labelled rows of another fold give a histogram of raw scores with the
   labels' sums; pool-adjacent-violators over its bins is the calibration.
4. Every document is scored with the model, a few kilobytes in the closure.

Defined cases: null text counts as empty, and empty texts are scored; without
any usable label every score is 1.0 (nothing speaks against a document); a
null doc_id is never learnt from and not held out; conflicting labels of one
doc_id are averaged; null labels are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from horavento.llm.common import IS_SPACE_WORD, LOWER, map_batches, register, table, text_column, word_hashes
from horavento.session import materialize

MAX_LABELLED = 400_000
FEATURES, PARTS, RIDGE, GAMMA = 384, 8, 1e-3, 0.03
THRESHOLD = 0.7
BINS = 1024
BLOCK = 32

STATISTICS = (
    "log_words", "word_length", "word_length_sd", "upper", "digits", "symbols", "exclaim", "bars", "distinct",
    "top_word", "repeated", "symbol_end", "sentence_end", "log_lines", "repeated_lines", "log_line_words",
    "upper_words", "worst_upper", "worst_symbol", "worst_repeat", "worst_bars", "odd_bytes", "next_distinct",
)

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#$%&*|<>{}[]\\^~_=+@/"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:?\"')"]] = True
_ODD = np.zeros(256, dtype=bool)
_ODD[:32] = True
_ODD[127] = True
_ODD[list(b"\t\n\r")] = False


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text, in the order of ``STATISTICS``."""
    out = np.zeros(len(STATISTICS), dtype=np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = IS_SPACE_WORD[b]
    edge = np.diff(inside)
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(lo)
    if not n:
        return out
    size = hi - lo
    upper, letter, symbol = _UPPER[b], _LETTER[b], _SYMBOL[b]
    sums = lambda x: np.add.reduceat(x, lo, dtype=np.int32)  # noqa: E731  white space counts in none of them
    up, let, sym = sums(upper), sums(letter), sums(symbol)
    last = b[hi - 1]
    caps = (up > 1) & (up == let)
    marked = sym > 0
    bar = (size == 1) & (last == 124)
    h = word_hashes(data.translate(LOWER), IS_SPACE_WORD)
    same = np.zeros(n, dtype=bool)
    same[1:] = h[1:] == h[:-1]
    _, count = np.unique(h, return_counts=True)
    pair = np.unique(h[1:] * np.uint64(3) + h[:-1]) if n > 1 else h
    lines = [x for x in data.split(b"\n") if x.strip()]
    blocks = np.arange(0, n, BLOCK)
    weight = np.minimum(BLOCK, n - blocks).astype(np.float32)

    def worst(flag):
        return float((np.add.reduceat(flag, blocks, dtype=np.int32) / np.maximum(weight, 8)).max())

    chars, letters = int(size.sum()), max(1, int(let.sum()))
    out[:] = (np.log1p(n), min(float(size.mean()), 40.0), min(float(size.std()), 40.0), up.sum() / letters,
              _DIGIT[b].sum() / chars, sym.sum() / chars, min((b == 33).sum() / n, 3.0), bar.mean(),
              len(count) / n, count.max() / n, same.mean(), _SYMBOL[last].mean(), _STOP[last].mean(),
              np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
              caps.mean(), worst(caps), worst(marked & ~bar), worst(same), worst(bar),
              min(_ODD[b].sum() / chars, 1.0), len(pair) / n)
    return out


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index(name))
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(STATISTICS)).astype(np.float64)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics per row."""
    def fn(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "x": [statistics(t) for t in text_column(batch, "text")]}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                       fn, "doc_id long, x array<float>")


class Model:
    """Standardisation, random features, ridge weights, calibration knots."""

    def __init__(self, mean, scale, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.asarray(mean), np.asarray(scale)
        self.directions = rng.normal(0, np.sqrt(2 * GAMMA), (len(self.mean), FEATURES))
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.knots, self.values = np.array([0.0]), np.array([1.0])

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing weighted least-squares fit of the bin means
    (pool adjacent violators)."""
    level, size, bins = [], [], []
    for w, t in zip(weight, total):
        level.append(t / w)
        size.append(w)
        bins.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            w2 = size[-2] + size[-1]
            level[-2:] = [(level[-2] * size[-2] + level[-1] * size[-1]) / w2]
            size[-2:], bins[-2:] = [w2], [bins[-2] + bins[-1]]
    return np.repeat(level, bins)


def held_out(doc_id):
    """The documents whose labels are never used."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(stats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model | None:
    """Learn from the labelled rows of ``stats`` (``doc_id, x``) that are not
    held out; None if there are none."""
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
         .where("doc_id IS NOT NULL AND y IS NOT NULL").where(~held_out(F.col("doc_id")))
         .groupBy("doc_id").agg(F.avg("y").alias("y")))
    rows = y.count()
    if rows > max_labelled:
        y = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(max_labelled / rows * (1 << 30)))
    used = materialize(stats.join(y, "doc_id").withColumn("fold", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)))
                       .select("doc_id", "x", "y", "fold"), "quality-labelled")
    d = len(STATISTICS)
    m = used.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)],
                 *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    if not m["n"]:
        return None
    model = Model([m[f"m{i}"] for i in range(d)], [max(m[f"s{i}"], 1e-3) for i in range(d)])
    size = FEATURES + 1

    def sums(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.expand(_matrix(batch, "x"))
                total += z.T @ np.hstack([z, batch.column(1).to_numpy()[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    # folds 1 and 3 fit, fold 0 calibrates; with too few rows one fold does both
    parts = (used.where("fold <> 0").select("x", "y").repartition(PARTS).mapInArrow(sums, "part binary").collect())
    total = np.sum([np.frombuffer(p.part).reshape(size, size + 1) for p in parts], axis=0)
    if not total[-1, -2]:
        return None
    a = total[:, :-1] + RIDGE * total[-1, -2] * np.diag([1.0] * FEATURES + [0.0]) / FEATURES
    model.weights = np.linalg.solve(a + 1e-9 * np.eye(size), total[:, -1])

    def raw(batch: pa.RecordBatch) -> dict:
        r = np.clip(model.raw(_matrix(batch, "x")), -0.5, 1.5)
        return {"bin": np.floor((r + 0.5) / 2 * BINS).astype(np.int64), "y": batch.column(1), "r": r}

    binned = lambda df: (map_batches(df.select("x", "y"), raw, "bin long, y double, r double").groupBy("bin")
                         .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t"), F.avg("r").alias("r"))
                         .orderBy("bin").collect())
    hist = binned(used.where("fold = 0")) or binned(used)
    w = np.array([h.n for h in hist], dtype=float)
    level = isotonic(w, np.array([h.t for h in hist]))
    model.knots, model.values = np.array([h.r for h in hist]), level
    return model


def score(stats: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``stats``."""
    if model is None:
        out = stats.select("doc_id", F.lit(1.0).alias("score"))
    else:
        def fn(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "score": model.score(_matrix(batch, "x"))}

        out = map_batches(stats.select("doc_id", "x"), fn, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all columns) without the documents that the model rejects.
    The rows are scored where they are, so no text is shuffled."""
    model = fit(materialize(with_statistics(docs), "quality-stats"), labels)
    if model is None:
        return docs
    schema = T.StructType([T.StructField("row", docs.select(F.struct("*").alias("r")).schema["r"].dataType),
                           T.StructField("good", T.BooleanType())])

    def fn(batch: pa.RecordBatch) -> dict:
        x = np.array([statistics(t) for t in text_column(batch, "__text")], dtype=np.float64).reshape(-1, len(STATISTICS))
        return {"row": batch.column(0), "good": (model.score(x) >= threshold).tolist() if len(x) else []}

    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), F.col("text").cast("string").alias("__text"))
    return map_batches(rows, fn, schema).where("good").select("row.*")


@register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(with_statistics(table(spark, sf_dir, "documents")), "quality-stats")
    return score(stats, fit(stats, table(spark, sf_dir, "labels")))
