"""Log-likelihood of whole documents under a gated recurrent language model.

1. Word counts of all training documents: per batch a local count, then one
   partial aggregate by word.  The count table grows with the corpus and stays
   distributed; of it only the ``LOCAL`` most frequent words and a sum per
   shape class travel to the tasks.
2. Every text is turned into input numbers once; the written table of numbers
   is what training and scoring read.
3. The network (``gru``) is trained on all tokens of all training documents,
   which a hash deals to ``ROUNDS`` rounds and, in a round, to shards of about
   ``BLOCK_TOKENS`` tokens, whatever the layout of the input (a document of
   more than ``PIECE`` tokens goes piece by piece).  Truncated backpropagation
   runs over every shard from the round's starting weights; the shards'
   weights are averaged by their tokens.  Beyond ``SHARDS`` shards a round they
   grow instead, and a shard is worked through in blocks of ``BLOCK_TOKENS``.
4. Every document is scored whole, its state carried from token to token.  The
   network tells the head words apart and gives the shape class of any other
   word; inside a shape class a word has the share (c + 1) / T of its class.
5. The counts of words beyond the local table are joined in: per document only
   the distinct such words are shuffled, keyed by word.

Defined cases: null or empty text is the end token alone; a null doc_id is not
held out and is trained on; a text of any length is counted, trained on and
scored whole; repeated rows are scored each (and counted each); without
training tokens all counts are 0; an empty table gives an empty result; columns
other than doc_id and text are not read, whatever their names.  Shards and the
order inside them follow from doc_id and text alone, so the layout of the input
changes a score by no more than rounding; only rows whose repeats would fill a
quarter of a shard are dealt by their row numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm import gru
from horavento.llm.common import map_batches, register, table
from horavento.session import materialize

LOCAL = 100_000
#: documents are scored side by side in groups of about this many tokens
GROUP_TOKENS = 1_000_000
#: tokens of a shard, and of a block inside a shard that had to grow
BLOCK_TOKENS, ROUNDS, SHARDS = 500_000, 3, 8192
#: longer documents are dealt to shards in pieces of so many tokens
PIECE = 16_384
#: texts are split into words about so many bytes at a time
TEXT_BYTES = 4_000_000
#: rows of weights that one task sums, and that reach the driver at most
FAN = 16


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def _parts(batch: pa.RecordBatch, column: int):
    """Slices of a batch with texts of about ``TEXT_BYTES``, or one longer text."""
    size = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(size, size[begin] + TEXT_BYTES, side="right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space of all texts, A-Z lower-cased, one
    after another, and the number of words of every text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, owner = pc.list_flatten(split), pc.list_parent_indices(split)
    full = pc.not_equal(pc.binary_length(flat), 0)
    size = np.bincount(owner.filter(full).to_numpy(zero_copy_only=False), minlength=len(texts))
    return flat.filter(full).cast(pa.binary()), size


def shapes(ws: pa.Array) -> np.ndarray:
    """The shape classes of words."""
    if not len(ws):
        return np.empty(0, dtype=np.int64)
    at = np.frombuffer(ws.buffers()[1], np.int32)[ws.offset:ws.offset + len(ws) + 1]
    data = np.frombuffer(ws.buffers()[2], np.uint8)
    wide = np.append(0, np.cumsum(data > 127))
    return gru.shapes(data[at[1:] - 1], wide[at[1:]] > wide[at[:-1]])


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes; empty for the end token) and its count ``c`` in the
    training documents."""
    def fn(batch: pa.RecordBatch):
        for part in _parts(batch, 0):
            counted = words(part.column(0))[0].value_counts()
            word, c = counted.field(0), counted.field(1)
            yield {"word": pa.concat_arrays([word, pa.array([b""], pa.binary())]),
                   "c": np.append(c.to_numpy(), part.num_rows), "shape": np.append(shapes(word), -1)}

    return map_batches(docs.where(~F.col("held_out")).select("text"), fn, "word binary, c long, shape int") \
        .groupBy("word").agg(F.sum("c").alias("c"), F.first("shape").alias("shape"))


class Vocabulary:
    """The ``LOCAL`` most frequent words with their counts, the totals of the
    corpus, and every shape class's total."""

    def __init__(self, counts: DataFrame, local: int):
        t = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.n, self.v = t.n, t.v
        # a histogram of the counts' logarithms gives the least count of the local words
        step = F.floor(F.log(F.col("c").cast("double")) * 64)
        least, have = 0, 0
        for r in counts.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("c")) \
                .orderBy(F.desc("b")).collect():
            if have + r.k > local:
                break
            have, least = have + r.k, r.c
        rows = counts.where(F.col("c") >= max(least, 1)).select("word", "c").collect() if have else []
        rows = sorted(((bytes(r.word), r.c) for r in rows), key=lambda r: (-r[1], r[0]))
        self.end = next((c for w, c in rows if not w), 0) or (
            (counts.where(F.length("word") == 0).agg(F.sum("c")).first()[0] or 0))
        rows = [r for r in rows if r[0]]
        #: the local words by their place in ``count``; the first HEAD places are head words
        self.place = pa.array([w for w, _ in rows], pa.binary())
        self.count = np.array([c for _, c in rows] + [0], dtype=np.int64)
        shapes = np.array([gru.shape(w) for w, _ in rows], dtype=np.int64)
        #: input numbers of the local words
        self.input = np.concatenate([np.arange(len(rows))[:gru.HEAD] + 1, gru.HEAD + 1 + shapes[gru.HEAD:], [0]]).astype(np.int64)
        self.total = np.ones(gru.SHAPES)
        for r in counts.where(F.length("word") > 0).groupBy("shape").agg(F.sum(F.col("c") + 1).alias("t")).collect():
            self.total[r["shape"]] += r.t
        np.add.at(self.total, shapes[:gru.HEAD], -(self.count[:-1][:gru.HEAD] + 1))

    @classmethod
    def of(cls, state: dict) -> Vocabulary:
        v = cls.__new__(cls)
        v.__dict__.update(state)
        return v

    def log_share(self) -> np.ndarray:
        """Starting biases: log shares of the output classes and, behind
        them, of the head words."""
        head = np.zeros(gru.HEAD)
        c = self.count[:-1][:gru.HEAD]
        head[:len(c)] = c
        head += 0.01
        per = head.reshape(gru.CLASSES, gru.PER_CLASS)
        cls = np.concatenate([[self.end + 1], per.sum(axis=1) + 1, self.total])
        return np.concatenate([np.log(cls / cls.sum()), np.log(per / per.sum(axis=1, keepdims=True)).ravel()])

    def read(self, ws: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Places (-1: not local) and input numbers of words, and the words
        that are not local."""
        place = pc.fill_null(pc.index_in(ws, value_set=self.place), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        x, far = self.input[place], place < 0
        rest = ws.filter(pa.array(far))
        x[far] = gru.HEAD + 1 + shapes(rest)
        return place, x, rest


def numbered(rows: DataFrame, shared) -> DataFrame:
    """Per row a number ``uid``, a hash of the row, the input numbers ``x`` with the end token,
    what the local counts give, and the distinct other words with their times;
    written once."""
    def number(batch: pa.RecordBatch, v: Vocabulary) -> dict:
        n = batch.num_rows
        ws, size = words(batch.column(1))
        place, x, rest = v.read(ws)
        row, near, tail = np.repeat(np.arange(n), size), place >= 0, x > gru.HEAD
        log_count, log_total = np.log10(v.count + 1.0), np.log10(v.total)

        def per_row(which, weights=None):
            return np.bincount(row[which], weights=None if weights is None else weights[which], minlength=n)

        lift = log_count[place]
        share = log_total[np.maximum(x - gru.HEAD - 1, 0)]
        far = pa.table({"row": row[~near], "word": rest}).group_by(["row", "word"], use_threads=False).aggregate([("word", "count")])
        far = far.sort_by("row").combine_chunks()
        cuts = pa.array(np.append(0, np.cumsum(np.bincount(far["row"].to_numpy(), minlength=n))), pa.int32())
        whole = lambda c, kind: pa.concat_arrays([pa.array([], kind)] + [k.cast(kind) for k in c.chunks])
        return {"doc_id": batch.column(0), "held_out": batch.column(2), "key": batch.column(3),
                "x": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size + 1)), pa.int32()),
                                              pa.array(np.insert(x, np.cumsum(size), 0), pa.int32())),
                "known": per_row(near) + (v.end > 0), "base": per_row(near, lift) + np.log10(v.end + 1.0),
                "model": per_row(near & tail, lift) - per_row(tail, share),
                "far": pa.ListArray.from_arrays(cuts, whole(far["word"], pa.binary())),
                "times": pa.ListArray.from_arrays(cuts, whole(far["word_count"], pa.int64()))}

    def fn(batch: pa.RecordBatch):
        v = Vocabulary.of(shared.value)
        for part in _parts(batch, 1):
            yield number(part, v)

    kinds = "doc_id long, held_out boolean, key long, x array<int>, known long, base double, model double, far array<binary>, times array<long>"
    keyed = rows.select("doc_id", "text", "held_out", F.xxhash64("doc_id", "text").alias("key"))
    return materialize(map_batches(keyed, fn, kinds).withColumn("uid", F.monotonically_increasing_id()), "lm-numbered")


def _blocks(batches, tokens: int):
    """(shard, token stream) of at most ``tokens`` tokens, from rows of shard
    and tokens that are sorted by shard."""
    held, have, shard = [], 0, None
    for batch in batches:
        x = batch.column(1)
        values, cuts = x.values.to_numpy(zero_copy_only=False), x.offsets.to_pylist()
        for s, a, b in zip(batch.column(0).to_pylist(), cuts, cuts[1:]):
            if s != shard and held:
                yield shard, np.concatenate(held)
                held, have = [], 0
            shard = s
            while a < b:
                n = min(b - a, tokens - have)
                held.append(values[a:a + n])
                a, have = a + n, have + n
                if have == tokens:
                    yield shard, np.concatenate(held)
                    held, have = [], 0
    if held:
        yield shard, np.concatenate(held)


def _weights(n: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([flat.astype(np.float32).tobytes()], pa.binary())], ["n", "w"])


def _averaged(batches):
    """The average of weights, by their tokens, and all the tokens."""
    n, total = 0, 0.0
    for batch in batches:
        for k, w in zip(batch.column(0).to_pylist(), batch.column(1)):
            n, total = n + k, total + k * np.frombuffer(w.as_buffer(), dtype=np.float32).astype(np.float64)
    if n:
        yield _weights(n, total / n)


def fit(numbers: DataFrame, vocab: Vocabulary, tokens: int = BLOCK_TOKENS, rounds: int = ROUNDS) -> dict:
    """The trained weights: data-parallel rounds with averaged weights, every
    training document in one of them."""
    params = gru.initial(vocab.log_share())
    if not vocab.n:
        return params
    spark = numbers.sparkSession
    shards = min(SHARDS, -(-vocab.n // (rounds * tokens)))
    pieces = F.when(F.size("x") <= PIECE, F.array("x")).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.size("x") - 1) / PIECE).cast("int")),
                    lambda k: F.slice("x", k * PIECE + 1, F.lit(PIECE))))
    train_rows = numbers.where(~F.col("held_out")).select("uid", "key", "x")
    often = materialize(train_rows.groupBy("key").agg(F.sum(F.size("x")).alias("n"), F.count(F.lit(1)).alias("k"))
                        .where((F.col("k") > 1) & (F.col("n") > tokens / 4)).select("key", F.lit(True).alias("often")), "lm-often")
    if not often.isEmpty():
        train_rows = (train_rows.join(often, "key", "left")
                      .withColumn("key", F.when(F.col("often"), F.xxhash64("key", "uid")).otherwise(F.col("key"))))
    for turn in range(rounds):
        now = spark.sparkContext.broadcast(params)

        def run(batches, turn=turn, now=now):
            shard, n, p, squares = None, 0, {}, {}
            for s, stream in _blocks(batches, tokens):
                if s != shard:
                    if n:
                        yield _weights(n, np.concatenate([p[k].ravel() for k in sorted(p)]))
                    shard, n, p = s, 0, {k: w.copy() for k, w in now.value.items()}
                    squares = gru.start(p)
                gru.train(p, stream, lanes=min(512, max(64, len(stream) // 1000)), rate=0.1 / (1 + turn), squares=squares)
                n += len(stream)
            if n:
                yield _weights(n, np.concatenate([p[k].ravel() for k in sorted(p)]))

        dealt = (train_rows.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == turn).select("key", F.posexplode(pieces).alias("piece", "x"))
                 .select(F.pmod(F.xxhash64("piece", "key"), F.lit(shards)).alias("shard"), F.xxhash64("key", "piece").alias("place"), "x")
                 .repartition(shards, "shard").sortWithinPartitions("shard", "place").select("shard", "x"))
        trained = materialize(dealt.mapInArrow(run, "n long, w binary"), "lm-weights")
        while (k := trained.count()) > FAN:
            trained = materialize(trained.coalesce(-(-k // FAN)).mapInArrow(_averaged, "n long, w binary"), "lm-weights")
        n, total = 0, 0.0
        for g in trained.toLocalIterator():
            n, total = n + g.n, total + g.n * np.frombuffer(g.w, dtype=np.float32).astype(np.float64)
        if n:
            flat, at = (total / n).astype(np.float32), 0
            for k in sorted(params):
                params[k] = flat[at:at + params[k].size].reshape(params[k].shape)
                at += params[k].size
    return params


def score(docs: DataFrame, local: int = LOCAL, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` per row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       held_out(F.col("doc_id").cast("long")).alias("held_out"))
    counts = materialize(word_counts(rows), "lm-counts")
    vocab = Vocabulary(counts, local)
    numbers = numbered(rows, spark.sparkContext.broadcast(vars(vocab)))
    weights = spark.sparkContext.broadcast(fit(numbers, vocab, tokens))

    def fn(batch: pa.RecordBatch):
        x = batch.column(batch.num_columns - 1)
        values, cuts = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()
        begin = 0
        while begin < len(x):
            end = max(begin + 1, int(np.searchsorted(cuts, cuts[begin] + GROUP_TOKENS, side="right")) - 1)
            part = batch.slice(begin, end - begin)
            lp = gru.score_documents(weights.value, [values[a:b] for a, b in zip(cuts[begin:end], cuts[begin + 1:end + 1])])
            yield {"uid": part.column(0), "doc_id": part.column(1), "held_out": part.column(2), "known": part.column(3), "base": part.column(4),
                   "model": part.column(5).to_numpy() + lp / np.log(10), "n_tokens": np.diff(cuts[begin:end + 1])}
            begin = end

    scored = materialize(map_batches(numbers.select("uid", "doc_id", "held_out", "known", "base", "model", "x"), fn,
                                     "uid long, doc_id long, held_out boolean, known long, base double, model double, n_tokens long"), "lm-scored")
    tail = numbers.select("uid", F.explode(F.arrays_zip("far", "times")).alias("z")).select("uid", F.col("z.far").alias("word"), F.col("z.times").alias("k"))
    # the counts have a row per word: hashed, neither side is sorted by its words
    rest = (tail.join(counts.select("word", "c").hint("shuffle_hash"), "word").groupBy("uid")
            .agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + F.lit(1.0))).alias("lift")))
    return scored.join(rest, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("lift", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(vocab.n + vocab.v + 1)))).alias("base_score"),
        (F.col("model") + F.coalesce("lift", F.lit(0.0))).alias("score"))


@register("op1_language_model")
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
