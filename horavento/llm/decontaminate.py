"""Benchmark decontamination with suffix arrays over the training texts.

Every task works through its documents in shards.  A shard is one sequence of
word numbers (numbered by the benchmark's vocabulary, 0 for any other word, a
run of 0 between documents) with a suffix array over it, sorted to window
depth.  The array is sparse: it holds the suffixes that open with two words
adjacent in some test item (or with a one-word item), as no other suffix can
match.  Every test suffix is binary-searched in it; the range found gives all
verbatim occurrences, which mark words, name items and are extended to the
longest match.  A document never leaves its task, so nothing is shuffled.

The benchmark is cut into blocks of at most about ``BLOCK_WORDS`` words, dealt
by a hash of the item; each block is searched in a pass of its own, chained
row by row, so what a task holds of the benchmark stays bounded however large
it is.

Defined cases: null or wordless documents have no words and no hits; items
without words match nothing; an item with a null id is listed as the empty
string; rows with the same item_id are one item; repeated documents are
answered row by row; all columns of ``docs`` are kept except those that clash
with a result's name.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from horavento.llm.common import map_batches, register, table, text_column, without

WINDOW = 10
BLOCK_WORDS = 400_000
#: words numbered, and suffixes sorted, at a time
SHARD = 2_000_000
#: every byte of a word as it is, A-Z lower-cased, all else a space
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class TestSuffixes:
    """One block of the benchmark: vocabulary, item words as numbers, and the
    sorted distinct windows with the items and places they come from."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.names = window, sorted({i for i, _ in items})
        place = {n: k for k, n in enumerate(self.names)}
        self.vocab: dict[bytes, int] = {}
        seqs, seen = [], set()
        for name, ws in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws]
            if ids and (name, tuple(ids)) not in seen:
                seen.add((name, tuple(ids)))
                seqs.append((place[name], np.array(ids, dtype=np.int64)))
        pad = np.full(window, -1, dtype=np.int64)
        self.words = np.concatenate([x for _, s in seqs for x in (s, pad)] or [pad])
        starts, depth, owner, at = [], [], [], 0
        for k, s in seqs:
            n = max(1, len(s) - window + 1)
            starts.append(at + np.arange(n))
            depth.append(np.full(n, min(window, len(s))))
            owner.append(np.full(n, k))
            at += len(s) + window
        cat = lambda x: np.concatenate(x) if x else np.empty(0, dtype=np.int64)
        starts, depth, owner = cat(starts), cat(depth), cat(owner)
        grid = self.words[np.minimum(starts[:, None] + np.arange(window), len(self.words) - 1)].copy()
        grid[np.arange(window) >= depth[:, None]] = 0
        keys = _keys(grid)
        order = np.lexsort((depth, keys))
        starts, depth, owner, keys = starts[order], depth[order], owner[order], keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (depth[1:] != depth[:-1])
        #: distinct windows: first and (behind the) last key, depth; rows of window k: first[k]:first[k + 1]
        self.first = np.append(np.flatnonzero(new), len(keys))
        self.low, self.depth = keys[new], depth[new]
        high = grid[order][new]
        high[np.arange(window) >= self.depth[:, None]] = 0xFFFFFFFF
        self.high = _keys(high)
        self.starts, self.owner = starts, owner
        pairs = [s[:-1] << 32 | s[1:] for _, s in seqs if len(s) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, dtype=np.int64)
        self.single = np.zeros(len(self.vocab) + 1, dtype=bool)
        self.single[[int(s[0]) for _, s in seqs if len(s) == 1]] = True

    @classmethod
    def of(cls, state: dict) -> TestSuffixes:
        block = cls.__new__(cls)
        block.__dict__.update(state)
        return block

    def number(self, text: str | None) -> np.ndarray:
        """The words of a text as numbers, piece by piece of the text."""
        if not text:
            return np.empty(0, dtype=np.int64)
        out, at, piece = [], 0, 1 << 20
        while at < len(text):
            end = at + piece
            # a piece ends behind an ASCII separator, or with the text
            while end < len(text) and (text[end - 1] >= "\x80" or text[end - 1].isalnum()):
                end += 1
            ws = words(text[at:end])
            out.append(np.fromiter(map(self.vocab.get, ws, repeat(0)), dtype=np.int64, count=len(ws)))
            at = end
        return out[0] if len(out) == 1 else np.concatenate(out)

    def occurrences(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ``(position in t, window)`` where a window occurs verbatim, by
        binary search in the suffix arrays of the shards of ``t``; ``t`` ends
        in ``window`` zeros."""
        found = []
        if not len(self.low):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        last = len(t) - self.window
        for at in range(0, last, SHARD):
            end = min(last, at + SHARD)
            here = t[at:end]
            keep = self.single[here]
            known = np.flatnonzero((here > 0) & (t[at + 1:end + 1] > 0))
            if len(self.pairs) and len(known):
                pair = here[known] << 32 | t[at + 1 + known]
                i = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
                keep[known[self.pairs[i] == pair]] = True
            suffix = at + np.flatnonzero(keep)
            if not len(suffix):
                continue
            keys = _keys(t[suffix[:, None] + np.arange(self.window)])
            order = np.argsort(keys, kind="stable")
            suffix, keys = suffix[order], keys[order]
            lo, hi = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
            n = hi - lo
            w = np.repeat(np.arange(len(n)), n)
            found.append((suffix[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())], w))
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def longest(self, t: np.ndarray, pos: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(position, words, item)`` of the occurrences that can't be
        extended to the left, extended to the right word by word."""
        n = self.first[w + 1] - self.first[w]
        row = np.repeat(self.first[w] - np.cumsum(n) + n, n) + np.arange(n.sum())
        q, p, depth, item = np.repeat(pos, n), self.starts[row], np.repeat(self.depth[w], n), self.owner[row]
        before = np.where(q > 0, t[np.maximum(q - 1, 0)], 0)
        left = (p > 0) & (before > 0) & (self.words[np.maximum(p - 1, 0)] == before)
        q, p, size, item = q[~left], p[~left], depth[~left].copy(), item[~left]
        alive = np.arange(len(q))
        while len(alive):
            i, j = q[alive] + size[alive], p[alive] + size[alive]
            ok = (i < len(t)) & (j < len(self.words))
            alive, i, j = alive[ok], i[ok], j[ok]
            alive = alive[t[i] == self.words[j]]
            size[alive] += 1
        return q, size, item


def _keys(grid: np.ndarray) -> np.ndarray:
    """Rows of word numbers as fixed-length byte strings that sort alike."""
    big = np.ascontiguousarray(grid.astype(np.uint32).astype(">u4"))
    return big.view(f"S{4 * grid.shape[1]}").ravel()


def _runs(hit: np.ndarray) -> list[int]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edge.tolist()


def _search(block: TestSuffixes, texts: list, before: list) -> tuple[list, list, list, list, list]:
    """Per text: word count, hit runs, item names and the longest match,
    united with ``before``, what earlier blocks found."""
    counts, runs, names, longest = [], [], [], []

    def flush(group: list[np.ndarray]):
        size = np.array([len(x) for x in group], dtype=np.int64)
        gap = np.zeros(block.window, dtype=np.int64)
        t = np.concatenate([y for x in group for y in (x, gap)] or [gap])
        begin = np.concatenate(([0], np.cumsum(size + block.window)))[:-1]
        pos, w = block.occurrences(t)
        delta = np.zeros(len(t) + block.window + 1, dtype=np.int64)
        np.add.at(delta, pos, 1)
        np.add.at(delta, pos + block.depth[w] if len(w) else pos, -1)
        hit = np.cumsum(delta) > 0
        doc = np.searchsorted(begin, pos, "right") - 1
        which: dict[int, list] = {}
        if len(pos):
            code = np.unique(doc * len(block.low) + w)
            for d, k in zip((code // len(block.low)).tolist(), (code % len(block.low)).tolist()):
                which.setdefault(d, []).append(k)
        best: dict[int, tuple] = {}
        if len(pos):
            q, words_, item = block.longest(t, pos, w)
            d = np.searchsorted(begin, q, "right") - 1
            order = np.lexsort((item, q, -words_, d))
            d, q, words_, item = d[order], q[order], words_[order], item[order]
            top = np.ones(len(d), dtype=bool)
            top[1:] = d[1:] != d[:-1]
            for a, b, c, e in zip(d[top].tolist(), q[top].tolist(), words_[top].tolist(), item[top].tolist()):
                best[a] = (c, b - int(begin[a]), block.names[e])
        for k in range(len(group)):
            old_runs, old_names, old_best = before[len(counts)]
            h = hit[begin[k]:begin[k] + size[k]]
            if old_runs:
                h = h.copy()
                for a, b in zip(old_runs[::2], old_runs[1::2]):
                    h[a:b] = True
            own = {block.names[o] for x in which.get(k, ()) for o in
                   set(block.owner[block.first[x]:block.first[x + 1]].tolist())}
            counts.append(int(size[k]))
            runs.append(_runs(h) if k in which or old_runs else [])
            names.append(sorted(own | set(old_names)))
            longest.append(max([x for x in (best.get(k), old_best) if x], key=lambda x: (x[0], -x[1]),
                               default=(0, None, None)))

    group, total = [], 0
    for text in texts:
        x = block.number(text)
        if group and total + len(x) > SHARD:
            flush(group)
            group, total = [], 0
        group.append(x)
        total += len(x)
    flush(group)
    return counts, runs, names, longest


def _blocks(benchmark: DataFrame, block_words: int):
    """The benchmark's items, one bounded block after another."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # words are at least one byte with one separator each, so half the bytes bound their number
    bound = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 2 + 1
    n = -(-bound // block_words)
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item, words(r.text)) for r in part.collect()]


STATE = "__words long, __runs array<long>, __items array<string>, __long long, __at long, __of string"


def annotate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_runs`` (word offsets, start
    and end by turns), ``items``, ``n_items``, ``items_sha256``,
    ``contaminated``, ``longest`` (words of the longest verbatim match, at
    least a window), ``longest_at`` and ``longest_item``."""
    spark = docs.sparkSession
    result = ["n_words", "n_hit", "hit_runs", "items", "n_items", "items_sha256", "contaminated", "longest",
              "longest_at", "longest_item"]
    out = without(docs, *[r for r in result], *[f.split()[0] for f in STATE.split(", ")])
    state = spark.createDataFrame([], STATE).schema.fields
    plain = out.schema
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in plain.fields] + state)
    out = out.select("*", F.col("text").cast("string").alias("__text"))
    for block in _blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(vars(TestSuffixes(block, window)))

        def fn(batch: pa.RecordBatch, shared=shared, names=tuple(plain.names)) -> dict:
            texts = text_column(batch, "__text")
            before = ([([], [], None)] * len(texts) if "__runs" not in batch.schema.names else
                      [(r, i, (n, a, o) if n else None) for r, i, n, a, o in
                       zip(*(text_column(batch, c) for c in ("__runs", "__items", "__long", "__at", "__of")))])
            counts, runs, items, best = _search(TestSuffixes.of(shared.value), texts, before)
            cols = {n: batch.column(k) for k, n in enumerate(batch.schema.names) if n in names}
            return cols | {"__words": counts, "__runs": runs, "__items": items, "__long": [b[0] for b in best],
                           "__at": [b[1] for b in best], "__of": [b[2] for b in best], "__text": texts}

        out = map_batches(out, fn, T.StructType(schema.fields + [T.StructField("__text", T.StringType())]))
    starts = F.expr("filter(__runs, (x, i) -> i % 2 = 0)")
    ends = F.expr("filter(__runs, (x, i) -> i % 2 = 1)")
    hit = F.aggregate(F.zip_with(ends, starts, lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select(
        *[F.col(f"`{n}`") for n in plain.names], F.col("__words").alias("n_words"), hit.alias("n_hit"),
        F.col("__runs").alias("hit_runs"), F.col("__items").alias("items"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("__items")), 256).alias("items_sha256"),
        (F.size("__runs") > 0).alias("contaminated"), F.col("__long").alias("longest"),
        F.col("__at").alias("longest_at"), F.col("__of").alias("longest_item"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) without the affected documents."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select(F.struct(*names).alias("row"), F.col("text").cast("string").alias("text"))
    return annotate(packed, benchmark, window).where("NOT contaminated").select("row.*")


_WORDS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark),
iw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n,
  array_to_string(list_slice(w, s + 1, s + least(len(w), 10)), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, n, array_to_string(list_slice(w, s + 1, s + n), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
occ AS (SELECT doc_id, s, dw.n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)"""


@register("op2_decontaminate", OP2_SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return annotate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
