"""Phrase collocations by best-first branch and bound.

A phrase of 2 to 5 words that occurs at least ``MIN_COUNT`` times in a
language scores ``floor(1000 * a * n / (l * r))`` at its lowest cut into a
first part (``l`` occurrences) and a rest (``r``), with ``a`` occurrences of
its own among ``n`` words.  The best ``TOP`` of every language are wanted.

1. One pass counts the words.  A word below ``MIN_COUNT`` stands in no
   candidate; a second pass turns the texts into blocks of 64-bit word hashes
   with a boundary (0) in its place and between pieces, and writes stretches
   of two words and more for the passes that follow.
2. Bound: a phrase that begins with a prefix of ``l`` occurrences scores at
   most ``floor(1000 * n / l)``, because ``a <= r``.  Of all prefixes of a
   phrase the first word gives the least bound.  The frontier therefore opens
   with the rarest first words, which have the largest bounds, and grows in
   waves towards the frequent ones.
3. A wave grows the phrases of its first words word by word.  Only occurrences
   whose prefix is frequent are counted: a bit table of bounded size
   (``CELLS`` masks, no false negatives) of the prefixes of the last step
   travels to the tasks, which add equal phrases up before the shuffle.  The
   rests of the phrases are counted in one more pass.
4. With every phrase the least and greatest word before and behind it are
   kept.  If one word stands at all its occurrences, a longer candidate has
   the same count, and the phrase is dropped; a longer candidate of any length
   with that count implies one that is longer by a word, so this is exact.
5. A language is settled when ``TOP`` surviving phrases score more than the
   bound of the first words not opened yet (so ties are settled, too), or when
   no first word is left.  Only settled languages leave the frontier.

Words are told apart by their 64-bit hashes; counts, products and quotients are
exact (decimals of 38 digits).

Defined cases: null text is empty, a null language is ``und``; pieces of one
word give nothing; repeated rows count each; very long texts are worked
through in bounded pieces, cut between words (about 8 bytes a frequent word
are held for a text); ties rank by count, then by the
phrase's bytes; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from horavento.llm.common import CELLS, LOWER, U, mix, register, spans_hashed, table
from horavento.session import materialize

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: first words of a language in the first wave, and growth from wave to wave
FIRST_WAVE, GROWTH = 3 * TOP, 4
#: bytes of text turned into one block of words, and counted rows a task holds
BLOCK, HELD = 1 << 19, 1 << 17
#: words of a written row, and rows looked through at once
ROW, ROWS = 256, 512
#: first words share a step of the frontier within a quarter octave of counts
STEPS = 4

_SPLITS = b".,;:!?\n\x0b\x0c\r"
_IS_SPLIT = np.zeros(256, dtype=bool)
_IS_SPLIT[list(_SPLITS)] = True
_IS_WORD = ~_IS_SPLIT
_IS_WORD[list(b" \t")] = False
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
_BASE = U(0x9E3779B97F4A7C15)


# --- words -------------------------------------------------------------------

def _blocks(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bounded stretches of ``data``, cut between words: bytes, word hashes,
    starts, ends, and whether a new piece begins at a word."""
    at, open_piece = 0, True
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data) and _IS_WORD[data[end]] and _IS_WORD[data[end - 1]]:
            end += 1
        b = np.frombuffer(data, np.uint8, count=end - at, offset=at)
        h, starts, ends = spans_hashed(b, _IS_WORD)
        splits = np.concatenate(([0], np.cumsum(_IS_SPLIT[b])))
        if len(h):
            h[h == 0] = 1
            fresh = np.empty(len(h), dtype=bool)
            fresh[0] = open_piece or splits[starts[0]] > 0
            fresh[1:] = splits[starts[1:]] > splits[ends[:-1]]
            open_piece = bool(splits[-1] > splits[ends[-1]])
            yield b, h, starts, ends, fresh
        else:
            open_piece = open_piece or bool(splits[-1])
        at = end


def _with_boundaries(h: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The words with a 0 before each that begins a piece."""
    out = np.zeros(len(h) + int(fresh.sum()), dtype=U)
    out[np.arange(len(h)) + np.cumsum(fresh)] = h
    return out


def _groups(batches) -> Iterator[tuple[str, bytes]]:
    """Texts of one language, joined until they fill a block."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            held.setdefault(lang, []).append(data)
            size[lang] = size.get(lang, 0) + len(data) + 1
            if size[lang] >= BLOCK:
                yield lang, b"\n".join(held.pop(lang)).translate(LOWER)
                del size[lang]
    for lang, texts in held.items():
        yield lang, b"\n".join(texts).translate(LOWER)


def _merged(parts):
    """Counts of distinct words, with their bytes."""
    h = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    words = pa.concat_arrays([p[2] for p in parts])
    h, first, at = np.unique(h, return_index=True, return_inverse=True)
    return h, np.bincount(at, weights=counts, minlength=len(h)).astype(np.int64), words.take(pa.array(first))


def _word_counts(texts: DataFrame) -> DataFrame:
    """``lang, h, a, word``: words by their hash, added up before the shuffle;
    a task holds a bounded number of them."""
    def rows(tally):
        for lang, parts in tally.items():
            h, counts, words = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(h.view(np.int64)),
                                              pa.array(counts), words], names=["lang", "h", "cnt", "word"])

    def run(batches):
        tally, size = {}, 0
        for lang, data in _groups(batches):
            for b, h, starts, ends, _ in _blocks(data):
                u, first, counts = np.unique(h, return_index=True, return_counts=True)
                raw = b.tobytes()
                words = pa.array([raw[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())], pa.binary())
                tally.setdefault(lang, []).append((u, counts, words))
                size += len(u)
            if size > HELD:
                tally = {lang: [_merged(parts)] for lang, parts in tally.items()}
                size = sum(len(parts[0][0]) for parts in tally.values())
                if size > HELD // 2:
                    yield from rows(tally)
                    tally, size = {}, 0
        yield from rows(tally)

    # the word is a key and not an aggregate, so that the rows are hashed and not sorted
    return texts.mapInArrow(run, "lang string, h long, cnt long, word binary").groupBy("lang", "h", "word").agg(F.sum("cnt").alias("a"))


# --- bit tables of phrases -----------------------------------------------------

def _salt(lang: str) -> np.uint64:
    h = 0xCBF29CE484222325
    for b in lang.encode("utf-8", "surrogatepass"):
        h = ((h ^ b) * 0x100000001B3) % (1 << 64)
    return U(h)


def _key(words: list[np.ndarray], lang: str) -> np.ndarray:
    """One 64-bit number per word sequence of a language."""
    with np.errstate(over="ignore"):
        h = np.full(len(words[0]), _salt(lang) + U(len(words)), dtype=U)
        for w in words:
            h = mix(h * _BASE + w)
    return h


def _bit_table(phrases: DataFrame) -> np.ndarray:
    """Bits of the phrases (``lang``, ``w1`` ...; 0 after the last word): at
    most ``CELLS`` masks reach the driver, whatever the number of phrases."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            words = [batch.column(i).to_numpy().view(U) for i in range(1, batch.num_columns)]
            size = sum((w != 0).astype(int) for w in words)
            keys = np.empty(batch.num_rows, dtype=U)
            for lang in set(langs):
                for k in range(1, len(words) + 1):
                    at = np.flatnonzero((langs == lang) & (size == k))
                    if len(at):
                        keys[at] = _key([w[at] for w in words[:k]], lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array((keys % U(CELLS)).astype(np.int32)),
                 pa.array((U(1) << ((keys >> U(40)) % U(64))).view(np.int64))], names=["cell", "mask"])

    cols = [c for c in _WORDS if c in phrases.columns]
    masks = (phrases.select("lang", *cols).mapInArrow(run, "cell int, mask long")
             .groupBy("cell").agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
    out = np.zeros(CELLS, dtype=U)
    out[masks.column(0).to_numpy()] = masks.column(1).to_numpy().view(U)
    return out


def _hit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (bits[keys % U(CELLS)] >> ((keys >> U(40)) % U(64))) & U(1) == 1


def _kept_blocks(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """``lang, toks``: rows of about ``ROW`` word hashes, cut at boundaries,
    with a boundary in place of every word that is surely rare and without
    words left alone between boundaries.  Readers hold some thousand rows at a
    time, so rows are kept small."""
    def run(batches):
        for lang, data in _groups(batches):
            parts = [_with_boundaries(h, fresh) for _, h, _, _, fresh in _blocks(data)]
            if not parts:
                continue
            t = np.concatenate(parts)
            word = (t != 0) & _hit(bits, _key([t], lang))
            near = np.zeros(len(t), dtype=bool)
            near[1:] |= word[:-1]
            near[:-1] |= word[1:]
            at = np.flatnonzero(word & near)
            if len(at):
                kept = _with_boundaries(t[at], np.concatenate(([True], np.diff(at) > 1)))
                first = np.flatnonzero(kept == 0)
                first = first[np.concatenate(([True], np.diff(first // ROW) > 0))]
                ends = (np.append(first, len(kept)) * 8).astype(np.int32)
                toks = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), toks], names=["lang", "toks"])

    return texts.mapInArrow(run, "lang string, toks binary")


# --- counting ------------------------------------------------------------------

_SIDES = ("pmin", "pmax", "nmin", "nmax")
_COUNTED = "lang string, " + ", ".join(f"{c} long" for c in _WORDS) + ", a long, " + ", ".join(f"{c} long" for c in _SIDES)


def _joined(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """The rows of a batch, ``ROWS`` of one language at a time."""
    for lang, rows in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), key=lambda r: r[0]):
        while part := [data for _, data in islice(rows, ROWS)]:
            yield lang, b"".join(part)


def _counted(blocks: DataFrame, sizes: list[int], bits: np.ndarray, whole: bool) -> DataFrame:
    """Occurrences of word sequences of the given sizes, added up: those whose
    prefix (without the last word), or if ``whole`` they themselves, may be in
    the bit table.  With the least and greatest word before and behind."""
    names = ["lang", *_WORDS, "a", *_SIDES]
    arrow = pa.schema([(n, pa.string() if n == "lang" else pa.int64()) for n in names])

    def added(lang, k, parts):
        cols = [np.concatenate(c) for c in zip(*parts)]
        words, (a, pmin, pmax, nmin, nmax) = cols[:k], cols[k:]
        keys = _key(words, lang)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(keys[order]) != 0)))
        pick = order[first]
        return [w[pick] for w in words] + [np.add.reduceat(a[order], first)] + [
            f.reduceat(c[order], first) for f, c in ((np.minimum, pmin), (np.maximum, pmax), (np.minimum, nmin), (np.maximum, nmax))]

    def rows(lang, k, cols):
        n = len(cols[0])
        zero = np.zeros(n, dtype=np.int64)
        arrays = [c.view(np.int64) for c in cols[:k]] + [zero] * (LONGEST - k) + [c.view(np.int64) for c in cols[k:]]
        return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string())] + [pa.array(c) for c in arrays], schema=arrow)

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, data in _joined(batch):
                t = np.concatenate((np.frombuffer(data, U), [U(0)]))
                for k in sizes:
                    at = 1 + np.arange(max(0, len(t) - 1 - k))  # t begins and ends with a boundary
                    for j in range(k):
                        at = at[t[at + j] != 0]
                    asked = [t[at + j] for j in range(k if whole else k - 1)]
                    at = at[_hit(bits, _key(asked, lang))]
                    if not len(at):
                        continue
                    before, behind = t[at - 1].view(np.int64), t[at + k].view(np.int64)
                    one = [t[at + j] for j in range(k)] + [np.ones(len(at), dtype=np.int64), before, before, behind, behind]
                    held.setdefault((lang, k), []).append(added(lang, k, [one]))
                    size += len(held[lang, k][-1][0])
                if size > HELD:
                    held = {(lang, k): [added(lang, k, parts)] for (lang, k), parts in held.items()}
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 2:
                        yield from (rows(lang, k, parts[0]) for (lang, k), parts in held.items())
                        held, size = {}, 0
        for (lang, k), parts in held.items():
            yield rows(lang, k, added(lang, k, parts))

    return (blocks.mapInArrow(run, _COUNTED).groupBy("lang", *_WORDS)
            .agg(F.sum("a").alias("a"), *[(F.min if c.endswith("min") else F.max)(c).alias(c) for c in _SIDES]))


def _always(low: Column, high: Column) -> Column:
    """One word stands at every occurrence."""
    return (low == high) & (low != 0)


def _suffix(k: int, cut: int) -> list[Column]:
    """The words from ``cut`` on of a phrase of ``k`` words, filled with 0."""
    return [F.col(_WORDS[cut + i]) if cut + i < k else F.lit(0).cast("long") for i in range(LONGEST - 1)]


def _wave(blocks: DataFrame, words: DataFrame, first: DataFrame, min_count: int) -> DataFrame:
    """The scored survivors that begin with one of the words ``first``
    (``lang``, ``w1``, ``a``, ``n``): ``lang, w1.., a, l, r, n, score``."""
    grown, steps = first.select("lang", "w1", F.array("a").alias("heads"), "n"), []
    for k in range(2, LONGEST + 1):
        bits = _bit_table(grown.select("lang", *_WORDS[:k - 1]))
        if not bits.any():
            break
        found = _counted(blocks, [k], bits, False).where(F.col("a") >= min_count)
        grown = materialize(found.join(grown.select("lang", *_WORDS[:k - 1], "heads", "n"), ["lang", *_WORDS[:k - 1]])
                            .select("lang", *_WORDS, "a", *_SIDES, F.concat("heads", F.array("a")).alias("heads"), "n"),
                            "collocations-grown")
        steps.append((k, grown))
    parts = ["s1", "s2", "s3", "s4"]
    cuts = None
    for k, rows in steps:
        dropped = _always(F.col("pmin"), F.col("pmax")) | _always(F.col("nmin"), F.col("nmax"))
        rows = rows if k == LONGEST else rows.where(~dropped)
        for cut in range(1, k):
            one = rows.select("lang", *_WORDS, "a", "n", F.lit(cut).alias("k"), F.col("heads")[cut - 1].alias("l"),
                              *[c.alias(s) for c, s in zip(_suffix(k, cut), parts)])
            cuts = one if cuts is None else cuts.unionByName(one)
    spark = blocks.sparkSession
    if cuts is None:
        empty = ["lang string", *[f"{c} long" for c in _WORDS], "a long", "l long", "r long", "n long", "score long"]
        return spark.createDataFrame([], ", ".join(empty))
    cuts = materialize(cuts, "collocations-cuts")
    rests = materialize(cuts.where("s2 <> 0").select("lang", *parts).distinct(), "collocations-rests")
    bits = _bit_table(rests.toDF("lang", *_WORDS[:4]))
    known = words.select("lang", F.col("h").alias("s1"), *[F.lit(0).cast("long").alias(s) for s in parts[1:]], F.col("a").alias("r"))
    if bits.any():
        counted = _counted(blocks, list(range(2, LONGEST)), bits, True)
        known = known.unionByName(counted.select("lang", *[F.col(w).alias(s) for w, s in zip(_WORDS, parts)], F.col("a").alias("r"))
                                  .join(rests, ["lang", *parts], "left_semi"))
    exact = lambda c: F.col(c).cast("decimal(14,0)")
    cuts = cuts.join(known, ["lang", *parts]).withColumn("up", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)"))
    cuts = cuts.withColumn("down", exact("l") * exact("r")).withColumn("score", F.expr("up div down"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("c")
    return cuts.groupBy("lang", *_WORDS, "a", "n").agg(worst).select("lang", *_WORDS, "a", "c.l", "c.r", "n", "c.score")


def _frontier(words: DataFrame) -> dict[str, list[tuple[int, int, int]]]:
    """Per language the steps (step, words, least count) of its first words,
    rarest first: some ten rows a language."""
    rows = words.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("c"), F.min("a").alias("low")).collect()
    out: dict[str, list[tuple[int, int, int]]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.step)):
        out.setdefault(r.lang, []).append((r.step, r.c, r.low))
    return out


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, first_wave: int = FIRST_WAVE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` best phrases of
    every language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").alias("text")).where("text <> ''")
    counts = materialize(_word_counts(texts), "collocations-words")
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    step = F.floor(STEPS * F.log2(F.col("a") / F.lit(float(min_count)))).cast("int")
    words = materialize(counts.where(F.col("a") >= min_count).withColumn("step", step).join(totals, "lang"), "collocations-frequent")
    blocks = materialize(_kept_blocks(texts, _bit_table(words.select("lang", F.col("h").alias("w1")))), "collocations-blocks")
    frontier, done, opened = _frontier(words), None, first_wave
    total = {r.lang: r.n for r in words.groupBy("lang").agg(F.max("n").alias("n")).collect()}
    while frontier:
        until: dict[str, int] = {}
        for lang, steps in frontier.items():
            got = 0
            for s, c, _ in steps:
                got += c
                until[lang] = s
                if got >= opened:
                    break
        now = _steps(spark, {lang: (steps[0][0], until[lang]) for lang, steps in frontier.items()})
        first = words.join(F.broadcast(now), "lang").where("step >= low AND step <= high").select("lang", F.col("h").alias("w1"), "a", "n")
        wave = materialize(_wave(blocks, words, first, min_count), "collocations-wave")
        done = wave if done is None else done.unionByName(wave)
        left = {lang: [s for s in steps if s[0] > until[lang]] for lang, steps in frontier.items()}
        left = {lang: steps for lang, steps in left.items() if steps}
        if left:
            bound = _bounds(spark, {lang: 1000 * total[lang] // steps[0][2] for lang, steps in left.items()})
            settled = {r.lang for r in done.join(F.broadcast(bound), "lang").where("score > bound").groupBy("lang").count()
                       .where(F.col("count") >= top).collect()}
            left = {lang: steps for lang, steps in left.items() if lang not in settled}
        frontier, opened = left, opened * GROWTH
    if done is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    rows = done.withColumn("__rank", F.rank().over(best)).where(F.col("__rank") <= top).drop("__rank")
    for w in _WORDS:
        text = words.select("lang", F.col("h").alias(w), F.col("word").cast("string").alias(f"t{w}"))
        rows = rows.join(text, ["lang", w], "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", *[f"t{w}" for w in _WORDS]))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def _steps(spark: SparkSession, bands: dict[str, tuple[int, int]]) -> DataFrame:
    """A row per language of the frontier."""
    return spark.createDataFrame([(k, a, b) for k, (a, b) in bands.items()], "lang string, low int, high int")


def _bounds(spark: SparkSession, bound: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(bound.items()), "lang string, bound long")


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13_SQL = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM piece),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, {LONGEST + 1}) r(k))),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS MATERIALIZED (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM f WHERE f >= {MIN_COUNT}),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM often WHERE k >= 2),
part AS MATERIALIZED (
  SELECT lang, f, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
gone AS MATERIALIZED (SELECT DISTINCT c.lang, c.phrase FROM c JOIN part USING (lang, phrase) WHERE 100 * part.f >= 100 * c.f),
x AS MATERIALIZED (
  SELECT lang, phrase, f AS a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
cut AS (
  SELECT x.lang, x.phrase, x.a, x.j, l.f AS l, r.f AS r, n.n,
    (CAST(1000 AS HUGEINT) * x.a * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM x JOIN n ON n.lang = x.lang JOIN often l ON l.lang = x.lang AND l.phrase = x.head
  JOIN often r ON r.lang = x.lang AND r.phrase = x.tail),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM worst ANTI JOIN gone USING (lang, phrase))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {TOP}"""


@register("op13_collocations", OP13_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations(table(spark, sf_dir, "documents"))
