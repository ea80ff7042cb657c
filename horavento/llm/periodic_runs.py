"""Periodic runs of words, found by Baier grouping.

A run is a stretch of words with smallest period ``q`` and at least
``max(min_length, 2 * q)`` words that no neighbouring word extends.  Per text,
inside the tasks:

1. A word that stands once in a stretch lies in no run of it, as every word of
   a run has a partner ``q`` words away.  Such words cut the text into
   stretches, again and again until nothing changes; stretches shorter than a
   run go.  This is exact and leaves most prose with nothing to search.
2. The first phase of Baier's suffix sorter groups the suffixes of a stretch
   by their longest Lyndon prefix.  Groups are taken in descending order; the
   nearest unfinished position left of every member is moved to a new group
   behind its own, with a prefix longer by what it reaches.  The prefix length
   of a position when its group is taken is its entry of the Lyndon array.
   This is done under both orders of the words.
3. Every run is the extension of the Lyndon word at one of its positions under
   one of the orders (runs theorem): the roots are extended to the left and
   right by longest common extensions.  These are exact: names of all
   substrings of 1, 2, 4, ... words, compared from the longest down.

All steps are linear in the text, but for the names (one sort per doubling).
Texts are independent, so nothing is shuffled; a very long text is worked on
whole by one task, with about 4 bytes a word and doubling.

Defined cases: null, empty or blank text has no word and no run; repeated rows
give a row each; ties of the longest run go to the smallest start, then
period; an empty table gives an empty result; other columns are passed on,
those that clash with result names are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm.common import let, map_batches, register, spread, table, text_column

#: words of a run at least
MIN_LENGTH = 12


def lyndon_lengths(s: list[int], sigma: int) -> list[int]:
    """Length of the longest Lyndon word at every position of ``s`` (ranks
    below ``sigma``): the first phase of Baier's suffix sorting.

    ``left[i]`` leads to the nearest position before ``i`` that is not
    finished (path halving); position 0 of these arrays stands for none, so
    positions are shifted by one."""
    n = len(s)
    group = [0] * (n + 1)
    members: list[list[int]] = [[] for _ in range(sigma)]
    for i, c in enumerate(s, 1):
        group[i] = c
        members[c].append(i)
    length = [1] * sigma
    lower = list(range(-1, sigma - 1))  # the next smaller group
    upper = list(range(1, sigma + 1))   # the next larger one
    left = list(range(n + 1))
    out = [0] * n
    g = sigma - 1
    while g >= 0:
        size = length[g]
        here = [i for i in members[g] if group[i] == g]
        for i in here:
            left[i] = i - 1
            out[i - 1] = size
        reached: dict[int, int] = {}
        for i in here:
            j = i
            while left[j] != j:
                left[j] = left[left[j]]
                j = left[j]
            if j:
                reached[j] = reached.get(j, 0) + 1
        if reached:
            by_count: dict[int, list[int]] = {}
            for j, k in reached.items():
                by_count.setdefault(k, []).append(j)
            for k in sorted(by_count, reverse=True):
                fresh: dict[int, int] = {}
                for j in by_count[k]:
                    old = group[j]
                    new = fresh.get(old)
                    if new is None:
                        new = fresh[old] = len(members)
                        above = upper[old]
                        members.append([])
                        length.append(length[old] + k * size)
                        lower.append(old)
                        upper.append(above)
                        upper[old] = new
                        lower[above] = new
                    members[new].append(j)
                    group[j] = new
        g = lower[g]
    return out


def _names(s: np.ndarray) -> list[np.ndarray]:
    """Names of the substrings of 1, 2, 4, ... words (equal names, equal
    substrings), until a level has no name twice."""
    levels = [s.astype(np.int64)]
    width = 1
    while 2 * width <= len(s):
        a = levels[-1]
        pair = a[:-width] * (int(a.max()) + 1) + a[width:]
        _, name = np.unique(pair, return_inverse=True)
        if int(name.max()) + 1 == len(pair):
            break
        levels.append(name.astype(np.int64))
        width *= 2
    return levels


def _extend(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common extension to the right of positions ``a`` < ``b``."""
    n, a, b = len(levels[0]), a.copy(), b.copy()
    start = a.copy()
    for k in range(len(levels) - 1, -1, -1):
        # the longest level may match more than once: longer levels, cut off
        # as all distinct, match never
        while True:
            fits = b + (1 << k) <= n
            same = np.zeros(len(a), dtype=bool)
            same[fits] = levels[k][a[fits]] == levels[k][b[fits]]
            if not same.any():
                break
            a[same] += 1 << k
            b[same] += 1 << k
            if k < len(levels) - 1:
                break
    return a - start


def _stretches(codes: np.ndarray, min_length: int) -> list[tuple[int, np.ndarray]]:
    """(start, words) of the stretches that may hold a run."""
    at = np.arange(len(codes))
    codes = codes.astype(np.int64)
    while len(codes):
        _, codes, counts = np.unique(codes, return_inverse=True, return_counts=True)
        keep = counts[codes] > 1
        kept, codes = at[keep], codes[keep]
        # stretches of neighbours among what is left, short ones dropped
        part = np.cumsum(np.concatenate(([1], np.diff(kept) != 1))) - 1 if len(kept) else kept
        sizes = np.bincount(part) if len(part) else part
        keep = sizes[part] >= min_length if len(part) else np.zeros(0, dtype=bool)
        kept, part = kept[keep], part[keep]
        codes = codes[keep] * (len(sizes) + 1) + part
        if len(kept) == len(at):
            break
        at = kept
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) != 1) + 1
    return [(int(p[0]), c) for p, c in zip(np.split(at, cuts), np.split(codes, cuts))]


def find_runs(codes: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of a sequence of word numbers: (start, length, period) rows by
    start, then period."""
    found = [np.empty((0, 3), dtype=np.int64)]
    for start, part in _stretches(codes, min_length):
        _, s = np.unique(part, return_inverse=True)
        sigma, n = int(s.max()) + 1, len(s)
        both = []
        for ranks in (s, sigma - 1 - s):
            p = np.array(lyndon_lengths(ranks.tolist(), sigma), dtype=np.int64)
            i = np.flatnonzero(p * 2 <= n)
            both.append(np.stack((i, p[i]), axis=1))
        roots = np.unique(np.concatenate(both), axis=0)
        i, p = roots[:, 0], roots[:, 1]
        inside = i + p < n
        i, p = i[inside], p[inside]
        right = _extend(_names(s), i, i + p)
        # to the left: to the right in the mirrored stretch; position x is n - 1 - x there
        some = np.flatnonzero(i > 0)
        left = np.zeros(len(i), dtype=np.int64)
        left[some] = _extend(_names(s[::-1]), n - i[some] - p[some], n - i[some])
        size = left + right + p
        ok = size >= np.maximum(min_length, 2 * p)
        found.append(np.stack((start + i - left, size, p), axis=1)[ok])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def runs_of_words(words: list[bytes], min_length: int = MIN_LENGTH) -> np.ndarray:
    if len(words) < min_length:
        return np.empty((0, 3), dtype=np.int64)
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return find_runs(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)), min_length)


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def longest(runs: np.ndarray) -> tuple[int | None, int | None, int | None]:
    if not len(runs):
        return None, None, None
    return tuple(int(x) for x in runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]])


RESULT = "n_runs long, start long, length long, period long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with all runs of the text, the longest one's start, length and
    period, and the text with every run cut to its first period."""
    names = [f.split(" ")[0] for f in RESULT.split(", ")]
    kept = [c for c in docs.columns if c.lower() not in names]
    rest = F.struct(*[F.col(f"`{c}`") for c in kept])
    slim = docs.select(rest.alias("__row"), F.col(f"`{text}`").cast("string").alias("__text"))

    def run(batch):
        out = {n: [] for n in names}
        for t in text_column(batch, "__text"):
            words = words_of(t)
            runs = runs_of_words(words, min_length)
            start, length, period = longest(runs)
            out["n_runs"].append(len(runs))
            out["start"].append(start)
            out["length"].append(length)
            out["period"].append(period)
            out["runs"].append([{"start": a, "length": n, "period": q} for a, n, q in runs.tolist()])
            out["collapsed"].append(b" ".join(collapsed(words, runs)).decode("utf-8", "replace"))
        return out | {"__row": batch.column(0)}

    schema = docs.sparkSession.createDataFrame([], RESULT).schema
    schema = type(schema)([slim.schema["__row"]] + schema.fields)
    return map_batches(slim, run, schema).select(*[F.col("__row")[c].alias(c) for c in kept], *names)


def rolled(text: Column, doc_id: Column) -> Column:
    """The contract's made periods: for a tenth of the documents the words
    from ``a`` on repeat the first ``p`` of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def turned(ws: Column) -> Column:
        n = F.size(ws).cast("long")

        def at(c: Column) -> Column:
            a, p = c["a"], c["p"]
            return F.array_join(F.concat(F.slice(ws, F.lit(1), a.cast("int")), F.transform(
                F.sequence(a, n - 1), lambda i: F.get(ws, (a + (i - a) % p).cast("int")))), " ")

        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.when(n > 0, let(F.struct(a.alias("a"), p.alias("p")), at)).otherwise("")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(text.isNotNull() & (h % 10 == 0), let(words, turned)).otherwise(text)


_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
OP11_SQL = f"""
WITH RECURSIVE bits(b, k, c) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i)
  UNION ALL SELECT b, k + 1, {_STEP} FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, ws, len(ws) AS n, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda x: CAST(ascii(x) AS BIGINT)), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
        FROM documents), crc),
e AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
w AS (
  SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM f)),
eq AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i),
island AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS len
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM eq) GROUP BY doc_id, q, k
  HAVING count(*) >= q AND count(*) + q >= {MIN_LENGTH}),
run AS (
  SELECT * FROM island r WHERE NOT EXISTS (SELECT 1 FROM island o WHERE o.doc_id = r.doc_id AND o.q < r.q
    AND o.s <= r.s AND o.s + o.len >= r.s + r.len)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM w WHERE NOT EXISTS (
    SELECT 1 FROM run r WHERE r.doc_id = w.doc_id AND w.i >= r.s + r.q AND w.i < r.s + r.len) GROUP BY doc_id),
best AS (SELECT doc_id, s, len, q FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len DESC, s, q) = 1),
sums AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t
  FROM run GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(sums.n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start,
  CAST(best.len AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
  CAST(1000 * best.len // best.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(sums.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""

@register("op11_periodic_runs", OP11_SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, a tenth of them with made periods."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs.select("doc_id", rolled(F.col("text"), F.col("doc_id")).alias("text")))
    line = lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n"))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
