"""Quality rules as a short-circuit cascade, on DataFrame functions only.

Every rule is a condition over the text that means *reject*.  On a bounded
sample (drawn by a hash of the text) two things are measured: which rules
reject each sampled row, and what a rule's evaluation costs (seconds of a job
over the sample, less those of a job with no rule).  The order is chosen
greedily: next comes the rule with the most rejections, among sampled rows
that no earlier rule rejects, per cost.  The cascade is one ``CASE`` in that
order, so a row pays for a rule only if all earlier ones let it pass.  The
sample decides nothing but the order: which documents are kept is the same in
any order, only the name in ``failed_rule`` (the first that rejects) follows
it.

Defined cases: null or blank text has no word and fails ``few_words``; ties in
the order go to the rule listed first; repeated rows are judged each; very
long texts are judged whole; an empty table keeps the listed order and gives
an empty result; other columns are passed on, those that clash with result
names are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm.common import about, let, register, table, without
from horavento.llm.packing import n_words
from horavento.session import materialize

#: rows that costs and rejections are estimated on
SAMPLE_ROWS = 2000
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LOWERS, UPPERS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _removed(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def n_word_chars(text: Column) -> Column:
    return F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return _removed(text, SYMBOLS)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more.

    The windows' hashes are sorted with their positions, those equal to a
    neighbour are kept, and each position covers three words less what the
    next one covers: linear but for the two sorts."""
    def hashes(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def repeated(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda x, j: F.coalesce(F.least(F.get(at, j + 1) - x, F.lit(3)), F.lit(3))),
                           F.lit(0), lambda a, x: a + x)

    def counted(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(let(F.sort_array(placed), repeated), covered))

    words = F.filter(F.split(text, SPACE), lambda x: x != "")
    return let(let(words, hashes), counted).cast("long")


#: figures of a text by name
FIGURES: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words, "word_chars": n_word_chars, "n_symbols": n_symbols, "n_lines": n_lines, "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words, "n_upper": lambda t: _removed(t, UPPERS), "n_lower": lambda t: _removed(t, LOWERS)}


class Figures:
    """The figures of ``text`` as Columns; those in ``given`` (columns that
    hold the figure of the same name) are not computed again."""

    def __init__(self, text: Column, given: Sequence[str] = ()):
        self.text, self.given = text, frozenset(given)

    def __getitem__(self, name: str) -> Column:
        return F.col(name) if name in self.given else FIGURES[name](self.text)


@dataclass(frozen=True)
class Rule:
    """``fails`` of the figures is true for texts to reject and never null."""
    name: str
    fails: Callable[[Figures], Column]


#: the first two are the contract's base rules
RULES = (
    Rule("few_words", lambda f: f["n_words"] < 50),
    Rule("repeated_words", lambda f: 100 * f["n_repeat_words"] > 50 * f["n_words"]),
    Rule("symbols", lambda f: 10 * f["n_symbols"] > f["n_words"]),
    Rule("word_length", lambda f: ~f["word_chars"].between(2 * f["n_words"], 12 * f["n_words"])),
    Rule("repeated_lines", lambda f: 100 * f["n_dup_lines"] > 50 * f["n_lines"]),
    Rule("capitals", lambda f: f["n_upper"] > f["n_lower"]),
)


def _timed(sample: DataFrame, condition: Column) -> float:
    """Seconds of counting ``condition`` over the sample, the better of two."""
    spent = []
    for _ in range(2):
        t0 = time.perf_counter()
        sample.agg(F.count_if(condition)).collect()
        spent.append(time.perf_counter() - t0)
    return min(spent)


def cascade_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS,
                  given: Sequence[str] = ()) -> list[tuple[Rule, float, float]]:
    """The rules by rejection per cost, each with its cost (seconds on the
    sample) and the share of the sample it rejects at its place."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    sample = materialize(about(docs.select(t.alias("t"), *given), rows, "t"), "rule-sample")
    figures = Figures(F.col("t"), given)
    bits = [r.fails(figures).alias(f"r{i}") for i, r in enumerate(rules)]
    patterns = [(tuple(r[:-1]), r[-1]) for r in
                sample.select(*bits).groupBy(*[f"r{i}" for i in range(len(rules))]).count().collect()]
    total = max(1, sum(n for _, n in patterns))
    idle = _timed(sample, F.length("t") < 0)
    cost = [max(1e-3, _timed(sample, r.fails(figures)) - idle) for r in rules]
    left, out = list(range(len(rules))), []
    while left:
        caught = {i: sum(n for p, n in patterns if p[i]) for i in left}
        i = max(left, key=lambda i: (caught[i] / cost[i], -i))
        out.append((rules[i], cost[i], caught[i] / total))
        patterns = [(p, n) for p, n in patterns if not p[i]]
        left.remove(i)
    return out


def first_failed(text: Column, rules: Sequence[Rule], given: Sequence[str] = ()) -> Column:
    """Name of the first of ``rules`` that rejects, else null; later rules are
    not evaluated for a row that an earlier one rejects."""
    if not rules:
        return F.lit(None).cast("string")
    figures = Figures(F.coalesce(text.cast("string"), F.lit("")), given)
    out = F.when(rules[0].fails(figures), rules[0].name)
    for r in rules[1:]:
        out = out.when(r.fails(figures), r.name)
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS,
          given: Sequence[str] = ()) -> DataFrame:
    """``docs`` with ``failed_rule`` and boolean ``kept``; ``given`` names
    columns that hold the figure of that name already."""
    order = [r for r, _, _ in cascade_order(docs, rules, text, rows, given)]
    out = without(docs.withColumn("__failed", first_failed(F.col(f"`{text}`"), order, given)), "failed_rule", "kept")
    return (out.withColumn("failed_rule", F.col("__failed")).withColumn("kept", F.col("__failed").isNull()).drop("__failed"))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, their columns unchanged."""
    order = [r for r, _, _ in cascade_order(docs, rules, text, rows)]
    return docs.where(first_failed(F.col(f"`{text}`"), order).isNull())


OP12_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (VALUES (0), (1), (2)) o(k) WHERE c > 1 GROUP BY doc_id),
s AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
    len(ls) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS ups, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lows
  FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR 100 * n_dup_lines > 50 * n_lines OR ups > lows) AS kept
FROM b"""


@register("op12_quality_rules", OP12_SQL)
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base figures of every document and the cascade's verdict."""
    t = F.coalesce(F.col("text"), F.lit(""))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", *[FIGURES[n](t).alias(n) for n in base])
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return judge(docs, given=base).select("doc_id", *base, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))
