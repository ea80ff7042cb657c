import random

import pytest
from pyspark.sql import functions as F

from horavento.llm import line_dedup as ld
from horavento.llm.common import table
from tests.llm.helpers import SF, Union, docs, edited, links, prose

BLANK = " \t\r\f\v"


def brute(rows):
    """Text, lines and dropped lines by exact similarity of all line sets."""
    first, sets = {}, {}
    key = lambda i, k: (i is None, i or 0, k)
    for i, t in rows:
        for k, x in enumerate(t.split("\n") if t is not None else []):
            line = x.strip(BLANK).lower()
            if line:
                first[line] = min(first.get(line, key(i, k)), key(i, k))
                n = ld.SHINGLE
                sets[line] = frozenset(line[j:j + n] for j in range(len(line) - n + 1)) if len(line) >= n else frozenset([line])
    names = {x: k for k, x in enumerate(sorted(sets))}
    u = Union(names.values())
    for a, b in links(sets):
        u.join(names[a], names[b])
    kept = {}
    for x, f in first.items():
        c = u.find(names[x])
        kept[c] = min(kept.get(c, f), f)
    out = []
    for i, t in rows:
        parts = t.split("\n") if t is not None else []
        left = [x for k, x in enumerate(parts) if not x.strip(BLANK) or key(i, k) == kept[u.find(names[x.strip(BLANK).lower()])]]
        out.append((i, None if t is None else "\n".join(left), len(parts), len(parts) - len(left)))
    return sorted(out, key=str)


def run(spark, rows):
    got = ld.dedup_lines(docs(spark, rows)).collect()
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got], key=str)


LINE = prose(1, 30)
ROWS = [
    (1, f"{LINE}\nhead one\n\n{prose(2, 25)}"), (2, f"  {LINE.upper()}\t\n\nhead one\nhead two"),
    (3, f"{edited(LINE, 3, 0.05)}\n{LINE}\n{LINE}"), (4, ""), (5, None), (6, "\n \n"), (7, "é\nÉ\nab\nab"),
    (8, "\n".join(prose(s, 20) for s in range(10, 40))), (9, prose(77, 9000)), (10, prose(77, 9000) + "x"),
    (11, "\n".join(["same"] * 300)), (12, "a,b|c 'd' \\n \\ $1 {x}\na,b|c 'd' \\n \\ $1 {x}"),
]


def test_against_brute_force(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_near_copies_of_one_line(spark):
    rows = [(i, f"{edited(LINE, i, 0.02)}\n{prose(100 + i, 12)}") for i in range(120)]
    assert run(spark, rows) == brute(rows)


def test_short_lines_at_the_threshold(spark):
    # 5 and 4 shingles, similarity 0.8: no link may be lost before the exact comparison
    rng = random.Random(4)
    lines = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(400)]
    rows = [(2 * k + j, x[:12 - j]) for k, x in enumerate(lines) for j in (0, 1)]
    assert run(spark, rows) == brute(rows)


def test_open_pairs_by_prefix(spark, monkeypatch):
    monkeypatch.setattr(ld, "BUCKET", 2)
    base = prose(50, 40)
    rows = [(i, f"{edited(base, i, 0.05)}\n{prose(900 + i, 8)}") for i in range(80)]
    assert run(spark, rows) == brute(rows)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got, want = run(spark, rows), brute(rows)
    # banding may miss a pair with probability 0.002
    assert sum(a != b for a, b in zip(got, want)) <= max(1, len(rows) // 100)


def test_null_id_repeated_rows_empty_and_clashes(spark):
    text = f"{LINE}\n{prose(5, 9)}"
    got = run(spark, [(None, text), (3, text), (3, text)])
    assert got == sorted([(None, "", 2, 2), (3, text, 2, 0), (3, text, 2, 0)], key=str)
    assert run(spark, []) == []
    d = docs(spark, ROWS[:3]).selectExpr("*", "'x' AS n_lines", "1 AS line", "2 AS h1", "3 AS drop")
    out = ld.dedup_lines(d)
    assert out.columns == [c for c in d.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert out.count() == 3


def test_no_python_in_the_plan(spark):
    plan = ld.dedup_lines(docs(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_bit_table_has_no_false_negatives(spark, n):
    keys = spark.range(n).selectExpr("xxhash64(id) AS k")
    df = spark.range(20_000).selectExpr("id", "xxhash64(id) AS h")
    left = ld.only_likely(df, df.h, keys)
    assert left.where(f"id < {n}").count() == n
    assert left.count() <= n + 100


def test_frequent_shingles_are_ranked_without_a_join(spark):
    # a row per shingle made one join by shingle; now rows are joined by node alone
    rows = [(k, f"{prose(50, 12)} {prose(60 + k, 3)}") for k in range(40)]
    texts = spark.createDataFrame(rows, "node long, line string")
    hot = texts.select("node", F.lit(0).alias("c"), F.lit(9).alias("n"), F.array(F.lit(0)).alias("sketch"))
    got = ld._prefixes(texts, hot, 80)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join" in x]
    assert joins and not any("(h#" in x for x in joins)
    for node, line in rows:
        size = len({line[j:j + ld.SHINGLE] for j in range(len(line) - ld.SHINGLE + 1)})
        assert got.where(got.node == node).count() == size - -(-size * 80 // 100) + 1


def test_texts_are_gathered_once(spark, monkeypatch):
    calls, texts = [], ld._texts
    monkeypatch.setattr(ld, "_texts", lambda *a: calls.append(1) or texts(*a))
    base = prose(50, 40)
    rows = [(i, f"{edited(base, i, 0.05)}\n{prose(900 + i, 8)}") for i in range(20)]
    assert run(spark, rows) == brute(rows) and len(calls) == 1


def test_minima_see_every_16_bit_shingle(spark):
    lines = ["x" * 3, "ab" * 40, prose(3, 30), "\U0001F600\U0001F601" * 30 + prose(4, 5), "".join(chr(0x1F600 + k) for k in range(50))]
    units = lambda x: x.encode("utf-16-be")
    cut = lambda b: {b[j:j + 2 * ld.SHINGLE] for j in range(0, max(2, len(b) - 2 * ld.SHINGLE + 2), 2)}
    rows = [(k, 0, x, sorted(cut(units(x)))) for k, x in enumerate(lines)]
    df = spark.createDataFrame(rows, "h1 long, h2 long, line string, cut array<binary>")
    want = df.select("h1", F.explode("cut").alias("b")).groupBy("h1").agg(
        *[F.min(F.hash("b").bitwiseXOR(F.lit(c))).alias(f"m{i}") for i, c in enumerate(ld._constants())])
    want = want.select("h1", F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{i}") for i in band]) for b, band in enumerate(ld._bands())]).alias("w"))
    got = ld._minhashed(df).join(want, "h1").collect()
    assert len(got) == len(lines) and all(r.bands == r.w for r in got)
