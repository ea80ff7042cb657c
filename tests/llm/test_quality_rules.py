"""The cascade against all rules evaluated one by one, and the awkward texts."""

import random
from collections import Counter

from pyspark.sql import functions as F

from horavento.llm import quality_rules as Q
from tests.llm.helpers import SF, docs, prose


def repeated(text):
    w = text.split()
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    return len({i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)})


def test_figures_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts += ["", " ", "a", "a b", "a b c", "a a a a", "x\nx\n\n \n x\nx", "* # a|b <c> & % $"]
    t = F.col("text")
    rows = docs(spark, list(enumerate(texts))).select(
        "text", Q.n_repeat_words(t), Q.n_dup_lines(t), Q.n_symbols(t), Q.n_word_chars(t), Q.n_lines(t)).collect()
    assert len(rows) == len(texts)
    for text, rep, dup, sym, chars, lines in rows:
        held = [x for x in text.split("\n") if x.strip()]
        assert rep == repeated(text) and lines == len(held) and dup == len(held) - len(set(held))
        assert sym == sum(c in Q.SYMBOLS for c in text) and chars == sum(len(w) for w in text.split())


def test_order_changes_no_verdict_and_every_rule_is_placed(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    order = Q.cascade_order(df, rows=200)
    assert {r.name for r, _, _ in order} == {r.name for r in Q.RULES} and all(c > 0 and 0 <= s <= 1 for _, c, s in order)
    t = F.col("text")
    given, other = Q.first_failed(t, Q.RULES), Q.first_failed(t, [r for r, _, _ in order])
    assert df.where(given.isNull() != other.isNull()).count() == 0
    names = {r.doc_id: r.failed_rule for r in Q.judge(df).collect()}
    kept = {r.doc_id for r in Q.keep_good(df).collect()}
    assert kept == {i for i, n in names.items() if n is None} and 0 < len(kept) < len(names)


def test_rejections_per_cost_come_first(spark, monkeypatch):
    rules = [Q.Rule("rare", lambda f: f.text == "x"), Q.Rule("dear", lambda f: f.text.isin("x", "y")), Q.Rule("cheap", lambda f: f.text.isin("y", "z"))]
    seconds = iter([0.0, 0.1, 9.0, 0.1])
    monkeypatch.setattr(Q, "_timed", lambda sample, condition: next(seconds))
    df = docs(spark, [(1, "x"), (2, "y"), (3, "z"), (4, "kept")])
    assert [r.name for r, _, _ in Q.cascade_order(df, rules)] == ["cheap", "rare", "dear"]


def test_a_later_rule_is_not_evaluated_for_a_rejected_row(spark):
    rules = [Q.Rule("first", lambda f: F.length(f.text) >= 0), Q.Rule("second", lambda f: F.raise_error(F.lit("reached")).cast("boolean"))]
    got = docs(spark, [(1, "a"), (2, None)]).select(Q.first_failed(F.col("text"), rules).alias("f")).collect()
    assert [r.f for r in got] == ["first", "first"]


def test_figures_at_hand_are_used(spark):
    df = docs(spark, [(1, "a b c"), (2, "a b c")]).withColumn("n_words", F.col("doc_id") * 49)
    assert [r.failed_rule for r in Q.judge(df, Q.RULES[:1], given=["n_words"]).orderBy("doc_id").collect()] == ["few_words", None]


def test_main_path_has_no_python(spark):
    from horavento.llm.quality_rules import op12_quality_rules
    plan = op12_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_awkward_rows(spark):
    good = prose(4, 200)
    rows = [(1, None), (2, ""), (3, good), (3, good), (4, prose(5, 60_000)), (5, "same words here " * 40), (6, good.upper())]
    df = docs(spark, rows).withColumnRenamed("lang", "Kept").withColumnRenamed("source", "failed_rule")
    out = Q.judge(df)
    assert out.columns == ["doc_id", "text", "n_chars", "failed_rule", "kept"]
    got = [(r.doc_id, r.kept) for r in out.orderBy("doc_id").collect()]
    assert got == [(1, False), (2, False), (3, True), (3, True), (4, True), (5, False), (6, False)]
    assert Q.keep_good(df).columns == df.columns
    assert Q.judge(docs(spark, [])).collect() == [] and Q.judge(docs(spark, rows), rules=[]).where("kept").count() == 7
