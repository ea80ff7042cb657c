"""Runs against all (start, period) pairs tried out, and the awkward texts."""

import random

import numpy as np

from horavento.llm.periodic_runs import find_runs, lyndon_lengths, periodic_runs
from tests.llm.helpers import docs


def brute(s, least):
    n, found = len(s), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    inside = lambda r, o: o[2] < r[2] and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1]
    return sorted((r for r in found if not any(inside(r, o) for o in found)), key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(5)
    for _ in range(1500):
        n, k = rng.randint(0, 70), rng.randint(1, 5)
        s = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 9)
            s = s[:a] + [s[a + (i - a) % p] for i in range(a, n)]
        yield s, rng.choice([2, 5, 12])


def test_lyndon_lengths_reach_the_next_smaller_suffix():
    for s, _ in sequences():
        got = lyndon_lengths(s, 5)
        for i in range(len(s)):
            assert got[i] == next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i


def test_runs_equal_brute_force():
    for s, least in sequences():
        assert [tuple(r) for r in find_runs(np.array(s, dtype=np.int64), least).tolist()] == brute(s, least)


def test_awkward_texts(spark):
    long = " ".join(str(i) for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 11), (5, "a " * 12), (5, "a " * 12),
            (6, "x " + "a b c " * 5 + "a b y " + "d e " * 9), (7, long + " " + long)]
    df = docs(spark, rows).selectExpr("doc_id", "text", "lang AS start", "source AS Runs", "n_chars AS extra")
    out = periodic_runs(df)
    assert out.columns == ["doc_id", "text", "extra", "n_runs", "start", "length", "period", "runs", "collapsed"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    for i in (1, 2, 3):
        assert (got[i][0].n_runs, got[i][0].start, got[i][0].runs, got[i][0].collapsed) == (0, None, [], "")
    assert got[4][0].n_runs == 0 and got[4][0].collapsed == " ".join("a" * 11)
    assert len(got[5]) == 2 and [(r.n_runs, r.start, r.length, r.period, r.collapsed) for r in got[5]] == [(1, 0, 12, 1, "a")] * 2
    six = got[6][0]
    assert [tuple(r) for r in six.runs] == [(1, 17, 3), (19, 18, 2)] and (six.start, six.length, six.period) == (19, 18, 2)
    assert six.collapsed == "x a b c y d e"
    assert (got[7][0].start, got[7][0].length, got[7][0].period) == (0, 60_000, 30_000) and got[7][0].collapsed == long


def test_ties_go_to_the_smallest_start(spark):
    r = periodic_runs(docs(spark, [(1, "a " * 12 + "z " + "b c " * 6)])).first()
    assert r.n_runs == 2 and (r.start, r.length, r.period) == (0, 12, 1)


def test_empty_table(spark):
    assert periodic_runs(docs(spark, [])).collect() == []
