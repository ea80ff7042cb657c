"""Collocations against a brute-force count of all phrases."""

import random
import re
from collections import Counter

import pytest

from horavento.llm import collocations as C
from horavento.llm.collocations import collocations
from tests.llm.helpers import LOW, docs

DOCS = "lang string, text string, extra int, Score string"


def brute(rows, top, least):
    f = {}
    for lang, text in rows:
        c = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            for k in range(1, 6):
                c.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        cand = {g: v for g, v in c.items() if len(g) > 1 and v >= least}
        gone = set()
        for g, v in cand.items():
            for k in range(2, len(g)):
                gone.update(g[i:i + k] for i in range(len(g) - k + 1) if v >= c[g[i:i + k]])
        found = []
        for g, a in cand.items():
            if g not in gone:
                score, k = min((1000 * a * n // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus(seed, n, langs=("en", "de", None)):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ärger", "ÄRGER", "été", "x-y", "The", "the"]
    fixed = [["alpha", "beta", "gamma"], ["one", "two", "three", "four", "five", "six"], ["la", "la"], ["hapax", "w1"]]
    rows = []
    for _ in range(n):
        words = []
        while len(words) < rng.randint(0, 60):
            words += rng.choice(fixed) if rng.random() < 0.2 else [vocab[min(int(rng.expovariate(0.08)), 65)]]
        text = "".join(w + rng.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "!?", " - "]) for w in words)
        rows.append((rng.choice(langs), text))
    return rows


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("top,wave", [(2000, 6000), (15, 3), (4, 1)])
def test_equals_brute_force_in_one_wave_and_in_many(spark, top, wave):
    rows = corpus(2, 400)
    df = spark.createDataFrame([(a, b, 1, "s") for a, b in rows], DOCS).repartition(3)
    got = rows_of(collocations(df, top=top, min_count=8, first_wave=wave))
    assert got == brute(rows, top, 8) and len(got) > 10


def test_waves_stop_before_the_frequent_words(spark, monkeypatch):
    """Settled languages leave words unopened, and the result is the same."""
    opened, wave = [], C._wave
    monkeypatch.setattr(C, "_wave", lambda b, w, first, m: (opened.append(first.count()), wave(b, w, first, m))[1])
    rows = corpus(3, 400, ("en",)) + [("en", t) for t in ("zig zag", "tick tock", "ping pong")] * 9
    df = spark.createDataFrame([(a, b, 1, "s") for a, b in rows], DOCS)
    assert rows_of(collocations(df, top=3, min_count=8, first_wave=4)) == brute(rows, 3, 8)
    words = Counter(w for _, t in rows for w in re.findall(r"[^\s.,;:!?]+", t.translate(LOW)))
    assert sum(opened) < sum(v >= 8 for v in words.values())


def test_small_blocks_and_tallies_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 200)
    monkeypatch.setattr(C, "HELD", 50)
    monkeypatch.setattr(C, "ROW", 10)
    monkeypatch.setattr(C, "ROWS", 3)
    rows = corpus(4, 120, ("en", "fr"))
    rows.append(("en", "long " * 3000 + "tail"))
    df = spark.createDataFrame([(a, b, 1, "s") for a, b in rows], DOCS).coalesce(2)
    assert rows_of(collocations(df, top=50, min_count=5)) == brute(rows, 50, 5)


def test_awkward_rows(spark):
    rows = [(None, None), ("en", ""), ("en", " . , "), (None, "a b " * 6), ("und", "a b. a b"), ("en", "solo. solo, solo"), ("en", "solo")]
    rows += [("de", "ein paar")] * 7
    df = spark.createDataFrame([(a, b, 1, "s") for a, b in rows], DOCS)
    got = rows_of(collocations(df, min_count=3))
    assert got == brute(rows, 2000, 3) and {r[0] for r in got} == {"und", "de"}
    assert collocations(docs(spark, [])).collect() == []
    assert collocations(docs(spark, [(1, None), (2, "one two")])).collect() == []


def test_scores_past_64_bits_are_exact(spark):
    """The quotient is taken from products of 38 digits."""
    row = spark.sql("SELECT cast(9000000000000 as decimal(14,0)) a, cast(90000000000001 as decimal(14,0)) n").selectExpr(
        "a * n * cast(1000 as decimal(4,0)) AS up", "a * a AS down").selectExpr("up div down AS s").first()
    assert row.s == 9000000000000 * 90000000000001 * 1000 // 9000000000000 ** 2
