import math
import random

import pytest

from horavento.llm import knn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    vs = []
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        vs.append((i, [math.floor(256 * x) for x in v]))
    out, done = [], set()
    for q, v in vs:
        if q % every or q in done:
            continue
        done.add(q)
        s = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in vs if i != q and len(w) == len(v)))[:k]
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 AS cell", "'s' AS score", "2 AS v")
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in knn.top_k(df, **more).collect())


def vectors(n, d, seed):
    import numpy as np
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, 0.3, d).astype("float32")]) for i in range(n)]


def test_random_vectors(spark):
    rows = vectors(700, 16, 1)
    assert run(spark, rows) == brute(rows)


def test_small_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 20)
    monkeypatch.setattr(knn, "CHUNK", 3)
    monkeypatch.setattr(knn, "ROWS_PER_CELL", 50)
    rows = vectors(600, 8, 2)
    assert run(spark, rows, every=10) == brute(rows, every=10)


def test_common_vector_ties_and_repeats(spark):
    rows = [(i, [0.5, 0.25, -0.125]) for i in range(300)] + [(i + 1000, v) for i, v in vectors(150, 3, 3)] + [(50, [0.5, 0.25, -0.125]), (7, [0.5, 0.25, -0.125])]
    assert run(spark, rows) == brute(rows)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.0, 0.0]), (1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (6, [1.0, 1.0]), (100, [1.0, 2.0, 3.0]), (7, [-1.0, 0.001]), (150, [1e6, 1e6])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []


def test_clusters_send_queries_to_few_cells(spark, monkeypatch):
    monkeypatch.setattr(knn, "ROWS_PER_CELL", 40)
    rng = random.Random(4)
    centres = [[4.0, 0, 0, 0], [0, 4.0, 0, 0], [0, 0, 4.0, 0], [0, 0, 0, 4.0]]
    rows = [(i, [c + rng.gauss(0, 0.01) for c in centres[i % 4]]) for i in range(400)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("big", [1.0, 3e5])
def test_products_are_exact(big):
    import numpy as np
    rng = np.random.default_rng(1)
    q, x = (np.floor(rng.normal(0, big, (5, 64)) * 256) for _ in range(2))
    want = [[int(sum(int(a) * int(b) for a, b in zip(r, s))) for s in x] for r in q]
    assert knn._products(q, x).tolist() == want


def test_ids_repeated_more_than_k_times(spark, monkeypatch):
    """A cell full of a query's own rows bounds nothing."""
    monkeypatch.setattr(knn, "ROWS_PER_CELL", 1)
    rows = vectors(400, 8, 5)
    rows += [(i, v) for i, v in rows if i % 40 == 0 for _ in range(11)]
    got = run(spark, rows, every=40)
    assert got == brute(rows, every=40) and len(got) == 50


def test_large_components_are_exact(spark):
    rows = [(0, [1e7, 3.0]), (1, [1e7, -5.0]), (2, [2.0, 1e7]), (50, [-1e7, 1.0]), (3, [1.0, 1.0]), (4, [1e5, 1e5])]
    assert run(spark, rows) == brute(rows)


def test_components_past_the_long_range_are_held(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.0]), (3, [1.0, 1.0])]
    got = run(spark, rows)
    top = (1 << 63) - 1
    assert [(r[2], r[3]) for r in got] == [(1, top), (3, 256 * top + 256 * 256 if 256 * top < top else top), (2, 1 - (1 << 63))]


def test_data_goes_only_to_chunks_with_queries(spark, monkeypatch):
    monkeypatch.setattr(knn, "CHUNK", 1)
    monkeypatch.setattr(knn, "ROWS_PER_CELL", 20)
    rows = vectors(500, 4, 9)
    assert run(spark, rows, every=25) == brute(rows, every=25)
