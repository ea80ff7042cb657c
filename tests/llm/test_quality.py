import random

import numpy as np

from horavento.llm import quality
from horavento.llm.common import QUERIES, table
from tests.llm.helpers import docs, prose

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op9_quality"](spark, SF).toPandas()
    assert len(got) == table(spark, SF, "documents").count()
    assert got.score.between(0, 1).all() and ((got.score >= 0.7).astype(int) == got.predicted).all()
    both = got.merge(table(spark, SF, "labels").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    good = both[both.quality == 1]
    assert (good.predicted == 1).mean() > 0.98


def test_statistics_of_awkward_texts():
    for t in (None, "", " \n\t", "é", "x" * 100_000, "a " * 50_000, "\ud800 x", "|", "\x00\x01"):
        s = quality.statistics(t)
        assert s.shape == (len(quality.STATISTICS),) and np.isfinite(s).all()
    named = dict(zip(quality.STATISTICS, quality.statistics("THE!! the the ## one.\nthe the\n\nthe the")))
    assert named["repeated_lines"] > 0.3 and named["repeated"] > 0.4 and named["exclaim"] > 0.1
    assert abs(named["distinct"] - 4 / 9) < 1e-6


def test_isotonic_is_the_monotone_fit():
    rng = random.Random(1)
    w = np.array([rng.randint(1, 9) for _ in range(40)], dtype=float)
    t = np.array([rng.random() * x for x in w])
    fit = quality.isotonic(w, t)
    assert (np.diff(fit) >= -1e-12).all()
    # optimality: block means, and no monotone neighbour is closer
    best = (w * (t / w - fit) ** 2).sum()
    for _ in range(300):
        other = np.sort(np.clip(fit + np.array([rng.gauss(0, 0.05) for _ in fit]), 0, 1))
        assert (w * (t / w - other) ** 2).sum() >= best - 1e-9


def test_normal_equations_match_direct_fit(spark):
    rows = [(i, prose(i, 40) if i % 3 else "JUNK!! " * (i % 7 + 2)) for i in range(240)]
    labels = spark.createDataFrame([(i, int(bool(i % 3)), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    stats = quality.with_statistics(docs(spark, rows)).cache()
    model = quality.fit(stats, labels)
    x = {r.doc_id: r.x for r in stats.collect()}
    import zlib
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    used = [i for i in x if fold(i) in (1, 3)]
    z = model.expand(np.array([x[i] for i in used], dtype=np.float64))
    y = np.array([float(bool(i % 3)) for i in used])
    reg = quality.RIDGE * len(used) / quality.FEATURES
    a = z.T @ z + np.diag([reg] * quality.FEATURES + [0.0]) + 1e-9 * np.eye(z.shape[1])
    assert np.allclose(z @ np.linalg.solve(a, z.T @ y), z @ model.weights, atol=1e-4)
    out = {r.doc_id: r for r in quality.score(stats, model).collect()}
    assert np.mean([out[i].predicted == bool(i % 3) for i in x]) > 0.95
    assert all(out[i].held_out == (fold(i) == 2) for i in x)


def test_no_labels_nulls_and_clashes(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, [(1, "a b"), (None, "x"), (2, None), (2, None)]).selectExpr("*", "'q' AS score", "1 AS row", "2 AS x")
    stats = quality.with_statistics(d)
    assert [r.score for r in quality.score(stats, quality.fit(stats, none)).collect()] == [1.0] * 4
    assert quality.keep_good(d, none).count() == 4
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = docs(spark, [(i, "GOOD TEXT " * 9 if i % 2 else "and so on, it is.") for i in range(40)] + [(None, None), (77, "")])
    kept = quality.keep_good(rows.selectExpr("*", "'q' AS good"), labels)
    assert kept.columns == rows.columns + ["good"]
    stats = quality.with_statistics(rows)
    assert quality.score(stats, quality.fit(stats, labels)).count() == 42
    empty = quality.with_statistics(rows.limit(0))
    assert quality.score(empty, quality.fit(empty, labels)).collect() == []
