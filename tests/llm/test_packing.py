import itertools
import random
from collections import defaultdict

import pytest

from horavento.llm import packing
from horavento.llm.common import QUERIES, table
from tests.llm.helpers import SF, docs


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    sizes = sorted(rng.sample(range(60), 9))
    counts = [rng.randint(1, 20) for _ in sizes]

    def padding(bounds):
        return sum(c * (next(b for b in bounds if b >= s) - s) for s, c in zip(sizes, counts))

    for k in (1, 2, 3, 5, 9, 20):
        want = min(padding((*cut, sizes[-1])) for n in range(min(k, len(sizes))) for cut in itertools.combinations(sizes[:-1], n))
        got = packing.boundaries(sizes, counts, k)
        assert padding(got) == want and len(got) <= k
    assert packing.boundaries([], [], 3) == []


def check(rows, budget):
    batches = defaultdict(list)
    for r in rows:
        assert 0 <= r.n_tokens <= r.bucket_len and r.padding == r.bucket_len - r.n_tokens
        batches[r.batch_id].append(r)
    for b in batches.values():
        assert len({(r.bucket, r.bucket_len) for r in b}) == 1
        assert sorted(r.slot for r in b) == list(range(len(b)))
        assert len(b) == 1 or len(b) * b[0].bucket_len <= budget
    return batches


def test_whole_table(spark):
    got = QUERIES["op6_pack"](spark, SF).collect()
    want = {r.doc_id: len((r.text or "").encode().split()) for r in table(spark, SF, "documents").collect()}
    assert {r.doc_id: r.n_tokens for r in got} == want
    batches = check(got, packing.BUDGET)
    full = defaultdict(list)
    for name, b in batches.items():
        full[name.rsplit("-", 1)[0]].append(len(b))
    for sizes in full.values():  # only the last batch of a shard may be partly filled
        assert sorted(sizes, reverse=True)[:-1] == [max(sizes)] * (len(sizes) - 1)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 16)
    rows = [(i, "w " * (i % 13)) for i in range(200)] + [(5, None), (5, None), (None, "a b"), (900, "x " * 70_000), (901, " \n")]
    d = docs(spark, rows).selectExpr("*", "'z' AS bucket", "1 AS n_tokens", "2 AS uid")
    got = packing.pack(d, buckets=4, budget=64).collect()
    assert len(got) == len(rows)
    check(got, 64)
    assert [r for r in got if r.doc_id == 900][0].n_tokens == 70_000
    assert packing.pack(d.limit(0)).collect() == []
    assert packing.pack(docs(spark, [(1, None)])).first().n_tokens == 0


def test_long_lengths_share_bins(spark):
    sizes = spark.range(20_000).selectExpr("id * 37 AS n_tokens")
    n, c = packing.histogram(sizes)
    assert sum(c) == 20_000 and n == sorted(set(n)) and n[-1] == 19_999 * 37
    assert len(n) < 16_000 and all(b - a <= max(37, b / 1024) for a, b in zip(n, n[1:]))
