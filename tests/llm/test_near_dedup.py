import numpy as np
import pytest

from horavento.llm import near_dedup
from horavento.llm.common import IS_SPACE_WORD, shingle_set, table, word_hashes
from horavento.llm.components import connected_components
from tests.llm.helpers import SF, Union, docs, edited, links, prose, word_shingles


def brute(rows, k=5):
    sets = {i: word_shingles(t, k) for i, t in rows if i is not None}
    u = Union(sets)
    for a, b in links(sets):
        u.join(a, b)
    return {i: u.find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def check(spark, rows, k=5):
    got = near_dedup.near_duplicates(docs(spark, rows), shingle=k).collect()
    assert len(got) == len(rows)
    want, size = brute(rows, k)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (size[r.doc_id], want[r.doc_id], r.doc_id == want[r.doc_id])


def test_groups_and_awkward_rows(spark):
    base, other = prose(1, 150), prose(2, 300)
    rows = [(10, base), (11, base), (12, base.upper().replace(" ", "\n ")), (13, edited(base, 3, 0.03)), (14, edited(base, 4, 0.01)),
            (15, edited(base, 5, 0.5)), (20, other), (21, edited(other, 6, 0.02)), (30, ""), (31, None), (32, " \t\n"),
            (40, "one two three"), (41, "ONE  two three"), (42, "one two"), (None, base), (None, None),
            (50, prose(9, 30_000)), (60, "é ü"), (61, "É ü")]
    check(spark, rows)
    check(spark, rows, 4)


def test_chain_is_one_component(spark):
    text, rows = prose(21, 200).split(" "), []
    for i in range(12):  # each is close to the next only
        rows.append((i, " ".join(text)))
        text[i * 15:i * 15 + 2] = [f"x{i}", f"y{i}"]
    check(spark, rows)


def test_group_of_copies_and_near_copies(spark):
    base = prose(5, 120)
    rows = [(i, base) for i in range(200)] + [(200 + i, edited(base, i, 0.01)) for i in range(150)]
    check(spark, rows)


def test_open_pairs_by_prefix(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BUCKET", 2)
    base = prose(6, 150)
    check(spark, [(i, edited(base, i, 0.025)) for i in range(120)])


def test_whole_table(spark):
    d = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    check(spark, rows, 4)


def test_extra_columns_and_empty(spark):
    d = docs(spark, [(1, "a b c d e f"), (2, "a b c d e f")])
    clash = d.selectExpr("*", "'x' AS n", "'y' AS kept", "1 AS component_id", "2 AS node")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.near_duplicates(clash).collect()}
    assert got == {1: (1, True), 2: (1, False)}
    kept = near_dedup.keep_one(clash)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [1]
    assert near_dedup.near_duplicates(d.limit(0)).collect() == []


def test_repeated_rows_and_shared_ids(spark):
    a, b = prose(31, 80), prose(32, 80)
    got = near_dedup.near_duplicates(docs(spark, [(5, a), (5, a), (7, b), (5, b), (9, b)])).collect()
    assert {r.component_id for r in got} == {5} and len(got) == 5


def test_signature_estimates(spark):
    rng = np.random.default_rng(0)
    for share in (0.3, 0.8, 0.95):
        both = rng.integers(0, 1 << 63, 4000, dtype=np.int64).astype(np.uint64)
        k = int(len(both) * share)
        rest = int((len(both) - k) / 2)
        x, y = both[:k + rest], np.concatenate([both[:k], both[k + rest:]])
        row = spark.createDataFrame([([int(v) for v in near_dedup.packed(near_dedup.minima(x))],
                                      [int(v) for v in near_dedup.packed(near_dedup.minima(y))])], "a array<long>, b array<long>")
        from horavento.llm.common import packed_similarity
        got = row.select(packed_similarity(row.a, row.b, near_dedup._K, near_dedup.BITS)).first()[0]
        assert abs(got - share) < 0.17


def test_word_hashes_match_words():
    text = (prose(3, 400_000) + " é ü\x0b\x0c x").encode()
    words = text.split()
    h = word_hashes(text, IS_SPACE_WORD)
    assert len(h) == len(words)
    assert len(set(h.tolist())) == len(set(words))
    seen = {}
    for w, x in zip(words, h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(shingle_set("x" * 3_000_000 + " y", 5)) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    u = Union({x for p in pairs for x in p})
    for a, b in pairs:
        u.join(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {n: u.find(n) for p in pairs if p[0] != p[1] for n in p}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
