from hashlib import sha256

import re

from horavento.llm import decontaminate as dc
from horavento.llm.common import table
from tests.llm.helpers import LOW, SF, docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(t):
    return WORD.findall((t or "").translate(LOW))


def brute(rows, items):
    windows = {}
    for i, t in items:
        w = tokens(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault((n, tuple(w[s:s + n])), set()).add("" if i is None else str(i))
    sizes = {n for n, _ in windows}
    out = []
    for i, t in rows:
        w, hit, names = tokens(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if found := windows.get((n, tuple(w[s:s + n]))):
                    hit.update(range(s, s + n))
                    names |= found
        out.append((i, len(w), len(hit), len(names), sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, rows, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.annotate(docs(spark, rows), bench, **more).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got], key=str), got


ITEM = prose(1, 40)
ITEMS = [(1, ITEM), (2, "Short Item"), (3, "solo"), (4, ""), (5, None), (6, ITEM), (None, prose(8, 15)), (1, ITEM),
         (7, "a a a a a a a a a a a a a"), (9, " ".join(ITEM.split()[5:25]) + " other ending")]
ROWS = [(1, prose(2, 50) + ". " + ITEM.upper().replace(" ", ", ") + " " + prose(3, 20)), (2, " ".join(ITEM.split()[3:13])),
        (3, " ".join(ITEM.split()[3:12])), (4, "the short... ITEM here"), (5, "solo"), (6, None), (7, ""), (8, "a " * 5000),
        (9, prose(4, 300)), (9, prose(4, 300)), (None, prose(8, 15)), (10, prose(5, 20_000) + " " + ITEM), (11, "éa solo é")]


def test_against_brute_force(spark):
    got, rows = run(spark, ROWS, ITEMS)
    assert got == brute(ROWS, ITEMS)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].longest == 40 and by[1].longest_at == 50 and by[1].longest_item in ("1", "6")
    assert by[2].longest == 10 and by[9].longest == 0 and by[9].longest_item is None
    assert by[10].longest == 40 and by[10].longest_at == 20_000


def test_blocks_give_the_same(spark):
    assert run(spark, ROWS, ITEMS, block_words=60)[0] == brute(ROWS, ITEMS)


def test_shards_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(dc, "SHARD", 64)
    assert run(spark, ROWS, ITEMS)[0] == brute(ROWS, ITEMS)


def test_whole_table(spark):
    d, b = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    rows, items = [(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()]
    assert run(spark, rows, items)[0] == brute(rows, items)


def test_clean_keeps_columns_and_clean_rows(spark):
    d = docs(spark, ROWS).selectExpr("*", "'k' AS n_words", "1 AS row")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.clean(d, bench)
    assert got.columns == d.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r[0]) for r in brute(ROWS, ITEMS) if not r[-1])
    assert dc.annotate(d, bench).columns.count("n_words") == 1


def test_empty_tables(spark):
    assert run(spark, ROWS, [])[0] == brute(ROWS, [])
    assert run(spark, [], ITEMS)[0] == []
