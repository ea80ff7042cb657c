from horavento.llm import licences as lic
from horavento.llm.common import QUERIES, table
from tests.llm.helpers import SF, docs, prose


def families(spark, rows, scanner):
    got = lic.find_licences(docs(spark, rows), scanner).collect()
    return {r.doc_id: sorted({f.family for f in r.found if f.confirmed}) for r in got}, got


def test_templates_variants_and_ordinary_text(spark):
    plain = [(i, "\n".join(prose(100 * i + j, 30) for j in range(8))) for i in range(1, 40)]
    s = lic.fit(docs(spark, plain))
    rows, want = [], {}
    for f, texts in lic.TEMPLATES.items():
        for t in texts:
            rows.append((len(rows) + 1000, f"{prose(len(rows), 20)}\n  {t.upper()}\n"))
            want[rows[-1][0]] = [f]
    ordinary = ["The license plate of the car was version 2.", "All rights reserved.", "I have no license to drive under the general public eye.",
                "Apache helicopters at MIT", "", "the the the of and", "Permission to land is granted, free of charge."]
    for t in ordinary:
        rows.append((len(rows) + 1000, t))
        want[rows[-1][0]] = []
    got, _ = families(spark, rows, s)
    wrong = {i: (got[i], want[i]) for i in want if got[i] != want[i]}
    assert len(wrong) <= 1, wrong


def test_whole_table_against_the_notices(spark):
    notices = {lic.TEMPLATES[f][0].lower(): f for f in lic.TEMPLATES}
    got = {r.doc_id: r for r in QUERIES["op5_licences"](spark, SF).collect()}
    rows = table(spark, SF, "documents").collect()
    assert len(got) == len(rows)
    found = 0
    for r in rows:
        want = sorted({notices[x.strip().lower()] for x in (r.text or "").split("\n") if x.strip().lower() in notices})
        found += len(want)
        assert set(want) <= set(filter(None, got[r.doc_id].families.split(",")))
        assert got[r.doc_id].n_paragraphs == sum(1 for x in (r.text or "").split("\n") if x.strip())
        if not any(w in (r.text or "").lower() for w in ("licen", "cc0", "cc by")):
            assert got[r.doc_id].n_licences == 0
    assert found > 0


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "Released under the MIT License."), (3, "\n\n \n"), (3, "\n\n \n"), (4, "w " * 200_000),
            (5, "\n" * 5000 + "Licensed under CC BY-NC 4.0."), (6, "x" * 300_000)]
    d = docs(spark, rows).selectExpr("*", "'f' AS found", "1 AS n_paragraphs")
    s = lic.fit(d)
    got = lic.find_licences(d, s).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [f.family for f in by[None].found] == ["MIT"]
    assert [(f.paragraph, f.family) for f in by[5].found] == [(5000, "CC-BY-NC")]
    assert by[1].n_paragraphs == 0 and by[4].n_paragraphs == 1
    assert lic.find_licences(d.limit(0), lic.fit(d.limit(0))).collect() == []


def test_training_paragraphs_come_from_all_places_and_are_whole(spark):
    rows = [(i, "\n".join(f"line {i} {k} " + "w" * 1500 for k in range(40))) for i in range(30)] + [(90, None), (91, ""), (92, "\n \n")]
    got = [r.line for r in lic.paragraphs(docs(spark, rows), 300).collect()]
    assert 150 < len(got) < 600 and all(len(x) > 1500 for x in got)
    assert len({x.split()[1] for x in got}) > 25 and max(int(x.split()[2]) for x in got) > 30
    long = [r.line for r in lic.paragraphs(docs(spark, [(1, "a b " * 20_000)]), 5).collect()]
    assert [len(x) for x in long] == [lic.LONGEST]
    assert lic.paragraphs(docs(spark, []), 5).collect() == []
