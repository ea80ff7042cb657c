import re
from hashlib import sha256

from horavento.llm import pii
from horavento.llm.common import QUERIES, table
from tests.llm.helpers import SF, docs

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (i % 2 + 1)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, rx in PLAIN.items():
        for m in re.finditer(rx, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(p or 0) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


CASES = [
    None, "", "é😀 a.b+c@d-e.co.uk, x@y x@y.z. @a.b a@b..c", "a@b.c_d@e.f@g.h", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3 256.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 5500005555555559 4 1 1 1", "+1 (415) 555-0132. +49-30-1234567 +1 +12 +1((((((((2",
    "00000000000000000000", "1 2", "+" * 50 + "1" * 12, "a" * 20_000, "1" * 20_000, "1." * 5_000, ("x@y.zz " * 3000), "\x00 \ud83d a@b.c",
    "iban DE89 3704 0044 0532 0130 00 and DE89370400440532013001", "GB82WEST12345698765432",
]


def run(spark, rows):
    return {r.doc_id: r for r in pii.find_pii(docs(spark, rows)).collect()}


def test_base_spans_match_the_plain_expressions(spark):
    cases = [None if c is None else c.encode("utf-8", "replace").decode() for c in CASES]
    got = run(spark, list(enumerate(cases)))
    for i, c in enumerate(cases):
        spans = [s for s in got[i].spans if s.kind in pii.BASE]
        assert [f"{s.kind}:{s.start}:{s.end}" for s in spans] == brute(c), c[:60]
        assert all(c[s.start:s.end] == s.value for s in spans)


def test_account_numbers_and_context(spark):
    got = run(spark, [(1, CASES[-2]), (2, CASES[-1]), (3, "version 1.2.3.4"), (4, "server 1.2.3.4"), (5, "XX00AAAAAAAAAAAAAAA")])
    assert [s.value for s in got[1].spans if s.kind == "iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert [s.kind for s in got[2].spans] == ["iban"] and got[5].spans == []
    assert got[3].spans[0].score < got[4].spans[0].score


def test_whole_table(spark):
    got = {r.doc_id: r for r in QUERIES["op8_pii"](spark, SF).collect()}
    rows = table(spark, SF, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = brute(r.text)
        assert got[r.doc_id].base_sha256 == sha256(",".join(want).encode()).hexdigest()
        assert got[r.doc_id].n_card == sum(w.startswith("card") for w in want)


def test_repeated_empty_clashing(spark):
    d = docs(spark, [(1, "a@b.c"), (1, "a@b.c"), (None, "+1 415 555 0132"), (2, None)]).selectExpr("*", "'s' AS spans", "3 AS m")
    assert pii.find_pii(d).count() == 4
    assert pii.find_pii(d.limit(0)).collect() == []
    red = {r.doc_id: r.text for r in pii.redact(d).collect()}
    assert red == {1: "<email>", None: "<phone>", 2: None}


def test_no_python_in_the_plan(spark):
    plan = pii.find_pii(docs(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_redact_replaces_just_the_reported_spans(spark):
    code = "DE89 3704 0044 0532 0130 00"
    texts = [f"account {code} end", f"version {code}", "é a@b.c, 192.168.0.1 and a@b.c", "no data", "", "x " * 30_000 + "a@b.c"]
    for score in (0.5, 0.99):
        d = docs(spark, list(enumerate(texts)))
        spans = {r.doc_id: r.spans for r in pii.find_pii(d, score).collect()}
        red = {r.doc_id: r.text for r in pii.redact(d, score).collect()}
        for i, t in enumerate(texts):
            want, at = "", 0
            for s in sorted(spans[i], key=lambda s: (s.start, -s.end)):
                if s.start >= at:
                    want, at = want + t[at:s.start] + f"<{s.kind}>", s.end
            assert red[i] == want + t[at:]
        assert ("<iban>" in red[0]) == (score == 0.5) and "<iban>" not in red[1]
    assert red[2] == "é <email>, <ip> and <email>"
