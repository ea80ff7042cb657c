"""Personal data in text, with DataFrame functions only.

Per kind one regular expression proposes spans: all matches and the gaps
between them come from the same expression, so the offsets are running sums of
lengths (in blocks, so a text with very many matches stays linear).  Checksum
validators confirm them: the Luhn sum for cards, mod-97 for bank account
numbers, part and digit counts for addresses and phones.  Words near a span
raise or lower its score; spans from ``MIN_SCORE`` on are reported, and
confirmed spans of the four base kinds always are.

The expressions match what the plain ones in the comments match, but start
only where a match can start and never give back, so they are linear in the
text however long a run of digits or name characters is.

Defined cases: null text counts as empty; offsets are code points, end
exclusive; repeated rows are answered each; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm.common import let, register, table

MIN_SCORE = 0.5
NEAR = 40

# Kind, expression, score before context, context words.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8,
     "mail contact write correo courriel"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip host server address client login"),
    # [0-9]([\x20-]?[0-9])+
    ("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7, "card visa master credit payment kredit tarjeta carte"),
    # \+[0-9][\x20().0-9-]+[0-9]
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, "phone tel call fax mobile ring"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b", 0.6,
     "iban account bank konto cuenta compte"),
)
BASE = ("email", "ip", "card", "phone")
AGAINST = "version release build section chapter order isbn"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_SPAN = "array<struct<start:bigint,end:bigint,value:string,near:string>>"


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _spans(text: Column, pattern: str, block: int = 256) -> Column:
    """``start, end, value, near`` of all leftmost non-overlapping matches."""
    def from_gaps(found: Column, gaps: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: (F.length(g) + F.length(m)).cast("long"))

        def placed(steps: Column) -> Column:
            blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / block).cast("int"))
            sums = F.transform(blocks, lambda b: _sum(F.slice(steps, b * block + 1, F.lit(block))))

            def with_sums(sums: Column) -> Column:
                before = F.transform(blocks, lambda b: _sum(F.slice(sums, F.lit(1), b)))
                return let(before, lambda before: F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda i: let(
                    before[F.floor(i / block).cast("int")]
                    + _sum(F.slice(steps, F.floor(i / block).cast("int") * block + 1, F.pmod(i, F.lit(block))))
                    + F.length(gaps[i]),
                    lambda start: F.struct(
                        start.alias("start"), (start + F.length(found[i])).alias("end"), found[i].alias("value"),
                        F.lower(F.concat(F.right(gaps[i], F.lit(NEAR)), F.lit(" "), F.left(gaps[i + 1], F.lit(NEAR))))
                        .alias("near")))))

            return let(sums, with_sums)

        return let(steps, placed)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, F.array().cast(_SPAN)).otherwise(
        let(F.split(text, pattern, -1), lambda g: from_gaps(m, g)).cast(_SPAN)))


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn sum divisible by ten."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, -i, F.lit(1)).cast("int") * (F.pmod(i - 1, F.lit(2)) + 1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number without spaces leaves 1 modulo 97, its first
    four characters moved to the end and letters read as 10 to 35."""
    turned = F.concat(F.substr(code, F.lit(5)), F.left(code, F.lit(4)))

    def step(r: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c >= 65, (r * 100 + c - 55) % 97).otherwise((r * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    """The kind's validator."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return let(F.regexp_replace(value, " ", ""), lambda c: F.when(F.length(c).between(15, 34), mod97(c)).otherwise(False))
    return F.lit(True)


def find_pii(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id`` and ``spans``: kind, start, end, value, score of every
    reported span, kinds in the order of ``KINDS``, then by start."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("text"))
    against = rf"\b(?:{'|'.join(AGAINST.split())})\b"
    return rows.select("doc_id", F.concat(*[_reported(*k, against, min_score) for k in KINDS]).alias("spans"))


def _reported(kind: str, pattern: str, score: float, words: str, against: str, min_score: float) -> Column:
    """The confirmed spans of one kind with their scores."""
    def judged(s: Column) -> Column:
        value = (F.lit(score) + F.when(F.rlike(s["near"], F.lit(rf"(?:{'|'.join(words.split())})")), 0.2).otherwise(0.0)
                 - F.when(F.rlike(s["near"], F.lit(against)), 0.2).otherwise(0.0))
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        s["value"].alias("value"), F.round(value, 2).alias("score"))

    spans = F.transform(F.filter(_spans(F.col("text"), pattern), lambda s: confirmed(kind, s["value"])), judged)
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= min_score)


def redact(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` (all columns) with the text of every reported span replaced by
    its kind in angle brackets: just the spans of ``find_pii``, so added kinds
    need ``min_score``, context included.  Of spans that overlap the one that
    starts first is replaced, and of those the longest (then by kind)."""
    text = F.col("text").cast("string")
    against = rf"\b(?:{'|'.join(AGAINST.split())})\b"
    spans = F.concat(*[_reported(*k, against, min_score) for k in KINDS])
    kind_no = lambda s: F.array_position(F.array(*[F.lit(k[0]) for k in KINDS]), s["kind"])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), kind_no(s).alias("no"), s["kind"].alias("kind"))))
    first = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], gap, F.lit("<"), s["kind"], F.lit(">")).alias("out"), (-s["back"]).cast("long").alias("at"))).otherwise(acc)

    cut = F.aggregate(ordered, first, step, lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))
    return docs.withColumn("text", F.when(text.isNotNull(), cut))


def _kind_sql(k: int, kind: str, pattern: str, valid: str) -> str:
    return f"""
SELECT doc_id, {k} AS k, '{kind}' AS kind, v, s, s + length(v) AS e FROM (
  SELECT doc_id, m[i + 1] AS v, CAST(coalesce(list_sum(list_transform(list_slice(g, 1, i + 1), lambda x: length(x))), 0)
    + coalesce(list_sum(list_transform(list_slice(m, 1, i), lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT doc_id, m, g, unnest(range(len(m))) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM b)))
WHERE {valid}"""


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_CODE = "replace(v, ' ', '')"
OP8_SQL = f"""
WITH b AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join([
    _kind_sql(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    _kind_sql(1, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
              "list_max(list_transform(string_split(v, '.'), lambda x: CASE WHEN length(ltrim(x, '0')) > 3 THEN 999 "
              "ELSE coalesce(TRY_CAST(x AS INTEGER), 999) END)) <= 255"),
    _kind_sql(2, "card", r"[0-9](?:[\x20-]?[0-9])+",
              f"length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), "
              f"lambda i: CASE WHEN i % 2 = 1 THEN CAST({_DIGITS}[-i] AS INTEGER) WHEN CAST({_DIGITS}[-i] AS INTEGER) > 4 "
              f"THEN 2 * CAST({_DIGITS}[-i] AS INTEGER) - 9 ELSE 2 * CAST({_DIGITS}[-i] AS INTEGER) END)) % 10 = 0"),
    _kind_sql(3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    _kind_sql(4, "iban", r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
              f"length({_CODE}) BETWEEN 15 AND 34 AND list_reduce(list_transform(string_split(array_to_string(list_transform("
              f"string_split(substr({_CODE}, 5) || {_CODE}[1:4], ''), lambda c: CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS "
              "VARCHAR) ELSE c END), ''), ''), lambda c: CAST(c AS INTEGER)), lambda r, d: (r * 10 + d) % 97) = 1"),
])})
SELECT b.doc_id, CAST(count(*) FILTER (k = 0) AS BIGINT) AS n_email, CAST(count(*) FILTER (k = 1) AS BIGINT) AS n_ip,
  CAST(count(*) FILTER (k = 2) AS BIGINT) AS n_card, CAST(count(*) FILTER (k = 3) AS BIGINT) AS n_phone,
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s), '') AS spans
FROM b LEFT JOIN found USING (doc_id) GROUP BY b.doc_id"""


@register("op8_pii", OP8_SQL)
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k) for k in BASE], F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, name), ",").alias("spans"))
