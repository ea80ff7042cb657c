"""Fuzzy line deduplication by MinHash, with DataFrame functions only.

1. Lines are trimmed and lower-cased; a line's set holds its ``SHINGLE``
   characters (16-bit units) from every position on.  For the signatures a
   line is cut into overlapping pieces (one linear expression), the pieces
   into shingles.
2. Per distinct line ``MINIMA`` minima of one 32-bit shingle hash, each XORed
   with its own constant, come from one partial aggregate.  The constants
   differ in their leading bits, so each minimum is drawn from another part of
   the hash range (one-permutation hashing; an empty part takes the nearest).
3. Bands of four minima: eight disjoint ones and ``EXTRA`` across them.
   Every line of a shared band key meets the key's smallest line.  The low
   bits of the minima, packed into longs, drop clear non-matches where both
   lines have ``CERTAIN`` different minima (about 30 shingles; those of smaller
   sets depend on each other); all others are confirmed by the exact Jaccard
   similarity of the shingle sets.
4. Lines of a key that are in different components by then first meet the
   line in the middle of the key's near copies, the one whose buckets hold the
   most lines.  The pairs still open are confirmed too, so no link between
   components is lost.  Where more than ``BUCKET`` lines share a key they meet
   by prefix filtering, which is exact: with shingles ordered from rare to
   frequent, sets of this similarity share one of their first few, with enough
   left behind it.  Open pairs are also filtered exactly, by set size and by
   parity sketches: the bits in which two sketches differ are at most the
   shingles that only one of the lines has.
5. Union-find over the links; one occurrence per component is kept, that of
   the smallest (doc_id, line number).

Large sides are thinned before a shuffle by ``only_likely``, a bit table of
fixed size that has no false negatives.

Defined cases: null text stays null; blank lines are kept and never compared;
a line shorter than a shingle is one shingle; rows that repeat both doc_id and
text are one document, so they keep the same lines; a null doc_id sorts last;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm.common import flagged, let, only_likely, packed_similarity, register, table, without
from horavento.llm.components import connected_components
from horavento.session import materialize

SHINGLE, PERCENT = 8, 80
PIECE = 32
#: a pair of similarity 0.8 is missed by bands and filter together in 0.00 (9 and 9 shingles), 0.09 (27 and 27),
#: 0.32 (90 and 90) to 0.45 % (450 and 450) of simulated pairs: the extra bands use the same minima again
MINIMA, EXTRA = 32, 4
BITS = 4
#: pairs are confirmed from this estimate on; with fewer than CERTAIN shingles among the minima a line is not estimated
SLACK, CERTAIN = 0.3, 20
#: tasks that the lines of one component are dealt over
SALTS = 16
#: longs of a parity sketch
SKETCH = 16
#: the open pairs of larger buckets are found by prefix filtering
BUCKET = 64
#: cells of the counts that tell rare shingles from frequent ones
CELLS = 1 << 14


def _constants() -> list[int]:
    """32-bit constants with all 32 leading five-bit prefixes."""
    out = []
    for k in range(MINIMA):
        low = (k * 0x9E3779B1 + 0x7F4A7C15) % (1 << 27)
        x = (k << 27) | low
        out.append(x - (1 << 32) if x >= 1 << 31 else x)
    return out


def _bands() -> list[list[int]]:
    step = MINIMA // 4
    rows = [[k + step * i for i in range(4)] for k in range(step)]
    across = [[4 * k + i for i in range(4)] for k in range(0, step, step // EXTRA)]
    return rows + across


def lines_of(docs: DataFrame) -> DataFrame:
    """``id, th, no, line, h1, h2``: every non-blank line, normalised."""
    text = F.col("text").cast("string")
    # normalised before the explode: behind it, the filter would normalise every line a second time
    parts = F.transform(F.split(text, "\n"), lambda x: F.lower(F.btrim(x, F.lit(" \t\r\f\v"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("th"), F.posexplode(parts).alias("no", "line"))
    return rows.where("line <> ''").select(
        "*", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(7)).alias("h2"))


def shingles(line: str) -> Column:
    """The line's set as distinct 64-bit hashes of its shingles; a shorter
    line is one shingle.  Shingles are cut from a fixed-width encoding, so no
    position is searched for."""
    def cut(b: Column) -> Column:
        starts = F.sequence(F.lit(1), F.octet_length(b) - (2 * SHINGLE - 1), F.lit(2))
        every = F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.substring(b, i, F.lit(2 * SHINGLE)))))
        return F.when(F.octet_length(b) >= 2 * SHINGLE, every).otherwise(F.array(F.xxhash64(b)))

    return let(F.encode(F.col(line), "UTF-16BE"), cut)


def _minhashed(lines: DataFrame) -> DataFrame:
    """``h1, h2``, the band keys and the packed signature (null where the set
    is too small for an estimate) per distinct line."""
    # pieces of PIECE starts each, overlapping by a shingle less one character;
    # where a last piece is shorter, its first shingle stands in again
    def pieces(b: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.octet_length(b) - (2 * SHINGLE - 1), F.lit(1)), F.lit(2 * PIECE))
        return F.transform(starts, lambda i: F.substring(b, i, F.lit(2 * (PIECE + SHINGLE - 1))))

    at = lambda i: F.hash(F.substring("b", 2 * i - 1, 2 * SHINGLE))
    cut = lines.select("h1", "h2", F.explode(let(F.encode("line", "UTF-16BE"), pieces)).alias("b"))
    cut = cut.select("h1", "h2", (F.octet_length("b") / 2).cast("int").alias("n"), "b", at(1).alias("s1"))
    hashed = cut.select("h1", "h2", "s1", *[F.when(F.col("n") >= i + SHINGLE - 1, at(i)).otherwise(F.col("s1")).alias(f"s{i}")
                                            for i in range(2, PIECE + 1)])
    mins = hashed.groupBy("h1", "h2").agg(
        *[F.min(F.least(*[F.col(f"s{j}").bitwiseXOR(F.lit(c)) for j in range(1, PIECE + 1)])).alias(f"m{i}")
          for i, c in enumerate(_constants())])
    keys = [F.xxhash64(F.lit(b), *[F.col(f"m{i}") for i in band]) for b, band in enumerate(_bands())]
    per, sig = 64 // BITS, []
    for at in range(0, MINIMA, per):
        word = F.lit(0).cast("long")
        for i in range(per):
            low = F.col(f"m{at + i}").bitwiseAND(F.lit((1 << BITS) - 1)).cast("long")
            word = word.bitwiseOR(F.shiftleft(low, BITS * i))
        sig.append(word)
    drawn = F.array_distinct(F.array(*[F.col(f"m{i}").bitwiseXOR(F.lit(c)) for i, c in enumerate(_constants())]))
    return mins.select("h1", "h2", F.array(*keys).alias("bands"), F.when(F.size(drawn) >= CERTAIN, F.array(*sig)).alias("sig"))


def _possible(a: str, b: str, percent: int) -> Column:
    return F.coalesce(packed_similarity(F.col(a), F.col(b), MINIMA, BITS) >= percent / 100 - SLACK, F.lit(True))


def _texts(lines: DataFrame, nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``node, line`` of the nodes in ``ends``, written once."""
    ends = materialize(nodes.select("node", "h1", "h2").join(ends, "node"), "line-ends")
    return materialize(
        only_likely(lines.select("h1", "h2", "line"), F.col("h1"), ends.select("h1")).groupBy("h1", "h2")
        .agg(F.first("line").alias("line")).join(ends, ["h1", "h2"]).select("node", "line"), "line-texts")


def _sketches(texts: DataFrame) -> DataFrame:
    """``node, n, sketch``: the size of each node's set and its parity sketch;
    every shingle flips one of 64 * ``SKETCH`` bits."""
    sets = texts.select("node", F.explode(shingles("line")).alias("h"))
    sets = sets.select("node", F.pmod("h", F.lit(SKETCH)).alias("w"), F.expr("shiftleft(1L, CAST(shiftright(h, 20) & 63L AS INT))").alias("b"))
    words = [F.bit_xor(F.when(F.col("w") == i, F.col("b")).otherwise(F.lit(0).cast("long"))).alias(f"w{i}") for i in range(SKETCH)]
    sums = sets.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *words)
    return sums.select("node", "n", F.array(*[f"w{i}" for i in range(SKETCH)]).alias("sketch"))


def _prefixes(texts: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """``hot`` with a row per ``key`` and its place ``at``: the first
    n - ceil(percent * n) + 1 shingles of the node's set, rarest first.  How
    frequent a shingle is, is told by the byte (8 * log2) of its hash's cell,
    one of ``CELLS``: any order is exact that is the same for all sets."""
    sets = materialize(texts.join(hot.select("node"), "node").select("node", shingles("line").alias("s")), "line-sets")
    cell = lambda h: F.pmod(h, F.lit(CELLS)).cast("int")
    found = sets.select(F.explode("s").alias("h")).groupBy(cell(F.col("h")).alias("cell")).agg(F.count(F.lit(1)).alias("f"))
    often = bytearray(CELLS)
    for r in found.collect():
        often[r.cell] = min(255, int(8 * math.log2(1 + r.f)))
    rank = lambda h: F.substring(F.lit(often), cell(h) + 1, F.lit(1))
    ranked = F.sort_array(F.transform("s", lambda h: F.struct(rank(h).alias("f"), h.alias("h"))))
    n = F.size("s")
    first = F.slice("o", F.lit(1), n - F.ceil(n * percent / 100).cast("int") + 1)
    return (sets.select("node", "s", ranked.alias("o")).select("node", F.posexplode(first).alias("at", "k"))
            .select("node", "at", F.col("k.h").alias("key")).join(hot, "node"))


def _pairs_by_key(rows: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` of nodes that share a ``key``, lie in different
    components and may meet the threshold.  Behind the first key that two
    ordered sets share, the rest of each bounds what they have in common."""
    side = lambda x: rows.select(*[F.col(c).alias(c + x) for c in ("key", "node", "c", "n", "at", "sketch")])
    enough = lambda x: (F.col("n" + x) - F.col("at" + x)) * (100 + percent) >= (F.col("nu") + F.col("nv")) * percent
    differ = sum((F.bit_count(F.col("sketchu")[i].bitwiseXOR(F.col("sketchv")[i])) for i in range(SKETCH)), F.lit(0))
    near = differ * (100 + percent) <= (F.col("nu") + F.col("nv")) * (100 - percent)
    return (side("u").join(side("v"), (F.col("keyu") == F.col("keyv")) & (F.col("nodeu") < F.col("nodev"))
                           & (F.col("cu") != F.col("cv")) & enough("u") & enough("v") & near)
            .select(F.col("nodeu").alias("u"), F.col("nodev").alias("v")))


def _open_buckets(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """``key, node, c, m``: the buckets of more than one component ``c`` and
    their size ``m``."""
    comp = shared.join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    split = (comp.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where("lo <> hi").select("key", "m"))
    return materialize(comp.join(split, "key"), "line-open")


def _middle_star(shared: DataFrame, open_: DataFrame) -> DataFrame:
    """The pairs ``(u, v)`` of each node and the line in the middle of its
    open bucket, where that lies in another component."""
    size = shared.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    weight = shared.join(size, "key").groupBy("node").agg(F.sum("m").alias("w"))
    rows = open_.select("key", "node", "c").join(weight, "node")
    head = rows.groupBy("key").agg(F.max(F.struct("w", "node", "c")).alias("h"))
    met = rows.join(head.select("key", F.col("h.node").alias("hn"), F.col("h.c").alias("hc")), "key").where("c <> hc")
    return met.select(F.least("node", "hn").alias("u"), F.greatest("node", "hn").alias("v")).distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` of node ids whose shingle sets meet the threshold."""
    both = (pairs.join(texts.select(F.col("node").alias("u"), F.col("line").alias("a")), "u")
            .join(texts.select(F.col("node").alias("v"), F.col("line").alias("b")), "v")
            .select("u", "v", "a", "b"))

    def similar(sets: Column) -> Column:
        return let(F.size(F.array_intersect(sets["a"], sets["b"])),
                   lambda n: n * 100 >= (F.size(sets["a"]) + F.size(sets["b"]) - n) * percent)

    sets = F.struct(shingles("a").alias("a"), shingles("b").alias("b"))
    return both.where(let(sets, similar)).select("u", "v")


def line_groups(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(nodes, links)``: the distinct lines (``node, h1, h2``) and the
    components ``(node, component)`` of those linked with another one."""
    lines = lines_of(docs)
    nodes = materialize(_minhashed(lines).withColumn("node", F.monotonically_increasing_id()), "line-nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    heads = materialize(banded.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"))
                        .where("head <> last").select("key", "head"), "line-heads")
    shared = materialize(only_likely(banded, F.col("key"), heads.select("key")).join(heads, "key"), "line-buckets")
    sig = nodes.select("node", "sig")
    # every pair below is one of lines with a shared key: the documents are read for their texts once
    texts = _texts(lines, nodes, shared.select("node").distinct())

    def likely(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sig.select(F.col("node").alias("u"), F.col("sig").alias("su")), "u")
                .join(sig.select(F.col("node").alias("v"), F.col("sig").alias("sv")), "v")
                .where(_possible("su", "sv", percent)).select("u", "v"))

    star = shared.where("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v")).distinct()
    star = materialize(likely(star), "line-star")
    links = materialize(_confirmed(star, texts, percent), "line-links")
    open_ = _open_buckets(shared, connected_components(links, "line-round1"))
    middle = materialize(likely(_middle_star(shared, open_).join(star, ["u", "v"], "left_anti")), "line-middle")
    links = links.unionByName(materialize(_confirmed(middle, texts, percent), "line-links"))
    open_ = _open_buckets(shared, connected_components(links, "line-round2"))

    texts = texts.join(open_.select("node").distinct(), "node")
    open_ = materialize(open_.join(_sketches(texts), "node"), "line-sketched")
    rest = _pairs_by_key(open_.where(F.col("m") <= BUCKET).withColumn("at", F.lit(0)), percent)
    hot = materialize(open_.where(F.col("m") > BUCKET).select("node", "c", "n", "sketch").dropDuplicates(["node"]), "line-hot")
    if not hot.isEmpty():
        rest = rest.unionByName(_pairs_by_key(_prefixes(texts, hot, percent), percent))
    rest = rest.distinct().join(star.unionByName(middle), ["u", "v"], "left_anti")
    rest = materialize(rest, "line-rest")
    more = _confirmed(rest, texts, percent)
    return nodes.select("node", "h1", "h2"), connected_components(links.unionByName(more), "line-round3")


def dropped_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``id, th, drop``: per document (doc_id and text hash) the numbers of
    the lines that another occurrence stands for."""
    nodes, groups = line_groups(docs, percent)
    lines = materialize(lines_of(docs).select("id", "th", "no", "h1", "h2"), "line-places")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("th"), F.col("no"))
    classes = lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    grouped = nodes.join(groups, "node").select("h1", "h2", "component")
    classes = classes.join(grouped, ["h1", "h2"], "left").where("component IS NOT NULL OR first <> last")
    classes = materialize(classes.select("h1", "h2", "first", "component"), "line-classes")
    # a hot component's lines are dealt over SALTS tasks, its one row stands in each
    keep = (classes.where("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("kept"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = classes.withColumn("salt", F.pmod("h1", F.lit(SALTS)).cast("int"))
    keeper = materialize(salted.join(keep, ["component", "salt"], "left").select(
        "h1", "h2", F.coalesce("kept", "first").alias("kept")), "line-keepers")
    found = only_likely(lines, F.col("h1"), keeper.select("h1")).join(keeper, ["h1", "h2"])
    return materialize(found.where(place != F.col("kept")).groupBy("id", "th")
                       .agg(F.collect_list("no").alias("drop")), "line-drops")


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` (all columns, rows and order of lines) with the surplus lines
    cut out of ``text``, and ``n_lines`` and ``n_dropped``."""
    drops = dropped_lines(docs, percent)
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    text = F.col("text").cast("string")
    rows = without(docs, "n_lines", "n_dropped").select(
        *[F.col(f"`{c}`") for c in names if c != "text"], text.alias("text"), F.col("doc_id").cast("long").alias("__id"),
        F.xxhash64(text).alias("__th"))
    likely = F.xxhash64("__id", "__th")
    marks = drops.select(F.col("id").alias("__i"), F.col("th").alias("__t"), F.col("drop").alias("__drop"))
    cells = drops.select(F.xxhash64("id", "th").alias("k"))
    # documents that surely lose nothing bypass the shuffle
    known = flagged(rows, likely, cells)
    touched = (known.where("__likely").join(marks, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t")), "left"))
    whole = known.where("NOT __likely").withColumn("__drop", F.lit(None).cast("array<int>"))
    both = touched.drop("__i", "__t").unionByName(whole)
    part = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(part) - 1), F.col("__drop"))
    cut = both.withColumn("__part", part).withColumn("__left", left)
    joined = F.expr("array_join(transform(__left, i -> __part[i]), '\\n')")
    return cut.select(
        *[(F.when(F.col("__drop").isNull(), F.col("text")).otherwise(joined) if c == "text" else F.col(f"`{c}`")).alias(c)
          for c in names],
        F.coalesce(F.size("__part"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("__drop").isNull(), F.lit(0)).otherwise(F.size("__drop")).cast("long").alias("n_dropped"))


@register("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
