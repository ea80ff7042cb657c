"""Exact quantiles (linear interpolation) with bounded per-task state.

``percentile`` keeps a value -> count map per group; for a group holding a
third of the data with continuous values that map is the group.  Here one
partial aggregate counts the rows of every (group, value), so repeated values
weigh one row; these are dealt by ranges of (group, value), which hold about
equal numbers of values however they are distributed, and written once.  A
running sum over the row counts per (group, range) finds the range of each
needed rank, and only the values of those few ranges are ranked.  Results
equal ``percentile`` / ``quantile_cont``: rank position ``p * (n - 1)``,
interpolated between the values at its floor and ceiling ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from horavento.session import materialize


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def exact_quantiles(df: DataFrame, col: str, probs: list[float], by=None,
                    names: list[str] | None = None, rows_per_bucket: int | None = None) -> DataFrame:
    """One row per group: ``n``, ``minimo``, ``maximo`` and one column per
    probability (``names`` or ``q_<i>``)."""
    by = _list(by)
    names = names or [f"q_{i}" for i in range(len(probs))]
    if not by:  # one global group: a constant key keeps every join an equi-join
        return exact_quantiles(df.withColumn("_all", F.lit(0)), col, probs, ["_all"], names, rows_per_bucket).drop("_all")
    cond = F.col(col).isNotNull()
    for c in by:
        cond = cond & F.col(c).isNotNull()
    values = df.where(cond).select(*by, F.col(col).cast("double").alias("_x")) \
        .groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_c"))
    if rows_per_bucket:
        values = materialize(values, "q-counts")
        values = values.repartitionByRange(max(1, -(-values.count() // rows_per_bucket)), *by, "_x")
    else:
        values = values.repartitionByRange(*by, "_x")
    values = materialize(values.withColumn("_b", F.spark_partition_id()), "q-values")
    ranges = materialize(values.groupBy(*by, "_b").agg(F.sum("_c").alias("_nb"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")),
                         "q-ranges")
    stats = ranges.groupBy(*by).agg(F.sum("_nb").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = ranges.select(*by, "_b", "_nb", F.sum("_nb").over(w).alias("_end")).withColumn("_start", F.col("_end") - F.col("_nb"))
    # ranks needed: floor and ceiling of p * (n - 1) for every probability;
    # the group's n / min / max ride along so the last step is one aggregate
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    pos = F.col("_q.p") * (F.col("_n") - 1).cast("double")
    ranks = stats.select(*by, "_n", "_lo", "_hi", F.explode(wanted).alias("_q")) \
        .select(*by, "_n", "_lo", "_hi", F.col("_q.i").alias("_i"), pos.alias("_pos")) \
        .select(*by, "_n", "_lo", "_hi", "_i", "_pos", F.explode(F.array(
            F.struct(F.lit(0).alias("hi"), F.floor("_pos").cast("long").alias("r")),
            F.struct(F.lit(1).alias("hi"), F.ceil("_pos").cast("long").alias("r")))).alias("_k")) \
        .select(*by, "_n", "_lo", "_hi", "_i", "_pos", F.col("_k.hi").alias("_which"), F.col("_k.r").alias("_r"))
    need = materialize(ranks.join(cum, by, "inner")
                       .where((F.col("_r") >= F.col("_start")) & (F.col("_r") < F.col("_end")))
                       .drop("_nb", "_end"), "q-need")  # a few rows per group
    # the values of the needed ranges only, ranked inside their range
    in_need = values.join(need.select(*by, "_b").distinct(), by + ["_b"], "left_semi")
    wv = Window.partitionBy(*by, "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    vc = in_need.withColumn("_vend", F.sum("_c").over(wv)).withColumn("_vstart", F.col("_vend") - F.col("_c"))
    pick = need.join(vc, by + ["_b"], "inner").where(
        (F.col("_r") >= F.col("_start") + F.col("_vstart")) & (F.col("_r") < F.col("_start") + F.col("_vend")))

    def at(i, which):
        return F.max(F.when((F.col("_i") == i) & (F.col("_which") == which), F.col("_x")))
    out = pick.groupBy(*by).agg(
        F.first("_n").alias("n"), F.first("_lo").alias("minimo"), F.first("_hi").alias("maximo"),
        *[F.struct(F.max(F.when(F.col("_i") == i, F.col("_pos"))).alias("pos"), at(i, 0).alias("lo"),
                   at(i, 1).alias("hi")).alias(f"_q{i}") for i in range(len(probs))])

    def interp(i):
        p, lo, hi = F.col(f"_q{i}.pos"), F.col(f"_q{i}.lo"), F.col(f"_q{i}.hi")
        lower, higher = F.floor(p), F.ceil(p)
        return F.when(lower == higher, lo).otherwise((higher - p) * lo + (p - lower) * hi)
    return out.select(*by, "n", "minimo", "maximo", *[interp(i).alias(nm) for i, nm in enumerate(names)])
