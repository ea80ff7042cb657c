"""Aggregations and climate analyses.

All are single ``groupBy`` / ``agg`` passes: Spark runs them as a partial
(map-side) aggregate, a shuffle of one row per group and task, and a final
aggregate -- so a station holding a third of all rows costs no more than
any other.  Extremes use ``max_by`` / ``min_by`` over a struct key instead of
a window so tie-breaking is exact and the work stays partial-aggregable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from horavento.schemas import (
    RISK_DRY_HUMIDITY, RISK_HOT_TEMPERATURE, RISK_STRONG_WIND, TARGETS, WIND_BOUNDS,
    WIND_CATEGORIES, WIND_STRONG, WIND_UNKNOWN,
)


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def profile(df: DataFrame, station: str = "estacao") -> DataFrame:
    """Row count, column count and distinct stations (A1)."""
    return df.agg(F.count(F.lit(1)).alias("n_registros"),
                  F.lit(len(df.columns)).cast("int").alias("n_colunas"),
                  F.countDistinct(station).alias("n_estacoes"))


def value_counts(df: DataFrame, col: str = "estacao") -> DataFrame:
    """Frequency table, most frequent first (A2)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def epoch_seconds(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_seconds(c.cast("timestamp"))


def period(df: DataFrame, ts: str = "ts", by=None) -> DataFrame:
    """First and last timestamp and whole days between them (A3).

    Days are elapsed 24-hour periods (floor of seconds / 86400), not calendar
    boundaries crossed."""
    g = df.groupBy(*_by(by)) if by else df.groupBy()
    out = g.agg(F.min(ts).alias("inicio"), F.max(ts).alias("fim"))
    secs = epoch_seconds("fim") - epoch_seconds("inicio")
    return out.withColumn("dias", F.floor(secs / F.lit(86400)).cast("long"))


def database_stats(df: DataFrame, date: str = "data") -> DataFrame:
    """Total rows and first / last date (printed beside A21 by the exporter)."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.min(date).alias("primeira_data"),
                  F.max(date).alias("ultima_data"))


def missing_report(df: DataFrame, cols: list[str] = TARGETS, by=None) -> DataFrame:
    """Missing count and percent (half-even, 2 places) per target, overall or
    per group, in long form (A4, P14, T25); NULL percent of an empty table."""
    by = _by(by)
    g = df.groupBy(*by) if by else df.groupBy()
    wide = g.agg(F.count(F.lit(1)).alias("total"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(by + ["total"], cols, "coluna", "faltantes")
    pct = F.bround(F.try_divide(F.col("faltantes").cast("double"), F.col("total").cast("double")) * 100.0, 2)
    return long.select(*by, "coluna", "faltantes", pct.alias("percentual"), "total")


def is_missing(cols: list[str] = TARGETS) -> dict[str, Column]:
    """Missing-value indicators per target."""
    return {f"{c}_faltante": F.col(c).isNull() for c in cols}


def hourly_profile(df: DataFrame, by: str = "estacao", cols: list[str] = TARGETS) -> DataFrame:
    """Mean of each measure by station and hour (A5); NULLs skipped."""
    return df.where(F.col(by).isNotNull()).groupBy(by, "hora") \
        .agg(*[F.avg(c).alias(c) for c in cols])


def extreme_hours(hourly: DataFrame, by: str = "estacao") -> DataFrame:
    """Hour of highest mean temperature and of lowest mean humidity per
    station; ties go to the lowest hour (A6, T10)."""
    h = F.col("hora")
    hot_key = F.when(F.col("temperatura").isNotNull(), F.struct(F.col("temperatura"), -h))
    dry_key = F.when(F.col("umidade").isNotNull(), F.struct(F.col("umidade"), h))
    return hourly.groupBy(by).agg(F.max_by(h, hot_key).alias("hora_pico_calor"),
                                  F.min_by(h, dry_key).alias("hora_mais_seca"))


def six_hour_snapshot(hourly: DataFrame, hours=(0, 6, 12, 18)) -> DataFrame:
    """Hourly profile at 00, 06, 12 and 18 h."""
    return hourly.where(F.col("hora").isin(list(hours)))


def monthly_pivot(df: DataFrame, by: str = "estacao", value: str = "temperatura",
                  date: str = "data") -> DataFrame:
    """Mean value per station and month, one column per month m01..m12.

    The month list is fixed, so the pivot needs no distinct-values pass."""
    months = list(range(1, 13))
    p = df.where(F.col(by).isNotNull()).withColumn("_mes", F.month(date)) \
        .groupBy(by).pivot("_mes", months).agg(F.avg(value))
    return p.select(by, *[F.col(str(m)).alias(f"m{m:02d}") for m in months])


def five_number(df: DataFrame, col: str = "temperatura", by: str = "estacao") -> DataFrame:
    """min, quartiles (linear interpolation) and max per station.

    Exact, via ``exact_quantiles``: per-task state is one bucket of one
    group, never the whole group's values."""
    from horavento.operators.quantiles import exact_quantiles
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by, ["q1", "mediana", "q3"])
    return q.select(by, "minimo", "q1", "mediana", "q3", "maximo")


def temp_humidity_corr(df: DataFrame, by: str = "estacao",
                       a: str = "temperatura", b: str = "umidade") -> DataFrame:
    """Pearson r per station over pairwise-complete rows (A10)."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.corr(a, b).alias("correlacao"))


def correlation_matrix(df: DataFrame, cols: list[str] = TARGETS) -> DataFrame:
    """All pairwise Pearson r in one pass, long form (coluna_a, coluna_b, r)."""
    aggs = [F.corr(a, b).alias(f"{a}|{b}") for a in cols for b in cols]
    wide = df.agg(*aggs)
    return wide.unpivot([], [f"{a}|{b}" for a in cols for b in cols], "par", "r") \
        .select(F.split("par", r"\|").getItem(0).alias("coluna_a"),
                F.split("par", r"\|").getItem(1).alias("coluna_b"), "r")


def wind_category(col="velocidade_vento") -> Column:
    """Simplified Beaufort class; NULL speed -> unknown."""
    v = F.col(col) if isinstance(col, str) else col
    expr = None
    for bound, name in WIND_BOUNDS:
        cond = v < F.lit(bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    strong = WIND_BOUNDS[-1][0]
    return expr.when(v >= F.lit(strong), F.lit(WIND_STRONG)).otherwise(F.lit(WIND_UNKNOWN))


def _slug(name: str) -> str:
    import unicodedata
    s = unicodedata.normalize("NFKD", name.lower())
    return "".join(ch for ch in s if not unicodedata.combining(ch)).replace(" ", "_")


def wind_share(df: DataFrame, by: str = "estacao") -> DataFrame:
    """Percent of hours in each wind class per station, zero-filled."""
    cats = WIND_CATEGORIES
    counts = df.where(F.col(by).isNotNull()).withColumn("_cat", wind_category("velocidade_vento")) \
        .groupBy(by).pivot("_cat", cats).agg(F.count(F.lit(1))).na.fill(0, subset=cats)
    total = sum((F.col(f"`{c}`") for c in cats), F.lit(0))
    return counts.select(by, *[(F.col(f"`{c}`").cast("double") * 100.0 / total).alias(_slug(c))
                               for c in cats])


def risk_hours(df: DataFrame, by: str = "estacao") -> DataFrame:
    """Hours of extreme dryness, heat and strong wind per station."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count_if(F.col("umidade") < RISK_DRY_HUMIDITY).alias("horas_secura_extrema"),
        F.count_if(F.col("temperatura") > RISK_HOT_TEMPERATURE).alias("horas_calor_extremo"),
        F.count_if(F.col("velocidade_vento") > RISK_STRONG_WIND).alias("horas_vento_forte"))


def describe_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max of each numeric column, long form."""
    from horavento.operators.quantiles import exact_quantiles
    if cols is None:
        numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
        cols = [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "coluna", "valor")
    v = F.col("valor")
    moments = long.groupBy("coluna").agg(
        F.count(v).alias("contagem"), F.avg(v).alias("media"), F.stddev_samp(v).alias("desvio"))
    q = exact_quantiles(long, "valor", [0.25, 0.5, 0.75], "coluna", ["p25", "p50", "p75"])
    return moments.join(q, "coluna", "left").select(
        "coluna", "contagem", "media", "desvio", "minimo", "p25", "p50", "p75", "maximo")


def score(pairs: DataFrame, by=("estacao", "modelo", "alvo"),
          real: str = "real", pred: str = "imputado", mape: bool = False) -> DataFrame:
    """RMSE, MAE and R2 per group (A14, M14): R2 = 1 - SSres / SStot with
    SStot = n * population variance of the truth; a constant truth (one row
    included) has no R2 and gives NULL."""
    e = F.col(real) - F.col(pred)
    aggs = [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(real) * F.count(real))).alias("r2"),
            F.count(F.lit(1)).alias("n")]
    if mape:
        aggs.append(F.avg(F.when(F.col(real) != 0, F.abs(e / F.col(real)))).alias("mape"))
    return pairs.groupBy(*_by(by)).agg(*aggs)


def score_macro(scores: DataFrame, by=("estacao", "modelo")) -> DataFrame:
    """Metrics averaged over targets."""
    return scores.groupBy(*_by(by)).agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"),
                                        F.avg("r2").alias("r2"))


def score_summary(scores: DataFrame, by=("modelo", "alvo")) -> DataFrame:
    """Cross-station mean and population std of the metrics."""
    return scores.groupBy(*_by(by)).agg(
        *[f(m).alias(f"{m}_{n}") for m in ("rmse", "mae", "r2")
          for n, f in (("media", F.avg), ("desvio", F.stddev_pop))])


def abs_error_stats(df: DataFrame, by=None, col: str = "erro_absoluto") -> DataFrame:
    """Mean, max and min absolute prediction error."""
    g = df.groupBy(*_by(by)) if by else df.groupBy()
    return g.agg(F.avg(col).alias("erro_medio"), F.max(col).alias("erro_maximo"),
                 F.min(col).alias("erro_minimo"))


def residual_histogram(df: DataFrame, col: str = "erro_predicao", width: float = 10.0,
                       by=None) -> DataFrame:
    """Counts of residuals in fixed-width bins."""
    b = (F.floor(F.col(col) / F.lit(width)) * F.lit(width)).cast("double")
    return df.where(F.col(col).isNotNull()).groupBy(*_by(by), b.alias("faixa_inicio")) \
        .agg(F.count(F.lit(1)).alias("n"))


def binned_heatmap(df: DataFrame, t_step: float = 50.0, u_step: float = 10.0) -> DataFrame:
    """Mean temperature over binned temperature x humidity cells."""
    t = (F.floor(F.col("temperatura") / F.lit(t_step)) * F.lit(t_step)).cast("double")
    u = (F.floor(F.col("umidade") / F.lit(u_step)) * F.lit(u_step)).cast("double")
    return df.where(F.col("temperatura").isNotNull() & F.col("umidade").isNotNull()) \
        .groupBy(t.alias("faixa_temperatura"), u.alias("faixa_umidade")) \
        .agg(F.count(F.lit(1)).alias("n"), F.avg("temperatura").alias("temperatura_media"))


def treatment_metadata(df: DataFrame, by: str = "estacao", ts: str = "ts",
                       cols: list[str] = TARGETS) -> DataFrame:
    """Per-station treatment facts in one aggregate: row count, period
    (start, end, days), missing counts per target and the column lists (A28)."""
    secs = epoch_seconds(F.max(ts)) - epoch_seconds(F.min(ts))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_registros"),
        F.struct(F.min(ts).alias("inicio"), F.max(ts).alias("fim"),
                 F.floor(secs / F.lit(86400)).cast("long").alias("dias")).alias("periodo"),
        F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).alias("faltantes"),
        F.array(*[F.lit(c) for c in cols]).alias("colunas_alvo"))


def flatten_treatment_metadata(meta: DataFrame, cols: list[str] = TARGETS) -> DataFrame:
    """The nested metadata as flat scalar columns."""
    return meta.select("estacao", "n_registros",
                       F.col("periodo.inicio").alias("inicio"), F.col("periodo.fim").alias("fim"),
                       F.col("periodo.dias").alias("dias"),
                       *[F.col(f"faltantes.{c}").alias(f"faltantes_{c}") for c in cols],
                       F.size("colunas_alvo").alias("n_alvos"))
