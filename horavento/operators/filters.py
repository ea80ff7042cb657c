"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from horavento.schemas import TARGETS, TEMPORAL_FEATURES

TS_CANDIDATES = ["timestamp", "data", "hora", "datetime"]


def select_final(df: DataFrame, targets: list[str] = TARGETS,
                 features: list[str] = TEMPORAL_FEATURES, prefix: str = "estacao_") -> DataFrame:
    """Final column order of the treated dataset: id, data, targets, temporal
    features, one-hot station columns (P1)."""
    onehot = sorted(c for c in df.columns if c.startswith(prefix))
    return df.select("id", "data", *targets, *features, *onehot)


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep only the listed columns that exist, in the given order."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    """All columns except a set."""
    return df.drop(*cols)


def rename_measures(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename by mapping; default lower-case with spaces -> ``_``."""
    if mapping is None:
        mapping = {c: c.strip().lower().replace(" ", "_") for c in df.columns}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns and k != v})


def drop_bad_ts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows whose timestamp did not parse are dropped (P5)."""
    return df.dropna(subset=[ts])


def by_year(df: DataFrame, anos: list[int], col: str = "ano") -> DataFrame:
    """Filter by years; on a year-partitioned table this prunes partitions."""
    return df.where(F.col(col).isin(list(anos)))


def by_station(df: DataFrame, estacoes: list[str], col: str = "estacao") -> DataFrame:
    """Filter by stations."""
    return df.where(F.col(col).isin(list(estacoes)))


def name_contains(df: DataFrame, s: str, col: str = "filename", negate: bool = False) -> DataFrame:
    """Substring filter, optionally negated."""
    cond = F.col(col).contains(s)
    return df.where(~cond if negate else cond)


def loaded_ok(ledger: DataFrame) -> DataFrame:
    """Ledger rows with status ``sucesso`` (P10)."""
    return ledger.where(F.col("status") == "sucesso")


def between_ts(df: DataFrame, a, b, ts: str = "ts") -> DataFrame:
    """Rows with ``a <= ts < b``; epoch-ms integers or timestamps."""
    def lit(x):
        if isinstance(x, (int, float)):
            return F.timestamp_millis(F.lit(int(x))).cast(dict(df.dtypes)[ts])
        return F.lit(x).cast(dict(df.dtypes)[ts])
    return df.where((F.col(ts) >= lit(a)) & (F.col(ts) < lit(b)))


def last_duration(df: DataFrame, hours: int, ts: str = "ts", now=None) -> DataFrame:
    """Rows within ``hours`` before ``now`` or, by default, before the latest
    timestamp in the data (P12).  The latest timestamp is a scalar subquery:
    Spark runs it once and inlines the value into the filter."""
    end = F.lit(now).cast(dict(df.dtypes)[ts]) if now is not None else df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) > F.timestamp_add("HOUR", F.lit(-hours), end))


def nonempty_points(df: DataFrame, values: str = "values") -> DataFrame:
    """Telemetry points with at least one value."""
    return df.where(F.size(values) > 0)


def stamp(df: DataFrame, col: str = "data_processamento") -> DataFrame:
    """Add the load time."""
    return df.withColumn(col, F.current_timestamp())


def pick_ts(df: DataFrame, candidates: list[str] = TS_CANDIDATES) -> str | None:
    """Name of the first timestamp-like column present."""
    return next((c for c in candidates if c in df.columns), None)
