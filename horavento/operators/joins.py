"""Joins and keyed lookups.

No side is forced to be broadcast: the planner broadcasts a side whose size
it knows to be below ``spark.sql.autoBroadcastJoinThreshold``, and adaptive
execution does so for one that it has measured; other joins are shuffled, with
skewed partitions split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from horavento.schemas import MODEL_CONFIGS


def pending_files(files: DataFrame, ledger: DataFrame, key: str = "arquivo_s3") -> DataFrame:
    """Files not yet loaded with success: left anti join on the path."""
    ok = ledger.where(F.col("status") == "sucesso").select(key)
    return files.join(ok, key, "left_anti")


def map_station(df: DataFrame, alias: DataFrame, col: str = "estacao",
                alias_key: str = "alias", canonical: str = "canonico") -> DataFrame:
    """Alias -> canonical station name; rows without a match are skipped."""
    a = alias.select(F.col(alias_key).alias(col), F.col(canonical).alias("_canon"))
    return df.join(a, col, "inner").withColumn(col, F.col("_canon")).drop("_canon")


def attach_device(df: DataFrame, devices: DataFrame, key: str = "estacao",
                  device: str = "device_id") -> DataFrame:
    """Station -> device; stations without a device are kept with status
    ``erro`` (J3)."""
    out = df.join(devices, key, "left")
    return out.withColumn("status", F.when(F.col(device).isNull(), F.lit("erro"))
                          .otherwise(F.lit("ok")))


def enrich_station(df: DataFrame, dim: DataFrame, key: str = "estacao") -> DataFrame:
    """Dimension enrichment: code, type, region, description."""
    return df.join(dim, key, "left")


def with_header(df: DataFrame, header: DataFrame, key: str = "arquivo") -> DataFrame:
    """Attach file metadata (one row per file) to that file's rows."""
    return df.join(header, key, "left")


def masked_pairs(truth: DataFrame, imputed: DataFrame, keys=("id", "alvo")) -> DataFrame:
    """Masked truth x imputed value by row id and target: inner equi-join."""
    return truth.join(imputed, list(keys), "inner")


def task_grid(stations: DataFrame, configs: list[dict] = MODEL_CONFIGS) -> DataFrame:
    """Station x model configuration grid (J7) as an ``explode`` of the fixed
    configuration array -- a bounded fan-out of len(configs) per station,
    no cartesian join."""
    arr = F.array(*[F.struct(F.lit(c["nome"]).alias("modelo"),
                             F.lit(c["n_estimators"]).alias("n_estimators"),
                             F.lit(c["max_depth"]).alias("max_depth"),
                             F.lit(c["max_iter"]).alias("max_iter")) for c in configs])
    return stations.select("*", F.explode(arr).alias("cfg")).select("*", "cfg.*").drop("cfg")


def split_existing(new: DataFrame, old: DataFrame, key) -> tuple[DataFrame, DataFrame]:
    """Incoming rows that already exist (semi) and that are new (anti)."""
    keys = [key] if isinstance(key, str) else list(key)
    o = old.select(*keys)
    return new.join(o, keys, "left_semi"), new.join(o, keys, "left_anti")


def restore_ids(imputed: DataFrame, ids=("id", "data", "hora")) -> DataFrame:
    """Identifiers are carried through imputation row by row, so restoring
    them is a projection, not a join (J9)."""
    return imputed.select(*ids, *[c for c in imputed.columns if c not in ids])


def require_station(spark, estacoes: list[str], known: DataFrame, col: str = "estacao") -> None:
    """Raise when a requested station is unknown (J10): left anti join of the
    (small, user-given) request list against the known stations."""
    req = spark.createDataFrame([(e,) for e in estacoes], f"{col} string")
    missing = [r[0] for r in req.join(known.select(col).distinct(), col, "left_anti").collect()]
    if missing:
        raise ValueError(f"unknown stations: {sorted(missing)}")
