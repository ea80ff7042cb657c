"""Set operations, upserts and the load ledger.

Parquet has no ``MERGE``: an upsert is a full outer join of the stored
table and the (deduplicated) incoming rows on the natural key, written as a
new version.  The key is fine-grained (station, date, hour), so the join
shuffles evenly even when one station dominates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from horavento.operators.windows import latest_per_key
from horavento.schemas import READING_KEY, TARGETS


def union_stations(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """Distinct combinations of the given columns."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct()


def _non_null(keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def merge_readings(target: DataFrame, incoming: DataFrame, keys: list[str] = READING_KEY,
                   measures: list[str] = TARGETS, order=("arquivo", "linha"),
                   now=None, carry: list[str] | None = None) -> DataFrame:
    """Upsert ``incoming`` into ``target``.

    * several incoming rows for one key: the last by ``order`` wins (T21);
    * a matched key takes the incoming measures verbatim, NULL included (T22),
      keeps ``created_at`` and gets a new ``updated_at``;
    * rows with a NULL key part never match anything and are appended (T3).

    Returns the merged table with ``acao`` in {inserido, atualizado, mantido}."""
    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    order = [c for c in order if c in incoming.columns]
    carry = [c for c in (carry or []) if c in incoming.columns]
    inc = incoming.select(*keys, *measures, *dict.fromkeys(order + carry))
    inc = latest_per_key(inc, keys, order) if order else inc
    inc = inc.drop(*[c for c in order if c not in carry])
    tgt = target
    for c in ("created_at", "updated_at"):
        if c not in tgt.columns:
            tgt = tgt.withColumn(c, F.lit(None).cast("timestamp"))
    tgt = tgt.select(*keys, *measures, "created_at", "updated_at")
    nn_t, nn_i = _non_null(keys), _non_null(keys)
    t = tgt.where(nn_t).select(*keys, *[F.col(m).alias(f"t_{m}") for m in measures],
                               "created_at", "updated_at", F.lit(True).alias("_in_t"))
    i = inc.where(nn_i).select(*keys, *[F.col(m).alias(f"i_{m}") for m in measures], *carry,
                               F.lit(True).alias("_in_i"))
    j = t.join(i, keys, "full_outer")
    in_i = F.col("_in_i").isNotNull()
    in_t = F.col("_in_t").isNotNull()
    merged = j.select(
        *keys,
        *[F.when(in_i, F.col(f"i_{m}")).otherwise(F.col(f"t_{m}")).alias(m) for m in measures],
        F.when(in_t, F.col("created_at")).otherwise(now).alias("created_at"),
        F.when(in_i, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(in_i & in_t, F.lit("atualizado")).when(in_i, F.lit("inserido"))
         .otherwise(F.lit("mantido")).alias("acao"), *carry)
    nulls_t = tgt.where(~nn_t).withColumn("acao", F.lit("mantido"))
    for c in carry:
        nulls_t = nulls_t.withColumn(c, F.lit(None).cast(dict(inc.dtypes)[c]))
    nulls_i = inc.where(~nn_i).withColumns({"created_at": now, "updated_at": now,
                                             "acao": F.lit("inserido")})
    return merged.unionByName(nulls_t).unionByName(nulls_i)


def merge_counts(merged: DataFrame) -> DataFrame:
    """True inserted / updated / kept counts of a merge."""
    return merged.agg(F.count_if(F.col("acao") == "inserido").alias("registros_inseridos"),
                      F.count_if(F.col("acao") == "atualizado").alias("registros_atualizados"),
                      F.count_if(F.col("acao") == "mantido").alias("registros_mantidos"))


def record_load(ledger: DataFrame, rows: DataFrame, key: str = "arquivo_s3") -> DataFrame:
    """Upsert load results into the ledger by file path (U4): the new row
    replaces status, counts and processing time."""
    cols = ["arquivo_s3", "data_processamento", "registros_inseridos",
            "registros_atualizados", "status"]
    new = latest_per_key(rows.select(*cols), [key], ["data_processamento"])
    kept = ledger.select(*cols).join(new.select(key), key, "left_anti")
    return kept.unionByName(new)


def load_totals(files: DataFrame, ledger: DataFrame, key: str = "arquivo_s3") -> DataFrame:
    """Files found, already processed with success, and pending."""
    ok = ledger.where(F.col("status") == "sucesso").select(key).distinct() \
        .withColumn("_ok", F.lit(True))
    f = files.select(key).distinct().join(ok, key, "left")
    return f.agg(F.count(F.lit(1)).alias("encontrados"),
                 F.count_if(F.col("_ok").isNotNull()).alias("ja_processados"),
                 F.count_if(F.col("_ok").isNull()).alias("pendentes"))
