"""File catalog aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from horavento.functions.parse import parse_raw_name, parse_result_name
from horavento.functions.telemetry import bytes_to_mb, model_info, success_rate


def operation_summary(log: DataFrame, status: str = "status", size: str = "size",
                      duration: str | None = None) -> DataFrame:
    """Totals, successes, failures, success rate %, megabytes and, with a
    duration column, MB/s (A19, F25)."""
    ok = F.count_if(F.col(status) == "sucesso")
    aggs = [F.count(F.lit(1)).alias("total"), ok.alias("sucesso"),
            F.count_if(F.col(status) != "sucesso").alias("falhas"),
            F.sum(F.col(size).cast("double")).alias("_bytes")]
    if duration:
        aggs.append(F.sum(F.col(duration).cast("double")).alias("duracao_segundos"))
    out = log.agg(*aggs).withColumn("taxa_sucesso", success_rate("sucesso", "total")) \
        .withColumn("total_mb", F.col("_bytes") / F.lit(1048576.0)).drop("_bytes")
    if duration:
        out = out.withColumn("mb_por_segundo", F.when(F.col("duracao_segundos") > 0,
                                                      F.col("total_mb") / F.col("duracao_segundos"))
                             .otherwise(F.lit(0.0)))
    return out


def inventory(files: DataFrame, group: str = "year", size: str = "size") -> DataFrame:
    """Files and bytes per year directory."""
    return files.groupBy(group).agg(F.count(F.lit(1)).alias("n_arquivos"),
                                    F.sum(F.col(size).cast("long")).alias("bytes_total"))


def inventory_summary(files: DataFrame, group: str = "year", size: str = "size") -> DataFrame:
    """Total files, total bytes and the sorted 4-digit year directories (A22);
    the year list is bounded by the number of year directories."""
    y = F.col(group)
    return files.agg(F.count(F.lit(1)).alias("total_arquivos"),
                     F.sum(F.col(size).cast("long")).alias("bytes_total"),
                     F.array_sort(F.collect_set(F.when(y.rlike("^[0-9]{4}$"), y))).alias("anos"))


def files_by_station(files: DataFrame, name: str = "filename", size: str = "size") -> DataFrame:
    """Raw files grouped by station code ``A###`` and city, with the sorted
    file list (A23).  One raw file per station-year, so the list per station
    is bounded by the number of years."""
    p = parse_raw_name(name, title=True)
    return files.select(p["codigo"].alias("codigo"), p["cidade"].alias("cidade"),
                        F.col(name), F.col(size)) \
        .where(F.col("codigo").isNotNull()) \
        .groupBy("codigo").agg(F.min("cidade").alias("cidade"),
                               F.count(F.lit(1)).alias("n_arquivos"),
                               F.sum(size).alias("bytes_total"),
                               F.sort_array(F.collect_list(name)).alias("arquivos"))


def files_by_key(files: DataFrame, key: str, path: str = "path", size: str = "size") -> DataFrame:
    """Per-key file count, bytes and first / last path in sort order (the
    unbounded-list-free form of A23 for arbitrary listings)."""
    return files.groupBy(key).agg(F.count(F.lit(1)).alias("n_arquivos"),
                                  F.sum(F.col(size).cast("long")).alias("bytes_total"),
                                  F.min(path).alias("primeiro"), F.max(path).alias("ultimo"))


def results_catalog(files: DataFrame, name: str = "filename", size: str = "size") -> DataFrame:
    """Result files by station and model with sizes in MB."""
    p = parse_result_name(name)
    desc, comp = model_info(p["modelo"])
    rows = files.select(p["estacao"].alias("estacao"), p["modelo"].alias("modelo"),
                        F.col(name).alias("arquivo"), bytes_to_mb(size).alias("tamanho_mb"),
                        desc.alias("descricao_modelo"), comp.alias("complexidade_modelo")) \
        .where(F.col("estacao").isNotNull())
    return rows


def results_by_station(catalog: DataFrame) -> DataFrame:
    """Per station: number of files, models present (sorted), total MB."""
    return catalog.groupBy("estacao").agg(
        F.count(F.lit(1)).alias("n_arquivos"),
        F.array_sort(F.collect_set("modelo")).alias("modelos"),
        F.sum("tamanho_mb").alias("tamanho_mb"))


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """Stations, files, model types and stations having a model file."""
    return catalog.agg(F.countDistinct("estacao").alias("n_estacoes"),
                       F.count(F.lit(1)).alias("n_arquivos"),
                       F.countDistinct("modelo").alias("n_tipos_modelo"),
                       F.countDistinct(F.when(F.col("modelo").isNotNull(), F.col("estacao")))
                       .alias("estacoes_com_modelo"))


def station_load_stats(df: DataFrame, by: str = "estacao", year: str = "ano") -> DataFrame:
    """Years loaded (sorted, joined), distinct year count, rows."""
    return df.groupBy(by).agg(
        F.array_join(F.array_sort(F.collect_set(F.col(year).cast("string"))), ",").alias("anos"),
        F.countDistinct(year).alias("n_anos"), F.count(F.lit(1)).alias("n_registros"))
