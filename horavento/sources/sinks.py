"""Sinks (K1-K8) and the raw station-file writer used to land derived data.

Writes are partitioned so every task writes its own files; nothing is
gathered on the driver.  ``write_raw_station_files`` renders readings in the
raw station layout (8 metadata lines, header, ``;`` rows, decimal commas,
``-9999`` / blank for missing) with one file per station-year written by one
task -- a station-year is ~8,760 lines, a bounded unit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from horavento.functions.telemetry import to_payload
from horavento.operators import analysis as A
from horavento.operators.windows import telemetry_batches
from horavento.schemas import BATCH_RESULTS, RAW_COLUMNS, RAW_MIN_FIELDS, TARGETS


def write_treated(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Treated data, one directory per station, sorted inside files (K1); dealt
    by ranges of the series order, so a large station is many files."""
    df.repartitionByRange("estacao", "data", "hora", "id").sortWithinPartitions("estacao", "data", "hora") \
        .write.mode(mode).partitionBy("estacao").parquet(path)


def write_imputed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Imputed data per station x model as parquet, plus the id/date/hour +
    measures projection as CSV with a header (K2)."""
    df.write.mode(mode).partitionBy("estacao", "modelo").parquet(f"{path}/parquet")
    df.select("id", "data", "hora", *TARGETS, "estacao", "modelo") \
        .write.mode(mode).partitionBy("estacao", "modelo").option("header", "true").csv(f"{path}/csv")


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", jdbc_url: str | None = None,
               properties: dict | None = None) -> None:
    """Save with fail / replace / append (K3): a catalog table, or a JDBC
    table written in batches of 1,000 rows when a URL is given."""
    modes = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
    mode = modes.get(mode, mode)
    if jdbc_url:
        df.write.mode(mode).option("batchsize", 1000).jdbc(jdbc_url, name, properties=properties or {})
    else:
        df.write.mode(mode).saveAsTable(name)


# Export projection; ``sensacao_termica`` is optional in the stored table.
EXPORT_COLUMNS = [("id", "long"), ("estacao", "string"), ("data", "date"), ("temperatura", "double"),
                  ("umidade", "double"), ("velocidade_vento", "double"), ("sensacao_termica", "double"),
                  ("created_at", "timestamp")]


def export_projection(df: DataFrame) -> DataFrame:
    """The exported columns; absent optional ones are typed NULLs."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                       for c, t in EXPORT_COLUMNS])


def export_snapshot(df: DataFrame, path: str, ts: str) -> str | None:
    """Timestamped parquet snapshot of the export projection ordered by date
    desc, station; nothing is written when the frame is empty (K4)."""
    if df.isEmpty():
        return None
    out = f"{path.rstrip('/')}/snapshot_{ts}"
    export_projection(df).orderBy(F.desc("data"), "estacao").write.mode("errorifexists").parquet(out)
    return out


def land_raw(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parsed raw rows landed by year and station (K5)."""
    rows.withColumn("ano", F.year("data")).write.mode(mode).partitionBy("ano", "estacao").parquet(path)


def write_telemetry(df: DataFrame, path: str, batch_size: int = BATCH_RESULTS) -> None:
    """Telemetry payload batches as JSON lines, one line per batch."""
    b = telemetry_batches(df, batch_size)
    b.select(F.to_json(F.struct("estacao", "lote", F.transform(
        "payload", lambda p: F.struct(p["ts"].alias("ts"), p["values"].alias("values"))).alias("pontos")))
        .alias("value")).write.mode("overwrite").text(path)


def point_payloads(df: DataFrame) -> DataFrame:
    """One JSON payload per telemetry point."""
    return df.select(to_payload("ts_ms", "values").alias("payload"))


def write_stats_json(df: DataFrame, path: str) -> None:
    """Descriptive statistics as JSON lines (K7)."""
    A.describe_all(df).select(F.to_json(F.struct("*")).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str, by: str = "estacao") -> dict[str, str]:
    """The six analysis tables written side by side (K8).  The input is
    projected and written once to the shared folder; every table reads that
    copy instead of re-deriving the source."""
    from horavento.session import materialize
    df = materialize(df.select(by, "data", "hora", *TARGETS), "report-input")
    hourly = A.hourly_profile(df, by)
    tables = {
        "perfil_horario": hourly, "horas_extremas": A.extreme_hours(hourly, by),
        "resumo_6h": A.six_hour_snapshot(hourly), "sazonalidade": A.monthly_pivot(df, by),
        "distribuicao": A.five_number(df, by=by), "correlacao": A.temp_humidity_corr(df, by),
        "vento": A.wind_share(df, by), "risco": A.risk_hours(df, by),
    }
    out = {}
    for name, t in tables.items():
        p = f"{path.rstrip('/')}/{name}"
        t.write.mode("overwrite").parquet(p)
        out[name] = p
    return out


# --- fixed values: header labels of the raw layout at the positions read --
RAW_HEADER_NAMES = {
    0: "Data", 1: "Hora UTC",
    7: "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)",
    15: "UMIDADE RELATIVA DO AR, HORARIA (%)",
    18: "VENTO, VELOCIDADE HORARIA (m/s)",
}


def station_codes(readings: DataFrame) -> DataFrame:
    """Station -> code ``A<300 + rank>`` by sorted name: a window over the
    distinct station names only (one row per station)."""
    st = readings.select("estacao").where(F.col("estacao").isNotNull()).distinct()
    w = Window.orderBy("estacao")
    return st.withColumn("codigo", F.concat(F.lit("A"), (F.lit(300) + F.dense_rank().over(w)).cast("string")))


def _num(col: str, missing: str) -> F.Column:
    txt = F.replace(F.col(col).cast("string"), F.lit("."), F.lit(","))
    return F.coalesce(txt, F.lit(missing))


def write_raw_station_files(readings: DataFrame, path: str) -> str:
    """Render readings (id, estacao, data, hora int, 3 measures) as raw
    station-year files under ``path/ano=YYYY/arquivo=<name>/`` (Latin-1-free
    UTF-8 text; the reader accepts both)."""
    codes = station_codes(readings)
    r = readings.join(codes, "estacao").withColumn("ano", F.year("data"))
    name = F.concat(F.lit("INMET_NE_PE_"), F.col("codigo"), F.lit("_"), F.col("estacao"),
                    F.lit("_01-01-"), F.col("ano").cast("string"), F.lit("_A_31-12-"),
                    F.col("ano").cast("string"), F.lit(".CSV"))
    r = r.withColumn("arquivo", name)
    n = max(RAW_MIN_FIELDS, max(RAW_COLUMNS.values()) + 1) + 1
    fields = []
    for i in range(n):
        if i == RAW_COLUMNS["data"]:
            fields.append(F.date_format("data", "yyyy/MM/dd"))
        elif i == RAW_COLUMNS["hora"]:
            fields.append(F.format_string("%02d00 UTC", "hora"))
        elif i == RAW_COLUMNS["temperatura"]:
            fields.append(_num("temperatura", "-9999"))
        elif i == RAW_COLUMNS["umidade"]:
            fields.append(_num("umidade", ""))
        elif i == RAW_COLUMNS["velocidade_vento"]:
            fields.append(_num("velocidade_vento", "-9999"))
        else:
            fields.append(F.lit(""))
    data_lines = r.select("ano", "arquivo", (F.lit(100) + F.col("id")).alias("ordem"),
                          F.concat_ws(";", *fields).alias("value"))
    header = ";".join(RAW_HEADER_NAMES.get(i, f"COLUNA {i}") for i in range(n))
    meta = r.select("ano", "arquivo", "estacao", "codigo").distinct()
    texts = [F.lit("REGIAO:;NE"), F.lit("UF:;PE"), F.concat(F.lit("ESTACAO:;"), "estacao"),
             F.concat(F.lit("CODIGO (WMO):;"), "codigo"), F.lit("LATITUDE:;-8,05"),
             F.lit("LONGITUDE:;-34,95"), F.lit("ALTITUDE:;10"), F.lit("DATA DE FUNDACAO:;2000-01-01"),
             F.lit(header)]
    meta_lines = meta.select("ano", "arquivo", F.explode(F.array(*[
        F.struct(F.lit(i + 1).cast("long").alias("ordem"), t.alias("value"))
        for i, t in enumerate(texts)])).alias("l")).select("ano", "arquivo", "l.ordem", "l.value")
    lines = meta_lines.unionByName(data_lines)
    lines.repartition("ano", "arquivo").sortWithinPartitions("ano", "arquivo", "ordem") \
        .select("ano", "arquivo", "value") \
        .write.mode("errorifexists").partitionBy("ano", "arquivo").text(path)
    return path
