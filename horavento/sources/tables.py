"""Driver tables and the readings adapter (S10-S14, FIXTURES adapter)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.functions.temporal import to_ts
from horavento.session import path_exists

READING_COLUMNS = ["id", "estacao", "data", "hora", "temperatura", "umidade", "velocidade_vento"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(events: DataFrame, keep_ts: bool = False) -> DataFrame:
    """Adapter: the ``events`` table as hourly station readings.

    Event type plays the station, the event value the temperature, the JSON
    ``k`` the humidity and ``user_id`` the wind; a fixed rule blanks some cells
    so every measure has missing values to report and impute."""
    eid = F.col("event_id")
    umid = F.get_json_object("props", "$.k").try_cast("double")
    wind = (F.col("user_id") % 80).cast("double") / F.lit(10).cast("double")
    return events.select(
        eid.alias("id"),
        F.col("event_type").alias("estacao"),
        F.col("ts").cast("date").alias("data"),
        F.hour("ts").cast("int").alias("hora"),
        F.when(eid % 10 == 0, F.lit(None)).otherwise(F.col("value")).cast("double").alias("temperatura"),
        F.when(eid % 7 == 0, F.lit(None)).otherwise(umid).cast("double").alias("umidade"),
        F.when(eid % 13 == 0, F.lit(None)).otherwise(wind).cast("double").alias("velocidade_vento"),
        *([F.col("ts")] if keep_ts else []),
    )


def telemetry_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that also keep the raw event instant as ``ts`` (sub-hour telemetry)."""
    return readings_from_events(load_table(spark, sf_dir, "events"), keep_ts=True)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings view over ``events`` (id, estacao, data, hora, 3 measures)."""
    return readings_from_events(load_table(spark, sf_dir, "events"))


def readings_with_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings plus the hourly timestamp built from date and hour."""
    return readings(spark, sf_dir).withColumn("ts", to_ts("data", "hora"))


def orders_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a multi-year monthly series: status as station, total
    price as temperature, order date as the reading date."""
    o = load_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("estacao"),
        F.col("o_orderdate").cast("date").alias("data"),
        F.col("o_totalprice").cast("double").alias("temperatura"),
    )


def load_readings(spark: SparkSession, src: str, fmt: str = "parquet",
                  columns: list[str] | None = None) -> DataFrame:
    """Fact table with the selected columns (S10); ordering is left to the
    consumer (``sort_series``) so the scan stays a plain columnar read."""
    df = spark.read.format(fmt).load(src)
    return df.select(*(columns or [c for c in READING_COLUMNS if c in df.columns]))


def query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over registered temp views."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def table_info(spark: SparkSession, name: str, with_count: bool = True) -> DataFrame:
    """Existence, columns, types and (optionally) row count of a table."""
    exists = spark.catalog.tableExists(name)
    rows = []
    if exists:
        df = spark.table(name)
        n = df.count() if with_count else None
        rows = [(name, f.name, f.dataType.simpleString(), n) for f in df.schema.fields]
    return spark.createDataFrame(rows, "tabela string, coluna string, tipo string, linhas long")


def station_dimension(spark: SparkSession) -> DataFrame:
    """The fixed station dimension (name, code, type, description) as a
    DataFrame: twelve literal rows, safe to broadcast."""
    from horavento.schemas import STATIONS
    return spark.createDataFrame(STATIONS, "nome string, codigo string, tipo string, descricao string")


def discover_stations(df: DataFrame, col: str = "estacao") -> DataFrame:
    """Distinct stations (partition column values), sorted."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def load_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    """A saved frame plus its metadata frame when one was written beside it."""
    data = spark.read.parquet(f"{path}/data")
    meta = spark.read.parquet(f"{path}/metadata") if path_exists(spark, f"{path}/metadata") else None
    return data, meta
