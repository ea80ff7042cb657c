"""Hourly telemetry statistics, batch and streaming.

The batch and the streaming forms share one aggregation: long form
(station, key, value), tumbling ``window(ts, interval)``, then avg / min /
max / count.  In the stream a 2-hour watermark bounds the state: a window is
emitted once the watermark passes its end, and rows later than that are
dropped from the statistics (the merge path R5 still stores them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from horavento.functions.telemetry import to_long
from horavento.operators.filters import between_ts, last_duration
from horavento.session import scratch_path
from horavento.sources.tables import readings_from_events

WATERMARK = "2 hours"

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def _long(df: DataFrame, keys: list[str], by: str, ts: str) -> DataFrame:
    return to_long(df, [by, ts], keys).where(F.col("valor").isNotNull())


def _hourly(long: DataFrame, by: str, ts: str, interval: str) -> DataFrame:
    return long.groupBy(by, "chave", F.window(ts, interval).alias("w")).agg(
        F.avg("valor").alias("media"), F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"), F.count(F.lit(1)).alias("n"))


def telemetry_stats(df: DataFrame, keys: list[str], a=None, b=None, interval: str = "1 hour",
                    by: str = "estacao", ts: str = "ts") -> DataFrame:
    """AVG / MIN / MAX / COUNT per device, key and time bucket over
    ``[a, b)`` (A27, P11)."""
    if a is not None and b is not None:
        df = between_ts(df, a, b, ts)
    return _hourly(_long(df, keys, by, ts), by, ts, interval) \
        .select(by, "chave", F.col("w.start").alias("hora_inicio"), "media", "minimo", "maximo", "n")


def dashboard_series(df: DataFrame, keys: list[str], days: int = 7, interval: str = "1 hour",
                     by: str = "estacao", ts: str = "ts") -> DataFrame:
    """Mean per bucket over the last ``days`` before the latest timestamp:
    every bucket, unordered (R9, P12)."""
    recent = last_duration(df, days * 24, ts)
    g = _long(recent, keys, by, ts).groupBy(by, "chave", F.window(ts, interval).alias("w")) \
        .agg(F.avg("valor").alias("media"))
    return g.select(by, "chave", F.col("w.start").alias("hora_inicio"), "media")


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None,
                  glob: str = "events.parquet") -> DataFrame:
    """Event parquet files as a file-source stream (explicit schema)."""
    r = spark.readStream.format("parquet").schema(EVENTS_SCHEMA).option("pathGlobFilter", glob) \
        .option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(sf_dir)


def telemetry_stats_stream(spark: SparkSession, sf_dir: str, keys: list[str],
                           interval: str = "1 hour", by: str = "estacao",
                           sink: str | None = None, checkpoint: str | None = None,
                           glob: str = "events.parquet", max_files: int | None = None) -> DataFrame:
    """Tumbling hourly statistics on a stream with a watermark, appended to
    parquet under the shared folder; runs with ``availableNow`` and returns
    the sink contents (R7)."""
    ev = events_stream(spark, sf_dir, max_files, glob)
    r = readings_from_events(ev, keep_ts=True).withColumn("ts", F.col("ts").cast("timestamp"))
    long = _long(r.withWatermark("ts", WATERMARK), keys, by, "ts")
    agg = _hourly(long, by, "ts", interval).select(
        by, "chave", F.col("w.start").cast("timestamp_ntz").alias("hora_inicio"),
        "media", "minimo", "maximo", "n")
    sink = sink or scratch_path(spark, "stats-stream")
    checkpoint = checkpoint or scratch_path(spark, "stats-stream-ckpt")
    q = (agg.writeStream.outputMode("append").format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(agg.schema).parquet(sink)
