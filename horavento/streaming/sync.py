"""Run-log synchronisation: new runs since a high-water mark, run processing,
continuous and once modes (R1-R4).

The reference keeps its per-experiment high-water mark in memory; here the
stream checkpoint (in the shared folder) is the durable mark, and the batch
form ``new_since`` takes the marks as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.functions.telemetry import run_station
from horavento.session import materialize, scratch_path
from horavento.sources.catalog import resolve_result_file

EPOCH = "1970-01-01 00:00:00"


def runs_from_events(events: DataFrame) -> DataFrame:
    """``events`` as a run log: one run per event, its type the experiment.

    The station is carried in a tag, a parameter or only the run name,
    following a rule on ``user_id``, so every lookup path of F15 is used;
    runs with the station tag also name a model type."""
    st = F.upper("event_type")
    u = F.col("user_id") % 3
    empty = F.create_map().cast("map<string,string>")
    return events.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("imputacao_"), st, F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("run_name"),
        F.col("event_type").alias("experimento"),
        F.col("ts").alias("start_time"),
        F.when(u == 0, F.create_map(F.lit("station"), st, F.lit("model_type"), F.lit("Medio")))
         .otherwise(empty).alias("tags"),
        F.when(u == 1, F.create_map(F.lit("station_name"), st)).otherwise(empty).alias("params"),
        F.create_map(F.lit("rmse"), F.col("value")).alias("metrics"))


def new_since(runs: DataFrame, marks: DataFrame, key: str = "experimento",
              ts: str = "start_time", mark: str = "marca") -> DataFrame:
    """Runs strictly newer than their experiment's mark; no mark -> all."""
    m = marks.select(key, mark)
    epoch = F.lit(EPOCH).cast(dict(runs.dtypes)[ts])
    return runs.join(m, key, "left").where(F.col(ts) > F.coalesce(F.col(mark), epoch)).drop(mark)


def next_marks(runs: DataFrame, marks: DataFrame, key: str = "experimento",
               ts: str = "start_time", mark: str = "marca") -> DataFrame:
    """New high-water mark per experiment: max of the old mark and new runs."""
    return runs.select(key, F.col(ts).alias(mark)).unionByName(marks.select(key, mark)) \
        .groupBy(key).agg(F.max(mark).alias(mark))


def process_runs(runs: DataFrame, result_files: DataFrame, readings: DataFrame) -> DataFrame:
    """Per run: station and model from the tags (station name rules as the
    fallback, F15), the device name, the result file for (station, model)
    (S8), the telemetry points, and a status whose failure reason follows the
    processing order (R4)."""
    tags = F.col("tags")
    station = F.coalesce(F.try_element_at(tags, F.lit("station_name")),
                         F.try_element_at(tags, F.lit("station")),
                         run_station("tags", "params", "run_name"))
    model = F.coalesce(F.try_element_at(tags, F.lit("model_type")), F.try_element_at(tags, F.lit("modelo")))
    r = runs.withColumns({"estacao": F.trim(F.replace(station, F.lit("_TESTE"), F.lit(""))),
                          "modelo": model})
    r = r.withColumn("dispositivo", F.concat(F.replace("estacao", F.lit("_"), F.lit(" ")),
                                             F.lit(" - Processado")))
    wanted = r.select("estacao", "modelo").where(F.col("estacao").isNotNull()).distinct()
    # both lookups hold one row per station (and model) and are written once
    found = materialize(resolve_result_file(result_files, wanted).select(
        F.col("estacao").alias("_e"), F.col("modelo").alias("_m"), "arquivo"), "runs-files")
    # only the stations of these runs are counted
    counted = readings.select(F.upper("estacao").alias("_p")).join(
        wanted.select(F.col("estacao").alias("_p")).distinct(), "_p", "left_semi")
    points = materialize(counted.groupBy("_p").agg(F.count(F.lit(1)).alias("n_pontos")), "runs-points")
    out = r.join(found, F.col("estacao").eqNullSafe(F.col("_e")) & F.col("modelo").eqNullSafe(F.col("_m")),
                 "left") \
        .join(points, F.col("estacao") == F.col("_p"), "left")
    n = F.coalesce("n_pontos", F.lit(0)).cast("long")
    status = (F.when(F.col("estacao").isNull(), "sem_estacao")
              .when(F.col("arquivo").isNull(), "arquivo_nao_encontrado")
              .when(n == 0, "sem_dados")
              .otherwise("sucesso"))
    return out.select("run_id", "run_name", "experimento", "start_time", "estacao", "modelo", "dispositivo",
                      "arquivo", n.alias("n_pontos"), status.alias("status"),
                      (status == "sucesso").alias("sucesso"))


def run_sync(stream: DataFrame, fn, checkpoint: str, interval: str = "60 seconds", once: bool = False):
    """Continuous (processing-time trigger) or once (availableNow) loop over a
    run stream; ``fn(batch_df, batch_id)`` handles each micro-batch (R2, R3)."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)
    q = w.start()
    if once:
        q.awaitTermination()
    return q


def sync_once(spark: SparkSession, runs_stream: DataFrame, result_files: DataFrame,
              readings: DataFrame, sink: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process every run available now and return the status rows.

    Each micro-batch writes to its own ``batch=<id>`` directory with
    overwrite, so a replayed batch replaces its own output (exactly once)."""
    sink = sink or scratch_path(spark, "sync-out")
    checkpoint = checkpoint or scratch_path(spark, "sync-ckpt")

    def handle(batch: DataFrame, batch_id: int):
        process_runs(batch, result_files, readings).write.mode("overwrite") \
            .parquet(f"{sink}/batch={batch_id}")
    run_sync(runs_stream, handle, checkpoint, once=True)
    return spark.read.parquet(sink)
