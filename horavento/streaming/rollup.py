"""Hourly rollup kept up by a stream and merged upwards to any interval.

A state is sum, count, minimum and maximum per station, key and hour; states of
the same hour merge, so rows may come late and in any order.  Every micro-batch
writes the states of its own rows to ``fluxo=<stream>/lote=<batch>``; a replayed
batch overwrites its folder, so it counts once.  Series of hours, days or weeks
read the states alone, never the rows.

NULL values have no state, a NULL timestamp belongs to no hour.  Without any
batch the rollup is an empty, typed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.functions.telemetry import to_long
from horavento.session import path_exists

STATE = "chave string, hora timestamp_ntz, soma double, n bigint, minimo double, maximo double"


def hour_states(df: DataFrame, keys: list[str], by: str = "estacao", ts: str = "ts") -> DataFrame:
    """``by, chave, hora, soma, n, minimo, maximo`` of the rows (partial aggregate)."""
    long = to_long(df, [by, ts], keys).where(F.col("valor").isNotNull() & F.col(ts).isNotNull())
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias("hora")
    return long.groupBy(by, "chave", hour).agg(
        F.sum("valor").alias("soma"), F.count(F.lit(1)).alias("n"),
        F.min("valor").alias("minimo"), F.max("valor").alias("maximo"))


def series(states: DataFrame, interval: str = "1 hour", a=None, b=None, by: str = "estacao") -> DataFrame:
    """States -> ``by, chave, inicio, media, minimo, maximo, n`` per interval,
    over the hours in ``[a, b)``.  ``interval`` is a whole number of hours or
    longer; weeks start on the weekday of 1970-01-01 as all windows do."""
    if a is not None:
        states = states.where(F.col("hora") >= F.lit(a).cast("timestamp_ntz"))
    if b is not None:
        states = states.where(F.col("hora") < F.lit(b).cast("timestamp_ntz"))
    g = states.groupBy(by, "chave", F.window("hora", interval).alias("w")).agg(
        F.sum("soma").alias("soma"), F.sum("n").alias("n"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"))
    return g.select(by, "chave", F.col("w.start").cast("timestamp_ntz").alias("inicio"),
                    (F.col("soma") / F.col("n")).alias("media"), "minimo", "maximo", "n")


def write_batch(rows: DataFrame, batch: int, root: str, keys: list[str], stream: str = "leituras",
                by: str = "estacao", ts: str = "ts") -> None:
    """The states of one micro-batch; the same batch again replaces them."""
    hour_states(rows, keys, by, ts).write.mode("overwrite").parquet(f"{root}/fluxo={stream}/lote={batch}")


def read_rollup(spark: SparkSession, root: str, by: str = "estacao") -> DataFrame:
    """All states, one row per station, key, hour and batch."""
    schema = f"{by} string, {STATE}"
    if not path_exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, fluxo string, lote bigint").parquet(root).drop("fluxo", "lote")


def rollup_stream(rows: DataFrame, root: str, checkpoint: str, keys: list[str], stream: str = "leituras",
                  by: str = "estacao", ts: str = "ts", once: bool = True):
    """Keep the rollup up with a stream of readings; with ``once`` all that is
    there is taken in and the query ends, else the running query is returned.
    One checkpoint goes with one ``stream`` name, as batch numbers start anew
    with a new checkpoint."""
    w = (rows.writeStream.foreachBatch(lambda df, i: write_batch(df, i, root, keys, stream, by, ts))
         .option("checkpointLocation", checkpoint))
    if not once:
        return w.start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
