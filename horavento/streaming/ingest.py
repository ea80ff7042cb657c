"""Incremental ingest of raw station files and periodic export.

Each micro-batch of new files is parsed on the executors, deduplicated (last
line wins), and upserted into the readings table, which is stored
partitioned by ``(ano, estacao)``: only the partitions the batch touches are
read (a null-safe semi join on the partition columns) and rewritten (dynamic
partition overwrite), via a staging copy in the shared folder so a plan never
overwrites its own input.  Rows with a NULL key part never match a stored row;
they are kept once per (arquivo, linha), so replaying a batch replaces them
instead of adding them again.  A file that cannot be read, or yields no row,
is recorded as ``erro`` and the others go on.  The ledger is appended, one row
per file and load; the latest row of a file is its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from horavento.functions.parse import decode_text
from horavento.operators.merge import merge_readings
from horavento.operators.windows import latest_per_key
from horavento.schemas import RAW_HEADER_MARKER, READING_KEY
from horavento.session import materialize, path_exists, scratch_path
from horavento.sources import versioned
from horavento.sources.station_files import parse_station_files
from horavento.sources.sinks import export_snapshot

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
TABLE_PARTITIONS = ["ano", "estacao"]
TABLE_SCHEMA = ("data date, hora string, temperatura double, umidade double, velocidade_vento double, "
                "created_at timestamp, updated_at timestamp, arquivo string, linha int, ano int, estacao string")
LEDGER_SCHEMA = ("arquivo_s3 string, data_processamento timestamp, registros_inseridos long, "
                 "registros_atualizados long, status string")
LEDGER_COLUMNS = ["arquivo_s3", "data_processamento", "registros_inseridos",
                  "registros_atualizados", "status"]


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The stored readings; the schema keeps station names strings whatever
    they look like."""
    return spark.read.schema(TABLE_SCHEMA).parquet(table) if path_exists(spark, table) else None


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The latest row of every file."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    return latest_per_key(rows, ["arquivo_s3"], ["data_processamento", "status"]).select(*LEDGER_COLUMNS)


def upsert_partitions(spark: SparkSession, incoming: DataFrame, table: str, now=None) -> DataFrame:
    """Merge parsed rows into the partitioned table; returns per-file counts."""
    rows, counts = _merged(spark, incoming, read_table(spark, table), now)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*TABLE_PARTITIONS).parquet(table))
    return counts


def _merged(spark: SparkSession, incoming: DataFrame, current: DataFrame | None, now=None) -> tuple[DataFrame, DataFrame]:
    """The partitions that ``incoming`` touches as they are afterwards, and
    the per-file counts; both read one written copy."""
    incoming = incoming.withColumn("ano", F.year("data"))
    if current is None:
        current = spark.createDataFrame([], TABLE_SCHEMA)
    else:
        touched = incoming.select(*[F.col(c).alias(f"_{c}") for c in TABLE_PARTITIONS]).distinct()
        current = current.join(touched, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TABLE_PARTITIONS], "left_semi")
    # rows without a whole key are known by their place in their file
    keyless = F.lit(False)
    for k in READING_KEY:
        keyless = keyless | F.col(k).isNull()
    placed = incoming.where(keyless).select(F.col("arquivo").alias("_a"), F.col("linha").alias("_l")).distinct()
    again = keyless & F.col("arquivo").eqNullSafe(F.col("_a")) & F.col("linha").eqNullSafe(F.col("_l"))
    current = current.join(placed, again, "left_anti")
    kept = current.where(keyless).withColumn("acao", F.lit("mantido"))
    merged = merge_readings(current.where(~keyless), incoming, order=["arquivo", "linha"], now=now,
                            carry=["arquivo", "linha"]).withColumn("ano", F.year("data"))
    # a stored row keeps no file of its own: it counts for the file that changed it
    source = F.col("acao") != "mantido"
    merged = merged.withColumns({c: F.when(source, F.col(c)) for c in ("arquivo", "linha")})
    merged = merged.withColumn("_novo", source).unionByName(kept.withColumn("_novo", F.lit(False)), allowMissingColumns=True)
    stage = scratch_path(spark, "ingest-stage")
    merged.write.mode("errorifexists").parquet(stage)
    staged = spark.read.schema(merged.schema).parquet(stage)
    rows = staged.withColumns({c: F.when(keyless, F.col(c)) for c in ("arquivo", "linha")})
    # dealt by ranges of the whole key, so a station-year of any size is many tasks
    rows = rows.drop("acao", "_novo").repartitionByRange(*TABLE_PARTITIONS, "data", "hora", "linha")
    return rows, staged.where("_novo AND arquivo IS NOT NULL").groupBy("arquivo").agg(
        F.count_if(F.col("acao") == "inserido").alias("registros_inseridos"),
        F.count_if(F.col("acao") == "atualizado").alias("registros_atualizados"))


def ingest_files(spark: SparkSession, files: DataFrame, table: str, ledger: str, now=None) -> None:
    """One batch: skip files already loaded, parse, upsert, record.

    A file without content or without the header line is recorded as ``erro``;
    the rest of the batch is loaded."""
    led = read_ledger(spark, ledger)
    done = led.where(F.col("status") == "sucesso").select(F.col("arquivo_s3").alias("path"))
    pending = files.join(done, "path", "left_anti")
    rows = materialize(parse_station_files(pending), "ingest-rows")
    counts = upsert_partitions(spark, rows, table, now)
    _ledger_rows(pending, counts, now).write.mode("append").parquet(ledger)


def ingest_versioned(spark: SparkSession, files: DataFrame, root: str, now=None) -> versioned.Version:
    """One batch like ``ingest_files``, its rows and ledger rows committed as
    one version of ``root``: a failure in between leaves the version before."""
    base = versioned.version(spark, root)
    led = ledger_of(spark, root, base)
    done = led.where(F.col("status") == "sucesso").select(F.col("arquivo_s3").alias("path"))
    pending = files.join(done, "path", "left_anti")
    if pending.isEmpty():
        return base
    parsed = materialize(parse_station_files(pending), "ingest-rows")
    rows, counts = _merged(spark, parsed, versioned.read_data(spark, root, TABLE_SCHEMA, base), now)
    return versioned.commit(spark, root, base, rows, _ledger_rows(pending, counts, now), TABLE_PARTITIONS)


def table_of(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The readings of a version of ``root``, the latest by default."""
    return versioned.read_data(spark, root, TABLE_SCHEMA, versioned.version(spark, root, number))


def ledger_of(spark: SparkSession, root: str, v: versioned.Version | None = None) -> DataFrame:
    """The latest ledger row of every file in a version."""
    rows = versioned.read_loads(spark, root, LEDGER_SCHEMA, v or versioned.version(spark, root))
    return latest_per_key(rows, ["arquivo_s3"], ["data_processamento", "status"]).select(*LEDGER_COLUMNS)


def _ledger_rows(pending: DataFrame, counts: DataFrame, now=None) -> DataFrame:
    """A ledger row for every file of a batch."""
    readable = F.coalesce(F.upper(decode_text("content")).contains(RAW_HEADER_MARKER), F.lit(False))
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    new = pending.select(F.col("path").alias("arquivo"), readable.alias("_ok")).join(counts, "arquivo", "left").select(
        F.col("arquivo").alias("arquivo_s3"), ts.alias("data_processamento"),
        F.coalesce("registros_inseridos", F.lit(0)).cast("long").alias("registros_inseridos"),
        F.coalesce("registros_atualizados", F.lit(0)).cast("long").alias("registros_atualizados"),
        F.when(F.col("_ok"), "sucesso").otherwise("erro").alias("status"))
    return new.select(*LEDGER_COLUMNS)


def ingest_stream(spark: SparkSession, src: str, table: str, ledger: str,
                  checkpoint: str | None = None, max_files: int = 64,
                  glob: str | None = None, once: bool = True, interval: str = "60 seconds",
                  load=None):
    """Streaming ingest of new raw files (R5): ``binaryFile`` stream +
    ``foreachBatch``; with ``once`` it drains what is there (availableNow).
    ``load(batch)`` stands in for ``ingest_files``, such as a versioned load."""
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
         .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files))
    if glob:
        r = r.option("pathGlobFilter", glob)
    stream = r.load(src)
    checkpoint = checkpoint or scratch_path(spark, "ingest-ckpt")
    w = stream.writeStream.foreachBatch(
        lambda batch, _id: load(batch) if load else ingest_files(spark, batch, table, ledger)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)
    q = w.start()
    if once:
        q.awaitTermination()
    return q


def export_stream(spark: SparkSession, table: str, out: str, interval: str = "3600 seconds",
                  checkpoint: str | None = None, once: bool = False):
    """Periodic snapshot export of the readings table (R6): a rate-driven
    trigger whose micro-batch writes one ordered, timestamped snapshot."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    checkpoint = checkpoint or scratch_path(spark, "export-ckpt")

    def snap(_batch, batch_id):
        df = read_table(spark, table)
        if df is not None:
            export_snapshot(df, out, f"{batch_id:08d}")
    w = ticks.writeStream.foreachBatch(snap).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)
    return w.start()
