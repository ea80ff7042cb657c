"""Raw station-year files: positional reader, by-name reader, header reader.

A raw file is 8 ``KEY:;value`` metadata lines, a ``;`` header on line 9 and
``;``-separated rows with decimal commas and ``-9999`` for missing values,
encoded in Latin-1 or UTF-8.  Files are read with the ``binaryFile`` source:
one row per file, decoded on the executors, split into lines with
``posexplode`` -- no shuffle, and a file (one station-year, ~8,760 lines) is
never split across tasks, so per-file facts (station label, header position)
are array expressions on that row rather than a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from horavento.functions.parse import (
    decode_text, normalize_header, parse_decimal, parse_obs_date, parse_obs_ts, null_sentinel,
)
from horavento.schemas import (
    HEADER_KEYS, RAW_COLUMNS, RAW_HEADER_LINES, RAW_HEADER_MARKER, RAW_MIN_FIELDS,
    RAW_STATION_LABEL,
)


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, modificationTime, length, content)`` rows, recursive."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def file_lines(files: DataFrame) -> DataFrame:
    """Files -> ``(arquivo, lines array)``: decoded text split into lines."""
    text = decode_text("content")
    return files.select(F.col("path").alias("arquivo"),
                        F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n").alias("lines"))


def _station_positions(lines, strict: bool):
    """Positions (0-based) and values of the ``ESTACAO:`` lines of one file."""
    idx = F.sequence(F.lit(0), F.size(lines) - 1)
    label = (lambda l: l) if strict else normalize_header

    def is_station(i):
        return label(F.try_element_at(lines, i + 1)).startswith(RAW_STATION_LABEL)

    def entry(i):
        parts = F.split(F.try_element_at(lines, i + 1), ";")
        return F.struct(i.alias("pos"),
                        F.when(F.size(parts) > 1, F.trim(F.try_element_at(parts, F.lit(2)))).alias("nome"))
    # a label line without a value leaves the previous station in force
    return F.filter(F.transform(F.filter(idx, is_station), entry), lambda s: s["nome"].isNotNull())


def _raw_rows(files: DataFrame, strict_label: bool) -> DataFrame:
    """Data lines after the header marker with the station in force on each line."""
    lf = file_lines(files)
    lines = F.col("lines")
    stations = _station_positions(lines, strict_label)
    # header: first non-station line whose upper-case text starts with the marker
    marks = F.transform(lines, lambda l: F.upper(l).startswith(RAW_HEADER_MARKER)
                        & ~normalize_header(l).startswith(RAW_STATION_LABEL))
    header_pos = F.array_position(marks, True) - 1  # -1 when absent
    lf = lf.select("arquivo", "lines", stations.alias("stations"), header_pos.alias("header_pos"))
    lf = lf.where(F.col("header_pos") >= 0)
    rows = lf.select("arquivo", "stations", "header_pos",
                     F.posexplode("lines").alias("linha", "texto"))
    rows = rows.where((F.col("linha") > F.col("header_pos")) & (F.trim("texto") != "")
                      & ~normalize_header("texto").startswith(RAW_STATION_LABEL))
    # the station is the last label line seen before the row (NULL when none, T3)
    seen = F.filter("stations", lambda s: s["pos"] < F.col("linha"))
    est = F.when(F.size(seen) > 0, F.try_element_at(seen, F.lit(-1))["nome"])
    return rows.select("arquivo", "linha", est.alias("estacao"),
                       F.split("texto", ";", -1).alias("campos"))


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with >= 19 fields and a valid date, and the rejects with a reason."""
    n = F.size("campos")
    date = parse_obs_date(F.try_element_at("campos", F.lit(1)))
    tagged = rows.withColumn("data", F.when(n >= RAW_MIN_FIELDS, date))
    ok = tagged.where(F.col("data").isNotNull())
    bad = tagged.where(F.col("data").isNull()).select(
        "arquivo", "linha", "estacao", F.array_join("campos", ";").alias("texto"),
        F.when(n < RAW_MIN_FIELDS, F.lit("campos_insuficientes"))
         .otherwise(F.lit("data_invalida")).alias("motivo"))
    return ok, bad


def read_station_csv(spark: SparkSession, path: str, keep_sentinel: bool = False,
                     strict_label: bool = False, with_rejects: bool = False,
                     glob: str | None = None):
    """Positional reader (S1): station from the label line, data after the
    ``DATA;HORA UTC`` header, fields 0/1/7/15/18.

    Returns ``(estacao, data, hora, temperatura, umidade, velocidade_vento,
    arquivo, linha)``; with ``with_rejects`` also the quarantined lines."""
    return parse_station_files(read_files(spark, path, glob), keep_sentinel, strict_label, with_rejects)


def parse_station_files(files: DataFrame, keep_sentinel: bool = False, strict_label: bool = False,
                        with_rejects: bool = False):
    """``read_station_csv`` over an existing ``binaryFile`` frame (batch or
    micro-batch)."""
    return measures(_raw_rows(files, strict_label), keep_sentinel, with_rejects)


def measures(rows: DataFrame, keep_sentinel: bool, with_rejects: bool):
    """Station and fields of each line -> the positional reader's columns."""
    ok, bad = split_valid(rows)

    def field(i):
        return F.try_element_at("campos", F.lit(i + 1))

    out = ok.select(
        "estacao", "data", field(RAW_COLUMNS["hora"]).alias("hora"),
        *[parse_decimal(field(RAW_COLUMNS[c]), keep_sentinel).alias(c)
          for c in ("temperatura", "umidade", "velocidade_vento")],
        "arquivo", "linha")
    return (out, bad) if with_rejects else out


def read_station_csv_named(spark: SparkSession, path: str, columns: list[str] | None = None,
                           glob: str | None = None, with_rejects: bool = False):
    """By-name reader (S2): 8 metadata lines skipped, line 9 is the header
    (names trimmed and normalised, T26), ``-9999`` / blank -> NULL.

    Output: ``arquivo, linha, ts`` plus one string column per requested name;
    rows whose timestamp does not parse are dropped (P5), as are files with
    no ``DATA`` column (their rows have no timestamp).  A name that the header
    repeats is numbered from its second use on (``X``, ``X_2``).  With
    ``with_rejects`` also the lines with more fields than the header has names,
    and the surplus text; their leading fields are in the rows."""
    lf = file_lines(read_files(spark, path, glob))
    # the header is computed before the explode, so the generator is the only
    # consumer of ``lines`` and exploded rows do not carry the whole file
    lf = header_names(lf.select("arquivo", "lines", F.try_element_at("lines", F.lit(RAW_HEADER_LINES + 1)).alias("nomes")), "nomes")
    rows = lf.select("arquivo", "header", F.posexplode("lines").alias("linha", "texto")) \
        .where((F.col("linha") > RAW_HEADER_LINES) & (F.trim("texto") != ""))
    return named_rows(rows, lf, columns, with_rejects)


def header_names(df: DataFrame, line: str) -> DataFrame:
    """``df`` with the names on the header line as array ``header``."""
    header = F.transform(F.split(F.col(line), ";", -1), lambda h: normalize_header(F.trim(h)))
    lf = df.withColumn("header", header).drop(line)
    earlier = F.transform("header", lambda h, i: F.size(F.filter(F.slice("header", F.lit(1), i), lambda g: g == h)))
    numbered = F.zip_with("header", earlier, lambda h, n: F.when(n > 0, F.concat_ws("_", h, n + 1)).otherwise(h))
    return lf.withColumn("header", numbered)


def named_rows(rows: DataFrame, headers: DataFrame, columns: list[str] | None, with_rejects: bool):
    """Lines with their file's ``header`` -> the by-name reader's columns."""
    fields = F.split("texto", ";", -1)
    # pair names and values position by position
    surplus = rows.where(F.size(fields) > F.size("header")).select(
        "arquivo", "linha", "texto", F.array_join(F.slice(fields, F.size("header") + 1, F.size(fields)), ";").alias("excedente"),
        F.lit("campos_excedentes").alias("motivo"))
    n = F.least(F.size("header"), F.size(fields))
    rec = F.map_from_arrays(F.slice("header", 1, n), F.slice(fields, 1, n))
    has_hora = F.array_contains("header", F.lit("HORA UTC"))
    rows = rows.select("arquivo", "linha", rec.alias("rec"), has_hora.alias("_has_hora"))
    if columns is None:
        # the distinct header names become the output schema
        names = headers.select(F.explode("header").alias("c")).where(F.col("c") != "").distinct().collect()
        columns = sorted(r[0] for r in names)
    columns = [normalize_header_py(c) for c in columns]
    data = null_sentinel(F.try_element_at("rec", F.lit("DATA")))
    hora = null_sentinel(F.try_element_at("rec", F.lit("HORA UTC")))
    # DATA + HORA UTC when the file has the hour column, else DATA alone
    ts = F.when(F.col("_has_hora"), parse_obs_ts(data, hora)) \
        .otherwise(F.try_to_timestamp(data, F.lit("yyyy/MM/dd")).cast("timestamp_ntz"))
    out = rows.select("arquivo", "linha", ts.alias("ts"),
                      *[null_sentinel(F.try_element_at("rec", F.lit(c))).alias(c) for c in columns])
    out = out.where(F.col("ts").isNotNull())
    return (out, surplus) if with_rejects else out


def normalize_header_py(name: str) -> str:
    """Python-side twin of ``normalize_header`` for requested column names."""
    import unicodedata
    s = unicodedata.normalize("NFKD", name.strip().upper())
    return "".join(ch for ch in s if not unicodedata.combining(ch))


def read_station_header(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Metadata lines 1-8 -> ``(arquivo, chave, valor)`` with friendly keys;
    unknown keys become ``linha_<i>`` holding ``"key: value"`` (S3)."""
    lf = file_lines(read_files(spark, path, glob))
    rows = lf.select("arquivo", F.posexplode(F.slice("lines", 1, RAW_HEADER_LINES)).alias("i", "texto")) \
        .where(F.trim("texto") != "")
    return header_pairs(rows)


def header_pairs(rows: DataFrame) -> DataFrame:
    """Metadata lines ``(arquivo, i, texto)`` -> ``(arquivo, chave, valor)``."""
    parts = F.split("texto", ";", -1)
    rows = rows.select("arquivo", (F.col("i") + 1).alias("linha"),
                       F.trim(F.try_element_at(parts, F.lit(1))).alias("k"),
                       F.trim(F.try_element_at(parts, F.lit(2))).alias("v"), F.size(parts).alias("n")) \
        .where(F.col("n") >= 2)
    key = normalize_header("k")
    friendly = None
    for needle, name in HEADER_KEYS:
        cond = key.contains(needle)
        friendly = F.when(cond, F.lit(name)) if friendly is None else friendly.when(cond, F.lit(name))
    friendly = friendly.otherwise(F.concat(F.lit("linha_"), F.col("linha").cast("string")))
    generic = F.col("chave").startswith("linha_")
    return rows.select("arquivo", friendly.alias("chave"), "k", "v") \
        .select("arquivo", "chave",
                F.when(generic, F.concat_ws(": ", "k", "v")).otherwise(F.col("v")).alias("valor"))


def header_wide(header: DataFrame) -> DataFrame:
    """Header key/values pivoted to one row per file over the fixed friendly keys."""
    keys = [name for _, name in HEADER_KEYS]
    return header.where(F.col("chave").isin(keys)).groupBy("arquivo").pivot("chave", keys) \
        .agg(F.first("valor"))


RESULTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("data", T.DateType()),
    T.StructField("hora", T.IntegerType()),
    T.StructField("temperatura", T.DoubleType()),
    T.StructField("umidade", T.DoubleType()),
    T.StructField("velocidade_vento", T.DoubleType()),
])


def read_results_csv(spark: SparkSession, path: str, schema: T.StructType = RESULTS_SCHEMA) -> DataFrame:
    """Imputed-result CSV with a header, UTF-8, explicit schema (S9); the file
    name is kept for station / model parsing."""
    return (spark.read.option("header", "true").option("encoding", "UTF-8")
            .schema(schema).csv(path)
            .withColumn("arquivo", F.col("_metadata.file_path")))
