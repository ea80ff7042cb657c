"""Raw station files read by lines, where one file may be many tasks.

``station_files`` takes a file as one row.  Here the text source splits files
by ``spark.sql.files.maxPartitionBytes``, and what a line needs to know of the
lines before it comes from one small state per block of a file:

- whether all its lines are UTF-8 (a file is Latin-1 as a whole as soon as one
  line is not UTF-8; line ends are ASCII, so no character spans two lines);
- its number of lines, which numbers the lines of the blocks behind it;
- its first header line and its last station line.

One partial aggregate gathers the states, a window over them (a row per block)
carries encoding, line number, header and station over the block borders, and
the lines join their block's row.  Lines are shuffled only in blocks that have
a station line behind the header; there a window of one block finds the station
in force.  The files must not change between the two scans.

Results equal those of ``station_files`` but for ``arquivo``, which is the URI
of the file, and a byte order mark, which the text source drops.  An empty
folder or file gives no rows; a file without header gives no readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from horavento.functions.parse import normalize_header
from horavento.schemas import RAW_HEADER_LINES, RAW_HEADER_MARKER, RAW_STATION_LABEL
from horavento.session import materialize
from horavento.sources.station_files import header_names, header_pairs, measures, named_rows

BLOCK = ["arquivo", "bloco"]


def raw_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``arquivo, bloco, ordem, bytes``: every line with the start of its
    block; ``ordem`` counts up by one from line to line of a block."""
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.text(path).select(
        F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("bloco"),
        F.monotonically_increasing_id().alias("ordem"), F.col("value").cast("binary").alias("bytes"))


def _utf8(raw: Column) -> Column:
    """Text of a line of UTF-8, else NULL."""
    return F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8"))


def _is_station(text: Column, strict: bool) -> Column:
    return (text if strict else normalize_header(text)).startswith(RAW_STATION_LABEL)


def _station(text: Column, strict: bool) -> Column:
    """Name on a station line; NULL on other lines and where it has none."""
    parts = F.split(text, ";")
    return F.when(_is_station(text, strict) & (F.size(parts) > 1), F.trim(F.try_element_at(parts, F.lit(2))))


def block_states(lines: DataFrame, strict_label: bool = False) -> DataFrame:
    """A row per block: ``primeira`` (its first ``ordem``), ``antes`` (lines of
    the file before it), ``utf8``, ``cabecalho`` (line number of the file's
    header), ``estacao`` (in force at its first line, or from its own station
    lines where all of them precede the header) and ``tardia`` (station lines
    behind the header).  Written once."""
    raw = F.col("bytes")
    aggs = [F.min("ordem").alias("primeira"), F.count(F.lit(1)).alias("n"),
            F.min(F.is_valid_utf8(raw.cast("string"))).alias("ok")]
    # both readings of a block, as its encoding is known with the whole file only
    for code, text in (("u", _utf8(raw)), ("l", F.decode(raw, "ISO-8859-1"))):
        name = _station(text, strict_label)
        mark = F.upper(text).startswith(RAW_HEADER_MARKER) & ~normalize_header(text).startswith(RAW_STATION_LABEL)
        aggs += [F.min(F.when(mark, F.col("ordem"))).alias(f"h{code}"),
                 F.max(F.when(name.isNotNull(), F.struct("ordem", name.alias("nome")))).alias(f"s{code}")]
    states = materialize(lines.groupBy(*BLOCK).agg(*aggs), "line-blocks")
    whole = Window.partitionBy("arquivo")
    before = whole.orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    pick = lambda c: F.when(F.col("utf8"), F.col(f"{c}u")).otherwise(F.col(f"{c}l"))
    s = states.withColumns({"utf8": F.min("ok").over(whole), "antes": F.coalesce(F.sum("n").over(before), F.lit(0))})
    s = s.withColumns({"h": pick("h"), "s": pick("s")})
    s = s.withColumns({
        "cabecalho": F.min(F.col("antes") + F.col("h") - F.col("primeira")).over(whole),
        "herdada": F.last("s.nome", ignorenulls=True).over(before),
        "ultima": F.col("antes") + F.col("s.ordem") - F.col("primeira")})
    late = F.coalesce(F.col("ultima") > F.col("cabecalho"), F.lit(False))
    return materialize(s.select(
        *BLOCK, "primeira", "antes", "utf8", "cabecalho", late.alias("tardia"),
        F.when(late, F.col("herdada")).otherwise(F.coalesce("s.nome", "herdada")).alias("estacao")), "line-states")


def numbered_lines(lines: DataFrame, states: DataFrame) -> DataFrame:
    """The lines with their block's state, ``linha`` (from 0) and ``texto``."""
    both = lines.join(states, BLOCK)
    return both.withColumns({
        "linha": (F.col("antes") + F.col("ordem") - F.col("primeira")).cast("int"),
        "texto": F.when(F.col("utf8"), _utf8(F.col("bytes"))).otherwise(F.decode("bytes", "ISO-8859-1"))}).drop("bytes")


def read_station_csv_split(spark: SparkSession, path: str, keep_sentinel: bool = False, strict_label: bool = False,
                           with_rejects: bool = False, glob: str | None = None):
    """``read_station_csv`` (S1) with files split over tasks."""
    lines = raw_lines(spark, path, glob)
    states = block_states(lines, strict_label)
    known = states.where("cabecalho IS NOT NULL")
    rows = numbered_lines(lines, known.where("NOT tardia"))
    if not known.where("tardia").isEmpty():
        late = numbered_lines(lines, known.where("tardia"))
        so_far = Window.partitionBy(*BLOCK).orderBy("ordem").rowsBetween(Window.unboundedPreceding, 0)
        seen = F.last(_station(F.col("texto"), strict_label), ignorenulls=True).over(so_far)
        rows = rows.unionByName(late.withColumn("estacao", F.coalesce(seen, "estacao")))
    rows = rows.where((F.col("linha") > F.col("cabecalho")) & (F.trim("texto") != "") & ~_is_station(F.col("texto"), False))
    return measures(rows.select("arquivo", "linha", "estacao", F.split("texto", ";", -1).alias("campos")),
                    keep_sentinel, with_rejects)


def _head(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Metadata lines and the header line of every file."""
    first = states.where(F.col("antes") <= RAW_HEADER_LINES)
    return numbered_lines(lines, first).where(F.col("linha") <= RAW_HEADER_LINES).select("arquivo", "linha", "texto")


def read_station_csv_named_split(spark: SparkSession, path: str, columns: list[str] | None = None,
                                 glob: str | None = None, with_rejects: bool = False):
    """``read_station_csv_named`` (S2) with files split over tasks."""
    lines = raw_lines(spark, path, glob)
    states = block_states(lines)
    head = _head(lines, states).where(F.col("linha") == RAW_HEADER_LINES)
    head = materialize(header_names(head.select("arquivo", F.col("texto").alias("linha_nomes")), "linha_nomes"), "line-headers")
    rows = numbered_lines(lines, states).where((F.col("linha") > RAW_HEADER_LINES) & (F.trim("texto") != ""))
    return named_rows(rows.select("arquivo", "linha", "texto").join(head, "arquivo"), head, columns, with_rejects)


def read_station_header_split(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``read_station_header`` (S3) with files split over tasks."""
    lines = raw_lines(spark, path, glob)
    rows = _head(lines, block_states(lines)).where((F.col("linha") < RAW_HEADER_LINES) & (F.trim("texto") != ""))
    return header_pairs(rows.withColumnRenamed("linha", "i"))
