"""File listings and lookups over them.

A listing is a DataFrame ``(path, size)``; it comes from the ``binaryFile``
source with ``content`` pruned (only metadata is read) or from any table
holding file paths.  All operators here are column expressions, filters,
equi-joins and rankings -- nothing walks a list on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from horavento.functions.parse import parse_result_name


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Recursive listing: path, relative path, year directory, name, size;
    names starting with ``.`` are skipped (S5, T17)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root).select("path", F.col("length").alias("size"))  # content pruned
    return describe_paths(df, root)


def describe_paths(df: DataFrame, root: str | None = None, path: str = "path") -> DataFrame:
    """Add ``relative_path``, ``year`` (first directory, text) and ``filename``."""
    p = F.col(path)
    rel = p
    if root:
        rel = F.regexp_replace(p, "^.*?" + _escape(root.rstrip("/")) + "/", "")
    parts = F.split(rel, "/")
    # year: the first directory under the root (``ano=`` of a partition
    # directory stripped); NULL for files at the root
    year = F.when(F.size(parts) >= 2, F.regexp_replace(F.try_element_at(parts, F.lit(1)), "^ano=", ""))
    # a partition directory arquivo=<name> names the file written inside it
    name = F.coalesce(F.nullif(F.regexp_extract(rel, r"arquivo=([^/]+)/", 1), F.lit("")),
                      F.try_element_at(parts, F.lit(-1)))
    return df.withColumns({"relative_path": rel, "year": year, "filename": name}) \
        .where(~F.col("filename").startswith("."))


def _escape(s: str) -> str:
    import re
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", s.replace("file:", ""))


def files_for_station(files: DataFrame, estacao: str, anos: list[int] | None = None) -> DataFrame:
    """Raw CSVs of one station across years: name holds the station with
    ``_`` read as a space (S6, P7)."""
    wanted = estacao.replace("_", " ").upper()
    df = files.where(F.upper("filename").contains(wanted) & F.upper("filename").endswith(".CSV"))
    if anos:
        df = df.where(F.col("year").isin([str(a) for a in anos]))
    return df


def filter_csv(files: DataFrame, prefix: str = "", ignore_case: bool = True,
               path: str = "path") -> DataFrame:
    """Files under a prefix ending in ``.csv``."""
    p = F.col(path)
    if ignore_case:
        return files.where(F.lower(p).startswith(prefix.lower()) & F.lower(p).endswith(".csv"))
    return files.where(p.startswith(prefix) & p.endswith(".csv"))


def resolve_result_file(files: DataFrame, wanted: DataFrame, path: str = "path") -> DataFrame:
    """Result CSV for each wanted ``(estacao, modelo)``.

    Files are matched by the station parsed from their name, first with the
    underscore spelling, else the spaced one; among matches a name holding
    the model wins, else the first path.  One equi-join on the normalised
    station, then one ranking per wanted row."""
    parsed = files.where(F.lower(F.col(path)).endswith(".csv")).select(
        F.col(path).alias("arquivo"), parse_result_name(path).alias("p"))
    parsed = parsed.select("arquivo", F.col("p.estacao").alias("f_est"))
    parsed = parsed.withColumn("f_key", F.upper(F.regexp_replace("f_est", " ", "_")))
    w = wanted.select("estacao", "modelo").withColumn(
        "f_key", F.upper(F.regexp_replace("estacao", " ", "_")))
    m = w.join(parsed, "f_key", "left")
    spelling = F.when(F.col("f_est") == F.regexp_replace("estacao", " ", "_"), 0).otherwise(1)
    model_hit = F.when(F.col("modelo").isNotNull() & F.col("arquivo").contains(F.col("modelo")), 0) \
        .otherwise(1)
    win = Window.partitionBy("estacao", "modelo").orderBy(spelling, model_hit, "arquivo")
    return m.withColumn("_r", F.row_number().over(win)).where(F.col("_r") == 1) \
        .select("estacao", "modelo", "arquivo")
