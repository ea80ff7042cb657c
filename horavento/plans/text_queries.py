"""Registered queries: text parsers over strings derived from the events,
file-catalog aggregates over ``pages`` and the run high-water mark."""

from __future__ import annotations

from pyspark.sql import functions as F

from horavento.functions.parse import parse_decimal, parse_obs_ts, parse_raw_name, parse_result_name
from horavento.functions.telemetry import json_field
from horavento.operators import catalog as C
from horavento.plans.common import register, rounded
from horavento.schemas import RESULT_PREFIX
from horavento.sources.tables import load_table
from horavento.streaming.sync import new_since, runs_from_events

# Derived text: a decimal-comma rendering of ``value`` with junk, blanks and
# the -9999 sentinel mixed in by a rule on ``user_id``.
DEC_TEXT_SQL = """CASE WHEN user_id % 50 = 0 THEN 'abc' WHEN user_id % 50 = 1 THEN ''
  WHEN user_id % 50 = 2 THEN '-9999' ELSE replace(printf('%.2f', value), '.', ',') END"""


def _dec_text():
    m = F.col("user_id") % 50
    return (F.when(m == 0, "abc").when(m == 1, "").when(m == 2, "-9999")
            .otherwise(F.replace(F.format_string("%.2f", "value"), F.lit("."), F.lit(","))))


@register("parse_decimal", f"""WITH t AS (SELECT event_id AS id, {DEC_TEXT_SQL} AS texto FROM events)
SELECT id, texto,
  CASE WHEN trim(texto) IN ('', '-9999') THEN NULL ELSE TRY_CAST(replace(trim(texto), ',', '.') AS DOUBLE) END AS valor,
  CASE WHEN trim(texto) = '' THEN NULL ELSE TRY_CAST(replace(trim(texto), ',', '.') AS DOUBLE) END AS valor_bruto
FROM t""")
def q_parse_decimal(spark, sf):
    t = load_table(spark, sf, "events").select(F.col("event_id").alias("id"), _dec_text().alias("texto"))
    return t.select("id", "texto", parse_decimal("texto").alias("valor"),
                    parse_decimal(F.nullif(F.trim("texto"), F.lit("")), keep_sentinel=True).alias("valor_bruto"))


@register("parse_obs_ts", """WITH t AS (SELECT event_id AS id,
  CASE WHEN user_id % 50 = 3 THEN '2024/13/01' ELSE strftime(ts, '%Y/%m/%d') END AS data_txt,
  strftime(ts, '%H%M') || ' UTC' AS hora_txt FROM events)
SELECT id, data_txt, hora_txt, try_strptime(data_txt || ' ' || substr(hora_txt, 1, 4), '%Y/%m/%d %H%M') AS ts_obs
FROM t""")
def q_parse_obs_ts(spark, sf):
    e = load_table(spark, sf, "events")
    t = e.select(F.col("event_id").alias("id"),
                 F.when(F.col("user_id") % 50 == 3, F.lit("2024/13/01"))
                 .otherwise(F.date_format("ts", "yyyy/MM/dd")).alias("data_txt"),
                 F.concat(F.date_format("ts", "HHmm"), F.lit(" UTC")).alias("hora_txt"))
    return t.withColumn("ts_obs", parse_obs_ts("data_txt", "hora_txt"))


RESULT_NAME_SQL = f"""'{RESULT_PREFIX}' || upper(event_type)
  || CASE WHEN user_id % 4 = 0 THEN '_VERDE' ELSE '' END
  || CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN '_Modelo_Leve' ELSE '_Modelo_Robusto' END || '.csv'"""
RESULT_RE = "^" + RESULT_PREFIX + r"(.+?)(?:_Modelo_([^.]+))?\.csv$"


def _result_name():
    u = F.col("user_id")
    return F.concat(F.lit(RESULT_PREFIX), F.upper("event_type"),
                    F.when(u % 4 == 0, F.lit("_VERDE")).otherwise(F.lit("")),
                    F.when(u % 3 == 0, F.lit("")).when(u % 3 == 1, F.lit("_Modelo_Leve"))
                    .otherwise(F.lit("_Modelo_Robusto")), F.lit(".csv"))


@register("parse_result_name", f"""WITH t AS (SELECT event_id AS id, {RESULT_NAME_SQL} AS nome FROM events)
SELECT id, nome, nullif(regexp_extract(nome, '{RESULT_RE}', 1), '') AS estacao,
  nullif(regexp_extract(nome, '{RESULT_RE}', 2), '') AS modelo FROM t""")
def q_parse_result_name(spark, sf):
    t = load_table(spark, sf, "events").select(F.col("event_id").alias("id"), _result_name().alias("nome"))
    p = parse_result_name("nome")
    return t.select("id", "nome", p["estacao"].alias("estacao"), p["modelo"].alias("modelo"))


RAW_NAME_SQL = """'INMET_NE_PE_A' || CAST(300 + user_id % 100 AS VARCHAR) || '_' || upper(event_type)
  || CASE WHEN user_id % 4 = 0 THEN ' VERDE' ELSE '' END
  || '_01-01-' || CAST(2020 + user_id % 5 AS VARCHAR) || '_A_31-12-' || CAST(2020 + user_id % 5 AS VARCHAR) || '.CSV'"""
RAW_RE = r"_(A\d{3})_(.+?)_\d{2}-\d{2}-(\d{4})_A_"


def _raw_name():
    u = F.col("user_id")
    year = (F.lit(2020) + u % 5).cast("string")
    return F.concat(F.lit("INMET_NE_PE_A"), (F.lit(300) + u % 100).cast("string"), F.lit("_"),
                    F.upper("event_type"), F.when(u % 4 == 0, F.lit(" VERDE")).otherwise(F.lit("")),
                    F.lit("_01-01-"), year, F.lit("_A_31-12-"), year, F.lit(".CSV"))


@register("parse_raw_name", f"""WITH t AS (SELECT event_id AS id, {RAW_NAME_SQL} AS nome FROM events)
SELECT id, nome, nullif(regexp_extract(nome, '{RAW_RE}', 1), '') AS codigo,
  nullif(regexp_extract(nome, '{RAW_RE}', 2), '') AS cidade,
  TRY_CAST(nullif(regexp_extract(nome, '{RAW_RE}', 3), '') AS INTEGER) AS ano FROM t""")
def q_parse_raw_name(spark, sf):
    t = load_table(spark, sf, "events").select(F.col("event_id").alias("id"), _raw_name().alias("nome"))
    p = parse_raw_name("nome")
    return t.select("id", "nome", p["codigo"].alias("codigo"), p["cidade"].alias("cidade"), p["ano"].alias("ano"))


@register("json_field", """SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""")
def q_json_field(spark, sf):
    e = load_table(spark, sf, "events")
    return e.select(F.col("event_id").alias("id"), json_field("props", "$.k", "double").alias("k"))


# ``pages`` as a file listing: the URL is the path, the HTML byte length the
# size, the first path segment the directory, the host the station.
PAGES_SQL = """files AS (SELECT url AS path, CAST(strlen(html) AS BIGINT) AS size,
  regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS diretorio,
  regexp_extract(url, '^https?://([^/]+)', 1) AS host,
  CASE WHEN html LIKE '%</html>%' THEN 'sucesso' ELSE 'erro' END AS status FROM pages)"""


def _pages_files(spark, sf):
    p = load_table(spark, sf, "pages")
    return p.select(F.col("url").alias("path"), F.octet_length("html").cast("long").alias("size"),
                    F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1).alias("diretorio"),
                    F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"),
                    F.when(F.col("html").contains("</html>"), "sucesso").otherwise("erro").alias("status"))


@register("operation_summary", f"""WITH {PAGES_SQL}
SELECT count(*) AS total, CAST(count_if(status = 'sucesso') AS BIGINT) AS sucesso,
  CAST(count_if(status <> 'sucesso') AS BIGINT) AS falhas,
  round(CAST(count_if(status = 'sucesso') AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 6) AS taxa_sucesso,
  round(CAST(sum(size) AS DOUBLE) / 1048576.0, 6) AS total_mb FROM files""")
def q_operation_summary(spark, sf):
    return rounded(C.operation_summary(_pages_files(spark, sf)))


@register("inventory", f"""WITH {PAGES_SQL}
SELECT diretorio, count(*) AS n_arquivos, CAST(sum(size) AS BIGINT) AS bytes_total FROM files GROUP BY diretorio""")
def q_inventory(spark, sf):
    return C.inventory(_pages_files(spark, sf), "diretorio")


@register("files_by_station", f"""WITH {PAGES_SQL}
SELECT host, count(*) AS n_arquivos, CAST(sum(size) AS BIGINT) AS bytes_total, min(path) AS primeiro,
  max(path) AS ultimo FROM files GROUP BY host""")
def q_files_by_station(spark, sf):
    return C.files_by_key(_pages_files(spark, sf), "host")


@register("new_since", """WITH marks AS (SELECT event_type AS experimento, max(ts) AS marca FROM events
  WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY event_type)
SELECT e.event_id AS run_id, e.event_type AS experimento, e.ts AS start_time
FROM events e LEFT JOIN marks m ON e.event_type = m.experimento
WHERE e.ts > coalesce(m.marca, TIMESTAMP '1970-01-01 00:00:00')""")
def q_new_since(spark, sf):
    runs = runs_from_events(load_table(spark, sf, "events"))
    marks = runs.where(F.col("start_time") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")) \
        .groupBy("experimento").agg(F.max("start_time").alias("marca"))
    return new_since(runs, marks).select("run_id", "experimento", "start_time")
