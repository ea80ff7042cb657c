"""Registered queries over raw station files that Spark renders from the
driver tables, and the streaming jobs (S1-S5, F15, R2-R5, R7, A24-A26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from horavento.functions.telemetry import run_station
from horavento.operators import catalog as C
from horavento.plans.common import READINGS_SQL, READINGS_TS_SQL, register, rounded
from horavento.schemas import RESULT_PREFIX, TARGETS
from horavento.session import scratch_path
from horavento.sources.catalog import list_files, resolve_result_file
from horavento.sources.sinks import write_raw_station_files
from horavento.sources.split_files import read_station_csv_named_split, read_station_csv_split
from horavento.sources.station_files import (
    header_wide, read_station_csv, read_station_csv_named, read_station_header,
)
from horavento.sources.tables import load_table, readings
from horavento.streaming.ingest import (
    ingest_stream, ingest_versioned, ledger_of, read_ledger, read_table, table_of, upsert_partitions,
)
from horavento.streaming.stats import events_stream, telemetry_stats_stream
from horavento.streaming.sync import process_runs, runs_from_events, sync_once


def raw_files(spark, sf):
    """Render the readings as raw station-year files in the shared folder."""
    return write_raw_station_files(readings(spark, sf), scratch_path(spark, "raw"))


STATION_CSV_SQL = f"""WITH {READINGS_SQL}
SELECT estacao, data, lpad(CAST(hora AS VARCHAR), 2, '0') || '00 UTC' AS hora,
  temperatura, umidade, velocidade_vento FROM readings"""


@register("station_csv", STATION_CSV_SQL)
def q_station_csv(spark, sf):
    return read_station_csv(spark, raw_files(spark, sf)).drop("arquivo", "linha")


@register("station_header", f"""WITH {READINGS_SQL}, st AS (SELECT DISTINCT estacao FROM readings)
SELECT 'NE' AS regiao, 'PE' AS estado, estacao,
  'A' || CAST(300 + dense_rank() OVER (ORDER BY estacao) AS VARCHAR) AS codigo_estacao,
  '-8,05' AS latitude, '-34,95' AS longitude, '10' AS altitude, '2000-01-01' AS data_fundacao FROM st""")
def q_station_header(spark, sf):
    h = header_wide(read_station_header(spark, raw_files(spark, sf)))
    return h.drop("arquivo")


@register("station_csv_named", f"""WITH {READINGS_TS_SQL}
SELECT ts, temperatura, umidade FROM readings_ts""")
def q_station_csv_named(spark, sf):
    """By-name reader (S2) over the rendered files: DATA + HORA UTC -> ts."""
    from horavento.functions.parse import parse_decimal
    from horavento.sources.sinks import RAW_HEADER_NAMES
    t, u = RAW_HEADER_NAMES[7], RAW_HEADER_NAMES[15]
    df = read_station_csv_named(spark, raw_files(spark, sf), ["DATA", "HORA UTC", t, u])
    return df.select("ts", parse_decimal(F.col(f"`{t}`")).alias("temperatura"),
                     parse_decimal(F.col(f"`{u}`")).alias("umidade"))


@register("station_csv_split", STATION_CSV_SQL)
def q_station_csv_split(spark, sf):
    """Positional reader (S1) by lines: a file may be many tasks."""
    return read_station_csv_split(spark, raw_files(spark, sf)).drop("arquivo", "linha")


@register("station_csv_named_split", f"""WITH {READINGS_TS_SQL}
SELECT ts, temperatura, umidade FROM readings_ts""")
def q_station_csv_named_split(spark, sf):
    """By-name reader (S2) by lines."""
    from horavento.functions.parse import parse_decimal
    from horavento.sources.sinks import RAW_HEADER_NAMES
    t, u = RAW_HEADER_NAMES[7], RAW_HEADER_NAMES[15]
    df = read_station_csv_named_split(spark, raw_files(spark, sf), ["DATA", "HORA UTC", t, u])
    return df.select("ts", parse_decimal(F.col(f"`{t}`")).alias("temperatura"),
                     parse_decimal(F.col(f"`{u}`")).alias("umidade"))


RAW_NAMES_CTE = f"""{READINGS_SQL},
st AS (SELECT estacao, 'A' || CAST(300 + dense_rank() OVER (ORDER BY estacao) AS VARCHAR) AS codigo
       FROM (SELECT DISTINCT estacao FROM readings)),
names AS (SELECT 'INMET_NE_PE_' || codigo || '_' || estacao || '_01-01-2024_A_31-12-2024.CSV' AS filename,
  '2024' AS year, estacao FROM st)"""


@register("file_listing", f"WITH {RAW_NAMES_CTE}\nSELECT filename, year FROM names")
def q_file_listing(spark, sf):
    """Recursive listing of the rendered files (S5): metadata only."""
    return list_files(spark, raw_files(spark, sf)).select("filename", "year")


@register("files_for_station", f"WITH {RAW_NAMES_CTE}\nSELECT filename, year FROM names WHERE estacao = 'click'")
def q_files_for_station(spark, sf):
    """One station's raw files for the listed years."""
    from horavento.sources.catalog import files_for_station
    return files_for_station(list_files(spark, raw_files(spark, sf)), "click", [2024]).select("filename", "year")


@register("filter_csv", f"WITH {RAW_NAMES_CTE}\nSELECT filename FROM names")
def q_filter_csv(spark, sf):
    """Files whose name ends in .csv, case-insensitive, under a prefix."""
    from horavento.sources.catalog import filter_csv
    return filter_csv(list_files(spark, raw_files(spark, sf)), "INMET_", True, "filename").select("filename")


@register("sql_query", f"""WITH {READINGS_SQL}
SELECT estacao, hora, round(avg(temperatura), 6) AS temperatura FROM readings GROUP BY estacao, hora""")
def q_sql_query(spark, sf):
    """SQL over a temp view of the readings."""
    from horavento.sources.tables import query
    return query(spark, "SELECT estacao, hora, round(avg(temperatura), 6) AS temperatura "
                        "FROM leituras GROUP BY estacao, hora", {"leituras": readings(spark, sf)})


@register("table_info", f"""WITH {READINGS_SQL}, n AS (SELECT count(*) AS linhas FROM readings)
SELECT 'leituras' AS tabela, c.coluna, c.tipo, n.linhas FROM (VALUES ('id', 'bigint'), ('estacao', 'string'),
  ('data', 'date'), ('hora', 'int'), ('temperatura', 'double'), ('umidade', 'double'),
  ('velocidade_vento', 'double')) AS c(coluna, tipo) CROSS JOIN n""")
def q_table_info(spark, sf):
    """Existence, columns, types and row count of a registered table."""
    from horavento.sources.tables import table_info
    readings(spark, sf).createOrReplaceTempView("leituras")
    return table_info(spark, "leituras")


@register("ingest_stream", f"""WITH {READINGS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY estacao, data, hora ORDER BY id DESC) AS rn FROM readings)
SELECT estacao, data, lpad(CAST(hora AS VARCHAR), 2, '0') || '00 UTC' AS hora,
  temperatura, umidade, velocidade_vento FROM r WHERE rn = 1""")
def q_ingest_stream(spark, sf):
    src = raw_files(spark, sf)
    table, ledger = scratch_path(spark, "readings-table"), scratch_path(spark, "ledger")
    ingest_stream(spark, src, table, ledger, max_files=2, once=True)
    return read_table(spark, table).select("estacao", "data", "hora", *TARGETS)


VERSIONED_SQL = f"""WITH {RAW_NAMES_CTE},
k AS (SELECT *, row_number() OVER (PARTITION BY estacao, data, hora ORDER BY id DESC) AS rn FROM readings),
l AS (SELECT count(*) AS arquivos, CAST(sum(n) AS BIGINT) AS inseridos FROM names
  JOIN (SELECT estacao, count(DISTINCT (data, hora)) AS n FROM readings GROUP BY estacao) USING (estacao))
SELECT estacao, data, lpad(CAST(hora AS VARCHAR), 2, '0') || '00 UTC' AS hora, temperatura, umidade, velocidade_vento,
  l.arquivos AS arquivos_no_registro, l.inseridos AS inseridos_no_registro FROM k CROSS JOIN l WHERE rn = 1"""


@register("versioned_ingest", VERSIONED_SQL)
def q_versioned_ingest(spark, sf):
    """Rows and ledger of the last version after a stream of versioned loads."""
    src, root = raw_files(spark, sf), scratch_path(spark, "readings-versions")
    ingest_stream(spark, src, root, root, max_files=2, load=lambda batch: ingest_versioned(spark, batch, root))
    led = ledger_of(spark, root).where("status = 'sucesso'")
    return table_of(spark, root).select("estacao", "data", "hora", *TARGETS).withColumns({
        "arquivos_no_registro": led.select(F.count(F.lit(1))).scalar(),
        "inseridos_no_registro": led.select(F.sum("registros_inseridos")).scalar()})


@register("ingest_ledger", f"""WITH {RAW_NAMES_CTE}
SELECT filename AS arquivo, n AS registros_inseridos, CAST(0 AS BIGINT) AS registros_atualizados, 'sucesso' AS status
FROM names JOIN (SELECT estacao, count(DISTINCT (data, hora)) AS n FROM readings GROUP BY estacao) USING (estacao)""")
def q_ingest_ledger(spark, sf):
    """Ledger after two availableNow runs over the same files: the second run
    finds nothing pending (R5 idempotence)."""
    src = raw_files(spark, sf)
    table, ledger = scratch_path(spark, "readings-table"), scratch_path(spark, "ledger")
    ingest_stream(spark, src, table, ledger, max_files=2, once=True)
    ingest_stream(spark, src, table, ledger, max_files=2, once=True)
    return read_ledger(spark, ledger).select(
        F.regexp_extract("arquivo_s3", r"arquivo=([^/]+)/", 1).alias("arquivo"), "registros_inseridos",
        "registros_atualizados", "status")


NULL_STATION = "CASE WHEN id % 4 = 0 THEN NULL ELSE estacao END"


@register("ingest_null_station", f"""WITH {READINGS_SQL},
r AS (SELECT id, {NULL_STATION} AS estacao, data, lpad(CAST(hora AS VARCHAR), 2, '0') || '00 UTC' AS hora,
  temperatura, umidade, velocidade_vento FROM readings),
k AS (SELECT *, row_number() OVER (PARTITION BY estacao, data, hora ORDER BY id % 2 DESC, id DESC) AS rn
  FROM r WHERE estacao IS NOT NULL)
SELECT estacao, data, hora, temperatura, umidade, velocidade_vento FROM k WHERE rn = 1
UNION ALL SELECT estacao, data, hora, temperatura, umidade, velocidade_vento FROM r WHERE estacao IS NULL""")
def q_ingest_null_station(spark, sf):
    """Two loads with NULL-station rows, the second one repeated: such
    rows accumulate, and a replay adds none."""
    r = readings(spark, sf).withColumns({
        "estacao": F.expr(NULL_STATION), "hora": F.format_string("%02d00 UTC", "hora"),
        "arquivo": F.concat(F.lit("lote-"), F.col("id") % 2), "linha": F.col("id").cast("int")})
    table = scratch_path(spark, "null-station-table")
    for lot in (0, 1, 1):
        upsert_partitions(spark, r.where(F.col("id") % 2 == lot).drop("id"), table).collect()
    return read_table(spark, table).select("estacao", "data", "hora", *TARGETS)


@register("run_station", """SELECT event_id AS run_id, upper(event_type) AS estacao FROM events""")
def q_run_station(spark, sf):
    runs = runs_from_events(load_table(spark, sf, "events"))
    return runs.select("run_id", run_station("tags", "params", "run_name").alias("estacao"))


def _result_listing(spark, sf):
    """Result files for all stations but one, named as the imputation writes them."""
    st = readings(spark, sf).select(F.upper("estacao").alias("estacao")).distinct() \
        .where(F.col("estacao") != "ERROR")
    models = F.array(F.lit("Leve"), F.lit("Medio"), F.lit("Robusto"))
    return st.select("estacao", F.explode(models).alias("m")).select(
        F.concat(F.lit(f"resultados/{RESULT_PREFIX}"), "estacao", F.lit("_Modelo_"),
                 "m", F.lit(".csv")).alias("path"),
        F.lit(2048).cast("long").alias("size"))


@register("resolve_result_file", f"""WITH {READINGS_SQL}
SELECT DISTINCT upper(estacao) AS estacao, 'Medio' AS modelo,
  CASE WHEN upper(estacao) = 'ERROR' THEN NULL
       ELSE 'resultados/{RESULT_PREFIX}' || upper(estacao) || '_Modelo_Medio.csv' END AS arquivo
FROM readings""")
def q_resolve_result_file(spark, sf):
    wanted = readings(spark, sf).select(F.upper("estacao").alias("estacao")).distinct() \
        .withColumn("modelo", F.lit("Medio"))
    return resolve_result_file(_result_listing(spark, sf), wanted)


@register("results_catalog", f"""WITH {READINGS_SQL},
st AS (SELECT DISTINCT upper(estacao) AS estacao FROM readings WHERE upper(estacao) <> 'ERROR')
SELECT estacao, m.modelo, '{RESULT_PREFIX}' || estacao || '_Modelo_' || m.modelo || '.csv' AS arquivo,
  CAST(0.0 AS DOUBLE) AS tamanho_mb, m.descricao AS descricao_modelo, m.complexidade AS complexidade_modelo
FROM st CROSS JOIN (VALUES
  ('Leve', 'Modelo leve de previsão de sensação térmica', 'baixa'),
  ('Medio', 'Modelo médio de previsão de sensação térmica', 'media'),
  ('Robusto', 'Modelo robusto de previsão de sensação térmica', 'alta')) AS m(modelo, descricao, complexidade)""")
def q_results_catalog(spark, sf):
    files = _result_listing(spark, sf).withColumn("filename", F.element_at(F.split("path", "/"), -1))
    return C.results_catalog(files)


@register("catalog_summary", f"""WITH {READINGS_SQL}
SELECT count(DISTINCT upper(estacao)) FILTER (WHERE upper(estacao) <> 'ERROR') AS n_estacoes,
  CAST(3 * count(DISTINCT upper(estacao)) FILTER (WHERE upper(estacao) <> 'ERROR') AS BIGINT) AS n_arquivos,
  CAST(3 AS BIGINT) AS n_tipos_modelo,
  count(DISTINCT upper(estacao)) FILTER (WHERE upper(estacao) <> 'ERROR') AS estacoes_com_modelo
FROM readings""")
def q_catalog_summary(spark, sf):
    files = _result_listing(spark, sf).withColumn("filename", F.element_at(F.split("path", "/"), -1))
    return C.catalog_summary(C.results_catalog(files))


@register("station_load_stats", """SELECT o_orderstatus AS estacao,
  string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS anos,
  count(DISTINCT year(o_orderdate)) AS n_anos, count(*) AS n_registros
FROM orders GROUP BY o_orderstatus""")
def q_station_load_stats(spark, sf):
    o = load_table(spark, sf, "orders").select(F.col("o_orderstatus").alias("estacao"),
                                               F.year("o_orderdate").alias("ano"))
    return C.station_load_stats(o)


PROCESS_SQL = f"""WITH {READINGS_SQL},
pts AS (SELECT upper(estacao) AS estacao, count(*) AS n_pontos FROM readings GROUP BY 1),
runs AS (SELECT event_id AS run_id, 'imputacao_' || upper(event_type) || '_' || strftime(ts, '%Y%m%d') AS run_name,
  event_type AS experimento, ts AS start_time, upper(event_type) AS estacao,
  CASE WHEN user_id % 3 = 0 THEN 'Medio' END AS modelo FROM events),
res AS (SELECT r.*, r.estacao || ' - Processado' AS dispositivo,
  CASE WHEN r.estacao = 'ERROR' THEN NULL
       ELSE 'resultados/{RESULT_PREFIX}' || r.estacao || '_Modelo_' || coalesce(r.modelo, 'Leve') || '.csv'
  END AS arquivo, coalesce(p.n_pontos, 0) AS n_pontos
  FROM runs r LEFT JOIN pts p ON r.estacao = p.estacao)
SELECT *, CASE WHEN arquivo IS NULL THEN 'arquivo_nao_encontrado' WHEN n_pontos = 0 THEN 'sem_dados'
  ELSE 'sucesso' END AS status,
  (arquivo IS NOT NULL AND n_pontos > 0) AS sucesso FROM res"""


@register("process_runs", PROCESS_SQL)
def q_process_runs(spark, sf):
    """Batch run processing over the whole run log."""
    runs = runs_from_events(load_table(spark, sf, "events"))
    return process_runs(runs, _result_listing(spark, sf), readings(spark, sf))


@register("sync_once", PROCESS_SQL)
def q_sync_once(spark, sf):
    """Once-mode sync over the run log as a file stream."""
    stream = runs_from_events(events_stream(spark, sf, max_files=1))
    return sync_once(spark, stream, _result_listing(spark, sf), readings(spark, sf)).drop("batch")


@register("stats_stream", """WITH tele AS (
  SELECT event_type AS estacao, ts,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(value AS DOUBLE) END AS temperatura,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS umidade,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id % 80 AS DOUBLE) / CAST(10 AS DOUBLE) END AS velocidade_vento
  FROM events),
tlong AS (""" + "\n  UNION ALL ".join(
    f"SELECT estacao, ts, '{c}' AS chave, {c} AS valor FROM tele WHERE {c} IS NOT NULL" for c in TARGETS) + """),
wm AS (SELECT max(ts) - INTERVAL 2 HOUR AS w FROM tele)
SELECT estacao, chave, date_trunc('hour', ts) AS hora_inicio, round(avg(valor), 6) AS media,
  min(valor) AS minimo, max(valor) AS maximo, count(*) AS n
FROM tlong GROUP BY 1, 2, 3
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT w FROM wm)""")
def q_stats_stream(spark, sf):
    """Hourly statistics from the event stream with a 2-hour watermark (R7):
    windows still open at the end of the stream are not emitted in append mode."""
    return rounded(telemetry_stats_stream(spark, sf, TARGETS))
