"""Registered queries: ordered operators, merges, the load ledger and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from horavento.functions.telemetry import to_long
from horavento.operators import joins as J
from horavento.operators import merge as U
from horavento.operators import windows as W
from horavento.plans.common import READINGS_SQL, READINGS_TS_SQL, register, rounded
from horavento.schemas import READING_KEY, TARGETS
from horavento.sources.tables import load_table, readings, readings_with_ts

LONG_TS_SQL = """long AS (""" + "\n  UNION ALL ".join(
    f"SELECT id, estacao, ts, '{c}' AS chave, {c} AS valor FROM readings_ts" for c in TARGETS) + ")"


@register("top_stations", f"""WITH {READINGS_SQL}
SELECT estacao, count(*) AS n FROM readings GROUP BY estacao ORDER BY n DESC, estacao LIMIT 5""")
def q_top_stations(spark, sf):
    return W.top_stations(readings(spark, sf), 5)


@register("recent_rows", f"""WITH {READINGS_TS_SQL}
SELECT id, estacao, ts, temperatura FROM readings_ts ORDER BY ts DESC, id DESC LIMIT 100""")
def q_recent_rows(spark, sf):
    return W.recent_rows(readings_with_ts(spark, sf).select("id", "estacao", "ts", "temperatura"), 100)


@register("latest_values", f"""WITH {READINGS_TS_SQL}, {LONG_TS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY estacao, chave ORDER BY ts DESC, id DESC) AS rn
      FROM long WHERE valor IS NOT NULL)
SELECT estacao, chave, ts, valor FROM r WHERE rn = 1""")
def q_latest_values(spark, sf):
    long = to_long(readings_with_ts(spark, sf), ["id", "estacao", "ts"], TARGETS)
    return W.latest_values(long)


@register("tail_per_key", f"""WITH {READINGS_TS_SQL},
r AS (SELECT id, estacao, ts, row_number() OVER (PARTITION BY estacao ORDER BY ts DESC, id DESC) AS rn
      FROM readings_ts)
SELECT id, estacao, ts FROM r WHERE rn <= 1000""")
def q_tail_per_key(spark, sf):
    return W.tail_per_key(readings_with_ts(spark, sf).select("id", "estacao", "ts"), 1000)


@register("latest_per_key", f"""WITH {READINGS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY estacao, data, hora ORDER BY id DESC) AS rn FROM readings)
SELECT estacao, data, hora, id, temperatura, umidade, velocidade_vento FROM r WHERE rn = 1""")
def q_latest_per_key(spark, sf):
    return W.latest_per_key(readings(spark, sf), READING_KEY, ["id"])


# Two overlapping loads of the readings: days 1-20 stored, days 11-31
# arriving with corrected temperatures.
T_STORED = "2024-02-01 00:00:00"
T_NOW = "2024-03-01 00:00:00"
MERGE_SQL = f"""WITH {READINGS_SQL},
tgt AS (SELECT estacao, data, hora, temperatura, umidade, velocidade_vento FROM (
  SELECT *, row_number() OVER (PARTITION BY estacao, data, hora ORDER BY id DESC) AS rn
  FROM readings WHERE day(data) <= 20) WHERE rn = 1),
inc AS (SELECT estacao, data, hora, temperatura + 1.0 AS temperatura, umidade, velocidade_vento FROM (
  SELECT *, row_number() OVER (PARTITION BY estacao, data, hora ORDER BY id DESC) AS rn
  FROM readings WHERE day(data) >= 11) WHERE rn = 1),
merged AS (
SELECT coalesce(i.estacao, t.estacao) AS estacao, coalesce(i.data, t.data) AS data,
  coalesce(i.hora, t.hora) AS hora,
  CASE WHEN i.estacao IS NOT NULL THEN i.temperatura ELSE t.temperatura END AS temperatura,
  CASE WHEN i.estacao IS NOT NULL THEN i.umidade ELSE t.umidade END AS umidade,
  CASE WHEN i.estacao IS NOT NULL THEN i.velocidade_vento ELSE t.velocidade_vento END AS velocidade_vento,
  CASE WHEN t.estacao IS NOT NULL THEN TIMESTAMP '{T_STORED}' ELSE TIMESTAMP '{T_NOW}' END AS created_at,
  CASE WHEN i.estacao IS NOT NULL THEN TIMESTAMP '{T_NOW}' ELSE TIMESTAMP '{T_STORED}' END AS updated_at,
  CASE WHEN i.estacao IS NOT NULL AND t.estacao IS NOT NULL THEN 'atualizado'
       WHEN i.estacao IS NOT NULL THEN 'inserido' ELSE 'mantido' END AS acao
FROM tgt t FULL OUTER JOIN inc i ON t.estacao = i.estacao AND t.data = i.data AND t.hora = i.hora)"""


def _merged(spark, sf):
    r = readings(spark, sf)
    stored = W.latest_per_key(r.where(F.dayofmonth("data") <= 20), READING_KEY, ["id"]) \
        .withColumns({"created_at": F.lit(T_STORED).cast("timestamp"),
                      "updated_at": F.lit(T_STORED).cast("timestamp")})
    incoming = r.where(F.dayofmonth("data") >= 11) \
        .withColumn("temperatura", F.col("temperatura") + 1.0)
    return U.merge_readings(stored, incoming, order=["id"], now=T_NOW)


@register("merge_readings", MERGE_SQL + """
SELECT estacao, data, hora, round(temperatura, 6) AS temperatura, umidade, velocidade_vento,
  created_at, updated_at, acao FROM merged""")
def q_merge_readings(spark, sf):
    m = _merged(spark, sf)
    return rounded(m.withColumns({"created_at": F.col("created_at").cast("timestamp_ntz"),
                                  "updated_at": F.col("updated_at").cast("timestamp_ntz")})
                   .select("estacao", "data", "hora", *TARGETS, "created_at", "updated_at", "acao"))


@register("merge_counts", MERGE_SQL + """
SELECT CAST(count_if(acao = 'inserido') AS BIGINT) AS registros_inseridos,
  CAST(count_if(acao = 'atualizado') AS BIGINT) AS registros_atualizados,
  CAST(count_if(acao = 'mantido') AS BIGINT) AS registros_mantidos FROM merged""")
def q_merge_counts(spark, sf):
    return U.merge_counts(_merged(spark, sf))


# Ledger over per-station-day files derived from the readings: days 1-15
# were loaded before (odd days succeeded, even days failed); days 10-20 are
# loaded now.
FILES_SQL = f"""{READINGS_SQL},
files AS (SELECT 'raw/' || estacao || '/' || strftime(data, '%Y-%m-%d') || '.csv' AS arquivo_s3,
  day(data) AS dia, count(*) AS registros FROM readings GROUP BY estacao, data),
ledger AS (SELECT arquivo_s3, TIMESTAMP '{T_STORED}' AS data_processamento, registros AS registros_inseridos,
  CAST(0 AS BIGINT) AS registros_atualizados, CASE WHEN dia % 2 = 1 THEN 'sucesso' ELSE 'erro' END AS status
  FROM files WHERE dia <= 15),
novos AS (SELECT arquivo_s3, TIMESTAMP '{T_NOW}' AS data_processamento, registros AS registros_inseridos,
  CAST(0 AS BIGINT) AS registros_atualizados, 'sucesso' AS status FROM files WHERE dia >= 10)"""


def _files(spark, sf):
    r = readings(spark, sf)
    return r.groupBy("estacao", "data").agg(F.count(F.lit(1)).alias("registros")).select(
        F.concat(F.lit("raw/"), "estacao", F.lit("/"), F.date_format("data", "yyyy-MM-dd"),
                 F.lit(".csv")).alias("arquivo_s3"),
        F.dayofmonth("data").alias("dia"), "registros")


def _ledger(files, when: str, cond, status):
    return files.where(cond).select(
        "arquivo_s3", F.lit(when).cast("timestamp").alias("data_processamento"),
        F.col("registros").alias("registros_inseridos"),
        F.lit(0).cast("long").alias("registros_atualizados"), status.alias("status"))


@register("record_load", f"""WITH {FILES_SQL}
SELECT * FROM ledger WHERE arquivo_s3 NOT IN (SELECT arquivo_s3 FROM novos)
UNION ALL SELECT * FROM novos""")
def q_record_load(spark, sf):
    files = _files(spark, sf)
    old = _ledger(files, T_STORED, F.col("dia") <= 15,
                  F.when(F.col("dia") % 2 == 1, "sucesso").otherwise("erro"))
    new = _ledger(files, T_NOW, F.col("dia") >= 10, F.lit("sucesso"))
    out = U.record_load(old, new)
    return out.withColumn("data_processamento", F.col("data_processamento").cast("timestamp_ntz"))


@register("pending_files", f"""WITH {FILES_SQL}
SELECT arquivo_s3, registros FROM files
WHERE arquivo_s3 NOT IN (SELECT arquivo_s3 FROM ledger WHERE status = 'sucesso')""")
def q_pending_files(spark, sf):
    files = _files(spark, sf)
    old = _ledger(files, T_STORED, F.col("dia") <= 15,
                  F.when(F.col("dia") % 2 == 1, "sucesso").otherwise("erro"))
    return J.pending_files(files.select("arquivo_s3", "registros"), old)


@register("load_totals", f"""WITH {FILES_SQL}
SELECT count(*) AS encontrados,
  CAST(count_if(arquivo_s3 IN (SELECT arquivo_s3 FROM ledger WHERE status = 'sucesso')) AS BIGINT) AS ja_processados,
  CAST(count_if(arquivo_s3 NOT IN (SELECT arquivo_s3 FROM ledger WHERE status = 'sucesso')) AS BIGINT) AS pendentes
FROM files""")
def q_load_totals(spark, sf):
    files = _files(spark, sf)
    old = _ledger(files, T_STORED, F.col("dia") <= 15,
                  F.when(F.col("dia") % 2 == 1, "sucesso").otherwise("erro"))
    return U.load_totals(files, old)


@register("station_enrich", """SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_station_enrich(spark, sf):
    nation, region = load_table(spark, sf, "nation"), load_table(spark, sf, "region")
    dim = J.enrich_station(nation.withColumnRenamed("n_regionkey", "r_regionkey"), region, "r_regionkey") \
        .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    cust = load_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return J.enrich_station(cust, dim, "c_nationkey").drop("c_nationkey")


@register("station_alias", """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'FINALIZADO' WHEN 'O' THEN 'ABERTO' END AS estacao
FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def q_station_alias(spark, sf):
    alias = spark.createDataFrame([("F", "FINALIZADO"), ("O", "ABERTO")], "alias string, canonico string")
    o = load_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("estacao"))
    return J.map_station(o, alias)


@register("attach_device", """WITH dev AS (SELECT s_nationkey AS n_nationkey, min(s_suppkey) AS device_id
  FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey)
SELECT n.n_nationkey, n.n_name, d.device_id,
  CASE WHEN d.device_id IS NULL THEN 'erro' ELSE 'ok' END AS status
FROM nation n LEFT JOIN dev d ON n.n_nationkey = d.n_nationkey""")
def q_attach_device(spark, sf):
    sup = load_table(spark, sf, "supplier")
    dev = sup.where(F.col("s_acctbal") > 0).groupBy(F.col("s_nationkey").alias("n_nationkey")) \
        .agg(F.min("s_suppkey").alias("device_id"))
    nation = load_table(spark, sf, "nation").select("n_nationkey", "n_name")
    return J.attach_device(nation, dev, "n_nationkey")


@register("task_grid", f"""WITH {READINGS_SQL}
SELECT s.estacao, c.modelo, c.n_estimators, c.max_depth, c.max_iter
FROM (SELECT DISTINCT estacao FROM readings) s CROSS JOIN (VALUES
  ('Modelo_Leve', 5, 2, 2), ('Modelo_Medio', 10, 3, 3), ('Modelo_Robusto', 15, 4, 4))
  AS c(modelo, n_estimators, max_depth, max_iter)""")
def q_task_grid(spark, sf):
    return J.task_grid(U.distinct_values(readings(spark, sf), "estacao"))


SPLIT_SQL = """SELECT c_custkey, c_name FROM customer WHERE c_custkey {op} IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"""


def _split(spark, sf):
    cust = load_table(spark, sf, "customer").select("c_custkey", "c_name")
    done = load_table(spark, sf, "orders").where(F.col("o_orderstatus") == "F") \
        .select(F.col("o_custkey").alias("c_custkey"))
    return J.split_existing(cust, done, "c_custkey")


@register("split_existing_semi", SPLIT_SQL.format(op=""))
def q_split_semi(spark, sf):
    return _split(spark, sf)[0]


@register("split_existing_anti", SPLIT_SQL.format(op="NOT"))
def q_split_anti(spark, sf):
    return _split(spark, sf)[1]


@register("union_stations", f"""WITH {READINGS_SQL}
SELECT id, estacao, data, hora, temperatura, umidade, velocidade_vento FROM readings
UNION ALL SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE), NULL, o_totalprice, NULL, NULL FROM orders""")
def q_union_stations(spark, sf):
    from horavento.sources.tables import orders_readings
    return U.union_stations([readings(spark, sf), orders_readings(spark, sf)])


@register("distinct_values", f"""WITH {READINGS_SQL}
SELECT DISTINCT estacao, hora FROM readings""")
def q_distinct_values(spark, sf):
    return U.distinct_values(readings(spark, sf), ["estacao", "hora"])


@register("snapshot_order", f"""WITH {READINGS_SQL}
SELECT * FROM readings ORDER BY data DESC, estacao""")
def q_snapshot_order(spark, sf):
    return readings(spark, sf).orderBy(F.desc("data"), "estacao")
