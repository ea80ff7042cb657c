"""Registered queries of the small projections, predicates, lookups and sinks
(P2-P5, P7, P10, P14, P16, P17, J6, J9, J10, A23, O1, O6, F20, K3, K5, S10, S14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from horavento.functions.telemetry import value_map
from horavento.functions.temporal import epoch_ms
from horavento.operators import analysis as A
from horavento.operators import catalog as C
from horavento.operators import filters as P
from horavento.operators import impute as M
from horavento.operators import joins as J
from horavento.operators import windows as W
from horavento.plans.common import READINGS_SQL, READINGS_TS_SQL, register, rounded
from horavento.plans.model_queries import MASK_SQL
from horavento.schemas import TARGETS
from horavento.session import scratch_path
from horavento.sources import sinks as K
from horavento.sources.tables import load_dataset, load_readings, load_table, readings, readings_with_ts


@register("select_existing", f"WITH {READINGS_SQL}\nSELECT estacao, id, umidade FROM readings")
def q_select_existing(spark, sf):
    return P.select_existing(readings(spark, sf), ["estacao", "radiacao", "id", "umidade"])


@register("drop_cols", f"WITH {READINGS_SQL}\nSELECT id, estacao, data, hora FROM readings")
def q_drop_cols(spark, sf):
    return P.drop_cols(readings(spark, sf), TARGETS)


@register("rename_measures", f"WITH {READINGS_SQL}\nSELECT id, temperatura AS temp, umidade AS umid FROM readings")
def q_rename_measures(spark, sf):
    return P.rename_measures(readings(spark, sf).select("id", "temperatura", "umidade"),
                             {"temperatura": "temp", "umidade": "umid", "pressao": "pres"})


@register("drop_bad_ts", f"WITH {READINGS_TS_SQL}\nSELECT id, ts FROM readings_ts WHERE id % 6 <> 0")
def q_drop_bad_ts(spark, sf):
    r = readings_with_ts(spark, sf).select("id", F.when(F.col("id") % 6 != 0, F.col("ts")).alias("ts"))
    return P.drop_bad_ts(r)


@register("by_year", """SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders
WHERE year(o_orderdate) IN (1995, 1997)""")
def q_by_year(spark, sf):
    o = load_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("ano"))
    return P.by_year(o, [1995, 1997])


@register("loaded_ok", "SELECT event_id, 'sucesso' AS status FROM events WHERE user_id % 3 > 0")
def q_loaded_ok(spark, sf):
    e = load_table(spark, sf, "events")
    return P.loaded_ok(e.select("event_id", F.when(F.col("user_id") % 3 > 0, "sucesso").otherwise("erro").alias("status")))


@register("missing_flags", f"WITH {READINGS_SQL}\nSELECT id, " + ", ".join(
    f"{c} IS NULL AS {c}_faltante" for c in TARGETS) + " FROM readings")
def q_missing_flags(spark, sf):
    flags = A.is_missing()
    return readings(spark, sf).withColumns(flags).select("id", *flags)


@register("load_stamp", f"WITH {READINGS_SQL}\nSELECT id, true AS agora FROM readings")
def q_load_stamp(spark, sf):
    s = P.stamp(readings(spark, sf))
    near = F.abs(F.unix_seconds("data_processamento") - F.unix_seconds(F.current_timestamp())) < 60
    return s.select("id", near.alias("agora"))


@register("pick_ts", f"WITH {READINGS_SQL}\nSELECT id, data AS quando FROM readings")
def q_pick_ts(spark, sf):
    r = readings(spark, sf)
    return r.select("id", F.col(P.pick_ts(r)).alias("quando"))


@register("masked_pairs_by_id", f"""WITH {MASK_SQL}
SELECT estacao, alvo, id, real, round(imputado, 6) AS imputado FROM pairs""")
def q_masked_pairs_by_id(spark, sf):
    """Masked truth x filled value, joined by row id and target."""
    r = readings(spark, sf).select("id", "estacao", *TARGETS)
    plan = M.MaskPlan(r)
    pairs = M.masked_pairs_long(M.mask_cells(r, plan=plan), M.mean_fill(M.apply_mask(r, plan=plan)))
    return rounded(pairs.select("estacao", "alvo", "id", "real", "imputado"))


@register("restore_ids", f"WITH {READINGS_SQL}\nSELECT id, data, hora, umidade, estacao FROM readings")
def q_restore_ids(spark, sf):
    return J.restore_ids(readings(spark, sf).select("umidade", "estacao", "hora", "id", "data"))


@register("require_station", f"WITH {READINGS_SQL}\nSELECT id, estacao FROM readings WHERE estacao IN ('click', 'view')")
def q_require_station(spark, sf):
    r = readings(spark, sf).select("id", "estacao")
    J.require_station(spark, ["click", "view"], r)
    return P.by_station(r, ["click", "view"])


@register("files_by_city", """WITH s AS (SELECT s_suppkey, 'A' || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS codigo,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Arco Verde' ELSE 'Recife' END AS cidade,
  CASE WHEN s_suppkey % 2 = 0 THEN 'ARCO VERDE' ELSE 'RECIFE' END AS bruto FROM supplier)
SELECT codigo, min(cidade) AS cidade, count(*) AS n_arquivos, CAST(sum(s_suppkey) AS BIGINT) AS bytes_total,
  string_agg('INMET_NE_PE_' || codigo || '_' || bruto || '_01-01-2024_A_31-12-2024.CSV', '|'
    ORDER BY 'INMET_NE_PE_' || codigo || '_' || bruto) AS arquivos
FROM s GROUP BY codigo""")
def q_files_by_city(spark, sf):
    """Raw files by station code and city."""
    k = F.col("s_suppkey")
    name = F.concat(F.lit("INMET_NE_PE_A"), F.lpad((k % 1000).cast("string"), 3, "0"),
                    F.when(k % 2 == 0, "_ARCO VERDE").otherwise("_RECIFE"), F.lit("_01-01-2024_A_31-12-2024.CSV"))
    files = load_table(spark, sf, "supplier").select(name.alias("filename"), k.cast("long").alias("size"))
    return C.files_by_station(files).withColumn("arquivos", F.array_join("arquivos", "|"))


@register("sort_series", f"WITH {READINGS_SQL}\nSELECT estacao, data, hora, id FROM readings")
def q_sort_series(spark, sf):
    return W.sort_series(readings(spark, sf).select("estacao", "data", "hora", "id"))


@register("cap_per_station", f"""WITH {READINGS_TS_SQL},
r AS (SELECT id, estacao, ts, row_number() OVER (PARTITION BY estacao ORDER BY ts, id) AS rn FROM readings_ts)
SELECT id, estacao, ts FROM r WHERE rn <= 1500""")
def q_cap_per_station(spark, sf):
    return W.cap_per_station(readings_with_ts(spark, sf).select("id", "estacao", "ts"), 1500)


@register("point_payloads", f"""WITH {READINGS_TS_SQL}
SELECT '{{"ts":' || CAST(epoch_ms(ts) AS VARCHAR) || ',"values":{{"hora":' || CAST(CAST(hora AS DOUBLE) AS VARCHAR) || '}}}}' AS payload
FROM readings_ts""")
def q_point_payloads(spark, sf):
    r = readings_with_ts(spark, sf)
    return K.point_payloads(r.select(epoch_ms("ts").alias("ts_ms"), value_map(["hora"]).alias("values")))


@register("save_table", f"WITH {READINGS_SQL}\nSELECT id, estacao FROM readings UNION ALL SELECT id, estacao FROM readings WHERE id % 2 = 0")
def q_save_table(spark, sf):
    """K3: replace, then append, to a catalog table."""
    r = readings(spark, sf).select("id", "estacao")
    name = f"leituras_{uuid.uuid4().hex}"
    K.save_table(r, name, "replace")
    K.save_table(r.where("id % 2 = 0"), name, "append")
    return spark.table(name)


@register("land_raw", f"WITH {READINGS_SQL}\nSELECT CAST(year(data) AS INTEGER) AS ano, estacao, id, temperatura FROM readings")
def q_land_raw(spark, sf):
    """K5: rows landed by year and station, read back."""
    path = scratch_path(spark, "landed")
    K.land_raw(readings(spark, sf), path)
    return load_readings(spark, path, columns=["ano", "estacao", "id", "temperatura"])


@register("load_dataset", f"WITH {READINGS_SQL}, n AS (SELECT count(*) AS n FROM readings)\nSELECT r.id, n.n AS linhas FROM readings r CROSS JOIN n")
def q_load_dataset(spark, sf):
    """A saved frame with its metadata frame."""
    path, r = scratch_path(spark, "dataset"), readings(spark, sf)
    r.write.parquet(f"{path}/data")
    r.agg(F.count(F.lit(1)).alias("linhas")).write.parquet(f"{path}/metadata")
    data, meta = load_dataset(spark, path)
    return data.select("id", meta.select("linhas").scalar().alias("linhas"))


@register("run_records", f"""WITH {MASK_SQL}, n AS (SELECT estacao, count(*) AS n FROM readings GROUP BY estacao)
SELECT s.estacao, 'Modelo_Leve' AS modelo, CAST(any_value(n.n) AS VARCHAR) AS n_records, '5' AS min_samples_leaf,
  CAST(12 AS INTEGER) AS n_metricas, round(avg(rmse), 6) AS avg_rmse,
  round(max(CASE WHEN alvo = 'umidade' THEN mae END), 6) AS umidade_mae
FROM scores s JOIN n ON s.estacao = n.estacao GROUP BY s.estacao""")
def q_run_records(spark, sf):
    """M8: the run-log row of every station, from the scores of the mean fill."""
    r = readings(spark, sf).select("id", "estacao", *TARGETS)
    plan = M.MaskPlan(r)
    pairs = M.mean_fill_pairs(M.mask_cells(r, plan=plan), M.apply_mask(r, plan=plan))
    scores = A.score(pairs.withColumn("modelo", F.lit("Modelo_Leve")))
    runs = M.run_records(scores, counts=r.groupBy("estacao").agg(F.count(F.lit(1)).alias("n_records")))
    return rounded(runs.select(
        F.col("tags.station_name").alias("estacao"), F.col("tags.model_type").alias("modelo"), F.col("params.n_records"),
        F.col("params.min_samples_leaf"), F.size("metrics").alias("n_metricas"), F.col("metrics.avg_rmse"),
        F.col("metrics.umidade_mae")))
