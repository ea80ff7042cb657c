"""Library operators without a registered query: listings, readers, catalog,
renames, lookups, export loop."""

import os

import pytest
from pyspark.sql import functions as F

from horavento.functions.temporal import hour_of_day, radiation_log, station_title
from horavento.operators import filters as P
from horavento.operators import joins as J
from horavento.operators.windows import cap_per_station
from horavento.plans.file_queries import raw_files
from horavento.schemas import RESULT_PREFIX, TARGETS
from horavento.session import scratch_path
from horavento.sources import sinks as K
from horavento.sources.catalog import files_for_station, filter_csv, list_files
from horavento.sources.tables import load_dataset, load_table, query, readings, table_info
from horavento.streaming.ingest import export_stream, ingest_stream
from tests.conftest import GOLDEN, SF001


def test_listing_station_and_csv_filters(spark):
    files = list_files(spark, GOLDEN)
    names = {r.filename for r in files.collect()}
    assert "INMET_NE_PE_A309_ARCO VERDE_01-01-2024_A_31-12-2024.CSV" in names
    assert [r.filename for r in files_for_station(files, "ARCO_VERDE", [2024]).collect()] == []  # no year dir
    assert files_for_station(files, "ARCO_VERDE").count() == 1
    assert filter_csv(files, GOLDEN, ignore_case=True, path="path").count() == 0  # path has file: scheme
    assert filter_csv(files.withColumn("p", F.col("filename")), "", True, "p").count() == 3
    assert filter_csv(files.withColumn("p", F.col("filename")), "", False, "p").count() == 2


def test_rendered_listing_has_year_and_name(spark):
    files = list_files(spark, raw_files(spark, SF001))
    rows = files.collect()
    assert {r.year for r in rows} == {"2024"}
    assert all(r.filename.startswith("INMET_NE_PE_A3") for r in rows)
    assert files_for_station(files, "click", [2024]).count() == 1


def test_inventory_summary(spark):
    from horavento.operators.catalog import inventory, inventory_summary
    files = list_files(spark, raw_files(spark, SF001))
    s = inventory_summary(files).first()
    assert s.total_arquivos == 5 and s.anos == ["2024"]
    assert {r.year: r.n_arquivos for r in inventory(files).collect()} == {"2024": 5}


def test_query_and_table_info(spark):
    r = readings(spark, SF001)
    out = query(spark, "SELECT estacao, count(*) AS n FROM leituras GROUP BY estacao", {"leituras": r})
    assert out.count() == 5
    info = table_info(spark, "leituras")
    assert {x.coluna for x in info.collect()} == set(r.columns)
    assert table_info(spark, "nao_existe").count() == 0


def test_load_dataset_with_metadata(spark, workdir):
    r = readings(spark, SF001)
    r.write.parquet(f"{workdir}/data")
    spark.createDataFrame([("estacoes", "5")], "k string, v string").write.parquet(f"{workdir}/metadata")
    data, meta = load_dataset(spark, workdir)
    assert data.count() == r.count() and meta.first().k == "estacoes"


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, `Velocidade Vento` string, x double")
    assert P.select_existing(df, ["x", "nope", "id"]).columns == ["x", "id"]
    assert P.rename_measures(df).columns == ["id", "velocidade_vento", "x"]
    assert P.drop_cols(df, ["x"]).columns == ["id", "Velocidade Vento"]
    assert P.pick_ts(spark.createDataFrame([(1,)], "hora int")) == "hora"
    assert P.pick_ts(df) is None
    names = spark.createDataFrame([("a_Modelo_Leve.csv",), ("b.csv",)], "filename string")
    assert P.name_contains(names, "_Modelo_").count() == 1
    assert P.name_contains(names, "_Modelo_", negate=True).count() == 1


def test_station_lookups(spark):
    known = readings(spark, SF001).select("estacao").distinct()
    J.require_station(spark, ["click"], known)
    with pytest.raises(ValueError):
        J.require_station(spark, ["click", "SURUBIM"], known)
    dim = spark.createDataFrame([("click", "A301")], "estacao string, codigo string")
    out = J.with_header(readings(spark, SF001), dim, "estacao")
    assert out.where(F.col("codigo").isNotNull()).select("estacao").distinct().count() == 1


def test_scalar_helpers(spark):
    r = spark.createDataFrame([("ARCO_VERDE", 0.0)], "s string, x double") \
        .select(station_title("s").alias("t"), radiation_log("x").alias("l"),
                hour_of_day(F.lit("2024-01-01 05:00:00").cast("timestamp")).alias("h")).first()
    assert (r.t, r.l, r.h) == ("Arco Verde", 0.0, 5)


def test_cap_per_station(spark):
    r = readings(spark, SF001).withColumn("ts", F.col("data"))
    capped = cap_per_station(r, 10)
    assert {x["count"] for x in capped.groupBy("estacao").count().collect()} == {10}


def test_write_imputed_layout(spark, workdir):
    K.write_imputed(readings(spark, SF001).withColumn("modelo", F.lit("Modelo_Leve")), workdir)
    back = spark.read.parquet(f"{workdir}/parquet")
    assert set(back.columns) >= {"estacao", "modelo", *TARGETS}
    assert os.path.isdir(workdir.replace("file:", "") + "/csv")


def test_export_stream_once(spark):
    src = raw_files(spark, SF001)
    table, ledger = scratch_path(spark, "t"), scratch_path(spark, "l")
    ingest_stream(spark, src, table, ledger)
    out = scratch_path(spark, "snap")
    q = export_stream(spark, table, out, once=True)
    q.awaitTermination()
    snaps = spark.read.parquet(out + "/*")
    assert snaps.count() == spark.read.parquet(table).count()


def test_save_table_modes(spark):
    r = readings(spark, SF001).limit(10)
    name = "leituras_k3_" + scratch_path(spark, "x")[-8:]
    K.save_table(r, name, "replace")
    K.save_table(r, name, "append")
    assert spark.table(name).count() == 20
    with pytest.raises(Exception):
        K.save_table(r, name, "fail")
    spark.sql(f"DROP TABLE {name}")


def test_station_dimension(spark):
    from horavento.sources.tables import station_dimension
    d = station_dimension(spark)
    assert d.count() == 12
    assert d.where(F.col("nome") == "ARCO_VERDE").first().codigo == "A309"


def test_scratch_scope_deletes_what_was_made_inside(spark):
    from horavento.session import materialize, path_exists, scratch_scope
    outside = scratch_path(spark, "kept")
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark):
        inside = scratch_path(spark, "gone")
        spark.range(3).write.parquet(inside)
        assert materialize(spark.range(5), "gone-too").count() == 5
    assert path_exists(spark, outside) and not path_exists(spark, inside)


def test_checkpoint_folder_is_required_off_local_mode():
    from horavento.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        checkpoint_root(Session())


def test_series_keep_every_bucket(spark):
    from horavento.streaming.stats import dashboard_series
    rows = spark.range(300 * 24 * 6).selectExpr(
        "id", "concat('s', id % 300) AS estacao", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, cast(id div 300 as int)) AS ts",
        "cast(id AS double) AS temperatura")
    out = dashboard_series(rows, ["temperatura"])
    assert out.count() == 300 * 24 * 6 and out.count() > 25_000
    assert out.agg(F.max("hora_inicio")).first() == rows.agg(F.max("ts")).first()


def test_station_without_observations_is_imputed(spark):
    from horavento.operators import impute as M
    from horavento.schemas import TARGETS
    r = readings(spark, SF001).withColumns({
        "umidade": F.when(F.col("estacao") != "click", F.col("umidade")),
        "estacao": F.when(F.col("estacao") != "view", F.col("estacao"))})
    cfg = {"nome": "t", "n_estimators": 2, "max_depth": 2, "max_iter": 1}
    for scope in ("pooled", "per_station"):
        out = M.iterative_impute(r, cfg, scope=scope)
        assert out.count() == r.count()
        assert out.where(" OR ".join(f"{t} IS NULL" for t in TARGETS)).count() == 0


def test_unreadable_file_is_recorded_and_the_rest_loaded(spark):
    from horavento.streaming.ingest import ingest_files, read_ledger, read_table
    from horavento.sources.station_files import read_files
    files = read_files(spark, GOLDEN)
    bad = files.limit(1).select(F.lit("file:/bad.csv").alias("path"), "modificationTime", F.lit(2).cast("long").alias("length"),
                                F.lit(b"\xff\x00").alias("content"))
    table, ledger = scratch_path(spark, "table"), scratch_path(spark, "ledger")
    for _ in range(2):
        ingest_files(spark, files.unionByName(bad), table, ledger)
    led = {r.arquivo_s3: r.status for r in read_ledger(spark, ledger).collect()}
    assert led.pop("file:/bad.csv") == "erro" and set(led.values()) == {"sucesso"}
    assert read_table(spark, table).count() > 0


def test_result_file_resolution_order(spark):
    from horavento.sources.catalog import resolve_result_file
    files = spark.createDataFrame([
        (f"r/{RESULT_PREFIX}ARCO VERDE_Modelo_Leve.csv",),
        (f"r/{RESULT_PREFIX}ARCO_VERDE_Modelo_Medio.csv",),
        (f"r/{RESULT_PREFIX}ARCO_VERDE_Modelo_Robusto.csv",),
        (f"r/{RESULT_PREFIX}SURUBIM_Modelo_Leve.csv",),
        ("r/notes.txt",)], "path string")
    wanted = spark.createDataFrame([("ARCO_VERDE", "Robusto"), ("ARCO_VERDE", None), ("SURUBIM", "Medio"),
                                    ("PETROLINA", None)], "estacao string, modelo string")
    got = {(r.estacao, r.modelo): r.arquivo for r in resolve_result_file(files, wanted).collect()}
    assert got[("ARCO_VERDE", "Robusto")].endswith("ARCO_VERDE_Modelo_Robusto.csv")
    assert got[("ARCO_VERDE", None)].endswith("ARCO_VERDE_Modelo_Medio.csv")  # underscore spelling first
    assert got[("SURUBIM", "Medio")].endswith("SURUBIM_Modelo_Leve.csv")  # no model match: first file
    assert got[("PETROLINA", None)] is None


def test_next_marks(spark):
    from horavento.streaming.sync import new_since, next_marks, runs_from_events
    runs = runs_from_events(load_table(spark, SF001, "events"))
    marks = spark.createDataFrame([], "experimento string, marca timestamp_ntz")
    fresh = new_since(runs, marks)
    assert fresh.count() == runs.count()
    m = next_marks(fresh, marks)
    assert new_since(runs, m).count() == 0


def test_run_records_maps(spark):
    from horavento.operators.impute import run_records
    scores = spark.createDataFrame([("a", "Modelo_Leve", t, 1.0, 0.5, 0.1) for t in TARGETS],
                                   "estacao string, modelo string, alvo string, rmse double, mae double, r2 double")
    counts = spark.createDataFrame([("a", 7)], "estacao string, n_records long")
    spent = spark.createDataFrame([("Modelo_Leve", 2.5)], "modelo string, duracao_segundos double")
    r = run_records(scores, counts=counts, durations=spent).first()
    assert r.tags["station_name"] == "a" and r.tags["model_type"] == "Modelo_Leve" and r.tags["method"] == "IterativeImputer"
    assert r.tags["avg_rmse_a"] == "1.0" and r.tags["duration_seconds_a"] == "2.5" and len(r.tags) == 5 + 13
    assert r.params["n_estimators"] == "5" and r.params["min_samples_split"] == "10" and r.params["n_records"] == "7"
    assert len(r.metrics) == 13 and r.metrics["umidade_rmse"] == 1.0 and abs(r.metrics["avg_r2"] - 0.1) < 1e-12
    assert r.run_name.startswith("a_Modelo_Leve_")
