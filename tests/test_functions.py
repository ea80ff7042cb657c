"""Scalar functions on literal inputs (parsers, name rules, categories)."""

import math

from pyspark.sql import functions as F

from horavento.functions.parse import (
    hour_of, normalize_header, parse_decimal, parse_obs_date, parse_raw_name, parse_result_name,
)
from horavento.functions.telemetry import run_station, value_map
from horavento.functions.temporal import cyclic, weekday_mon0
from horavento.operators.analysis import wind_category
from horavento.schemas import RESULT_PREFIX


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_hours(spark):
    assert _one(spark, hour_of(F.lit("0000 UTC"))) == 0
    assert _one(spark, hour_of(F.lit("2300 UTC"))) == 23
    assert _one(spark, hour_of(F.lit("xx"))) is None


def test_decimals(spark):
    assert _one(spark, parse_decimal(F.lit("23,4"))) == 23.4
    assert _one(spark, parse_decimal(F.lit(""))) is None
    assert _one(spark, parse_decimal(F.lit("abc"))) is None
    assert _one(spark, parse_decimal(F.lit("-9999"))) is None
    assert _one(spark, parse_decimal(F.lit("-9999"), keep_sentinel=True)) == -9999.0
    assert _one(spark, parse_decimal(F.lit("NaN"))) is None


def test_dates(spark):
    assert str(_one(spark, parse_obs_date(F.lit("2024/01/05")))) == "2024-01-05"
    assert _one(spark, parse_obs_date(F.lit("2024/13/01"))) is None


def test_result_names(spark):
    a = _one(spark, parse_result_name(F.lit(f"{RESULT_PREFIX}ARCO_VERDE.csv")))
    b = _one(spark, parse_result_name(F.lit(f"x/{RESULT_PREFIX}ARCO_VERDE_Modelo_Leve.csv")))
    assert (a.estacao, a.modelo) == ("ARCO_VERDE", None)
    assert (b.estacao, b.modelo) == ("ARCO_VERDE", "Leve")


def test_raw_name_with_space(spark):
    r = _one(spark, parse_raw_name(F.lit("INMET_NE_PE_A309_ARCO VERDE_01-01-2020_A_31-12-2020.CSV"), title=True))
    assert (r.codigo, r.cidade, r.ano) == ("A309", "Arco Verde", 2020)


def test_run_station_rules(spark):
    df = spark.createDataFrame([
        ({"station": "A"}, {}, "x"), ({"station_name": "B"}, {}, "x"), ({}, {"station_name": "C"}, "x"),
        ({}, {}, "processed_data_SERRA_TALHADA_20240101_1200"), ({}, {}, "processed_data_PETROLINA"),
        ({}, {}, "run_imputacao_SURUBIM_2024"), ({}, {}, "nothing_here"), ({}, {}, "imputacao")],
        "tags map<string,string>, params map<string,string>, run_name string")
    got = [r.x for r in df.select(run_station().alias("x")).collect()]
    assert got == ["A", "B", "C", "SERRA_TALHADA", "PETROLINA", "SURUBIM", None, None]


def test_accents(spark):
    assert _one(spark, normalize_header(F.lit("Estação: Fundação"))) == "ESTACAO: FUNDACAO"


def test_weekday_monday_zero(spark):
    assert _one(spark, weekday_mon0(F.lit("2024-01-01").cast("date"))) == 0


def test_cyclic_unit_circle(spark):
    s, c = cyclic(F.col("id"), 24)
    for r in spark.range(24).select((s * s + c * c).alias("x")).collect():
        assert math.isclose(r.x, 1.0, rel_tol=1e-12)


def test_wind_categories(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (3.3,), (5.5,), (None,)], "v double")
    got = [r.c for r in df.select(wind_category("v").alias("c")).collect()]
    assert got == ["Calmo", "Brisa Leve", "Brisa Moderada", "Vento Forte", "Desconhecido"]


def test_value_map_drops_nulls(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert df.select(value_map(["a", "b"]).alias("m")).first().m == {"a": 1.0}
    assert df.select(value_map(["a", "b"], keep_nulls=True).alias("m")).first().m == {"a": 1.0, "b": None}
