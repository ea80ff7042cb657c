"""Raw station files, hand-written (FIXTURES.md §2)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from horavento.operators.merge import merge_readings
from horavento.sources.station_files import (
    header_wide, read_station_csv, read_station_csv_named, read_station_header,
)
from tests.conftest import GOLDEN

LATIN = os.path.join(GOLDEN, "INMET_NE_PE_A309_ARCO VERDE_01-01-2024_A_31-12-2024.CSV")
UTF8 = os.path.join(GOLDEN, "second_file_utf8.csv")
NOSTATION = os.path.join(GOLDEN, "no_station.csv")
D1 = dt.date(2024, 1, 1)


def _rows(df):
    return sorted((r.estacao, r.data, r.hora, r.temperatura, r.umidade, r.velocidade_vento)
                  for r in df.collect())


def test_latin1_positional(spark):
    ok, bad = read_station_csv(spark, LATIN, with_rejects=True)
    assert _rows(ok) == sorted([
        ("ARCO VERDE", D1, "0000 UTC", 23.4, 80.0, 1.5),
        ("ARCO VERDE", D1, "0100 UTC", None, None, None),
        ("ARCO VERDE", D1, "2300 UTC", 19.5, 90.0, 0.3),
        ("ARCO VERDE", D1, "2300 UTC", 19.9, 91.0, 0.4),
    ])
    reasons = sorted(r.motivo for r in bad.collect())
    assert reasons == ["campos_insuficientes", "data_invalida"]


def test_sentinel_kept_on_request(spark):
    ok = read_station_csv(spark, LATIN, keep_sentinel=True)
    r = ok.where(F.col("hora") == "0100 UTC").first()
    assert r.velocidade_vento == -9999.0 and r.temperatura is None and r.umidade is None


def test_strict_label_gives_null_station(spark):
    ok = read_station_csv(spark, LATIN, strict_label=True)
    assert {r.estacao for r in ok.collect()} == {None}


def test_utf8_and_lower_case_header(spark):
    ok = read_station_csv(spark, UTF8)
    assert _rows(ok) == sorted([
        ("ARCO VERDE", dt.date(2024, 1, 2), "0000 UTC", 24.0, None, 1.0),
        ("ARCO VERDE", D1, "0000 UTC", 25.0, None, 1.1),
    ])


def test_header_reader(spark):
    h = header_wide(read_station_header(spark, LATIN)).first()
    assert h.regiao == "NE" and h.estado == "PE" and h.estacao == "ARCO VERDE"
    assert h.codigo_estacao == "A309" and h.data_fundacao == "2004-09-30"


def test_named_reader(spark):
    df = read_station_csv_named(spark, LATIN, columns=["DATA", "HORA UTC", "UMIDADE RELATIVA DO AR, HORÁRIA (%)"])
    rows = sorted((r["HORA UTC"], r["UMIDADE RELATIVA DO AR, HORARIA (%)"]) for r in df.collect())
    # the invalid date row is dropped by the timestamp parse; -9999 and blanks are NULL
    assert ("0000 UTC", "80") in rows and all(x[0] != "0200 UTC" for x in rows)


def test_merge_semantics(spark):
    first = read_station_csv(spark, LATIN)
    empty = first.limit(0).select("estacao", "data", "hora", "temperatura", "umidade", "velocidade_vento")
    t0 = "2024-02-01 00:00:00"
    table = merge_readings(empty, first, now=t0)
    assert table.count() == 3  # duplicate 2300 key collapsed, later line wins
    late = table.where(F.col("hora") == "2300 UTC").first()
    assert (late.temperatura, late.umidade) == (19.9, 91.0)
    t1 = "2024-03-01 00:00:00"
    second = read_station_csv(spark, UTF8)
    merged = merge_readings(table.drop("acao"), second, now=t1)
    upd = merged.where((F.col("data") == D1) & (F.col("hora") == "0000 UTC")).first()
    assert upd.acao == "atualizado" and upd.temperatura == 25.0 and upd.umidade is None
    assert upd.created_at == dt.datetime(2024, 2, 1) and upd.updated_at == dt.datetime(2024, 3, 1)
    counts = {r.acao: r["count"] for r in merged.groupBy("acao").count().collect()}
    assert counts == {"atualizado": 1, "inserido": 1, "mantido": 2}


def test_null_station_never_merges(spark):
    rows = read_station_csv(spark, NOSTATION)
    assert rows.first().estacao is None
    empty = rows.limit(0).select("estacao", "data", "hora", "temperatura", "umidade", "velocidade_vento")
    once = merge_readings(empty, rows).drop("acao")
    twice = merge_readings(once, rows)
    assert twice.count() == 2


def test_named_reader_repeated_names_and_surplus_fields(spark, tmp_path):
    from horavento.sources.station_files import read_station_csv_named
    lines = [f"CHAVE{i}:;v" for i in range(8)] + ["Data;Hora UTC;X;X;", "2024/01/01;0000 UTC;1;2;;extra;mais", "2024/01/02;0100 UTC;3"]
    (tmp_path / "a.CSV").write_text("\n".join(lines))
    rows, surplus = read_station_csv_named(spark, str(tmp_path), with_rejects=True)
    got = {r.linha: (r["X"], r["X_2"]) for r in rows.collect()}
    assert got == {9: ("1", "2"), 10: ("3", None)}
    assert [(r.linha, r.excedente) for r in surplus.collect()] == [(9, "extra;mais")]
