"""Raw files cut into many splits against the reader that takes a file as one row."""

import random
import shutil

import pytest

from horavento.sources import split_files as sp
from horavento.sources import station_files as st
from tests.conftest import GOLDEN

NAMES = ["DATA", "HORA UTC"] + [f"C{i}" for i in range(17)]


def body(rng, n):
    for i in range(n):
        kind = rng.random()
        if kind < 0.04:
            yield rng.choice(["ESTAÇÃO:;NOVA ", "Estacao:;OUTRA ", "ESTAÇÃO:", "ESTACAO:;"]) + str(i)
        elif kind < 0.08:
            yield rng.choice(["", "  ", "2024/01/01;curta", "31/31/2024;" + ";" * 18])
        else:
            yield f"2024/{rng.randint(1, 12):02d}/{rng.randint(1, 28):02d};{i % 24:02d}00 UTC;" + ";".join(
                f"{rng.randint(-9, 99)},{rng.randint(0, 9)}" for _ in range(17))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng, path = random.Random(3), tmp_path_factory.mktemp("raw")
    meta = ["REGIÃO:;NE", "UF:;PE", "ESTAÇÃO:;ÁGUA BRANCA", "CODIGO:;A1", "LATITUDE:;-8", "LONGITUDE:;-34", "ALTITUDE:;1", "FUNDACAO:;x"]
    for k, (code, end, n) in enumerate([("utf-8", "\n", 300), ("latin-1", "\r\n", 300), ("utf-8", "\r\n", 1), ("latin-1", "\n", 90)]):
        lines = [*meta, ";".join(NAMES), *body(rng, n)]
        (path / f"f{k}.CSV").write_bytes(end.join(lines).encode(code))
    # Latin-1 by its last line alone; no header; no station; empty
    late = [*meta, "Data;Hora UTC;" + ";".join(NAMES[2:]), *[x for x in body(rng, 80)], "ESTAÇÃO:;FIM"]
    (path / "late.CSV").write_bytes("\n".join(late[2:-1]).encode("utf-8").replace("Ç".encode(), b"C") + b"\n\xe9;x\n")
    (path / "nohead.CSV").write_text("\n".join([*meta, *[x for x in body(rng, 5) if not x.startswith("DATA")]]))
    (path / "empty.CSV").write_text("")
    for k, name in enumerate(["INMET_NE_PE_A309_ARCO VERDE_01-01-2024_A_31-12-2024.CSV", "second_file_utf8.csv", "no_station.csv"]):
        shutil.copy(f"{GOLDEN}/{name}", path / f"golden{k}.CSV")
    return str(path)


@pytest.fixture(params=["97b", "1200b", "64m"])
def cut(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(df):
    names = sorted(df.columns)
    return sorted(repr([r[c].rsplit("/", 1)[-1] if c == "arquivo" else r[c] for c in names]) for r in df.collect())


@pytest.mark.parametrize("strict", [False, True])
def test_positional(spark, folder, cut, strict):
    got = sp.read_station_csv_split(spark, folder, strict_label=strict, with_rejects=True)
    want = st.read_station_csv(spark, folder, strict_label=strict, with_rejects=True)
    assert [rows(d) for d in got] == [rows(d) for d in want]
    if cut == "97b":
        assert sp.raw_lines(spark, folder).rdd.getNumPartitions() > 200


def test_by_name(spark, folder, cut):
    got = sp.read_station_csv_named_split(spark, folder, with_rejects=True)
    want = st.read_station_csv_named(spark, folder, with_rejects=True)
    assert [rows(d) for d in got] == [rows(d) for d in want]


def test_header(spark, folder, cut):
    assert rows(sp.read_station_header_split(spark, folder)) == rows(st.read_station_header(spark, folder))


def test_no_shuffle_of_lines_without_late_stations(spark, tmp_path):
    (tmp_path / "a.CSV").write_text("ESTACAO:;A\nDATA;HORA UTC\n" + "2024/01/01;0000 UTC;" + ";" * 17)
    df = sp.read_station_csv_split(spark, str(tmp_path))
    assert df.count() == 1 and "Window" not in df._jdf.queryExecution().executedPlan().toString()
