"""Series from hourly states equal the aggregate of the rows."""

import datetime as dt
import random

import pytest

from horavento.session import scratch_path
from horavento.streaming.rollup import hour_states, read_rollup, rollup_stream, series, write_batch

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "estacao string, ts timestamp_ntz, temperatura double, umidade double"


def made(n=400):
    rng = random.Random(5)
    some = lambda: rng.choice([None, float(rng.randint(-20, 90))])
    return [(rng.choice(["A", "B", None]), rng.choice([None] + [T0 + dt.timedelta(minutes=rng.randint(0, 40000)) for _ in range(20)]), some(), some())
            for _ in range(n)]


def brute(rows, hours):
    groups = {}
    for e, ts, t, u in rows:
        for k, v in (("temperatura", t), ("umidade", u)):
            if ts is not None and v is not None:
                step = dt.timedelta(hours=hours)
                start = dt.datetime(1970, 1, 1) + (ts - dt.datetime(1970, 1, 1)) // step * step
                groups.setdefault((e, k, start), []).append(v)
    return sorted(((*g, sum(v) / len(v), min(v), max(v), len(v)) for g, v in groups.items()), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("interval,hours", [("1 hour", 1), ("1 day", 24), ("7 days", 168)])
def test_any_order_late_rows_and_a_replayed_batch(spark, interval, hours):
    rows, root = made(), scratch_path(spark, "rollup")
    for i in range(3):
        write_batch(spark.createDataFrame(rows[i::3], SCHEMA), i, root, ["temperatura", "umidade"])
    write_batch(spark.createDataFrame(rows[1::3], SCHEMA), 1, root, ["temperatura", "umidade"])
    got = series(read_rollup(spark, root), interval)
    assert rows_of(got) == brute(rows, hours)
    day = dt.datetime(2024, 1, 10)
    part = series(read_rollup(spark, root), interval, a=day)
    assert rows_of(part) == brute([r for r in rows if r[1] and r[1] >= day], hours)


def test_stream_restarts_where_it_stopped(spark):
    rows, src, root, ckpt = made(), *[scratch_path(spark, x) for x in ("src", "rollup", "ckpt")]
    for i in range(2):
        spark.createDataFrame(rows[i::2], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        for _ in range(2):  # the second run finds nothing new
            rollup_stream(spark.readStream.schema(SCHEMA).parquet(src), root, ckpt, ["temperatura", "umidade"])
    assert rows_of(series(read_rollup(spark, root), "1 day")) == brute(rows, 24)


def test_empty(spark):
    assert series(read_rollup(spark, scratch_path(spark, "none")), "1 day").collect() == []
    assert hour_states(spark.createDataFrame([], SCHEMA), ["umidade"]).collect() == []
