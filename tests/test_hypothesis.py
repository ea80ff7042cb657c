"""Spark parsers on generated values: a value is rendered as the raw files
write it and must come back; texts that are no value must give NULL."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from horavento.functions.parse import hour_of, parse_decimal, parse_obs_date

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

tenths = st.integers(min_value=-9_998, max_value=9_999_999)
no_number = st.sampled_from(["", " ", "-9999", " -9999 ", "abc", "1,2,3", "--1", "1 2", ",", "NaN"])


def parsed(spark, texts, fn):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r.i: r.x for r in df.select("i", fn("s").alias("x")).collect()}
    return [got[i] for i in range(len(texts))]


@SETTINGS
@given(st.lists(st.one_of(tenths, no_number), min_size=1, max_size=60))
def test_decimals_come_back(spark, values):
    texts = [v if isinstance(v, str) else f" {v // 10},{v % 10}" if v >= 0 else f"-{-v // 10},{-v % 10}" for v in values]
    want = [None if isinstance(v, str) else v / 10 for v in values]
    assert parsed(spark, texts, parse_decimal) == want


no_date = st.sampled_from(["", "2024/02/30", "2024/13/01", "2024/00/10", "2023/02/29", "24-1", "data", "2024/01/32"])


@SETTINGS
@given(st.lists(st.one_of(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)), no_date), min_size=1, max_size=60),
       st.sampled_from("/-"))
def test_dates_come_back(spark, values, mark):
    texts = [v if isinstance(v, str) else v.isoformat().replace("-", mark) for v in values]
    want = [None if isinstance(v, str) else v for v in values]
    assert parsed(spark, texts, parse_obs_date) == want


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=23), min_size=1, max_size=24))
def test_hours_come_back(spark, hours):
    assert parsed(spark, [f"{h:02d}00 UTC" for h in hours], hour_of) == hours
