"""Helpers shared by the registered queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from horavento.session import apply_conf

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

# DuckDB twin of ``readings_from_events`` (same casts, see FIXTURES.md §3).
def readings_cte(name: str = "readings", keep_ts: bool = False) -> str:
    extra = ", ts" if keep_ts else ""
    return f"""{name} AS (
  SELECT event_id AS id, event_type AS estacao, CAST(ts AS DATE) AS data,
         CAST(hour(ts) AS INTEGER) AS hora,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(value AS DOUBLE) END AS temperatura,
         CASE WHEN event_id % 7 = 0 THEN NULL
              ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS umidade,
         CASE WHEN event_id % 13 = 0 THEN NULL
              ELSE CAST(user_id % 80 AS DOUBLE) / CAST(10 AS DOUBLE) END AS velocidade_vento{extra}
  FROM events)"""


READINGS_SQL = readings_cte()
READINGS_TS_SQL = READINGS_SQL + """,
readings_ts AS (SELECT *, CAST(data AS TIMESTAMP) + to_hours(hora) AS ts FROM readings)"""


def register(name: str, sql: str | None = None):
    """Decorator: add a ``(spark, sf_dir) -> DataFrame`` query to the registry,
    with its DuckDB oracle SQL when the result is SQL-expressible.  The
    registered callable first applies the engine's runtime SQL settings (UTC
    session time zone, AQE) to whatever session it is given."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            apply_conf(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column so both engines agree past summation order."""
    return df.select(*[F.round(F.col(c), places).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])
