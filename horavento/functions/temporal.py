"""Temporal features and encodings (F2, F7-F12, F23, M1 column part)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from horavento.functions.parse import _c


def to_ts(data, hora) -> Column:
    """date + integer hour -> timestamp without zone."""
    return F.timestamp_add("HOUR", _c(hora), _c(data).cast("timestamp_ntz"))


def weekday_mon0(col) -> Column:
    """Day of week with Monday = 0 (F8, T5)."""
    return F.weekday(_c(col))


def cyclic(col, period: int) -> tuple[Column, Column]:
    """sin / cos encoding of a periodic integer."""
    angle = F.lit(2.0 * math.pi) * _c(col).cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def epoch_ms(col) -> Column:
    """Timestamp -> epoch milliseconds, UTC."""
    return F.unix_millis(_c(col).cast("timestamp"))


def calendar_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Year, month, day, day of year."""
    t = F.col(ts)
    return df.withColumns({"ano": F.year(t), "mes": F.month(t), "dia": F.dayofmonth(t),
                           "dia_ano": F.dayofyear(t)})


def temporal_features(df: DataFrame, data: str = "data", hora: str = "hora") -> DataFrame:
    """The ten temporal features of the treated dataset.

    ``hora`` may be an integer hour or the raw ``HHMM UTC`` text."""
    from horavento.functions.parse import hour_of
    h = F.col(hora)
    if dict(df.dtypes).get(hora) == "string":
        h = hour_of(hora)
    df = df.withColumn("hora", h).withColumn("ts", to_ts(data, "hora"))
    df = calendar_parts(df, "ts").withColumn("dia_semana", weekday_mon0("ts"))
    hs, hc = cyclic("hora", 24)
    ms, mc = cyclic("mes", 12)
    return df.withColumns({"hora_sin": hs, "hora_cos": hc, "mes_sin": ms, "mes_cos": mc})


def one_hot(df: DataFrame, col: str = "estacao", values: list[str] | None = None,
            prefix: str | None = None) -> DataFrame:
    """One int column per sorted distinct value; NULL -> all zeros.

    When ``values`` is not given the distinct values are read from the data.
    That list becomes the output schema, so this form is for small dimensions;
    training uses the sparse form of ``assemble_features``."""
    prefix = f"{col}_" if prefix is None else prefix
    if values is None:
        values = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect()]
    values = sorted(values)
    return df.withColumns({
        f"{prefix}{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0))
        for v in values
    })


def station_slug(col) -> Column:
    """Station name -> file-safe name: spaces and slashes -> ``_``."""
    return F.regexp_replace(_c(col), "[ /]", "_")


def station_title(col) -> Column:
    """File-safe name -> title-cased display name."""
    return F.initcap(F.regexp_replace(_c(col), "_", " "))


def radiation_log(col) -> Column:
    """log(1 + radiation)."""
    return F.log1p(_c(col))


def hour_of_day(col) -> Column:
    """Hour of a timestamp as int."""
    return F.hour(_c(col))
