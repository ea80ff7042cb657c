"""Telemetry payloads, lookups and small derived measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from horavento.functions.parse import _c
from horavento.schemas import MODEL_TYPES


def value_map(cols: list[str], keep_nulls: bool = False) -> Column:
    """Measures -> ``map<string,double>``; NULL values dropped unless ``keep_nulls``."""
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                          F.array(*[F.col(c).cast("double") for c in cols]))
    return m if keep_nulls else F.map_filter(m, lambda k, v: v.isNotNull())


def to_payload(ts, values) -> Column:
    """Telemetry point as JSON text ``{"ts":..,"values":{..}}``."""
    return F.to_json(F.struct(_c(ts).alias("ts"), _c(values).alias("values")))


def residuals(df: DataFrame, real: str = "temperatura_real",
              pred: str = "temperatura_prevista") -> DataFrame:
    """Prediction error and absolute error."""
    e = F.col(real) - F.col(pred)
    return df.withColumns({"erro_predicao": e, "erro_absoluto": F.abs(e)})


def model_info(col) -> tuple[Column, Column]:
    """Model type suffix -> (description, complexity) via a literal map."""
    desc = F.create_map(*[x for k, (d, _) in MODEL_TYPES.items() for x in (F.lit(k), F.lit(d))])
    comp = F.create_map(*[x for k, (_, c) in MODEL_TYPES.items() for x in (F.lit(k), F.lit(c))])
    return F.try_element_at(desc, _c(col)), F.try_element_at(comp, _c(col))


def bytes_to_mb(col) -> Column:
    """Bytes -> megabytes rounded to 2 places."""
    return F.round(_c(col).cast("double") / F.lit(1048576.0), 2)


def json_field(col, path: str, cast: str | None = None) -> Column:
    """Field of a JSON text column."""
    v = F.get_json_object(_c(col), path)
    return v.try_cast(cast) if cast else v


def success_rate(ok, n) -> Column:
    """ok / n * 100 with a zero guard."""
    return (F.when(_c(n) > 0, _c(ok).cast("double") / _c(n).cast("double") * F.lit(100.0))
            .otherwise(F.lit(0.0)))


def to_long(df: DataFrame, ids: list[str], cols: list[str],
            key: str = "chave", value: str = "valor") -> DataFrame:
    """Wide -> long (measure, value)."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(ids, cols, key, value)


def interactions(df: DataFrame) -> DataFrame:
    """Temperature x humidity x wind interaction features."""
    t, u, v = F.col("temperatura"), F.col("umidade"), F.col("velocidade_vento")
    return df.withColumns({"temp_x_umid": t * u, "temp_x_vento": t * v,
                           "umid_x_vento": u * v})


def _part_contains(parts: Column, kw: str):
    # one-argument lambda: Spark reads a two-argument one as (element, index)
    return lambda i: F.lower(F.try_element_at(parts, i)).contains(kw)


def _name_rule(run_name: Column) -> Column:
    """Station from a run name: ``processed_data_<STATION>[_<date>_<time>]`` first,
    then the part after the first part holding a keyword (F15)."""
    parts = F.split(run_name, "_")
    n = F.size(parts)
    last_is_digit = F.try_element_at(parts, F.lit(-1)).rlike("^[0-9]+$")
    processed = F.when(
        run_name.contains("processed_data_") & (n >= 3),
        F.array_join(F.when(last_is_digit, F.slice(parts, 3, F.greatest(n - 4, F.lit(0))))
                     .otherwise(F.slice(parts, 3, F.greatest(n - 2, F.lit(0)))), "_"))
    idx = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    keyword = None
    for kw in ["imputacao", "imputation", "estacao", "station"]:
        hits = F.filter(idx, _part_contains(parts, kw))
        first = F.try_element_at(hits, F.lit(1))
        found = F.when(F.lower(run_name).contains(kw) & (F.size(hits) > 0) & (first < n),
                       F.try_element_at(parts, first + 1))
        # a keyword in the name but with nothing after it falls through to the next
        keyword = found if keyword is None else F.coalesce(keyword, found)
    return F.coalesce(processed, keyword)


def run_station(tags="tags", params="params", run_name="run_name") -> Column:
    """Run -> station: tags, then params, then name rules, in that order."""
    t, p, name = _c(tags), _c(params), _c(run_name)
    return F.coalesce(F.try_element_at(t, F.lit("station")),
                      F.try_element_at(t, F.lit("station_name")),
                      F.try_element_at(p, F.lit("station_name")),
                      F.when(name.isNotNull(), _name_rule(name)))
