"""Scalar column functions (F1-F27): built-in Spark expressions only."""

from horavento.functions.parse import (
    hour_of, normalize_header, null_sentinel, parse_decimal, parse_obs_date,
    parse_obs_ts, parse_raw_name, parse_result_name, decode_text,
)
from horavento.functions.temporal import (
    calendar_parts, cyclic, epoch_ms, hour_of_day, one_hot, radiation_log,
    station_slug, station_title, temporal_features, to_ts, weekday_mon0,
)
from horavento.functions.telemetry import (
    json_field, model_info, bytes_to_mb, residuals, success_rate, to_long,
    to_payload, value_map, interactions, run_station,
)

__all__ = [
    "hour_of", "normalize_header", "null_sentinel", "parse_decimal", "parse_obs_date",
    "parse_obs_ts", "parse_raw_name", "parse_result_name", "decode_text",
    "calendar_parts", "cyclic", "epoch_ms", "hour_of_day", "one_hot", "radiation_log",
    "station_slug", "station_title", "temporal_features", "to_ts", "weekday_mon0",
    "json_field", "model_info", "bytes_to_mb", "residuals", "success_rate", "to_long",
    "to_payload", "value_map", "interactions", "run_station",
]
