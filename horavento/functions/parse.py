"""Parsing of raw text fields: hours, dates, decimals, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from horavento.schemas import RAW_MISSING, RESULT_PREFIX


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decode_text(content) -> Column:
    """Bytes -> text: UTF-8 when the bytes are valid UTF-8, else Latin-1."""
    content = _c(content)
    return (F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8"))
            .otherwise(F.decode(content, "ISO-8859-1")))


def hour_of(hora) -> Column:
    """``"HHMM UTC"`` -> hour as int; malformed -> NULL (F1)."""
    return F.substring(F.trim(_c(hora)), 1, 2).try_cast("int")


def parse_obs_date(col) -> Column:
    """``YYYY/MM/DD`` (or ``YYYY-MM-DD``) -> date; invalid -> NULL."""
    return F.try_to_date(F.regexp_replace(F.trim(_c(col)), "/", "-"), "yyyy-M-d")


def parse_obs_ts(data, hora) -> Column:
    """``YYYY/MM/DD`` + ``HHMM UTC`` -> timestamp without zone; invalid -> NULL."""
    text = F.concat_ws(" ", F.trim(_c(data)), F.substring(F.trim(_c(hora)), 1, 4))
    return F.try_to_timestamp(text, F.lit("yyyy/MM/dd HHmm")).cast("timestamp_ntz")


def null_sentinel(col, sentinel: str = RAW_MISSING) -> Column:
    """Blank or sentinel text -> NULL."""
    t = F.trim(_c(col))
    return F.when((t == "") | (t == F.lit(sentinel)), F.lit(None).cast("string")).otherwise(t)


def parse_decimal(col, keep_sentinel: bool = False) -> Column:
    """Decimal-comma text -> double; empty, junk, NaN -> NULL.

    The sentinel ``-9999`` becomes NULL unless ``keep_sentinel`` (T2)."""
    text = F.trim(_c(col)) if keep_sentinel else null_sentinel(col)
    v = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


# Result file names look like <prefix><STATION>[_Modelo_<TYPE>].csv; the
# station keeps inner underscores (ARCO_VERDE), the model suffix is optional.
_RESULT_RE = "^" + RESULT_PREFIX + r"(.+?)(?:_Modelo_([^.]+))?\.csv$"


def parse_result_name(col) -> Column:
    """Result file name -> struct(estacao, modelo); model NULL when absent."""
    name = F.regexp_replace(_c(col), r"^.*/", "")
    est = F.regexp_extract(name, _RESULT_RE, 1)
    mod = F.regexp_extract(name, _RESULT_RE, 2)
    return F.struct(F.nullif(est, F.lit("")).alias("estacao"),
                    F.nullif(mod, F.lit("")).alias("modelo"))


# Raw names: <...>_A###_<CITY>_DD-MM-YYYY_A_DD-MM-YYYY.CSV; city may hold spaces.
_RAW_RE = r"_(A\d{3})_(.+?)_\d{2}-\d{2}-(\d{4})_A_"


def parse_raw_name(col, title: bool = False) -> Column:
    """Raw station file name -> struct(codigo, cidade, ano)."""
    name = F.regexp_replace(_c(col), r"^.*/", "")
    code = F.nullif(F.regexp_extract(name, _RAW_RE, 1), F.lit(""))
    city = F.nullif(F.regexp_extract(name, _RAW_RE, 2), F.lit(""))
    if title:
        city = F.initcap(F.regexp_replace(city, "_", " "))
    year = F.nullif(F.regexp_extract(name, _RAW_RE, 3), F.lit("")).try_cast("int")
    return F.struct(code.alias("codigo"), city.alias("cidade"), year.alias("ano"))


# --- fixed values: accented letters and their plain forms (header normaliser) --
_ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
_PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCN"


def normalize_header(col) -> Column:
    """Upper-case and strip accents."""
    return F.translate(F.upper(_c(col)), _ACCENTED, _PLAIN)
