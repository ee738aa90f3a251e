"""Scalar functions of the model, as column expressions; `register` offers two of them in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

def ext_id(c: Column) -> Column:
    """Text to BIGINT: the first 16 hex digits of its MD5 as a signed number."""
    return F.conv(F.substring(F.md5(c), 1, 16), 16, -10).cast("bigint")


def attr_text(c: Column) -> Column:
    """The text of a JSON scalar; a JSON string is decoded, anything that is no JSON comes back as it is."""
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v"), c)


def json_text(c: Column, key: str) -> Column:
    """The value of a key that may contain dots, of the object `attributes` of a satellite."""
    return F.get_json_object(c, f"$.attributes['{key}']")


def bare_id(c: Column) -> Column:
    """An id without the `#<number>` of a split copy."""
    return F.regexp_replace(c, "#[0-9]+$", "")


def reference_id(c: Column) -> Column:
    """The id a reference points to: what follows the last `#`, without one leading `_`."""
    return F.regexp_replace(F.substring_index(c, "#", -1), "^_", "")


def station_kind(c: Column) -> Column:
    """Container type by the name of the station's category, whatever its case and blanks; without one a substation."""
    return F.when(F.regexp_replace(F.lower(c), r"\s+", "") == "distributionbox", "distribution-box").otherwise("substation")


def mapped(c: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in mapping.items():
        out = out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default))


def nominal_kv(name: Column) -> Column:
    """Nominal voltage in kV from the name of a voltage level: a number before `KV` at the end, or after `VL` or `VL_` at the beginning."""
    up = F.upper(name)
    number = lambda c: F.nullif(c, F.lit("")).try_cast("double")
    return F.coalesce(number(F.regexp_extract(up, r"([0-9]+(?:\.[0-9]+)?)\s*KV\s*$", 1)), number(F.regexp_extract(up, r"^VL_?([0-9]+(?:\.[0-9]+)?)(?:_|$)", 1)))


def number_or(c: Column, default: float | None) -> Column:
    """A literal as a number, or the default where it is none."""
    text = F.trim(c)
    fits = text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.coalesce(F.when(fits, text.try_cast("double")), F.lit(default).cast("double"))


_DUMP = r"^Gesamtdatenexport_([0-9]{8})_([0-9]+(?:\.[0-9]+)*)\.zip$"


def dump_date(file_name: Column) -> Column:
    """The day in the name of a register dump (`<fixed name>_yyyyMMdd_<version>.zip`); null for any other name or no such day."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(file_name, _DUMP, 1), F.lit("")), F.lit("yyyyMMdd")).cast("date")


def dump_version(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, _DUMP, 2), F.lit(""))


def rfc3339(c: Column) -> Column:
    """A timestamp as text in UTC, whole seconds: `2024-01-31T12:00:00Z`."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def from_rfc3339(c: Column) -> Column:
    """The timestamp in such a text, with `Z` or an offset; null if it is none."""
    good = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$")
    return F.when(good, c.try_cast("timestamp"))


def truthy(c: Column) -> Column:
    """`true`, `1` and `yes` in any letter case, with blanks around."""
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1", "yes"), F.lit(False))


def like_text(c: Column, term: str) -> Column:
    """Whether a column contains a term, in any letter case; `%` and `_` in the term stand for themselves."""
    return F.contains(F.lower(c), F.lit(term.lower()))


def register(spark: SparkSession) -> None:
    """SQL functions ext_id(text) and attr_text(json)."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION ext_id(x STRING) RETURNS BIGINT RETURN CAST(conv(substr(md5(x), 1, 16), 16, -10) AS BIGINT)")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION attr_text(x STRING) RETURNS STRING RETURN coalesce(get_json_object(concat('{"v":', x, '}'), '$.v'), x)""")
