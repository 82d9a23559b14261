"""Nested records of the run log: parameters, metrics, sorted name/value lists, time text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom import schemas as S

UTC_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _in_utc(ts: Column) -> Column:
    """Wall time in UTC: timestamps with a zone are moved from the session's, those without are UTC already."""
    return F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("timestamp")).otherwise(
        F.to_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def utc_text(ts: Column) -> Column:
    """``2018-06-25T21:08:27.516000Z``, whatever the session's time zone."""
    return F.date_format(_in_utc(ts), UTC_TEXT)


def sorted_entries(text_map: Column) -> Column:
    """A map as a name-sorted array of ``{name, value}``; NULL and empty give ``[]``."""
    entries = F.transform(
        F.map_entries(text_map),
        lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")),
    )
    return F.coalesce(F.array_sort(entries), F.array().cast(f"array<{S.NAME_VALUE.simpleString()}>"))


def run_parameter(name: Column, value: Column) -> Column:
    """One parameter record; the text of the value decides which member holds it."""
    is_bool = value.isin("True", "False")
    is_long = value.rlike(r"^[+-]?[0-9]+$") & value.try_cast("bigint").isNotNull()
    is_float = ~is_bool & ~is_long & value.try_cast("double").isNotNull()
    return F.struct(
        name.alias("name"),
        F.when(~is_bool & ~is_long & ~is_float, value).alias("string_value"),
        F.when(is_long, value.try_cast("bigint")).alias("long_value"),
        F.when(is_bool, value).alias("bool_value"),
        F.when(is_float, value.try_cast("double")).alias("float_value"),
    )


def run_parameters(text_map: Column) -> Column:
    """All parameters of a run, sorted by name."""
    return F.transform(
        F.array_sort(F.map_entries(text_map)), lambda e: run_parameter(e["key"], e["value"])
    )


def hour_of(ts: Column, back: int = 0) -> tuple[Column, Column]:
    """Partition values ``ds``, ``hh``, in UTC, of the hour ``back`` hours before ``ts``."""
    moved = _in_utc(ts)
    moved = moved - F.make_interval(hours=F.lit(back)) if back else moved
    return F.date_format(moved, "yyyy-MM-dd"), F.date_format(moved, "HH")
