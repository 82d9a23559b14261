"""Parsing and formatting of list, number and record text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom import schemas as S

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def comma_list(text: ColumnOrName) -> Column:
    """``'a,,b'`` to ``['a', '', 'b']``; blank entries stay."""
    return F.split(_c(text), ",")


def tag_list(tags: ColumnOrName) -> Column:
    """Drop the ``:weight`` of every tag and join the names with a pipe."""
    return F.array_join(F.transform(_c(tags), lambda t: F.substring_index(t, ":", 1)), "|")


def tag_list_from_commas(text: ColumnOrName) -> Column:
    return tag_list(comma_list(text))


def tag_list_from_words(text: ColumnOrName) -> Column:
    """Whitespace-separated tags; NULL counts as no tags."""
    words = F.btrim(F.coalesce(_c(text), F.lit("")), F.lit(" \t\n\r\f\x0b"))
    return tag_list(F.split(words, r"\s+"))


def rounded_text(number: ColumnOrName) -> Column:
    """``x + 0.5`` cut toward zero, as text: 2.5 gives 3, -1.7 gives -1."""
    return (_c(number).try_cast("double") + F.lit(0.5)).try_cast("bigint").cast("string")


def to_double(text: ColumnOrName) -> Column:
    """Text to double; text that is no number gives NULL instead of an ANSI error."""
    return _c(text).try_cast("double")


def to_whole(text: ColumnOrName, data_type: str = "bigint") -> Column:
    """Number text to an integer; a fraction (``'0.0'``) is cut off."""
    return _c(text).try_cast("double").try_cast(data_type)


def strip_newlines(text: ColumnOrName) -> Column:
    return F.btrim(_c(text), F.lit("\n"))


def typed_value(
    value_type: ColumnOrName, string_value: ColumnOrName, array_value: ColumnOrName, float_value: ColumnOrName
) -> Column:
    """Text of a feature value, parsed by its declared type; NULL when that member is absent."""
    kind = _c(value_type)
    return (
        F.when(kind == S.STRING_VALUE, _c(string_value))
        .when(kind == S.STRING_ARRAY_VALUE, tag_list(array_value))
        .when(kind == S.FLOAT_VALUE, rounded_text(float_value))
    )


def composite_key(content_id: ColumnOrName, device: ColumnOrName) -> Column:
    """Text key ``content_device`` for consumers that need one; joins use both columns."""
    return F.concat(_c(content_id), F.lit("_"), _c(device))


def key_content(key: ColumnOrName) -> Column:
    return F.substring_index(_c(key), "_", 1)


def key_device(key: ColumnOrName) -> Column:
    """All that follows the first underscore, so a device may hold one itself."""
    text = _c(key)
    return F.substr(text, F.instr(text, "_") + F.lit(1))


def record(*columns: ColumnOrName, sep: str = ",") -> Column:
    """Delimited record; a NULL prints as ``None`` and keeps its place.

    A value that holds the delimiter, a quote or a line break is quoted, quotes in it doubled.
    """
    def shown(c: ColumnOrName) -> Column:
        value = _c(c).cast("string")
        odd = value.contains(sep) | value.contains('"') | value.contains("\n") | value.contains("\r")
        quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(odd, quoted).otherwise(F.coalesce(value, F.lit("None")))

    return F.concat_ws(sep, *[shown(c) for c in columns])


def fixed_point(number: ColumnOrName) -> Column:
    """Six decimals, as C's ``%f``."""
    return F.format_string("%.6f", _c(number).cast("double"))


def usable_id(device: ColumnOrName) -> Column:
    """Not NULL, not blank and not ``'0'``."""
    return _c(device).isNotNull() & ~_c(device).isin("", "0")


def any_null(*columns: ColumnOrName) -> Column:
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in columns])
