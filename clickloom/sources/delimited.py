"""Delimited text with declared types and a default for every empty field.

What the writers of this library write comes back as it was: outer spaces stay, an empty text is told apart
from a missing one, and line breaks inside values are escaped, so that a line is a row and files can be split.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S

#: An empty text is written as quotes, a missing value as nothing; no text reads as the text of code point 0.
TEXT_OPTIONS = {
    "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
READ_OPTIONS = {**TEXT_OPTIONS, "nullValue": "\0", "emptyValue": ""}
#: Where a line that does not fit the schema is kept.
BAD_LINE = "_bad_line"


def _texts(rows: DataFrame, leave: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in rows.schema if isinstance(f.dataType, T.StringType) and f.name not in leave]


def escape_lines(rows: DataFrame) -> DataFrame:
    """Backslashes and line breaks of all text columns as two characters each."""
    def escaped(c: str) -> Column:
        value = F.replace(F.col(f"`{c}`"), F.lit("\\"), F.lit("\\\\"))
        return F.replace(F.replace(value, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))

    return rows.withColumns({c: escaped(c) for c in _texts(rows)})


def unescape_lines(rows: DataFrame, *leave: str) -> DataFrame:
    """Undoes :func:`escape_lines` in all text columns but those to ``leave``."""
    def plain(c: str) -> Column:
        parts = F.split(F.col(f"`{c}`"), r"\\\\")
        breaks = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.when(F.contains(F.col(f"`{c}`"), F.lit("\\")), F.array_join(breaks, "\\")).otherwise(F.col(f"`{c}`"))

    return rows.withColumns({c: plain(c) for c in _texts(rows, leave)})


def fill_defaults(rows: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema}
    return rows.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(kinds[name])) for name, value in defaults.items()
    })


def parse_checked(
    lines: DataFrame,
    line: str | Column = "value",
    sep: str = ",",
    schema: T.StructType = S.SAMPLE_SCHEMA,
    defaults: dict[str, Any] | None = None,
) -> DataFrame:
    """Fields of lines in a column, all other columns, and the line itself in ``_bad_line`` if it does not fit.

    A line fits if it has as many fields as the schema, each of its type or empty. Empty lines are no rows,
    unless the schema has one field alone.
    """
    text = F.col(line) if isinstance(line, str) else line
    if len(schema) > 1:
        lines = lines.where(F.length(text) > 0)
    rest = [c for c in lines.columns if not (isinstance(line, str) and c == line)]
    fields = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema], T.StructField(BAD_LINE, T.StringType())])
    options = {"sep": sep, **READ_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    parsed = F.from_csv(text, fields.toDDL(), options)
    rows = unescape_lines(lines.select(*rest, parsed.alias("_row")).select(*rest, "_row.*"), BAD_LINE, *rest)
    return fill_defaults(rows, S.TRAINING_DEFAULTS if defaults is None else defaults)


def parse_delimited(lines: DataFrame, line: str | Column = "value", sep: str = ",",
                    schema: T.StructType = S.SAMPLE_SCHEMA, defaults: dict[str, Any] | None = None) -> DataFrame:
    """The lines that fit; empty fields take their defaults, bad lines take none and are left out."""
    return parse_checked(lines, line, sep, schema, defaults).where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def bad_lines(lines: DataFrame, line: str | Column = "value", sep: str = ",",
              schema: T.StructType = S.SAMPLE_SCHEMA) -> DataFrame:
    """The other lines, with all other columns."""
    checked = parse_checked(lines, line, sep, schema, {})
    return checked.where(F.col(BAD_LINE).isNotNull()).drop(*schema.fieldNames())


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: T.StructType = S.SAMPLE_SCHEMA,
    defaults: dict[str, Any] | None = None,
) -> DataFrame:
    """Training text files; empty fields take their defaults, lines that do not fit are left out (see ``read_bad_lines``)."""
    return parse_delimited(spark.read.text(path), "value", sep, schema, defaults)


def read_bad_lines(spark: SparkSession, path: str | list[str], sep: str = ",",
                   schema: T.StructType = S.SAMPLE_SCHEMA) -> DataFrame:
    """The lines of text files that ``read_delimited`` leaves out."""
    return bad_lines(spark.read.text(path), "value", sep, schema)
