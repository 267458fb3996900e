"""Schemas of the panel tables and the projections that pin columns to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

# Observations as compared between releases: the identity key plus the value.
RAW_KEY = ["iso3", "source", "type", "year", "var_short"]
RAW_SCHEMA = _struct(
    ("iso3", _S), ("source", _S), ("type", _S), ("year", _I), ("var_short", _S), ("value", _D)
)

# Estimates as compared between releases.
INDICATOR_KEY = ["iso3", "year", "residence", "var_short", "indicator_type"]
INDICATOR_SCHEMA = _struct(
    ("iso3", _S), ("year", _I), ("residence", _S), ("var_short", _S), ("indicator_type", _S),
    ("percent", _D),
)

MANIFEST_SCHEMA = _struct(
    ("release_id", _S), ("snapshot_date", _S), ("pipeline", _S), ("file", _S), ("source", _S),
    ("notes", _S),
)

MISSING_TEXT = "NA"
# Quotes inside a text are doubled, as other CSV tools write and expect them; line
# breaks and blanks at either end of a text are kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def quoted(name: str) -> str:
    """A column name as an expression, whatever signs it holds."""
    return f"`{name.replace('`', '``')}`"


def nan_to_null(column: Column | str) -> Column:
    """Missing numbers are NULL inside the library, never NaN."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(column), column)


def blank_to_null(column: Column | str) -> Column:
    """The text exports spell a missing value ``NA`` or leave it empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(~column.isin(MISSING_TEXT, ""), column)


def clean_missing(df: DataFrame) -> DataFrame:
    """Turn ``NA``/empty text and NaN into NULL in every column of ``df``."""
    cleaned = []
    for field in df.schema.fields:
        column = F.col(quoted(field.name))
        if isinstance(field.dataType, T.StringType):
            column = blank_to_null(column)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = nan_to_null(column)
        cleaned.append(column.alias(field.name))
    return df.select(*cleaned)


def cast_project(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Select the columns of ``schema``; values that do not convert become NULL.

    Fractions are truncated towards zero when the target is an integer, text
    numbers included (``"2015.0"`` reads as 2015). Columns named in ``keep`` are
    passed on unchanged.
    """
    source = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType) and isinstance(
            source[field.name], T.StringType
        ):
            column = column.try_cast("double")
        column = column.try_cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            column = nan_to_null(column)
        columns.append(column.alias(field.name))
    return df.select(*columns, *keep)
