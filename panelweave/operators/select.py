"""Column and row selection that depends on the schema at hand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def select_by_type(
    df: DataFrame,
    ids: Sequence[str],
    dtype: type[T.DataType] = T.DoubleType,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Keep the id columns plus every column of one type, minus helper columns."""
    chosen = [
        f.name
        for f in df.schema.fields
        if f.name not in ids and isinstance(f.dataType, dtype) and f.name not in drop
    ]
    return df.select(*ids, *chosen)


def drop_optional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist; names that do not are no error."""
    return df.drop(*names)


def first_present(available: Sequence[str], candidates: Sequence[str], what: str = "name") -> str:
    """First *candidate* that exists; the order of the container is irrelevant."""
    for candidate in candidates:
        if candidate in available:
            return candidate
    raise ValueError(
        f"expected a {what} called {' or '.join(candidates)}, have {', '.join(available)}"
    )


def first_present_column(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The column that carries a value under whichever name this release uses."""
    return F.col(first_present(df.columns, candidates, "column"))


def columns_with_prefix(
    df: DataFrame, prefixes: Sequence[str], keep: Sequence[str] = ()
) -> list[str]:
    """Names starting with one of the prefixes (ignoring case), minus ``keep``."""
    lowered = tuple(prefix.lower() for prefix in prefixes)
    return [c for c in df.columns if c.lower().startswith(lowered) and c not in keep]


def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns from ``first`` to ``last`` by position, both included."""
    names = df.columns
    start, stop = names.index(first), names.index(last)
    return df.select(*names[start : stop + 1])


def relocate(df: DataFrame, names: Sequence[str], after: str | None = None) -> DataFrame:
    """Move columns to the front, or behind column ``after``."""
    others = [c for c in df.columns if c not in names]
    at = others.index(after) + 1 if after else 0
    return df.select(*others[:at], *names, *others[at:])


def shared_columns(frames: Sequence[DataFrame]) -> list[str]:
    """Names present in every frame, in the order of the first one."""
    rest = [set(frame.columns) for frame in frames[1:]]
    return [c for c in frames[0].columns if all(c in names for names in rest)]


def drop_placeholders(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remove rows in which every one of ``columns`` is missing."""
    return df.na.drop("all", subset=list(columns))


def column_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, to join or to filter with.

    They stay a DataFrame: a list of them on the driver would grow with the data.
    """
    return df.select(column).distinct()
