"""Data dictionary: describe and check the columns of a dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelweave.sources.tables import small_table

# Dictionary type names and the Spark types that satisfy them (fixed values).
DICTIONARY_TYPES = {
    "character": ["string"],
    "integer": ["int", "bigint"],
    "numeric": ["double", "float"],
    "factor": ["string"],
    "logical": ["boolean"],
    "date": ["date", "timestamp", "timestamp_ntz"],
}


def dictionary_for(dictionary: DataFrame, dataset: str, file_column: str = "file_name") -> DataFrame:
    """Entries of one dataset."""
    return dictionary.filter(F.col(file_column) == dataset)


def check_dictionary(
    spark: SparkSession, df: DataFrame, entries: Sequence[tuple[str, str]]
) -> DataFrame:
    """Compare a schema with its dictionary, one row per documented column."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [
        (
            position,
            name,
            documented,
            actual.get(name),
            actual.get(name) in DICTIONARY_TYPES.get(documented, []),
        )
        for position, (name, documented) in enumerate(entries, start=1)
    ]
    return small_table(
        spark,
        rows,
        "position int, variable_name string, variable_type string, actual_type string, "
        "matches boolean",
    )


def undocumented_columns(df: DataFrame, entries: Sequence[tuple[str, str]]) -> list[str]:
    documented = {name for name, _ in entries}
    return [c for c in df.columns if c not in documented]


def with_comments(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """Attach descriptions to the columns as schema metadata."""
    for name, text in descriptions.items():
        if name in df.columns:
            df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def columns_as_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Position, name and number of present values of every column of every table.

    Each table is scanned once by a single aggregate that yields one row; the
    rows of all tables are stacked, names that occur in several stay repeated.
    """
    stacked = None
    for table, df in tables.items():
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        entries = F.array(
            *[
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(i).alias("position"),
                    F.lit(c).alias("column_name"),
                    F.col(f"`{c}`").alias("n_values"),
                )
                for i, c in enumerate(df.columns, start=1)
            ]
        )
        rows = counts.select(F.inline(entries))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked
