"""Wide to long, long to wide, and row assembly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.functions.rules import TypeRule, typed_labels
from panelweave.operators.joins import missing_entities


def unpivot_columns(
    df: DataFrame,
    values: Sequence[str],
    name_column: str = "var_short",
    value_column: str = "value",
    drop_null: bool = False,
) -> DataFrame:
    """One row per listed column; every other column is an id of the row.

    Text that is not a number becomes NULL.
    """
    if not values:
        raise ValueError("no columns to unpivot")
    chosen = set(values)
    ids = [c for c in df.columns if c not in chosen]
    widened = df.select(*ids, *[F.col(c).try_cast("double").alias(c) for c in values])
    long = widened.unpivot(ids, list(values), name_column, value_column)
    return long.filter(F.col(value_column).isNotNull()) if drop_null else long


def count_by_status(
    df: DataFrame, by: Sequence[str], status: str, domain: Sequence[str], prefix: str = "n_"
) -> DataFrame:
    """Counts per group, one column per status of a known domain, missing → 0."""
    return df.groupBy(*by).agg(
        *[F.count_if(F.col(status) == value).alias(prefix + value) for value in domain]
    )


def explode_labels(
    df: DataFrame, code: str, service: str, label: str, rules: Sequence[TypeRule]
) -> DataFrame:
    """One row per indicator type a code belongs to; unclassified codes vanish."""
    return df.select(
        "*", F.inline(typed_labels(F.col(code), F.col(service), F.col(label), rules))
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; absent columns become NULL, repeats stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_placeholders(
    observations: DataFrame, entities: DataFrame, present: DataFrame, key: str
) -> DataFrame:
    """Add one otherwise empty row for every entity without any observation."""
    return union_all([observations, missing_entities(entities, present, key)])


def as_map(df: DataFrame, key: str, value: str, domain: Sequence[str]) -> DataFrame:
    """One row with a name → value map over a known domain; absent names are NULL."""
    picked = [F.max(F.when(F.col(key) == name, F.col(value))).alias(name) for name in domain]
    pairs = [part for name in domain for part in (F.lit(name), F.col(f"`{name}`"))]
    return df.agg(*picked).select(F.create_map(*pairs).alias("totals"))


def any_present(columns: Sequence[str]) -> Column:
    """True where at least one of the columns carries a value; text that is no number is none."""
    return F.coalesce(*[F.col(c).try_cast("double") for c in columns]).isNotNull()
