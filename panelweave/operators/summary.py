"""Counts, shares, rankings and bins of a long observation table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.functions.rules import ordinal
from panelweave.functions.scalars import interval_label
from panelweave.operators.joins import left_join_renamed, natural_left_join


def count_by(df: DataFrame, *by: str) -> DataFrame:
    """Rows per group, the group of missing values included."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def count_sorted(df: DataFrame, *by: str) -> DataFrame:
    """Largest group first; equal counts in group order."""
    return count_by(df, *by).orderBy(
        F.desc("n"), *[F.col(c).asc_nulls_last() for c in by]
    )


def with_level_order(df: DataFrame, category: str, levels: Sequence[str]) -> DataFrame:
    """Add the ordinal of a category and sort by it; unknown categories last."""
    return df.withColumn("ord", ordinal(category, levels)).orderBy(
        F.col("ord").asc_nulls_last()
    )


def count_distinct_with_null(column: Column | str) -> Column:
    """Exact number of distinct values where missing is a value of its own."""
    column = F.col(column) if isinstance(column, str) else column
    has_null = F.coalesce(F.max(column.isNull().cast("long")), F.lit(0))
    return F.count_distinct(column) + has_null


def share_of_total(counts: DataFrame, n: str = "n", share: str = "prop") -> DataFrame:
    """Percentage of the grand total, read as a scalar subquery."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(share, F.col(n) / F.nullif(total, F.lit(0)) * 100)


def share_within(
    counts: DataFrame, by: Sequence[str], n: str = "n", share: str = "prop"
) -> DataFrame:
    """Percentage of the total of each group, missing groups included.

    The totals are aggregated and joined back instead of summed in a window: a
    window would gather a whole group, however large, in one task.
    """
    totals = counts.groupBy(*by).agg(F.sum(n).alias("__total"))
    percentage = F.col(n) / F.nullif(F.col("__total"), F.lit(0)) * 100
    return (
        natural_left_join([counts, totals], on=by).withColumn(share, percentage).drop("__total")
    )


def component_max(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Largest component per group; NULL when every component is missing."""
    return df.groupBy(*by).agg(F.max(value).alias("component_max"))


def component_sum(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Sum of the components per group; 0 when every component is missing."""
    return df.groupBy(*by).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("component_sum"))


def top_entities(
    counts: DataFrame, entity: str, n: int = 10, names: DataFrame | None = None
) -> DataFrame:
    """The ``n`` largest counts, equal counts in entity order, with display names.

    The names table is filtered by the ``n`` ranked entities before it is
    joined, so it is scanned but never shuffled.
    """
    top = counts.orderBy(F.desc("n"), F.col(entity).asc_nulls_last()).limit(n)
    if names is None:
        return top
    wanted = names.join(F.broadcast(top.select(entity)), entity, "left_semi")
    return top.join(wanted, entity, "left")


def entity_frequency(
    base: DataFrame,
    counts: DataFrame,
    base_key: str,
    counts_key: str,
    breaks: Sequence[float],
) -> DataFrame:
    """Every entity of the base with its count and bin; no data stays visible."""
    return left_join_renamed(base, counts, base_key, counts_key).withColumn(
        "bin", interval_label("n", breaks)
    )


def dataset_size(df: DataFrame) -> DataFrame:
    """Rows and columns of a dataset."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def preview(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First rows in an explicit order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
