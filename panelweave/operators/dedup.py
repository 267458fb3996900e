"""Distinct rows and keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int = 1
) -> DataFrame:
    """First row (or first ``n`` rows) per key in the given order.

    Limiting a row number lets Spark prune to ``n`` rows per key before the
    shuffle as well as after it, so a key that holds most rows costs its final
    task only ``n`` rows per input partition. ``order_by`` must end in a unique
    column for the result not to depend on the order of the input.
    """
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n).drop(rank)


def keep_newest_edition(
    df: DataFrame,
    keys: Sequence[str],
    edition: Column | str,
    tie_break: Sequence[Column],
) -> DataFrame:
    """Newest edition per key; a missing edition is the oldest of all."""
    edition = F.col(edition) if isinstance(edition, str) else edition
    return keep_first(df, keys, [edition.desc_nulls_last(), *tie_break])


def collapsed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a collapse to one row per key would drop."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count("*").alias("n_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_dropped"),
        )
    )
