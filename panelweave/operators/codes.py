"""Run rules once per distinct code instead of once per row."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

CodeRule = Callable[[Column], Column]


def vocabulary_of(df: DataFrame, code: str) -> DataFrame:
    """The distinct non-NULL codes of a table."""
    return df.select(code).filter(F.col(code).isNotNull()).distinct()


def map_codes(
    df: DataFrame, code: str, rules: Mapping[str, CodeRule], once_per_code: bool = True
) -> DataFrame:
    """Add columns that follow from a code; a NULL code gives NULL everywhere.

    A long chain of regular expressions costs far more than a lookup, so the rules
    run over the distinct codes and the rows join the result. Spark broadcasts it
    when it turns out small, and splits the join at common codes otherwise. ``df``
    is read once more for the code column: apply this close to a scan, or let the
    rules run on the rows (``once_per_code=False``), which gives the same.
    """
    if not once_per_code:
        known = F.col(code).isNotNull()
        return df.withColumns({name: F.when(known, rule(F.col(code))) for name, rule in rules.items()})
    # There is one row per code; as aggregates, the rules stay above the distinct
    # codes even when a filter on their results is pushed down.
    mapped = vocabulary_of(df, code).groupBy(code).agg(
        *[F.max_by(rule(F.col(code)), F.lit(1)).alias(name) for name, rule in rules.items()]
    )
    return df.join(mapped, code, "left")


def count_codes(df: DataFrame, code: str) -> DataFrame:
    """Rows per code; what follows from the code can then be counted cheaply."""
    return df.groupBy(code).agg(F.count("*").alias("n"))


def count_mapped(df: DataFrame, code: str, rules: Mapping[str, CodeRule]) -> DataFrame:
    """Rows per combination of facts derived from a code.

    Counts per code first, so the rules and the second aggregate only see one
    row per code.
    """
    derived = count_codes(df, code).select(
        *[rule(F.col(code)).alias(name) for name, rule in rules.items()], "n"
    )
    return derived.groupBy(*rules).agg(F.sum("n").alias("n"))
