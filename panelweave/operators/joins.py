"""Joins of the panel tables.

No join carries a broadcast hint: Spark broadcasts a side when its size, taken
from statistics or measured at run time, is below the session's threshold, and
otherwise sorts and merges, splitting skewed partitions of the larger side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.operators.select import shared_columns


def clean_lookup(lookup: DataFrame, key: str, label: str) -> DataFrame:
    """Lookup rows with a label, exact repeats removed so joins do not fan out."""
    return lookup.filter(F.col(label).isNotNull()).select(key, label).distinct()


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join to a lookup; rows without a match, NULL keys included, stay.

    Repeated lookup rows count once.
    """
    return df.join(lookup.distinct(), on, "left")


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs]
    )


def natural_left_join(frames: Sequence[DataFrame], on: Sequence[str] | None = None) -> DataFrame:
    """Left join several sheets on the columns all of them share.

    The first sheet drives: rows only present in later sheets are lost. Missing
    keys equal each other. A column shared by some but not all sheets is neither
    key nor unique and must be renamed by the caller.
    """
    keys = list(on) if on is not None else shared_columns(frames)
    joined = frames[0]
    for right in frames[1:]:
        clash = [c for c in right.columns if c in joined.columns and c not in keys]
        if clash:
            raise ValueError(f"columns shared by only some sheets: {', '.join(clash)}")
        renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
        condition = null_safe(joined, renamed, [(k, f"__right_{k}") for k in keys])
        joined = joined.join(renamed, condition, "left").drop(*[f"__right_{k}" for k in keys])
    return joined


def missing_entities(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Distinct expected entities that are not present.

    ``present`` may be an observation table; it is reduced to its entities
    before the shuffle, so an entity with many rows costs no more than another.
    Missing entities equal each other.
    """
    return not_covered(expected.select(key).distinct(), present, [key])


def available_entities(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows of ``expected`` whose entity is present."""
    return expected.join(present.select(key).distinct(), key, "left_semi")


def not_covered(candidates: DataFrame, covered: DataFrame, on: Sequence[str]) -> DataFrame:
    """Candidate rows whose key combination does not occur in ``covered``.

    Missing keys equal each other.
    """
    names = {k: f"__covered_{k}" for k in on}
    known = covered.select(*on).distinct().withColumnsRenamed(names)
    return candidates.join(known, null_safe(candidates, known, list(names.items())), "left_anti")


def left_join_renamed(
    base: DataFrame, other: DataFrame, base_key: str, other_key: str
) -> DataFrame:
    """Left join on differently named keys; the name used by the base survives."""
    return base.join(other.withColumnRenamed(other_key, base_key), base_key, "left")
