"""Ordered rule tables turned into plain Catalyst expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column, functions as F


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


@dataclass(frozen=True)
class Rewrite:
    """Replace the part of a code that ``pattern`` matches.

    Patterns must be anchored: an anchored pattern matches at most once, so
    "replace the first match" and "replace all matches" are the same thing.
    """

    pattern: str
    replacement: str

    def __post_init__(self) -> None:
        if not (self.pattern.startswith("^") or self.pattern.endswith("$")):
            raise ValueError(f"rewrite pattern is not anchored: {self.pattern}")


@dataclass(frozen=True)
class Rule:
    """A code that contains a match of ``pattern`` belongs to ``label``."""

    pattern: str
    label: str


@dataclass(frozen=True)
class TypeRule:
    """Codes of ``service`` matching ``pattern`` carry a label of type ``name``."""

    service: str
    name: str
    pattern: str


def rewrite(column: Column | str, rewrites: Sequence[Rewrite]) -> Column:
    """Apply the rewrites one after the other, each on the previous result."""
    return reduce(
        lambda col, rw: F.regexp_replace(col, rw.pattern, rw.replacement),
        rewrites,
        as_column(column),
    )


def first_match(column: Column | str, rules: Sequence[Rule]) -> Column:
    """Label of the first rule that matches; NULL for no match or a NULL code."""
    column = as_column(column)
    first, *rest = rules
    branches = F.when(column.rlike(first.pattern), first.label)
    for rule in rest:
        branches = branches.when(column.rlike(rule.pattern), rule.label)
    return branches


def map_values(column: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace mapped values and let everything else, NULL included, through."""
    column = as_column(column)
    return F.coalesce(lookup_value(column, mapping), column)


def lookup_value(column: Column | str, mapping: Mapping[str, str]) -> Column:
    """Value of ``mapping`` for the column, NULL where the key is unknown."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return pairs[as_column(column)]


def ordinal(column: Column | str, levels: Sequence[str]) -> Column:
    """1-based position in the ordered category; NULL for unknown or NULL."""
    position = F.array_position(F.array(*[F.lit(level) for level in levels]), as_column(column))
    return F.when(position > 0, position.cast("int"))


def typed_labels(
    code: Column | str,
    service: Column | str,
    label: Column | str,
    rules: Sequence[TypeRule],
) -> Column:
    """Array of ``(indicator_type, indicator)`` for every rule the code satisfies."""
    code, service, label = as_column(code), as_column(service), as_column(label)
    candidates = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("indicator_type"),
                F.when(
                    (service == rule.service) & code.rlike(rule.pattern), label
                ).alias("indicator"),
            )
            for rule in rules
        ]
    )
    return F.filter(candidates, lambda entry: entry["indicator"].isNotNull())
