"""Small column expressions used by the plans."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from panelweave.functions.rules import as_column

NO_DATA = "No Data"


def strip_trailing_digits(column: Column | str) -> Column:
    """``CEN00`` → ``CEN``; an all-digit text becomes empty, not NULL."""
    return F.regexp_replace(as_column(column), "[0-9]+$", "")


def population_by_residence(
    residence: Column | str, population_thousands: Column | str, urban_percent: Column | str
) -> Column:
    """Head count of the residence group, NULL for an unknown residence."""
    residence = as_column(residence)
    people = as_column(population_thousands) * 1000
    urban = as_column(urban_percent)
    return (
        F.when(residence == "national", people)
        .when(residence == "urban", people * urban / 100)
        .when(residence == "rural", people * (100 - urban) / 100)
    )


def _plain(number: float) -> str:
    return str(int(number)) if float(number).is_integer() else str(number)


def interval_label(value: Column | str, breaks: Sequence[float]) -> Column:
    """Left-closed bin ``[a, b)`` of a count.

    ``math.inf`` as last break opens the top bin; without it the last bin is
    closed and larger values fall outside, which like a missing value gives
    :data:`NO_DATA`.
    """
    value = as_column(value)
    branches = None
    for i, (low, high) in enumerate(zip(breaks, breaks[1:])):
        if math.isinf(high):
            inside, label = value >= low, f"{_plain(low)} or more"
        else:
            closed = i == len(breaks) - 2
            inside = (value >= low) & ((value <= high) if closed else (value < high))
            label = f"{_plain(low)} to {'' if closed else '<'}{_plain(high)}"
        branches = F.when(inside, label) if branches is None else branches.when(inside, label)
    return branches.otherwise(NO_DATA)


def capture_date(timestamp: Column | str) -> Column:
    """Date of a 14-digit capture timestamp (``yyyyMMddHHmmss``)."""
    return F.try_to_timestamp(as_column(timestamp), F.lit("yyyyMMddHHmmss")).cast("date")


def pair_label(old: Column | str, new: Column | str) -> Column:
    return F.concat_ws("_vs_", as_column(old), as_column(new))


def with_thousands(number: Column | str) -> Column:
    return F.format_number(as_column(number), 0)


def iso_date(column: Column | str, default: str | None = None) -> Column:
    """A date or time as ``yyyy-MM-dd`` text; a missing one is the ``default`` day, if one is given.

    The default is a parameter and never the day of the run, so that a run can be repeated.
    """
    text = F.date_format(as_column(column), "yyyy-MM-dd")
    return text if default is None else F.coalesce(text, F.lit(default))
