"""Tidy the three wide indicator sheets of a release into long estimates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from panelweave.functions.rules import TypeRule
from panelweave.functions.vocabulary import (
    HELPER_COLUMNS,
    INDICATOR_ID_COLUMNS,
    INDICATOR_PREFIXES,
    INDICATOR_TYPE_RULES,
    derive_service,
    normalize_codes,
    strip_suffix,
    tidy_residence,
)
from panelweave.operators.audit import lookup_coverage, unmatched_codes
from panelweave.operators.codes import vocabulary_of
from panelweave.operators.joins import clean_lookup, natural_left_join
from panelweave.operators.reshape import explode_labels, unpivot_columns
from panelweave.operators.select import columns_with_prefix, drop_optional, relocate, select_by_type
from panelweave.sources.tables import small_table


@dataclass(frozen=True)
class TidyIndicators:
    """Long estimates, and what the lookup did not know."""

    estimates: DataFrame
    unmatched: DataFrame
    coverage: DataFrame


def classify_codes(
    codes: DataFrame,
    lookup: DataFrame,
    code: str = "code",
    rules: Sequence[TypeRule] = INDICATOR_TYPE_RULES,
) -> DataFrame:
    """Everything that follows from a variable code, one row per indicator type.

    ``codes`` holds distinct codes: the rules run once per code, not per row.
    """
    labelled = codes.withColumn("var_short", normalize_codes(code)).join(lookup, "var_short")
    named = labelled.withColumns(
        {
            "residence": tidy_residence("var_short"),
            "var_short": strip_suffix("var_short"),
        }
    ).withColumn("service", derive_service("var_short"))
    typed = explode_labels(named, "var_short", "service", "var_long", rules)
    return typed.select(code, "var_short", "residence", "service", "indicator_type", "indicator")


def classify_rows(rows: DataFrame, code: str, lookup: DataFrame) -> DataFrame:
    """Classify a long table whose codes are values: rows gain one row per type.

    The distinct codes of the table are classified once and joined to its rows.
    """
    return rows.join(classify_codes(vocabulary_of(rows, code), lookup, code), code)


def tidy_indicators(
    sheets: Sequence[DataFrame],
    lookup: DataFrame,
    ids: Sequence[str] = ("name", "iso3"),
    id_columns: Sequence[str] = tuple(INDICATOR_ID_COLUMNS),
    prefixes: Sequence[str] = tuple(INDICATOR_PREFIXES),
    helpers: Sequence[str] = tuple(HELPER_COLUMNS),
    dropped: Sequence[str] = ("sl",),
    join_on: Sequence[str] | None = None,
) -> TidyIndicators:
    """Wide sheets → one row per entity, year, residence and indicator.

    Variable codes are column names, known while the plan is built. They are
    harmonised, labelled and classified as a table of their own with one row per
    column, and the rows of the unpivoted sheets only look their code up there.
    Missing percentages are kept; columns the lookup does not know, or that
    belong to no indicator type, are left out of the estimates.
    """
    spark = sheets[0].sparkSession
    numeric = [select_by_type(sheet, ids, drop=helpers) for sheet in sheets]
    wide = relocate(drop_optional(natural_left_join(numeric, join_on), dropped), list(ids))
    values = columns_with_prefix(wide, prefixes, keep=id_columns)

    known = clean_lookup(lookup, "var_short", "var_long")
    codes = small_table(spark, [(c,) for c in values], "code string")
    classified = classify_codes(codes, known)
    normalized = codes.select(normalize_codes("code").alias("var_short"))

    long = unpivot_columns(wide, values, "code", "percent")
    # One row per column and indicator type: bounded by the width of the sheets.
    estimates = long.join(F.broadcast(classified), "code").drop("code")
    return TidyIndicators(
        estimates=estimates,
        unmatched=unmatched_codes(normalized, known, "var_short"),
        coverage=lookup_coverage(normalized, known, "var_short"),
    )
