"""Tidy per-entity sheets into long raw observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelweave.functions.vocabulary import (
    OBSERVATION_PREFIXES,
    classify_stage,
    derive_residence,
    derive_residence_legacy,
)
from panelweave.operators.joins import available_entities, lookup_join
from panelweave.operators.reshape import any_present, union_all, unpivot_columns
from panelweave.operators.select import columns_with_prefix

CONTEXT_COLUMNS = ["source", "type", "year"]


def classify_variables(variables: DataFrame) -> DataFrame:
    """Residence, legacy residence and stage of each listed raw variable."""
    return (
        variables.filter(F.col("var_short").startswith("s_"))
        .select("var_short", "var_long")
        .distinct()
        .select(
            "var_short",
            "var_long",
            derive_residence("var_short").alias("residence"),
            derive_residence_legacy("var_short").alias("residence_legacy"),
            classify_stage("var_short").alias("san_service_chain"),
        )
    )


def tidy_observations(
    sheets: DataFrame,
    entities: DataFrame,
    variables: DataFrame,
    entity: str = "iso3",
    context: Sequence[str] = tuple(CONTEXT_COLUMNS),
    prefixes: Sequence[str] = tuple(OBSERVATION_PREFIXES),
) -> DataFrame:
    """All per-entity sheets at once → one row per present value.

    Sheets of entities that are not listed are left out. Listed entities with a
    sheet but no value at all keep one otherwise empty row.

    Whether an entity has a value is read off the wide rows, before they are
    multiplied by the number of variables, in an aggregate of one flag.
    """
    values = columns_with_prefix(sheets, prefixes)
    wide = available_entities(sheets, entities, entity).select(
        entity,
        *[F.col(c).cast("string").alias(c) if c in ("source", "type") else c for c in context],
        *values,
    )
    long = unpivot_columns(wide, values, "var_short", "value", drop_null=True)
    without_data = (
        wide.groupBy(entity)
        .agg(F.max(any_present(values)).alias("has_data"))
        .filter(~F.col("has_data"))
        .select(entity)
    )
    complete = union_all([long, without_data])
    return lookup_join(complete, classify_variables(variables), "var_short")
