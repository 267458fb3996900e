"""Analysis tables built on the tidy panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.functions.scalars import population_by_residence
from panelweave.functions.vocabulary import recode_income
from panelweave.operators.joins import lookup_join
from panelweave.operators.select import drop_optional, first_present_column
from panelweave.operators.summary import count_by, entity_frequency, top_entities


def income_groups(groups: DataFrame, code: str, region: str, group: str) -> DataFrame:
    """Entity, region and short income group from a classification table."""
    return groups.select(
        F.col(code).alias("iso3"),
        F.col(region).alias("region"),
        recode_income(group).alias("income_id"),
    )


def subset_with_groups(
    estimates: DataFrame,
    groups: DataFrame,
    service: str = "sanitation",
    indicator: str = "Safely managed",
    years: Sequence[int] = (2000, 2010, 2020),
    population: Sequence[str] = ("pop_n", "pop_t"),
) -> DataFrame:
    """One indicator at a few years with head counts and income groups.

    The population column is taken under the first of its names that exists.
    """
    chosen = estimates.filter(
        (F.col("service") == service)
        & (F.col("indicator") == indicator)
        & F.col("year").isin(list(years))
    )
    people = population_by_residence(
        "residence", first_present_column(estimates, population), "prop_u"
    )
    columns = drop_optional(
        chosen.withColumn("pop", people),
        ["prop_u", *population, "arc_hyg_bas_u", "var_short", "indicator_type", "service"],
    )
    return lookup_join(columns, groups, "iso3")


def frequency_tables(
    observations: DataFrame,
    base: DataFrame,
    keep: Column,
    breaks: Sequence[float],
    entity: str = "iso3",
    base_key: str = "iso_a3",
    names: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Binned counts for every entity of the base, and the ten largest."""
    counts = count_by(observations.filter(keep), entity)
    return (
        entity_frequency(base, counts, base_key, entity, breaks),
        top_entities(counts, entity, 10, names),
    )
