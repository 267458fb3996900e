"""The end-to-end plans on small, fully known inputs."""

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from panelweave.functions import vocabulary as vocab
from panelweave.operators import diff
from panelweave.plans.diff_report import diff_report, pairs_of
from panelweave.plans import indicators
from panelweave.plans.indicators import tidy_indicators
from panelweave.plans.observations import tidy_observations
from panelweave.sources.tables import small_table

# Newer spelling of some stems (fixed values); the others kept their name.
NEW_STEMS = {
    "arc_wat_bas": "arc_wat_basal",
    "arc_san_bas": "arc_san_basal",
    "arc_san_od": "arc_san_ns",
    "wat_bas": "wat_basal",
    "san_bas": "san_basal",
    "wat_sur": "wat_ns",
    "san_od": "san_ns",
    "hyg_nfac": "hyg_ns",
    "wat_premises": "wat_imp_prem",
    "wat_available": "wat_imp_av",
    "wat_quality": "wat_imp_qual",
    "wat_npip": "wat_imp_npip",
    "san_lat": "san_othimp",
}
SERVICES = {"water": ["wat_", "arc_wat"], "sanitation": ["san_", "arc_san"], "hygiene": ["hyg_"]}


def stems(service):
    return [s for s in vocab.INDICATOR_LABELS if s.startswith(tuple(SERVICES[service]))]


def sheet(spark, service, newer, value=lambda stem, suffix: float(len(stem + suffix))):
    """Two areas and years of one wide sheet, in the older or newer spelling."""
    columns = {}
    for stem in stems(service):
        for suffix in ("_n", "_r", "_u"):
            name = (NEW_STEMS.get(stem, stem) if newer else stem) + (
                "_t" if newer and suffix == "_n" else suffix
            )
            columns[name] = value(stem, suffix)
    frame = spark.createDataFrame(
        [("Uganda", "UGA", 2000.0), ("Uganda", "UGA", 2001.0), ("Poland", "POL", 2000.0)],
        "name string, iso3 string, year double",
    )
    population = "pop_t" if newer else "pop_n"
    return frame.withColumns(
        {
            population: F.lit(10.0),
            "prop_u": F.lit(40.0),
            "sl": F.lit(1.0),
            "region_sdg": F.lit("text"),
            "latestyear": F.lit(2020.0),
            **{name: F.lit(v).cast("double") for name, v in columns.items()},
        }
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return small_table(spark, vocab.indicator_lookup(), "var_short string, var_long string")


def tidy(spark, lookup, newer, **kwargs):
    return tidy_indicators(
        [sheet(spark, s, newer, **kwargs) for s in ("water", "sanitation", "hygiene")], lookup
    )


def test_three_sheets_give_75_rows_per_area_and_year(spark, lookup):
    estimates = tidy(spark, lookup, newer=True).estimates
    per_group = {r["count"] for r in estimates.groupBy("iso3", "year").count().collect()}
    assert per_group == {3 * 25}
    bathing = estimates.filter(F.col("indicator_type") == "bathing_facilities")
    assert bathing.count() == 3 * 6


def test_older_and_newer_sheets_agree(spark, lookup):
    drop = ["pop_t", "pop_n"]
    old = tidy(spark, lookup, newer=False).estimates.drop(*drop)
    new = tidy(spark, lookup, newer=True).estimates.drop(*drop)
    assert bag(old) == bag(new)


def test_missing_percentages_stay(spark, lookup):
    estimates = tidy(spark, lookup, newer=True, value=lambda stem, suffix: None).estimates
    assert estimates.count() == 3 * 75
    assert estimates.filter(F.col("percent").isNotNull()).count() == 0


def test_columns_of_the_estimates(spark, lookup):
    estimates = tidy(spark, lookup, newer=True).estimates
    assert set(estimates.columns) == {
        "name", "iso3", "year", "pop_t", "prop_u", "var_short", "percent", "residence", "service",
        "indicator_type", "indicator",
    }


def test_unknown_columns_are_reported(spark, lookup):
    water, sanitation, hygiene = (
        sheet(spark, s, True) for s in ("water", "sanitation", "hygiene")
    )
    water = water.withColumn("wat_new_t", F.lit(1.0)).withColumn("WAT_odd", F.lit(2.0))
    result = tidy_indicators([water, sanitation, hygiene], lookup)
    assert set(rows(result.unmatched)) == {("wat_new_n",), ("WAT_odd",)}
    coverage = result.coverage.first()
    assert (coverage["n_unmatched"], coverage["verdict"]) == (2, "warn")
    assert result.estimates.filter(F.col("var_short").contains("new")).count() == 0


def test_rows_only_in_later_sheets_are_lost(spark, lookup):
    water, sanitation, hygiene = (
        sheet(spark, s, True) for s in ("water", "sanitation", "hygiene")
    )
    result = tidy_indicators([water.filter("iso3 = 'UGA'"), sanitation, hygiene], lookup)
    assert {r["iso3"] for r in result.estimates.select("iso3").distinct().collect()} == {"UGA"}


def test_id_columns_are_not_unpivoted(spark, lookup):
    water, sanitation, hygiene = (
        sheet(spark, s, True) for s in ("water", "sanitation", "hygiene")
    )
    hygiene = hygiene.withColumn("arc_hyg_bas_u", F.lit(0.5))
    estimates = tidy_indicators([water, sanitation, hygiene], lookup).estimates
    assert {r[0] for r in rows(estimates.select("arc_hyg_bas_u").distinct())} == {0.5}


def test_classifying_rows(spark, lookup):
    frame = spark.createDataFrame(
        [(1, "san_sm_t"), (2, "wat_ns_u"), (3, "nope"), (4, None), (5, "san_sm_t")], "id int, code string"
    )
    small = bag(indicators.classify_rows(frame, "code", lookup).select("id", "indicator"))
    assert small == {(1, "Safely managed"): 1, (5, "Safely managed"): 1, (2, "Surface water"): 1}


def test_observations(spark):
    sheets = spark.createDataFrame(
        [("UGA", "CEN", 7, 2002.0, 1.0, None, "x"), ("UGA", "DHS", 8, 2006.0, None, 0.0, "x"),
         ("BLM", None, None, None, None, None, None), ("XXX", "ES", 9, 2000.0, 5.0, 5.0, "x")],
        "iso3 string, source string, type int, year double, s_lat_nemp_u double, s_od_n double, "
        "w_ignored string",
    )
    # KEN is listed without a sheet, XXX has a sheet without being listed.
    entities = spark.createDataFrame([("UGA",), ("BLM",), ("KEN",)], "iso3 string")
    variables = small_table(spark, vocab.observation_lookup(), "var_short string, var_long string")
    found = tidy_observations(sheets, entities, variables)
    assert bag(
        found.select("iso3", "source", "type", "year", "var_short", "value", "residence",
                     "residence_legacy", "san_service_chain")
    ) == bag(
        spark.createDataFrame(
            [("UGA", "CEN", "7", 2002.0, "s_lat_nemp_u", 1.0, "urban", "national", "emptying"),
             ("UGA", "DHS", "8", 2006.0, "s_od_n", 0.0, None, None, None),
             ("BLM", None, None, None, None, None, None, None, None)],
            "iso3 string, source string, type string, year double, var_short string, value double, "
            "residence string, residence_legacy string, san_service_chain string",
        )
    )
    assert "w_ignored" not in found.columns


def releases(spark):
    data = []
    for r, years in enumerate(([2000, 2001], [2000, 2001, None], [2001, 2002])):
        for year in years:
            for i in range(5):
                data.append((f"r{r}", f"E{i}", year, "v", float(i + (r if i == 2 else 0))))
    return spark.createDataFrame(
        data, "release_id string, iso3 string, year int, var_short string, value double"
    )


def test_report_tables_agree_with_single_diffs(spark):
    table = releases(spark)
    keys = ["iso3", "year", "var_short"]
    report = diff_report(table, [("r0", "r1"), ("r1", "r2")], keys, "value", top=3)
    for old, new in (("r0", "r1"), ("r1", "r2")):
        label = f"{old}_vs_{new}"
        single = diff.diff_snapshots(
            table.filter(F.col("release_id") == old), table.filter(F.col("release_id") == new),
            keys, "value",
        )
        headline = report.headline.filter(F.col("pair") == label).drop("pair")
        assert bag(headline) == bag(diff.diff_headline(single))
        by_year = report.by_group.filter(F.col("pair") == label).drop("pair")
        assert rows(by_year) == rows(diff.summarise_diff_by(single, ["year"]))
        top = report.top_added.filter(F.col("pair") == label).drop("pair")
        assert bag(top) == bag(diff.top_added_entities(single, "iso3", 3))
        detail = report.detail.filter(F.col("pair") == label).drop("pair")
        assert rows(detail) == rows(diff.diff_detail(single, ["iso3", "year", "var_short"]))


def test_pairs_come_from_the_registry(spark):
    flags = spark.createDataFrame(
        [("r0", "d", "raw", "f0", True, False, 1), ("r1", "d", "raw", "f1", False, False, 2),
         ("r2", "d", "raw", "f2", True, False, 3), ("r2", "d", "indicators", "f3", True, False, 3)],
        "release_id string, snapshot_date string, pipeline string, file string, available boolean, "
        "excluded boolean, release_ord int",
    )
    assert pairs_of(flags, "raw") == [("r0", "r2")]
    assert pairs_of(flags, "indicators") == []
