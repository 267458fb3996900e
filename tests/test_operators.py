"""Operators on small frames: semantics that the large queries cannot show."""

import math

import pytest
from helpers import bag, plan, rows
from pyspark.sql import functions as F

from panelweave.functions import scalars, vocabulary as vocab
from panelweave.operators import audit, codes, dedup, dictionary, joins, registry, reshape, select
from panelweave.operators import summary
from panelweave.plans.analysis import subset_with_groups
from panelweave.schema import INDICATOR_SCHEMA, RAW_SCHEMA, cast_project, clean_missing
from panelweave.sources import snapshots
from panelweave.sources.tables import small_table

NAN = float("nan")


# --- schema ---------------------------------------------------------------------------


def test_cast_project_pins_types(spark):
    text = spark.createDataFrame(
        [("A", "2015.9", "x", "n", "t", "12.5"), ("B", "bad", "x", "n", None, "NaN")],
        "iso3 string, year string, residence string, var_short string, indicator_type string, "
        "percent string",
    )
    found = cast_project(text, INDICATOR_SCHEMA)
    assert found.schema == INDICATOR_SCHEMA
    assert rows(found) == [("A", 2015, "x", "n", "t", 12.5), ("B", None, "x", "n", None, None)]


def test_clean_missing(spark):
    frame = spark.createDataFrame([("NA", NAN), ("", 1.0), ("x", None)], "a string, b double")
    assert rows(clean_missing(frame)) == [(None, None), (None, 1.0), ("x", None)]


# --- selection -------------------------------------------------------------------------


def test_first_present_follows_candidate_order(spark):
    assert select.first_present(["b", "a"], ["x", "a", "b"]) == "a"
    with pytest.raises(ValueError, match="x, have b, a"):
        select.first_present(["b", "a"], ["x"])
    frame = spark.createDataFrame([(1.0,)], "pop_t double")
    assert rows(frame.select(select.first_present_column(frame, ["pop_n", "pop_t"]))) == [(1.0,)]


def test_prefix_ignores_case_and_range_is_inclusive(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], "WAT_a int, wat_b int, san_c int, other int")
    assert select.columns_with_prefix(frame, ["wat_"], keep=["wat_b"]) == ["WAT_a"]
    assert select.select_range(frame, "wat_b", "other").columns == ["wat_b", "san_c", "other"]
    assert select.relocate(frame, ["other"], after="WAT_a").columns == [
        "WAT_a", "other", "wat_b", "san_c",
    ]


def test_placeholders_need_every_column_missing(spark):
    frame = spark.createDataFrame(
        [("A", None, None), ("B", "s", None), ("C", None, 1.0)], "iso3 string, s string, v double"
    )
    assert [r[0] for r in rows(select.drop_placeholders(frame, ["s", "v"]))] == ["B", "C"]


# --- joins ------------------------------------------------------------------------------


def test_natural_join_uses_columns_of_all_sheets(spark):
    a = spark.createDataFrame([("x", 1.0, 5.0), (None, None, 6.0), ("y", NAN, 7.0)],
                              "k string, p double, a double")
    b = spark.createDataFrame([("x", 1.0, 8.0), (None, None, 9.0), ("z", 1.0, 1.0)],
                              "k string, p double, b double")
    c = spark.createDataFrame([("y", NAN, 3.0), ("x", 2.0, 4.0)], "k string, p double, c double")
    joined = joins.natural_left_join([a, b, c])
    assert joined.columns == ["k", "p", "a", "b", "c"]
    found = {r["a"]: (r["b"], r["c"]) for r in joined.collect()}
    assert found == {5.0: (8.0, None), 6.0: (9.0, None), 7.0: (None, 3.0)}


def test_natural_join_refuses_ambiguous_columns(spark):
    a = spark.createDataFrame([("x", 1.0)], "k string, extra double")
    b = spark.createDataFrame([("x", 1.0)], "k string, extra double")
    c = spark.createDataFrame([("x", 1.0)], "k string, c double")
    with pytest.raises(ValueError, match="extra"):
        joins.natural_left_join([a, b, c])


def test_lookup_keeps_unmatched_and_null_codes(spark):
    lookup = joins.clean_lookup(
        spark.createDataFrame([("a", "A"), ("a", "A"), ("b", None)], "code string, label string"),
        "code", "label",
    )
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    assert bag(joins.lookup_join(frame, lookup, "code")) == {
        ("a", "A"): 1, ("b", None): 1, (None, None): 1,
    }
    assert bag(audit.unmatched_codes(frame, lookup, "code")) == {("b",): 1, (None,): 1}


@pytest.mark.parametrize(
    "known, verdict", [("abcd", "ok"), ("abc", "warn"), ("ab", "warn"), ("a", "stop")]
)
def test_coverage_gate_is_strict(spark, known, verdict):
    frame = spark.createDataFrame([(c,) for c in "aabcd"], "code string")
    lookup = spark.createDataFrame([(c, c) for c in known], "code string, label string")
    row = audit.lookup_coverage(frame, lookup, "code").first()
    assert (row["n_codes"], row["n_unmatched"], row["verdict"]) == (4, 4 - len(known), verdict)
    if verdict == "stop":
        with pytest.raises(ValueError, match="3 of 4 code values"):
            audit.require_lookup(frame, lookup, "code")
    else:
        assert audit.require_lookup(frame, lookup, "code") is frame


# --- reshape -----------------------------------------------------------------------------


def test_unpivot(spark):
    frame = spark.createDataFrame([("x", 1, None), ("y", None, 2.5)], "k string, a int, b double")
    assert bag(reshape.unpivot_columns(frame, ["a", "b"])) == {
        ("x", 1.0, "a"): 1, ("x", None, "b"): 1, ("y", None, "a"): 1, ("y", 2.5, "b"): 1,
    }
    assert reshape.unpivot_columns(frame, ["a", "b"], drop_null=True).count() == 2
    with pytest.raises(ValueError):
        reshape.unpivot_columns(frame, [])


def test_explode_labels_gives_several_rows_or_none(spark):
    from panelweave.functions.rules import TypeRule

    rules = [TypeRule("s", "one", "sm$"), TypeRule("s", "two", "sew"), TypeRule("t", "three", ".")]
    frame = spark.createDataFrame(
        [("sew_sm", "s", "L"), ("sew", "s", "L"), ("zzz", "s", "L"), ("sm", None, "L"),
         ("sm", "s", None)],
        "code string, service string, label string",
    )
    found = reshape.explode_labels(frame, "code", "service", "label", rules)
    assert bag(found.select("code", "indicator_type")) == {
        ("sew_sm", "one"): 1, ("sew_sm", "two"): 1, ("sew", "two"): 1,
    }


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2, 3.0)], "a int, c double")
    assert bag(reshape.union_all([a, b])) == {(1, "x", None): 1, (2, None, 3.0): 1}


def test_placeholder_rows(spark):
    obs = spark.createDataFrame([("A", 1.0)], "iso3 string, value double")
    entities = spark.createDataFrame([("A",), ("B",), ("B",)], "iso3 string")
    found = reshape.append_placeholders(obs, entities, obs, "iso3")
    assert bag(found) == {("A", 1.0): 1, ("B", None): 1}


# --- de-duplication ------------------------------------------------------------------------


def test_newest_edition(spark):
    frame = spark.createDataFrame(
        [("k", "CEN00", 1, 1.0), ("k", "CEN99", 2, 2.0), ("k", None, 3, 3.0), ("k", "CEN99", 1, 4.0),
         ("q", None, 1, 5.0), (None, "ES13", 1, 6.0), (None, "ES9", 1, 7.0)],
        "key string, edition string, rid int, value double",
    )
    kept = dedup.keep_newest_edition(frame, ["key"], "edition", [F.col("rid").asc()])
    # Editions compare as text: CEN99 beats CEN00 and ES9 beats ES13.
    assert {r["key"]: r["value"] for r in kept.collect()} == {"k": 4.0, "q": 5.0, None: 7.0}
    assert dedup.collapsed_rows(frame, ["key"]).first().asDict() == {
        "n_rows": 7, "n_keys": 3, "n_dropped": 4,
    }


def test_collapse_of_nothing(spark):
    empty = spark.createDataFrame([], "key string")
    assert dedup.collapsed_rows(empty, ["key"]).first().asDict() == {
        "n_rows": 0, "n_keys": 0, "n_dropped": 0,
    }


def test_raw_harmonisation_makes_releases_comparable(spark):
    from panelweave.operators import diff

    columns = "iso3 string, source string, type string, year double, var_short string, value double"
    old = spark.createDataFrame(
        [("POL", "ES12", "Survey", 2015.0, "s_od_n", 1.0), ("POL", "ES13", "Survey", 2015.0, "s_od_n", 2.0),
         ("UGA", "CEN02", "Census", 2002.0, "s_lat_u", 3.0), ("BLM", None, None, None, None, None)],
        columns,
    )
    new = spark.createDataFrame(
        [("POL", "ES", "Encuesta", 2015.0, "s_ns_t", 2.0), ("UGA", "CEN", "Recensement", 2002.0, "s_lat_u", 4.0)],
        columns,
    )
    tidy = [
        snapshots.harmonise_raw(snapshots.raw_rows(x), [F.col("value").asc_nulls_last()])
        for x in (old, new)
    ]
    result = diff.diff_snapshots(*tidy, ["iso3", "source", "type", "year", "var_short"], "value")
    assert bag(result.select("iso3", "status")) == {("POL", "unchanged"): 1, ("UGA", "changed"): 1}


# --- audits ---------------------------------------------------------------------------------


def test_require_unique_reports_the_number_of_keys(spark):
    frame = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 1), ("b", 1)], "k string, v int")
    with pytest.raises(ValueError, match="snapshot rel holds 2 keys"):
        audit.require_unique(frame, ["k", "v"], "rel")
    unique = frame.distinct()
    assert audit.require_unique(unique, ["k", "v"], "rel") is unique


def test_failure_log_keeps_its_columns_when_empty(spark):
    frame = spark.createDataFrame([("QX1", "download failed"), ("A", "ok"), ("B", "late")], "iso3 string, status string")
    log = audit.failure_log(frame, "iso3", ["QX1", "QX2"], "closed in spring")
    assert rows(log) == [("QX1", "download failed", "closed in spring"), ("B", "late", None)]
    empty = audit.failure_log(frame.filter("status = 'ok'"), "iso3", ["QX1"])
    assert empty.columns == ["iso3", "status", "note"] and empty.count() == 0
    assert rows(audit.ingest_totals(frame)) == [(1, 2)]


def test_max_year_check(spark):
    frame = spark.createDataFrame([("a", 2015), ("a", None), ("b", 2014), ("c", None)], "rel string, year int")
    expected = spark.createDataFrame([("a", 2015), ("b", 2015), ("c", 2015), ("d", 2015)], "rel string, expected_max_year int")
    reasons = {r["rel"]: r["reason"] for r in audit.max_year_check(frame, expected, "rel").collect()}
    assert reasons == {
        "a": "ends in 2015",
        "b": "stale: ends in 2014 instead of 2015",
        "c": "stale: ends in NA instead of 2015",
        "d": "no estimates",
    }


def test_unreadable_captures_are_rejected_with_their_problem(spark):
    from datetime import datetime

    at = [datetime(2024, 5, d) for d in range(1, 6)]
    captures = spark.createDataFrame(
        [(at[0], 2022, "no such sheet"), (at[1], 2020, None), (at[2], None, None), (at[3], 2022, None),
         (at[4], 2022, None)],
        "ts timestamp, max_year int, problem string",
    )
    targets = [{"release_id": "r", "opens": at[0], "closes": at[3], "expected_max_year": 2022},
               {"release_id": "none", "opens": at[0], "closes": at[2], "expected_max_year": 1}]
    verdicts = audit.capture_verdicts(captures, targets, "ts", "max_year", "problem")
    reasons = [r["reason"] for r in verdicts.filter("release_id = 'r'").orderBy("ts").collect()]
    assert reasons == [
        "no such sheet",
        "stale: ends in 2020 instead of 2022",
        "stale: ends in NA instead of 2022",
        "ends in 2022",
    ]
    first = {r["release_id"]: (r["first_valid"], r["n_rejected"])
             for r in audit.first_valid_capture(verdicts, "ts").collect()}
    assert first == {"r": (at[3], 3), "none": (None, 3)}


def test_coverage_verdicts(spark):
    entities = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 4), ("b", 5), ("c", 6)], "g string, e int")
    present = spark.createDataFrame([(1,), (1,), (2,), (3,), (99,)], "e int")
    found = {r["g"]: (r["n_entities"], r["n_present"], r["verdict"])
             for r in audit.entity_coverage(entities, present, "e", ["g"]).collect()}
    assert found == {"a": (2, 2, "complete"), "b": (3, 1, "reject"), "c": (1, 0, "reject")}
    half = audit.entity_coverage(entities.filter("g = 'a'"), present.filter("e = 1"), "e").first()
    assert half["verdict"] == "partial"


# --- registry ----------------------------------------------------------------------------------

COLUMNS = ("release_id string, snapshot_date string, pipeline string, file string, source string, "
           "notes string")


def test_upsert_replaces_by_file_and_is_idempotent(spark):
    manifest = spark.createDataFrame(
        [("r1", "d1", "raw", "f1", "live", None), ("r0", None, "raw", None, "live", None),
         ("r1", None, "indicators", "f2", "live", None)], COLUMNS,
    )
    new = spark.createDataFrame(
        [("r2", "d2", "raw", "f1", "live", "second", 2), ("r2", "d1", "raw", "f1", "live", "first", 1),
         ("r3", "d3", "indicators", "f3", "live", None, 1)], COLUMNS + ", seq int",
    )
    once = registry.manifest_upsert(manifest, new, "seq")
    assert [(r["file"], r["notes"]) for r in once.collect()] == [
        ("f2", None), ("f3", None), ("f1", "second"),
    ]
    assert rows(registry.manifest_upsert(once, new, "seq")) == rows(once)


def test_registry_outranks_builtin(spark):
    known = spark.createDataFrame([("r1", "d", "raw", "f1", "live", "kept")], COLUMNS)
    builtin = spark.createDataFrame(
        [("r1", None, "raw", "other", None, None), ("r2", None, "raw", "f1", None, None),
         ("r2", None, "indicators", "f9", None, None)], COLUMNS,
    )
    merged = registry.manifest_merge(known, builtin)
    assert bag(merged.select("file", "notes")) == {("f1", "kept"): 1, ("f9", None): 1}


def test_single_snapshot_gives_no_pair(spark):
    manifest = spark.createDataFrame([("r1", "d", "raw", "f1", "live", None)], COLUMNS)
    flags = registry.manifest_flags(manifest, manifest.select("file"), ["r1", "r2"])
    assert registry.consecutive_pairs(registry.first_snapshot_per_release(flags)).count() == 0


def test_latest_file_or_error(spark):
    manifest = spark.createDataFrame([("2020-01-01_a.csv",), ("2021-01-01_a.csv",), ("zz",)], "file string")
    assert registry.require_latest_file(manifest, r"^\d{4}-.*_a\.csv$") == "2021-01-01_a.csv"
    with pytest.raises(ValueError, match="no registered file"):
        registry.require_latest_file(manifest, "^nothing$")


# --- summaries ------------------------------------------------------------------------------------


def test_component_aggregates_of_missing_values(spark):
    frame = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None), ("b", 2.0)], "g string, v double")
    assert dict(rows(summary.component_max(frame, ["g"], "v"))) == {"a": None, "b": 2.0}
    assert dict(rows(summary.component_sum(frame, ["g"], "v"))) == {"a": 0.0, "b": 3.0}


def test_distinct_counts_null(spark):
    count = summary.count_distinct_with_null("c")
    for data, expected in (([("a",), ("a",), (None,)], 2), ([("a",)], 1), ([], 0)):
        assert rows(spark.createDataFrame(data, "c string").agg(count)) == [(expected,)]


@pytest.mark.parametrize(
    "breaks, labels",
    [
        ([1, 11, 21, math.inf], ["No Data", "No Data", "1 to <11", "11 to <21", "21 or more", "21 or more"]),
        ([1, 11, 21], ["No Data", "No Data", "1 to <11", "11 to 21", "11 to 21", "No Data"]),
    ],
)
def test_bins(spark, breaks, labels):
    frame = spark.createDataFrame([(None,), (0,), (10,), (11,), (21,), (22,)], "n int")
    assert [r[0] for r in rows(frame.select(scalars.interval_label("n", breaks)))] == labels


def test_shares(spark):
    counts = spark.createDataFrame([("a", 1, 1), ("a", 2, 3), ("b", 1, 4)], "y string, t int, n long")
    assert {(r["y"], r["t"]): r["prop"] for r in summary.share_within(counts, ["y"]).collect()} == {
        ("a", 1): 25.0, ("a", 2): 75.0, ("b", 1): 100.0,
    }
    missing = spark.createDataFrame([(None, 1, 1), (None, 2, 1), ("z", 1, 0)], "y string, t int, n long")
    assert {(r["y"], r["t"]): r["prop"] for r in summary.share_within(missing, ["y"]).collect()} == {
        (None, 1): 50.0, (None, 2): 50.0, ("z", 1): None,
    }
    assert sum(r["prop"] for r in summary.share_of_total(counts).collect()) == 100.0
    assert rows(summary.share_of_total(counts.filter("n > 99"))) == []


def test_top_entities_with_names(spark):
    counts = spark.createDataFrame([("NGA", 5), ("COL", 5), ("UGA", 9), ("XXX", 5), (None, 1)], "iso3 string, n long")
    names = spark.createDataFrame([("UGA", "Uganda"), ("COL", "Colombia"), ("ZZZ", "Z")], "iso3 string, country string")
    top = summary.top_entities(counts, "iso3", 3, names)
    assert bag(top) == {("Uganda", "UGA", 9): 1, ("Colombia", "COL", 5): 1, (None, "NGA", 5): 1}


def test_population_and_subset(spark):
    frame = spark.createDataFrame(
        [("A", 2000, "national"), ("A", 2000, "urban"), ("A", 2000, "rural"), ("A", 2000, None), ("A", 2001, "rural")],
        "iso3 string, year int, residence string",
    ).withColumns(
        {"pop_t": F.lit(2.0), "prop_u": F.lit(25.0), "service": F.lit("sanitation"),
         "indicator": F.lit("Safely managed"), "var_short": F.lit("san_sm"),
         "indicator_type": F.lit("t"), "percent": F.lit(1.0)}
    )
    groups = spark.createDataFrame([("A", "Region", "HIC")], "iso3 string, region string, income_id string")
    subset = subset_with_groups(frame, groups)
    assert {r["residence"]: r["pop"] for r in subset.collect()} == {
        "national": 2000.0, "urban": 500.0, "rural": 1500.0, None: None,
    }
    assert set(subset.columns) == {
        "iso3", "year", "residence", "indicator", "percent", "pop", "region", "income_id",
    }


# --- codes -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("once", [True, False])
def test_mapping_codes_equals_mapping_rows(spark, once):
    frame = spark.createDataFrame([("wat_ns_t",), ("san_ns_r",), ("x",), (None,), ("x",)], "code string")
    mapped = codes.map_codes(frame, "code", {"out": vocab.normalize_codes}, once)
    assert bag(mapped) == {
        ("wat_ns_t", "wat_sur_n"): 1, ("san_ns_r", "san_od_r"): 1, ("x", "x"): 2, (None, None): 1,
    }
    assert ("Aggregate" in plan(mapped)) == once


# --- dictionary --------------------------------------------------------------------------------------


def test_dictionary(spark):
    frame = spark.createDataFrame([("a", 1, 1.0)], "iso3 string, year int, value double")
    checked = dictionary.check_dictionary(
        spark, frame, [("iso3", "character"), ("year", "numeric"), ("gone", "factor")]
    )
    assert [r["matches"] for r in checked.collect()] == [True, False, False]
    assert dictionary.undocumented_columns(frame, [("iso3", "character")]) == ["year", "value"]
    described = dictionary.with_comments(frame, {"year": "Year of data collection", "gone": "x"})
    assert described.schema["year"].metadata["comment"] == "Year of data collection"
    entries = spark.createDataFrame([("raw", "iso3"), ("indicators", "iso3")], "file_name string, variable_name string")
    assert dictionary.dictionary_for(entries, "raw").count() == 1


def test_columns_as_rows_keeps_repeats(spark):
    frame = spark.createDataFrame([("a", None)], "name string, year int")
    found = dictionary.columns_as_rows({"wat": frame, "san": frame})
    assert bag(found.select("column_name", "n_values")) == {("name", 1): 2, ("year", 0): 2}


def test_small_table_has_a_known_size(spark):
    table = small_table(spark, [("a", 1), ("b", None)], "code string, n int")
    assert "LocalTableScan" in plan(table)
    assert rows(table) == [("a", 1), ("b", None)]
    assert rows(small_table(spark, [], "code string")) == []
    assert table.schema["n"].dataType == RAW_SCHEMA["year"].dataType


def test_missing_keys_are_covered_by_missing_keys(spark):
    frame = spark.createDataFrame([(None, "a"), ("r", "a"), ("r", None)], "r string, p string")
    assert joins.not_covered(frame, frame, ["r", "p"]).count() == 0
    assert joins.missing_entities(frame, frame, "r").count() == 0
    some = spark.createDataFrame([("r", "a")], "r string, p string")
    assert set(rows(joins.not_covered(frame, some, ["r", "p"]))) == {(None, "a"), ("r", None)}


def test_a_code_without_label_is_unmatched(spark):
    frame = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "c string, v int")
    lookup = spark.createDataFrame(
        [("x", "one"), ("x", "one"), ("y", None), (None, "none")], "c string, label string"
    )
    assert sorted(rows(audit.unmatched_codes(frame, lookup, "c"))) == [("y",), ("z",)]
    assert rows(audit.lookup_coverage(frame, lookup, "c")) == [(3, 2, "stop")]
    assert rows(audit.matched_rows(frame, lookup, "c", "label")) == [("x", 1, "one")]


def test_rules_treat_missing_codes_alike(spark):
    frame = spark.createDataFrame([("x",), (None,)], "c string")
    rules = {"here": lambda c: c.isNotNull(), "named": lambda c: F.coalesce(c, F.lit("none"))}
    for once in (True, False):
        found = codes.map_codes(frame, "c", rules, once_per_code=once)
        assert set(rows(found.select("c", "here", "named"))) == {("x", True, "x"), (None, None, None)}
