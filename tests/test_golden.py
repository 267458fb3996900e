"""Published classification results, replayed."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from panelweave.functions import scalars, vocabulary as vocab
from panelweave.functions.rules import Rewrite, first_match, ordinal
from panelweave.operators import audit, registry
from panelweave.plans.indicators import classify_codes
from panelweave.plans.observations import classify_variables
from panelweave.sources.tables import small_table

# --- fixed values: stage of every raw code, by stem -------------------------------
STAGES = {
    "s_imp": "user interface",
    "s_lat_con": "containment",
    "s_lat_dtp": "transport",
    "s_lat_ebo": "emptying",
    "s_lat_edl": "emptying",
    "s_lat_ero": "emptying",
    "s_lat_nemp": "emptying",
    "s_lat": "user interface",
    "s_ns": "open defecation",
    "s_sep_con": "containment",
    "s_sep_dtp": "transport",
    "s_sep_ebo": "emptying",
    "s_sep_edl": "emptying",
    "s_sep_ero": "emptying",
    "s_sep_nemp": "emptying",
    "s_sep": "user interface",
    "s_sew_net": "containment",
    "s_sew": "user interface",
    "s_sew_rtp": "transport",
    "s_shared": "sharing",
    "s_treat_fstp": "FS treatment",
    "s_treat_wtp": "WW treatment",
}
SUFFIX_RESIDENCE = {"_t": "national", "_r": "rural", "_u": "urban"}
# Stems whose older label ignores the suffix.
LEGACY_BY_STEM = {
    "s_lat_nemp": "national",
    "s_ns": "national",
    "s_sep_nemp": "national",
    "s_sew_net": "national",
    "s_sew_rtp": "rural",
}
TRANSITIONS = {
    ("national", "rural"): 4,
    ("national", "urban"): 4,
    ("rural", "national"): 1,
    ("rural", "urban"): 1,
}
REWRITTEN = [
    ("wat_basal_t", "wat_bas_n"),
    ("san_ns_r", "san_od_r"),
    ("wat_ns_t", "wat_sur_n"),
    ("arc_san_ns_u", "arc_san_od_u"),
    ("wat_imp_prem_u", "wat_premises_u"),
    ("san_arc_sm_r", "arc_san_sm_r"),
    ("wat_bas_n", "wat_bas_n"),
    ("hyg_ns_t", "hyg_nfac_n"),
    ("wat_imp_npip_r", "wat_npip_r"),
    ("san_othimp_u", "san_lat_u"),
]
# --- end of fixed values -----------------------------------------------------------


@pytest.fixture(scope="module")
def classified(spark):
    variables = small_table(spark, vocab.observation_lookup(), "var_short string, var_long string")
    return classify_variables(variables).cache()


def test_all_66_codes(classified):
    expected = {
        (
            stem + suffix,
            residence,
            LEGACY_BY_STEM.get(stem, residence),
            stage,
        )
        for stem, stage in STAGES.items()
        for suffix, residence in SUFFIX_RESIDENCE.items()
    }
    found = classified.select("var_short", "residence", "residence_legacy", "san_service_chain")
    assert set(rows(found)) == expected and len(expected) == 66


def test_label_transitions(classified):
    moved = audit.label_transitions(classified, "residence_legacy", "residence")
    assert {(a, b): n for a, b, n in rows(moved)} == TRANSITIONS


def test_codes_per_stage(classified):
    counts = dict(rows(classified.groupBy("san_service_chain").count()))
    assert counts == {
        "emptying": 24,
        "user interface": 12,
        "containment": 9,
        "transport": 9,
        "open defecation": 3,
        "sharing": 3,
        "FS treatment": 3,
        "WW treatment": 3,
    }


@pytest.mark.parametrize("code", [None, "abc", ""])
def test_codes_without_class(spark, code):
    frame = spark.createDataFrame([(code,)], "c string").select(
        vocab.derive_residence("c"), vocab.derive_residence_legacy("c"), vocab.classify_stage("c")
    )
    assert rows(frame) == [(None, None, None)]


def test_rewrites(spark):
    frame = spark.createDataFrame(REWRITTEN, "c string, expected string")
    found = frame.select("c", vocab.normalize_codes("c"))
    assert rows(found) == REWRITTEN


def test_rewrites_keep_canonical_codes(spark):
    lookup = vocab.indicator_lookup()
    assert len(lookup) == 91
    frame = small_table(spark, lookup, "var_short string, var_long string")
    once = vocab.normalize_codes("var_short")
    changed = frame.filter((once != F.col("var_short")) | (vocab.normalize_codes(once) != once))
    assert changed.count() == 0


def test_indicator_type_pairs(spark):
    """11 sanitation, 9 water, 3 + 2 hygiene pairs; only wat_sm has no type."""
    lookup = small_table(spark, vocab.indicator_lookup(), "var_short string, var_long string")
    codes = lookup.select(F.col("var_short").alias("code"))
    typed = classify_codes(codes, lookup)
    pairs = typed.select("service", "var_short", "indicator_type").distinct()
    assert dict(rows(pairs.groupBy("service").count())) == {
        "sanitation": 11,
        "water": 9,
        "hygiene": 5,
    }
    untyped = codes.select(vocab.strip_suffix("code").alias("var_short")).distinct().filter(
        F.col("var_short").rlike("^(wat|san|hyg)")
    ).join(typed, "var_short", "left_anti")
    assert rows(untyped) == [("wat_sm",)]


def test_type_labels_in_five_languages(spark):
    frame = spark.createDataFrame(
        [("Encuesta con microdatos",), ("Перепись населения",), ("التعداد",), ("Autre",),
         ("مصدر إداري",), ("Census",), ("unknown",), (None,)],
        "type string",
    )
    assert [r[0] for r in rows(frame.select(vocab.map_source_type("type")))] == [
        "Survey", "Census", "Census", "Other", "Admin", "Census", "unknown", None,
    ]
    assert len(vocab.SOURCE_TYPE_LABELS) == 18


def test_strip_suffix_is_sequential(spark):
    frame = spark.createDataFrame([("x_r_n",), ("x_n_r",), ("x_u",), ("x",)], "c string")
    assert [r[0] for r in rows(frame.select(vocab.strip_suffix("c")))] == ["x", "x_n", "x", "x"]


def test_strip_trailing_digits(spark):
    frame = spark.createDataFrame([("CEN00",), ("2015",), ("A1B",), (None,)], "c string")
    found = [r[0] for r in rows(frame.select(scalars.strip_trailing_digits("c")))]
    assert found == ["CEN", "", "A1B", None]


def test_unanchored_rewrite_is_refused():
    with pytest.raises(ValueError):
        Rewrite("_ns_", "_od_")


def test_first_match_wins(spark):
    frame = spark.createDataFrame([("s_lat_con_r",)], "c string")
    assert rows(frame.select(first_match("c", vocab.STAGE_RULES))) == [("containment",)]


def test_ordinal(spark):
    frame = spark.createDataFrame([("sharing",), ("nothing",), (None,)], "c string")
    assert [r[0] for r in rows(frame.select(ordinal("c", vocab.STAGE_LEVELS)))] == [2, None, None]


def test_income_groups(spark):
    frame = spark.createDataFrame([("High income",), ("Unclassified",), (None,)], "c string")
    assert [r[0] for r in rows(frame.select(vocab.recode_income("c")))] == ["HIC", None, None]


# Releases of two pipelines: spare files of a date, an undated file, and one release
# of each pipeline that has no snapshot.
MANIFEST = [
    ("spring", "2011-04-02", "survey", "survey/spring-a", "site", "first of two of a day"),
    ("spring", "2011-04-02", "survey", "survey/spring-b", "site", "second of two of a day"),
    ("summer", None, "survey", "survey/summer-sheet", "mail", "never arrived"),
    ("winter", "2012-01-15", "survey", "survey/winter", "site", "kept"),
    ("autumn", "2011-10-09", "survey", "survey/autumn-late", "site", "kept"),
    ("autumn", "2011-10-01", "survey", "survey/autumn-early", "site", "replaced"),
    ("spring", None, "prices", "prices/spring-sheet", "mail", "never arrived"),
    ("winter", "2012-02-01", "prices", "prices/winter", "site", "kept"),
    ("summer", "2011-07-20", "prices", "prices/summer", "site", "kept"),
    ("autumn", "2011-10-30", "prices", "prices/autumn", "site", "kept"),
]
ORDER = ["spring", "summer", "autumn", "winter"]


def test_manifest_pairs_skip_gaps(spark):
    manifest = spark.createDataFrame(
        MANIFEST, "release_id string, snapshot_date string, pipeline string, file string, "
        "source string, notes string",
    )
    files = manifest.filter(F.col("snapshot_date").isNotNull()).select("file")
    flags = registry.manifest_flags(manifest, files, ORDER)
    pairs = registry.consecutive_pairs(registry.first_snapshot_per_release(flags))
    labels = {(p, label) for p, label in rows(pairs.select("pipeline", "label"))}
    assert labels == {
        ("survey", "spring_vs_autumn"),
        ("survey", "autumn_vs_winter"),
        ("prices", "summer_vs_autumn"),
        ("prices", "autumn_vs_winter"),
    }
    unavailable = set(rows(registry.unavailable_releases(flags)))
    assert unavailable == {("summer", "survey"), ("spring", "prices")}
