"""The shipped vocabulary: codes, labels and categories of the survey panel.

Everything takes its rules as data, so another panel passes its own tables to
the functions in :mod:`panelweave.functions.rules`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column

from panelweave.functions.rules import (
    Rewrite,
    Rule,
    TypeRule,
    as_column,
    first_match,
    lookup_value,
    map_values,
    rewrite,
)

# --- fixed values ------------------------------------------------------------
# These tables must equal the published vocabulary; their order is meaningful.

RESIDENCE_RULES = [
    Rule("_(t|n)$", "national"),
    Rule("_r$", "rural"),
    Rule("_u$", "urban"),
]

# Codes that are already normalised have no total suffix any more.
TIDY_RESIDENCE_RULES = [
    Rule("_n$", "national"),
    Rule("_r$", "rural"),
    Rule("_u$", "urban"),
]

# Older labelling that looked for the marker anywhere in the code.
RESIDENCE_LEGACY_RULES = [
    Rule("_n", "national"),
    Rule("_r", "rural"),
    Rule("_u", "urban"),
    Rule("_t", "national"),
]

CODE_REWRITES = [
    Rewrite("_t$", "_n"),
    Rewrite("^arc_wat_basal", "arc_wat_bas"),
    Rewrite("^arc_san_basal", "arc_san_bas"),
    Rewrite("^arc_san_ns_", "arc_san_od_"),
    Rewrite("^wat_basal", "wat_bas"),
    Rewrite("^san_basal", "san_bas"),
    Rewrite("^wat_ns_", "wat_sur_"),
    Rewrite("^san_ns_", "san_od_"),
    Rewrite("^hyg_ns_", "hyg_nfac_"),
    Rewrite("^wat_imp_prem", "wat_premises"),
    Rewrite("^wat_imp_av", "wat_available"),
    Rewrite("^wat_imp_qual", "wat_quality"),
    Rewrite("^wat_imp_npip", "wat_npip"),
    Rewrite("^san_othimp", "san_lat"),
    Rewrite("^wat_arc_sm", "arc_wat_sm"),
    Rewrite("^san_arc_sm", "arc_san_sm"),
]

RAW_CODE_REWRITES = [
    Rewrite("_t$", "_n"),
    Rewrite("^s_ns_", "s_od_"),
]

SOURCE_TYPE_LABELS = {
    "Survey with microdata": "Survey",
    "Encuesta": "Survey",
    "Encuesta con microdatos": "Survey",
    "Enquête": "Survey",
    "Enquête avec microdonnées": "Survey",
    "Обследование": "Survey",
    "Обследование с микроданными": "Survey",
    "الدراسة الاستقصائية": "Survey",
    "المسح باستخدام البيانات الجزئية": "Survey",
    "Censo": "Census",
    "Recensement": "Census",
    "Перепись населения": "Census",
    "التعداد": "Census",
    "Autre": "Other",
    "Otro": "Other",
    "آخر": "Other",
    "Административная отчётность": "Admin",
    "مصدر إداري": "Admin",
}

STAGE_LEVELS = [
    "open defecation",
    "sharing",
    "user interface",
    "containment",
    "emptying",
    "transport",
    "FS treatment",
    "WW treatment",
]

STAGE_RULES = [
    Rule("od", "open defecation"),
    Rule("imp", "user interface"),
    Rule("con|net", "containment"),
    Rule("ebo|edl|ero|nemp", "emptying"),
    Rule("dtp", "transport"),
    Rule("rtp", "transport"),
    Rule("treat_fstp", "FS treatment"),
    Rule("treat_wtp", "WW treatment"),
    Rule("^s_sep|^s_lat|^s_sew", "user interface"),
    Rule("shared", "sharing"),
    Rule("_ns", "open defecation"),
]

SERVICE_RULES = [
    Rule("^san", "sanitation"),
    Rule("^wat", "water"),
    Rule("^hyg", "hygiene"),
]

INDICATOR_TYPE_RULES = [
    TypeRule("sanitation", "sanitation_technology", "(lat|sep|sew)$"),
    TypeRule("sanitation", "safely_managed_sanitation", "sm$"),
    TypeRule("sanitation", "sanitation_ladder", "(bas|lim|unimp|od)$"),
    TypeRule("water", "water_technology", "(pip|npip)$"),
    TypeRule("water", "safely_managed_drinking_water", "(ses|ble|ity)$"),
    TypeRule("water", "water_ladder", "(bas|lim|unimp|sur)$"),
    TypeRule("hygiene", "hygiene_ladder", "(bas|lim|nfac)$"),
    TypeRule("hygiene", "bathing_facilities", "(bfacw|bfac)$"),
]

INCOME_GROUPS = {
    "High income": "HIC",
    "Low income": "LIC",
    "Lower middle income": "LMC",
    "Upper middle income": "UMC",
}

INDICATOR_PREFIXES = ["wat_", "san_", "hyg_", "arc_"]
OBSERVATION_PREFIXES = ["s_"]
INDICATOR_ID_COLUMNS = ["name", "iso3", "year", "pop_n", "pop_t", "prop_u", "arc_hyg_bas_u"]
HELPER_COLUMNS = ["year2", "pop_n2", "blank", "latestyear"]

EXCLUDED_NOTE_PATTERN = "^(duplicate|alias|superseded|input)"

# Labels of the indicator codes, by code without its residence suffix.
INDICATOR_LABELS = {
    "wat_bas": "At least basic",
    "wat_lim": "Limited (more than 30 mins)",
    "wat_unimp": "Unimproved",
    "wat_sur": "Surface water",
    "arc_wat_bas": "Annual rate of change in basic",
    "wat_sm": "Safely managed",
    "wat_premises": "Accessible on premises",
    "wat_available": "Available when needed",
    "wat_quality": "Free from contamination",
    "wat_pip": "Piped",
    "wat_npip": "Non-piped",
    "san_bas": "At least basic",
    "san_lim": "Limited (shared)",
    "san_unimp": "Unimproved",
    "san_od": "Open defecation",
    "arc_san_bas": "Annual rate of change in basic",
    "arc_san_od": "Annual rate of change in open defecation",
    "san_sm": "Safely managed",
    "san_sdo_sm": "Disposed in situ",
    "san_fst_sm": "Emptied and treated",
    "san_sew_sm": "Wastewater treated",
    "san_lat": "Latrines and other",
    "san_sep": "Septic tanks",
    "san_sew": "Sewer connections",
    "hyg_bas": "Basic",
    "hyg_lim": "Limited (without water or soap)",
    "hyg_nfac": "No facility",
    "hyg_bfacw": "Bathing facilities on premises with water",
    "hyg_bfac": "Bathing facilities on premises",
}
# Codes whose published label differs from the label of their stem.
INDICATOR_LABEL_EXCEPTIONS = {"hyg_lim_r": "Limited"}
# Labelled columns that are not indicators.
PLAIN_LABELS = {
    "name": "name",
    "year": "year",
    "pop_n": "Population (thousands)",
    "prop_u": "% urban",
}
RESIDENCE_SUFFIXES = ["_n", "_r", "_u"]

# Labels of the raw observation codes, by code without its residence suffix.
OBSERVATION_LABELS = {
    "s_imp": "Improved",
    "s_lat_con": "Latrines: contained",
    "s_lat_dtp": "Latrines: delivered to treatment plant",
    "s_lat_ebo": "Latrines: emptied and buried onsite",
    "s_lat_edl": "Latrines: emptied and discharged locally",
    "s_lat_ero": "Latrines: emptied and removed offsite",
    "s_lat_nemp": "Latrines: not emptied",
    "s_lat": "Latrines and other",
    "s_ns": "Open defecation",
    "s_sep_con": "Septic: contained",
    "s_sep_dtp": "Septic: delivered to treatment plant",
    "s_sep_ebo": "Septic: emptied and buried onsite",
    "s_sep_edl": "Septic: emptied and discharged locally",
    "s_sep_ero": "Septic: emptied and removed offsite",
    "s_sep_nemp": "Septic: not emptied",
    "s_sep": "Septic tanks",
    "s_sew_net": "Wastewater enters network",
    "s_sew": "Sewer connection",
    "s_sew_rtp": "Wastewater reaches treatment plant",
    "s_shared": "Shared",
    "s_treat_fstp": "Treated at faecal sludge treatment plant",
    "s_treat_wtp": "Treated at wastewater treatment plant",
}
OBSERVATION_SUFFIXES = ["_t", "_r", "_u"]
# --- end of fixed values -------------------------------------------------------


def indicator_lookup() -> list[tuple[str, str]]:
    """``(var_short, var_long)`` of every labelled code: each stem at each level."""
    by_stem = {
        stem + suffix: label
        for stem, label in INDICATOR_LABELS.items()
        for suffix in RESIDENCE_SUFFIXES
    }
    return list({**PLAIN_LABELS, **by_stem, **INDICATOR_LABEL_EXCEPTIONS}.items())


def observation_lookup() -> list[tuple[str, str]]:
    """``(var_short, var_long)`` of every raw observation code."""
    return [
        (stem + suffix, label)
        for stem, label in OBSERVATION_LABELS.items()
        for suffix in OBSERVATION_SUFFIXES
    ]


def derive_residence(code: Column | str) -> Column:
    """National, rural or urban from the suffix of a variable code."""
    return first_match(code, RESIDENCE_RULES)


def derive_residence_legacy(code: Column | str) -> Column:
    """The pre-correction residence label, kept to reproduce older results."""
    return first_match(code, RESIDENCE_LEGACY_RULES)


def normalize_codes(code: Column | str, rewrites: Sequence[Rewrite] = CODE_REWRITES) -> Column:
    """Map codes of newer releases onto the vocabulary shared by all releases."""
    return rewrite(code, rewrites)


def normalize_raw_codes(code: Column | str) -> Column:
    """The two rewrites that make raw observation codes comparable."""
    return rewrite(code, RAW_CODE_REWRITES)


def map_source_type(
    label: Column | str, mapping: Mapping[str, str] = SOURCE_TYPE_LABELS
) -> Column:
    """Base label of a localised source type; unknown labels pass through."""
    return map_values(label, mapping)


def classify_stage(code: Column | str) -> Column:
    """Service-chain stage of a raw observation code."""
    return first_match(code, STAGE_RULES)


def derive_service(code: Column | str) -> Column:
    """Service area from the code prefix; rate-of-change codes have none."""
    return first_match(code, SERVICE_RULES)


def tidy_residence(code: Column | str) -> Column:
    """Residence of an already normalised code (``_n``, ``_r``, ``_u`` only)."""
    return first_match(code, TIDY_RESIDENCE_RULES)


def strip_suffix(
    code: Column | str, suffixes: Sequence[str] = tuple(RESIDENCE_SUFFIXES)
) -> Column:
    """Remove each suffix in turn, so a code may lose more than one."""
    return rewrite(code, [Rewrite(f"{suffix}$", "") for suffix in suffixes])


def recode_income(group: Column | str) -> Column:
    """Short identifier of an income group; NULL when the group is unknown."""
    return lookup_value(group, INCOME_GROUPS)


def is_excluded(notes: Column | str) -> Column:
    """Registry rows that are listed but never compared; a NULL note is kept."""
    notes = as_column(notes)
    return notes.isNotNull() & notes.rlike(EXCLUDED_NOTE_PATTERN)
