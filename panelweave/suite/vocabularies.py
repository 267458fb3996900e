"""Queries on codes, labels, lookups and the wide-to-long plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions import scalars, vocabulary as vocab
from panelweave.operators import audit, codes, joins, reshape, summary
from panelweave.plans import analysis, indicators, observations
from panelweave.suite import fixtures as fx
from panelweave.suite.registry import query

_OBS = fx.with_tables("observation_codes")
_IND = fx.with_tables("indicator_codes")
_NORMALIZED = fx.sql_rewrite("code", vocab.CODE_REWRITES)


@query(
    "derive_residence",
    _OBS
    + f"""SELECT event_id, code, {fx.sql_first_match('code', vocab.RESIDENCE_RULES)}
          AS residence FROM observation_codes""",
)
def derive_residence(spark, folder):
    return fx.observation_codes(spark, folder).select(
        "event_id", "code", vocab.derive_residence("code").alias("residence")
    )


@query(
    "derive_residence_legacy",
    _OBS
    + """SELECT event_id, code, CASE WHEN contains(code, '_n') THEN 'national'
           WHEN contains(code, '_r') THEN 'rural' WHEN contains(code, '_u') THEN 'urban'
           WHEN contains(code, '_t') THEN 'national' END AS residence_legacy
         FROM observation_codes""",
)
def derive_residence_legacy(spark, folder):
    return fx.observation_codes(spark, folder).select(
        "event_id", "code", vocab.derive_residence_legacy("code").alias("residence_legacy")
    )


@query("normalize_codes", _IND + f"SELECT event_id, {_NORMALIZED} AS code FROM indicator_codes")
def normalize_codes(spark, folder):
    rows = fx.indicator_codes(spark, folder)
    mapped = codes.map_codes(rows, "code", {"var_short": vocab.normalize_codes})
    return mapped.select("event_id", F.col("var_short").alias("code"))


@query(
    "normalize_codes_rowwise",
    _IND + f"SELECT event_id, {_NORMALIZED} AS code FROM indicator_codes",
)
def normalize_codes_rowwise(spark, folder):
    return fx.indicator_codes(spark, folder).select(
        "event_id", vocab.normalize_codes("code").alias("code")
    )


@query(
    "map_labels",
    fx.with_tables("editions")
    + f"""SELECT iso3, source, {fx.sql_case('type', vocab.SOURCE_TYPE_LABELS, 'type')} AS type,
          value FROM editions""",
)
def map_labels(spark, folder):
    return fx.editions(spark, folder).select(
        "iso3", "source", vocab.map_source_type("type").alias("type"), "value"
    )


@query(
    "strip_trailing_digits",
    fx.with_tables("editions")
    + "SELECT iso3, regexp_replace(source, '[0-9]+$', '') AS source, value FROM editions",
)
def strip_trailing_digits(spark, folder):
    return fx.editions(spark, folder).select(
        "iso3", scalars.strip_trailing_digits("source").alias("source"), "value"
    )


@query(
    "classify_stage",
    _OBS
    + f"""SELECT event_id, code, {fx.sql_first_match('code', vocab.STAGE_RULES)} AS stage
          FROM observation_codes""",
)
def classify_stage(spark, folder):
    rows = fx.observation_codes(spark, folder)
    mapped = codes.map_codes(rows, "code", {"stage": vocab.classify_stage})
    return mapped.select("event_id", "code", "stage")


@query(
    "ordered_categories",
    _OBS
    + f"""SELECT stage, CAST(nullif(list_position({fx.sql_list(vocab.STAGE_LEVELS)}, stage), 0)
            AS INTEGER) AS ord, n
          FROM (SELECT {fx.sql_first_match('code', vocab.STAGE_RULES)} AS stage, count(*) AS n
                FROM observation_codes GROUP BY 1) ORDER BY ord NULLS LAST""",
)
def ordered_categories(spark, folder):
    rows = fx.observation_codes(spark, folder)
    counts = codes.count_mapped(rows, "code", {"stage": vocab.classify_stage})
    return summary.with_level_order(counts, "stage", vocab.STAGE_LEVELS)


@query(
    "derive_service",
    _IND
    + """SELECT event_id, code, CASE WHEN starts_with(code, 'san') THEN 'sanitation'
           WHEN starts_with(code, 'wat') THEN 'water' WHEN starts_with(code, 'hyg') THEN 'hygiene'
         END AS service FROM indicator_codes""",
)
def derive_service(spark, folder):
    return fx.indicator_codes(spark, folder).select(
        "event_id", "code", vocab.derive_service("code").alias("service")
    )


_STRIPPED = "regexp_replace(regexp_replace(regexp_replace({0}, '_n$', ''), '_r$', ''), '_u$', '')"


@query(
    "strip_suffix",
    _IND
    + f"""SELECT event_id, CASE right(code, 2) WHEN '_n' THEN 'national' WHEN '_r' THEN 'rural'
            WHEN '_u' THEN 'urban' END AS residence, {_STRIPPED.format('code')} AS stem
          FROM (SELECT event_id, {_NORMALIZED} AS code FROM indicator_codes)""",
)
def strip_suffix(spark, folder):
    rules = {
        "residence": lambda code: vocab.tidy_residence(vocab.normalize_codes(code)),
        "stem": lambda code: vocab.strip_suffix(vocab.normalize_codes(code)),
    }
    rows = fx.indicator_codes(spark, folder)
    return codes.map_codes(rows, "code", rules).select("event_id", "residence", "stem")


_LABELLED = (
    fx.with_tables("indicator_codes", "lookup")
    + f""", labelled AS (SELECT event_id, value, {_STRIPPED.format('c.code')} AS code,
            l.var_long AS label,
            CASE WHEN starts_with(c.code, 'san') THEN 'sanitation'
                 WHEN starts_with(c.code, 'wat') THEN 'water'
                 WHEN starts_with(c.code, 'hyg') THEN 'hygiene' END AS service
          FROM (SELECT event_id, value, {_NORMALIZED} AS code FROM indicator_codes) c
          JOIN lookup l ON l.var_short = c.code)
"""
)
_TYPE_BRANCHES = " UNION ALL ".join(
    f"""SELECT event_id, value, code, service, '{r.name}' AS indicator_type, label AS indicator
        FROM labelled WHERE service = '{r.service}' AND regexp_matches(code, '{r.pattern}')"""
    for r in vocab.INDICATOR_TYPE_RULES
)


@query("classify_explode", _LABELLED + _TYPE_BRANCHES)
def classify_explode(spark, folder):
    rows = fx.indicator_codes(spark, folder).select("event_id", "value", "code")
    return indicators.classify_rows(rows, "code", fx.lookup_table(spark)).select(
        "event_id", "value", F.col("var_short").alias("code"), "service", "indicator_type",
        "indicator",
    )


@query(
    "explode_labels_rowwise",
    _LABELLED + _TYPE_BRANCHES,
)
def explode_labels_rowwise(spark, folder):
    normalized = fx.indicator_codes(spark, folder).select(
        "event_id", "value", vocab.normalize_codes("code").alias("var_short")
    )
    labelled = joins.lookup_join(normalized, fx.lookup_table(spark), "var_short").select(
        "event_id",
        "value",
        vocab.strip_suffix("var_short").alias("code"),
        vocab.derive_service("var_short").alias("service"),
        F.col("var_long").alias("label"),
    )
    return reshape.explode_labels(
        labelled, "code", "service", "label", vocab.INDICATOR_TYPE_RULES
    ).drop("label")


_ROWS = (
    fx.with_tables("indicator_codes", "lookup")
    + f", coded AS (SELECT event_id, {_NORMALIZED} AS var_short FROM indicator_codes)\n"
)


def _coded(spark, folder):
    rows = fx.indicator_codes(spark, folder).select("event_id", "code")
    return codes.map_codes(rows, "code", {"var_short": vocab.normalize_codes}).drop("code")


@query(
    "lookup_left_join",
    _ROWS + "SELECT event_id, var_short, var_long FROM coded LEFT JOIN lookup USING (var_short)",
)
def lookup_left_join(spark, folder):
    return joins.lookup_join(_coded(spark, folder), fx.lookup_table(spark), "var_short")


@query(
    "lookup_matched_rows",
    _ROWS + "SELECT event_id, var_short, var_long FROM coded JOIN lookup USING (var_short)",
)
def lookup_matched_rows(spark, folder):
    lookup = joins.clean_lookup(fx.lookup_table(spark), "var_short", "var_long")
    return audit.matched_rows(_coded(spark, folder), lookup, "var_short", "var_long")


@query(
    "unmatched_codes",
    _ROWS
    + """SELECT DISTINCT var_short FROM coded
         WHERE var_short IS NULL OR var_short NOT IN (SELECT var_short FROM lookup)""",
)
def unmatched_codes(spark, folder):
    return audit.unmatched_codes(_coded(spark, folder), fx.lookup_table(spark), "var_short")


@query(
    "lookup_coverage_gate",
    _ROWS
    + """SELECT n_codes, n_unmatched, CASE WHEN 2 * n_unmatched > n_codes THEN 'stop'
           WHEN n_unmatched > 0 THEN 'warn' ELSE 'ok' END AS verdict
         FROM (SELECT count(*) AS n_codes, count(*) FILTER (WHERE var_short IS NULL
                 OR var_short NOT IN (SELECT var_short FROM lookup)) AS n_unmatched
               FROM (SELECT DISTINCT var_short FROM coded))""",
)
def lookup_coverage_gate(spark, folder):
    return audit.lookup_coverage(_coded(spark, folder), fx.lookup_table(spark), "var_short")


@query(
    "distinct_codes",
    _OBS
    + """SELECT count(DISTINCT code) + CASE WHEN count(*) > count(code) THEN 1 ELSE 0 END
           AS n_codes FROM observation_codes""",
)
def distinct_codes(spark, folder):
    return fx.observation_codes(spark, folder).agg(
        summary.count_distinct_with_null("code").alias("n_codes")
    )


@query(
    "label_transition_counts",
    _OBS
    + f"""SELECT residence_legacy, residence, count(*) AS n FROM (
            SELECT CASE WHEN contains(code, '_n') THEN 'national'
                     WHEN contains(code, '_r') THEN 'rural' WHEN contains(code, '_u') THEN 'urban'
                     WHEN contains(code, '_t') THEN 'national' END AS residence_legacy,
                   {fx.sql_first_match('code', vocab.RESIDENCE_RULES)} AS residence
            FROM observation_codes)
          WHERE residence_legacy IS DISTINCT FROM residence GROUP BY ALL""",
)
def label_transition_counts(spark, folder):
    rules = {
        "residence_legacy": vocab.derive_residence_legacy,
        "residence": vocab.derive_residence,
    }
    counts = codes.count_mapped(fx.observation_codes(spark, folder), "code", rules)
    return audit.label_transitions(counts, "residence_legacy", "residence", "n")


@query("natural_left_join_3way", fx.JOINED_SHEETS + "SELECT * FROM joined_sheets")
def natural_left_join_3way(spark, folder):
    from panelweave.operators.select import select_by_type

    sheets = fx.wide_sheets(spark, folder)
    return joins.natural_left_join(
        [select_by_type(s, ["name", "iso3"], drop=vocab.HELPER_COLUMNS) for s in sheets]
    )


# Sheet column, code without suffix, residence, service, type and label (fixed values).
_TIDY_ROWS = [
    ("wat_basal_t", "wat_bas", "national", "water", "water_ladder", "At least basic"),
    ("wat_lim_r", "wat_lim", "rural", "water", "water_ladder", "Limited (more than 30 mins)"),
    ("wat_ns_u", "wat_sur", "urban", "water", "water_ladder", "Surface water"),
    ("san_basal_t", "san_bas", "national", "sanitation", "sanitation_ladder", "At least basic"),
    ("san_ns_r", "san_od", "rural", "sanitation", "sanitation_ladder", "Open defecation"),
    ("san_sew_u", "san_sew", "urban", "sanitation", "sanitation_technology", "Sewer connections"),
    ("san_sm_t", "san_sm", "national", "sanitation", "safely_managed_sanitation", "Safely managed"),
    ("hyg_bas_t", "hyg_bas", "national", "hygiene", "hygiene_ladder", "Basic"),
    ("hyg_ns_u", "hyg_nfac", "urban", "hygiene", "hygiene_ladder", "No facility"),
]


@query(
    "tidy_wide_sheets",
    fx.JOINED_SHEETS
    + " UNION ALL ".join(
        f"""SELECT name, iso3, year, pop_t, prop_u, arc_hyg_bas_u, '{code}' AS var_short,
              {column} AS percent, '{residence}' AS residence, '{service}' AS service,
              '{kind}' AS indicator_type, '{label}' AS indicator FROM joined_sheets"""
        for column, code, residence, service, kind, label in _TIDY_ROWS
    ),
)
def tidy_wide_sheets(spark, folder):
    tidy = indicators.tidy_indicators(fx.wide_sheets(spark, folder), fx.lookup_table(spark))
    return tidy.estimates


_SHEET_COLUMNS = {
    "s_imp_t": "CASE WHEN o_orderstatus = 'F' THEN o_totalprice END",
    "s_lat_nemp_u": "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END",
    "s_ns_r": "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1.0 END",
}
_LISTED = "(SELECT l_orderkey FROM lineitem)"


@query(
    "tidy_entity_files",
    fx.with_tables("variables")
    + f""", sheets AS (SELECT o_orderkey, o_orderpriority AS source, o_orderstatus AS type,
              CAST(year(o_orderdate) AS DOUBLE) AS year,
              {', '.join(f'{sql} AS {name}' for name, sql in _SHEET_COLUMNS.items())}
            FROM orders WHERE o_orderkey IN {_LISTED}),
          long AS ({' UNION ALL '.join(
              f"SELECT o_orderkey, source, type, year, '{c}' AS var_short, {c} AS value "
              f"FROM sheets WHERE {c} IS NOT NULL" for c in _SHEET_COLUMNS)}),
          complete AS (SELECT * FROM long UNION ALL
            SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL FROM sheets
            WHERE o_orderkey NOT IN (SELECT o_orderkey FROM long))
        SELECT c.*, v.var_long,
          {fx.sql_first_match('v.var_short', vocab.RESIDENCE_RULES)} AS residence,
          {fx.sql_first_match('v.var_short', vocab.RESIDENCE_LEGACY_RULES)} AS residence_legacy,
          {fx.sql_first_match('v.var_short', vocab.STAGE_RULES)} AS san_service_chain
        FROM complete c LEFT JOIN variables v ON v.var_short = c.var_short""",
)
def tidy_entity_files(spark, folder):
    status, priority, price = (
        F.col(c) for c in ("o_orderstatus", "o_orderpriority", "o_totalprice")
    )
    sheets = fx.table(spark, folder, "orders").select(
        "o_orderkey",
        priority.alias("source"),
        status.alias("type"),
        F.year("o_orderdate").cast("double").alias("year"),
        F.when(status == "F", price).alias("s_imp_t"),
        F.when(priority == "1-URGENT", price).alias("s_lat_nemp_u"),
        F.when((priority == "5-LOW") & (status == "P"), 1.0).alias("s_ns_r"),
    )
    entities = fx.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return observations.tidy_observations(
        sheets, entities.distinct(), fx.variable_table(spark), entity="o_orderkey"
    )


GROUP_LABELS = {
    "AUTOMOBILE": "High income",
    "BUILDING": "Low income",
    "FURNITURE": "Lower middle income",
    "HOUSEHOLD": "Upper middle income",
}


def _income(spark, folder):
    segment = F.col("c_mktsegment")
    labels = F.create_map(*[F.lit(x) for kv in GROUP_LABELS.items() for x in kv])
    return fx.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Code"), segment.alias("Region"), labels[segment].alias("group")
    )


_INCOME_ID = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'HIC' WHEN 'BUILDING' THEN 'LIC' " \
    "WHEN 'FURNITURE' THEN 'LMC' WHEN 'HOUSEHOLD' THEN 'UMC' END"


@query(
    "recode_groups",
    f"SELECT c_custkey AS iso3, c_mktsegment AS region, {_INCOME_ID} AS income_id FROM customer",
)
def recode_groups(spark, folder):
    return analysis.income_groups(_income(spark, folder), "Code", "Region", "group")


_ESTIMATES = """SELECT o_orderkey, o_custkey AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(o_custkey AS DOUBLE) + 0.5 AS pop_t, CAST(o_custkey % 100 AS DOUBLE) AS prop_u,
    CASE o_orderstatus WHEN 'F' THEN 'national' WHEN 'O' THEN 'urban' WHEN 'P' THEN 'rural' END
      AS residence,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'sanitation' ELSE 'water' END
      AS service,
    CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'Safely managed' ELSE 'Basic' END
      AS indicator,
    o_totalprice AS percent FROM orders"""
_POP = """CASE residence WHEN 'national' THEN pop_t * 1000 WHEN 'urban' THEN
    pop_t * 1000 * prop_u / 100 WHEN 'rural' THEN pop_t * 1000 * (100 - prop_u) / 100 END"""


def _estimates(spark, folder):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return fx.table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("iso3"),
        F.year("o_orderdate").alias("year"),
        (F.col("o_custkey").cast("double") + 0.5).alias("pop_t"),
        (F.col("o_custkey") % 100).cast("double").alias("prop_u"),
        F.when(status == "F", "national").when(status == "O", "urban").otherwise("rural")
        .alias("residence"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "sanitation").otherwise("water")
        .alias("service"),
        F.when(priority.isin("1-URGENT", "3-MEDIUM"), "Safely managed").otherwise("Basic")
        .alias("indicator"),
        F.col("o_totalprice").alias("percent"),
    )


@query(
    "population_by_residence",
    f"SELECT o_orderkey, residence, {_POP} AS pop FROM ({_ESTIMATES})",
)
def population_by_residence(spark, folder):
    return _estimates(spark, folder).select(
        "o_orderkey",
        "residence",
        scalars.population_by_residence("residence", "pop_t", "prop_u").alias("pop"),
    )


@query(
    "subset_with_groups",
    f"""SELECT o_orderkey, iso3, year, residence, indicator, percent, {_POP} AS pop,
          c_mktsegment AS region, {_INCOME_ID} AS income_id
        FROM ({_ESTIMATES}) LEFT JOIN customer ON c_custkey = iso3
        WHERE service = 'sanitation' AND indicator = 'Safely managed'
          AND year IN (1996, 1998, 2000)""",
)
def subset_with_groups(spark, folder):
    groups = analysis.income_groups(_income(spark, folder), "Code", "Region", "group")
    return analysis.subset_with_groups(
        _estimates(spark, folder), groups, years=(1996, 1998, 2000)
    )


@query(
    "capture_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def capture_date(spark, folder):
    stamped = fx.table(spark, folder, "events").select(
        "event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("stamp")
    )
    return stamped.select(
        "event_id", scalars.capture_date("stamp").cast("string").alias("day")
    )


@query(
    "topk_entities",
    """SELECT c.c_name AS name, t.entity, t.n FROM (
         SELECT o_custkey AS entity, count(*) AS n FROM orders GROUP BY 1
         ORDER BY n DESC, entity LIMIT 10) t LEFT JOIN customer c ON c.c_custkey = t.entity""",
)
def topk_entities(spark, folder):
    counts = summary.count_by(
        fx.table(spark, folder, "orders").select(F.col("o_custkey").alias("entity")), "entity"
    )
    names = fx.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_name").alias("name")
    )
    return summary.top_entities(counts, "entity", 10, names)


