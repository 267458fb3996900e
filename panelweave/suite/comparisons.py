"""Queries on release comparison, key audits, the registry and capture checks."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from panelweave.functions import scalars, vocabulary as vocab
from panelweave.operators import audit, dedup, diff, joins, registry
from panelweave.operators.reshape import append_placeholders, as_map
from panelweave.plans.diff_report import report_registered
from panelweave.schema import RAW_KEY
from panelweave.session import input_bytes, shuffle_partitions
from panelweave.sources.scratch import scratch_path
from panelweave.sources.snapshots import harmonise_raw, raw_rows, save_releases
from panelweave.sources.tables import small_table
from panelweave.suite import fixtures as fx
from panelweave.suite.registry import query


def _diff(spark, folder):
    return diff.diff_snapshots(
        fx.snap_old(spark, folder), fx.snap_new(spark, folder), fx.SNAP_KEY, "value"
    )


_HARMONISED = (
    fx.with_tables("editions")
    + f""", harmonised AS (SELECT iso3, source AS edition,
            regexp_replace(source, '[0-9]+$', '') AS source,
            {fx.sql_case('type', vocab.SOURCE_TYPE_LABELS, 'type')} AS type,
            CAST(trunc(year) AS INTEGER) AS year,
            {fx.sql_rewrite('var_short', vocab.RAW_CODE_REWRITES)} AS var_short, value
          FROM editions WHERE coalesce(source, type, var_short) IS NOT NULL
            OR coalesce(year, value) IS NOT NULL)
"""
)


def _newest_sql(condition: str) -> str:
    return f"""(SELECT * FROM harmonised WHERE {condition}
      QUALIFY row_number() OVER (PARTITION BY iso3, source, type, year, var_short
        ORDER BY edition DESC NULLS LAST, value ASC NULLS LAST) = 1)"""


@query(
    "diff_harmonised_snapshots",
    _HARMONISED
    + f"""SELECT coalesce(o.iso3, n.iso3) AS iso3, coalesce(o.source, n.source) AS source,
            coalesce(o.type, n.type) AS type, coalesce(o.year, n.year) AS year,
            coalesce(o.var_short, n.var_short) AS var_short,
            o.value AS value_old, n.value AS value_new,
            CASE WHEN o.iso3 IS NULL THEN 'added' WHEN n.iso3 IS NULL THEN 'removed'
                 WHEN abs(n.value - o.value) > 1e-6 THEN 'changed' ELSE 'unchanged' END AS status
          FROM {_newest_sql('year < 2000')} o FULL JOIN {_newest_sql('year >= 1996')} n
            ON o.iso3 = n.iso3 AND o.source = n.source AND o.type = n.type
           AND o.year = n.year AND o.var_short = n.var_short""",
)
def diff_harmonised_snapshots(spark, folder):
    """Harmonise two raw releases and compare them; the comparison shuffles nothing."""
    rows = raw_rows(fx.editions(spark, folder))
    sides = [
        harmonise_raw(side, [F.col("value").asc_nulls_last()])
        for side in (rows.filter(F.col("year") < 2000), rows.filter(F.col("year") >= 1996))
    ]
    return diff.diff_snapshots(*sides, RAW_KEY, "value")


def _counts_sql(by: str, source: str) -> str:
    columns = ", ".join(
        f"count(*) FILTER (WHERE status = '{s}') AS n_{s}" for s in diff.STATUSES
    )
    return f"SELECT {by}{', ' if by else ''}{columns} FROM {source}" + (
        f" GROUP BY {by}" if by else ""
    )


@query("diff_snapshots", fx.SNAP_DIFF + "SELECT * FROM snap_diff")
def diff_snapshots(spark, folder):
    return _diff(spark, folder)


@query("diff_by_year", fx.SNAP_DIFF + _counts_sql("yr", "snap_diff"))
def diff_by_year(spark, folder):
    return diff.summarise_diff_by(_diff(spark, folder), ["yr"])


@query("diff_detail", fx.SNAP_DIFF + "SELECT * FROM snap_diff WHERE status <> 'unchanged'")
def diff_detail(spark, folder):
    return diff.diff_detail(_diff(spark, folder), ["entity", "yr", "source", "obs"])


@query(
    "diff_full_outer",
    fx.SNAP_DIFF
    + """SELECT entity, source, obs, yr, value_old, value_new,
           CAST(status <> 'added' AS BIGINT) AS n_old,
           CAST(status <> 'removed' AS BIGINT) AS n_new FROM snap_diff""",
)
def diff_full_outer(spark, folder):
    return diff.align_snapshots(
        fx.snap_old(spark, folder), fx.snap_new(spark, folder), fx.SNAP_KEY, "value"
    )


@query(
    "status_totals",
    fx.SNAP_DIFF
    + """SELECT s.status, count(d.status) AS n
         FROM (VALUES ('added'), ('removed'), ('changed'), ('unchanged')) s(status)
         LEFT JOIN snap_diff d USING (status) GROUP BY 1""",
)
def status_totals(spark, folder):
    return diff.status_totals(_diff(spark, folder))


@query("status_totals_map", fx.SNAP_DIFF + _counts_sql("", "snap_diff"))
def status_totals_map(spark, folder):
    totals = as_map(diff.status_totals(_diff(spark, folder)), "status", "n", diff.STATUSES)
    return totals.select(*[F.col("totals")[s].alias("n_" + s) for s in diff.STATUSES])


_HEADLINE = ("count(*) FILTER (WHERE status <> 'added') AS old_rows, "
             "count(*) FILTER (WHERE status <> 'removed') AS new_rows")


@query(
    "diff_headline",
    fx.SNAP_DIFF + _counts_sql("", "snap_diff").replace("SELECT ", f"SELECT {_HEADLINE}, ", 1),
)
def diff_headline(spark, folder):
    return diff.diff_headline(_diff(spark, folder))


@query(
    "headline_numbers",
    fx.SNAP_DIFF
    + """SELECT source, format('{:,}', old_rows) AS old_rows, format('{:,}', new_rows) AS new_rows,
           round(n_changed * 100.0::DOUBLE / new_rows, 1) AS changed_percent
         FROM (SELECT source, count(*) FILTER (WHERE status <> 'added') AS old_rows,
                 count(*) FILTER (WHERE status <> 'removed') AS new_rows,
                 count(*) FILTER (WHERE status = 'changed') AS n_changed
               FROM snap_diff GROUP BY source)""",
)
def headline_numbers(spark, folder):
    return diff.diff_headline(_diff(spark, folder), ["source"]).select(
        "source",
        scalars.with_thousands("old_rows").alias("old_rows"),
        scalars.with_thousands("new_rows").alias("new_rows"),
        F.round(F.col("n_changed") * F.lit(100.0) / F.col("new_rows"), 1).alias("changed_percent"),
    )


@query(
    "top_added_entities",
    fx.SNAP_DIFF
    + """SELECT entity, count(*) AS n_added FROM snap_diff WHERE status = 'added'
         GROUP BY 1 ORDER BY n_added DESC, entity LIMIT 15""",
)
def top_added_entities(spark, folder):
    return diff.top_added_entities(_diff(spark, folder), "entity", 15)


_PAIRS = list(zip(fx.RELEASES, fx.RELEASES[1:]))


@query("diff_all_pairs", fx.PAIR_DIFF + "SELECT * FROM pair_diff")
def diff_all_pairs(spark, folder):
    return diff.diff_pairs(fx.release_panel(spark, folder), _PAIRS, fx.RELEASE_KEY, "value")


@query("diff_release_table", fx.PAIR_DIFF + "SELECT * FROM pair_diff")
def diff_release_table(spark, folder):
    """The same comparison on a table that needs no shuffle for it."""
    size = input_bytes(spark, f"{folder}/orders.parquet")
    releases = save_releases(
        fx.release_panel(spark, folder),
        f"panelweave_releases_{uuid.uuid4().hex}",
        fx.RELEASE_KEY,
        buckets=max(spark.sparkContext.defaultParallelism, shuffle_partitions(size)),
        path=scratch_path(spark, "releases"),
        mode="overwrite",
    )
    return diff.diff_pairs(releases, _PAIRS, fx.RELEASE_KEY, "value", clustered=True)


def _report(spark, folder):
    """From a registry of written snapshots to the tables of the report."""
    panel = fx.release_panel(spark, folder)
    base = scratch_path(spark, "report-snapshots")
    panel.write.partitionBy("release_id").parquet(base)
    manifest = panel.select("release_id").distinct().select(
        "release_id",
        F.concat(F.substring("release_id", 2, 4), F.lit("-12-31")).alias("snapshot_date"),
        F.lit("raw").alias("pipeline"),
        F.concat(F.lit(f"{base}/release_id="), "release_id").alias("file"),
        F.lit("live").alias("source"),
        F.lit("as published").alias("notes"),
    )
    return report_registered(
        registry.manifest_flags(manifest, manifest, fx.RELEASES), "raw", spark.read.parquet,
        fx.RELEASE_KEY, "value", group="kind", entity="entity", detail_order=("entity", "kind"),
    )


@query(
    "diff_report_headline",
    fx.PAIR_DIFF
    + _counts_sql("pair", "pair_diff").replace("SELECT pair", f"SELECT pair, {_HEADLINE}", 1),
)
def diff_report_headline(spark, folder):
    return _report(spark, folder).headline


@query("diff_report_by_group", fx.PAIR_DIFF + _counts_sql("pair, kind", "pair_diff"))
def diff_report_by_group(spark, folder):
    return _report(spark, folder).by_group


@query(
    "diff_report_top_added",
    fx.PAIR_DIFF
    + """SELECT pair, entity, n_added FROM (
           SELECT pair, entity, count(*) AS n_added, row_number() OVER (PARTITION BY pair
             ORDER BY count(*) DESC, entity) AS rn
           FROM pair_diff WHERE status = 'added' GROUP BY pair, entity) WHERE rn <= 15""",
)
def diff_report_top_added(spark, folder):
    return _report(spark, folder).top_added


@query(
    "diff_report_detail", fx.PAIR_DIFF + "SELECT * FROM pair_diff WHERE status <> 'unchanged'"
)
def diff_report_detail(spark, folder):
    return _report(spark, folder).detail


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, folder):
    return audit.duplicate_keys(
        fx.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


_EDITION_KEY = ["iso3", "source", "type", "year", "var_short"]
_EDITION_KEY_SQL = "iso3, regexp_replace(source, '[0-9]+$', ''), type, trunc(year), var_short"


def _editions(spark, folder):
    return fx.editions(spark, folder).withColumns(
        {
            "edition": F.col("source"),
            "source": scalars.strip_trailing_digits("source"),
            "year": F.col("year").cast("int"),
        }
    )


@query(
    "keep_newest_edition",
    fx.with_tables("editions")
    + f"""SELECT iso3, regexp_replace(source, '[0-9]+$', '') AS source, type,
            CAST(trunc(year) AS INTEGER) AS year, var_short, value, source AS edition
          FROM editions QUALIFY row_number() OVER (PARTITION BY {_EDITION_KEY_SQL}
            ORDER BY source DESC NULLS LAST, value ASC NULLS LAST) = 1""",
)
def keep_newest_edition(spark, folder):
    return dedup.keep_newest_edition(
        _editions(spark, folder), _EDITION_KEY, "edition", [F.col("value").asc_nulls_last()]
    )


@query(
    "collapsed_rows",
    fx.with_tables("editions")
    + f"""SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
            CAST(sum(n - 1) AS BIGINT) AS n_dropped
          FROM (SELECT count(*) AS n FROM editions GROUP BY {_EDITION_KEY_SQL})""",
)
def collapsed_rows(spark, folder):
    return dedup.collapsed_rows(_editions(spark, folder), _EDITION_KEY)


@query(
    "distinct_rows",
    "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
)
def distinct_rows(spark, folder):
    return (
        fx.table(spark, folder, "lineitem")
        .select("l_suppkey", "l_returnflag", "l_linestatus")
        .distinct()
    )


# --- registry ----------------------------------------------------------------------


@query(
    "manifest_fill_anti_join",
    fx.with_tables("manifest", "builtin")
    + """SELECT * FROM builtin b WHERE NOT EXISTS (SELECT 1 FROM manifest m
           WHERE m.release_id = b.release_id AND m.pipeline = b.pipeline)""",
)
def manifest_fill_anti_join(spark, folder):
    return joins.not_covered(
        fx.builtin(spark, folder), fx.manifest(spark, folder), ["release_id", "pipeline"]
    )


@query(
    "manifest_merge",
    fx.with_tables("manifest", "builtin")
    + """SELECT release_id, snapshot_date, pipeline, file, source, notes FROM (
           SELECT *, row_number() OVER (PARTITION BY file ORDER BY rank, pipeline, release_id) AS rn
           FROM (SELECT *, 1 AS rank FROM manifest UNION ALL
                 SELECT *, 2 FROM builtin b WHERE NOT EXISTS (SELECT 1 FROM manifest m
                   WHERE m.release_id = b.release_id AND m.pipeline = b.pipeline))) WHERE rn = 1""",
)
def manifest_merge(spark, folder):
    return registry.manifest_merge(fx.manifest(spark, folder), fx.builtin(spark, folder))


def revisions(spark, folder):
    """New registrations: every shipped line re-registers the file of its order."""
    lines = fx.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat_ws(
            "-", F.date_format("l_shipdate", "yyyy-MM-dd"), "l_linenumber", "l_partkey", "l_suppkey",
            (F.col("l_extendedprice") * 100).cast("long"),
        ).alias("sequence"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )
    return lines.join(fx.table(spark, folder, "orders"), "o_orderkey").select(
        F.concat(F.lit("r"), F.year("o_orderdate")).alias("release_id"),
        F.col("shipped").alias("snapshot_date"),
        F.lit("raw").alias("pipeline"),
        F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_raw_"), "o_orderkey", F.lit(".csv")
        ).alias("file"),
        F.lit("live").alias("source"),
        F.lit("tidied again").alias("notes"),
        "sequence",
    )


@query(
    "manifest_upsert",
    fx.with_tables("manifest")
    + """, revisions AS (
           SELECT 'r' || CAST(year(o_orderdate) AS VARCHAR) AS release_id,
             max(strftime(l_shipdate, '%Y-%m-%d')) AS snapshot_date, 'raw' AS pipeline,
             strftime(o_orderdate, '%Y-%m-%d') || '_raw_' || CAST(o_orderkey AS VARCHAR) || '.csv'
               AS file, 'live' AS source, 'tidied again' AS notes
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
         SELECT * FROM manifest WHERE file NOT IN (SELECT file FROM revisions)
         UNION ALL SELECT * FROM revisions""",
)
def manifest_upsert(spark, folder):
    return registry.manifest_upsert(
        fx.manifest(spark, folder), revisions(spark, folder), sequence="sequence"
    )


def _flags(spark, folder):
    return registry.manifest_flags(
        fx.manifest(spark, folder), fx.listing(spark, folder), fx.RELEASE_ORDER
    )


@query("manifest_flags", fx.FLAGS + "SELECT * FROM flags")
def manifest_flags(spark, folder):
    return _flags(spark, folder)


@query(
    "manifest_unavailable",
    fx.FLAGS + "SELECT DISTINCT release_id, pipeline FROM flags WHERE NOT available",
)
def manifest_unavailable(spark, folder):
    return registry.unavailable_releases(_flags(spark, folder))


@query(
    "manifest_available",
    fx.FLAGS + "SELECT DISTINCT release_id, pipeline FROM flags WHERE available AND NOT excluded",
)
def manifest_available(spark, folder):
    return registry.available_releases(_flags(spark, folder))


@query(
    "manifest_inventory",
    fx.FLAGS
    + """SELECT release_id, pipeline, snapshot_date, file, source,
           CASE WHEN available THEN 'yes' ELSE 'no' END AS available, notes FROM flags""",
)
def manifest_inventory(spark, folder):
    return registry.inventory(_flags(spark, folder))


@query("first_snapshot_per_release", fx.FIRST_SNAPSHOTS + "SELECT * FROM first_snapshots")
def first_snapshot_per_release(spark, folder):
    return registry.first_snapshot_per_release(_flags(spark, folder))


@query(
    "consecutive_pairs",
    fx.FIRST_SNAPSHOTS
    + """SELECT pipeline, old_release, new_release, old_file, new_file,
           concat_ws('_vs_', old_release, new_release) AS label
         FROM (SELECT pipeline, release_id AS old_release, file AS old_file,
                 lead(release_id) OVER w AS new_release, lead(file) OVER w AS new_file
               FROM first_snapshots
               WINDOW w AS (PARTITION BY pipeline ORDER BY release_ord NULLS LAST))
         WHERE new_file IS NOT NULL""",
)
def consecutive_pairs(spark, folder):
    return registry.consecutive_pairs(registry.first_snapshot_per_release(_flags(spark, folder)))


# --- entities and ingest --------------------------------------------------------------


def _customers(spark, folder):
    return fx.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("segment")
    )


def _recent(spark, folder):
    """Observations on record: every event; most entities have none."""
    return fx.table(spark, folder, "events").select(F.col("user_id").alias("entity"), "value")


_RECENT = "SELECT user_id AS entity, value FROM events"


@query(
    "missing_entities",
    f"""SELECT c_custkey AS entity FROM customer
        WHERE c_custkey NOT IN (SELECT entity FROM ({_RECENT}))""",
)
def missing_entities(spark, folder):
    return joins.missing_entities(_customers(spark, folder), _recent(spark, folder), "entity")


@query(
    "available_entities",
    f"""SELECT c_custkey AS entity, c_mktsegment AS segment FROM customer
        WHERE c_custkey IN (SELECT entity FROM ({_RECENT}))""",
)
def available_entities(spark, folder):
    return joins.available_entities(_customers(spark, folder), _recent(spark, folder), "entity")


@query(
    "no_data_entities",
    f"""SELECT c_custkey AS entity, count(r.entity) AS n FROM customer
        LEFT JOIN ({_RECENT}) r ON r.entity = c_custkey GROUP BY 1 HAVING count(r.entity) = 0""",
)
def no_data_entities(spark, folder):
    missing = joins.missing_entities(_customers(spark, folder), _recent(spark, folder), "entity")
    return missing.withColumn("n", F.lit(0).cast("long"))


@query(
    "append_placeholders",
    f"""SELECT * FROM ({_RECENT}) UNION ALL SELECT c_custkey, NULL FROM customer
        WHERE c_custkey NOT IN (SELECT entity FROM ({_RECENT}))""",
)
def with_placeholders(spark, folder):
    recent = _recent(spark, folder)
    return append_placeholders(recent, _customers(spark, folder), recent, "entity")


@query(
    "entity_coverage_gate",
    f"""SELECT segment, n_entities, n_present, CASE WHEN 2 * n_present < n_entities THEN 'reject'
          WHEN n_present < n_entities THEN 'partial' ELSE 'complete' END AS verdict
        FROM (SELECT c_mktsegment AS segment, count(*) AS n_entities, count(*) FILTER (
                WHERE c_custkey IN (SELECT entity FROM ({_RECENT}))) AS n_present
              FROM customer GROUP BY 1)""",
)
def entity_coverage_gate(spark, folder):
    return audit.entity_coverage(
        _customers(spark, folder), _recent(spark, folder), "entity", ["segment"]
    )


_RESULTS = """SELECT event_id, user_id AS entity, CASE event_type WHEN 'error'
    THEN 'download failed' WHEN 'signup' THEN 'not the expected kind of file' ELSE 'ok' END AS status
  FROM events"""
KNOWN_MISSING = [17, 42]


def _results(spark, folder):
    kind = F.col("event_type")
    return fx.table(spark, folder, "events").select(
        F.col("user_id").alias("entity"),
        F.when(kind == "error", "download failed")
        .when(kind == "signup", "not the expected kind of file")
        .otherwise("ok")
        .alias("status"),
    )


@query(
    "failure_log",
    f"""SELECT entity, status, CASE WHEN entity IN (17, 42) THEN 'known missing' END AS note
        FROM ({_RESULTS}) WHERE status <> 'ok'""",
)
def failure_log(spark, folder):
    return audit.failure_log(_results(spark, folder), "entity", KNOWN_MISSING)


@query(
    "ingest_totals",
    f"""SELECT count(*) FILTER (WHERE status = 'ok') AS n_ok,
          count(*) FILTER (WHERE status <> 'ok') AS n_failed FROM ({_RESULTS})""",
)
def ingest_totals(spark, folder):
    return audit.ingest_totals(_results(spark, folder))


# --- release validation -------------------------------------------------------------------


def _estimates(spark, folder):
    return fx.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("release_id"), F.year("o_orderdate").alias("year")
    )


@query(
    "max_year_per_release",
    """SELECT o_orderpriority AS release_id, CAST(max(year(o_orderdate)) AS INTEGER) AS max_year
       FROM orders GROUP BY 1""",
)
def max_year_per_release(spark, folder):
    return _estimates(spark, folder).groupBy("release_id").agg(F.max("year").alias("max_year"))


EXPECTED_YEARS = [
    ("1-URGENT", 2001), ("2-HIGH", 2000), ("3-MEDIUM", 2001), ("5-LOW", 2001), ("6-ABSENT", 2001),
]


@query(
    "release_max_year_check",
    """SELECT release_id, max_year, expected_max_year,
         CASE WHEN max_year IS NULL THEN 'no estimates'
              WHEN max_year IS NOT DISTINCT FROM expected_max_year
              THEN 'ends in ' || CAST(max_year AS VARCHAR)
              ELSE 'stale: ends in ' || CAST(max_year AS VARCHAR) || ' instead of '
                || coalesce(CAST(expected_max_year AS VARCHAR), 'NA') END AS reason
       FROM (SELECT o_orderpriority AS release_id,
               CAST(max(year(o_orderdate)) AS INTEGER) AS max_year FROM orders GROUP BY 1)
       FULL JOIN (VALUES ('1-URGENT', 2001), ('2-HIGH', 2000), ('3-MEDIUM', 2001),
         ('5-LOW', 2001), ('6-ABSENT', 2001)) e(release_id, expected_max_year) USING (release_id)""",
)
def release_max_year_check(spark, folder):
    expected = small_table(spark, EXPECTED_YEARS, "release_id string, expected_max_year int")
    return audit.max_year_check(_estimates(spark, folder), expected, "release_id")


TARGETS = [
    {
        "release_id": "early",
        "opens": datetime(2024, 1, 3),
        "closes": datetime(2024, 1, 12),
        "expected_max_year": 2010,
    },
    {
        "release_id": "late",
        "opens": datetime(2024, 1, 10),
        "closes": datetime(2024, 1, 28),
        "expected_max_year": 2017,
    },
    {
        "release_id": "never",
        "opens": datetime(2024, 1, 5),
        "closes": datetime(2024, 1, 6),
        "expected_max_year": 1900,
    },
]

_VERDICTS = """SELECT event_id, ts, c.max_year, t.release_id, t.expected_max_year,
    c.max_year IS NOT DISTINCT FROM t.expected_max_year AS is_valid
  FROM (SELECT event_id, ts, CASE WHEN event_type <> 'error'
          THEN CAST(2000 + floor(value) AS INTEGER) END AS max_year FROM events) c
  JOIN (VALUES
    ('early', TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-12', 2010),
    ('late', TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-28', 2017),
    ('never', TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-06', 1900)
  ) t(release_id, opens, closes, expected_max_year) ON c.ts >= t.opens AND c.ts <= t.closes"""


def _verdicts(spark, folder):
    captures = fx.table(spark, folder, "events").select(
        "event_id",
        "ts",
        F.when(
            F.col("event_type") != "error", (F.floor("value") + 2000).cast("int")
        ).alias("max_year"),
    )
    return audit.capture_verdicts(captures, TARGETS, "ts", "max_year")


@query(
    "capture_verdicts",
    f"""SELECT event_id, release_id, max_year, is_valid,
          CASE WHEN is_valid THEN 'ends in ' || CAST(max_year AS VARCHAR)
               ELSE 'stale: ends in ' || coalesce(CAST(max_year AS VARCHAR), 'NA')
                 || ' instead of ' || CAST(expected_max_year AS VARCHAR) END AS reason
        FROM ({_VERDICTS})""",
)
def capture_verdicts(spark, folder):
    return _verdicts(spark, folder).select(
        "event_id", "release_id", "max_year", "is_valid", "reason"
    )


@query(
    "first_valid_capture",
    f"""SELECT release_id, strftime(first_valid, '%Y%m%d%H%M%S') AS first_valid,
          count(*) FILTER (WHERE first_valid IS NULL OR ts < first_valid) AS n_rejected
        FROM (SELECT *, min(CASE WHEN is_valid THEN ts END) OVER (PARTITION BY release_id)
                AS first_valid FROM ({_VERDICTS})) GROUP BY release_id, first_valid""",
)
def first_valid_capture(spark, folder):
    return audit.first_valid_capture(_verdicts(spark, folder), "ts").withColumn(
        "first_valid", F.date_format("first_valid", "yyyyMMddHHmmss")
    )
