"""Panels derived from the given tables, in Spark and as SQL.

Every fixture keeps all rows of its table. What is added, removed, missing or
revised follows from dates, states and categories of the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelweave.functions.vocabulary import indicator_lookup, observation_lookup
from panelweave.sources.tables import small_table


# Schemas of the given tables; naming them saves reading file footers to infer them.
TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def with_tables(*names: str) -> str:
    """``WITH`` clause for the named fixtures, in the given order."""
    return "WITH " + ",\n".join(f"{name} AS ({SQL[name]})" for name in names) + "\n"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_rewrite(column: str, rewrites) -> str:
    for rw in rewrites:
        column = f"regexp_replace({column}, {sql_text(rw.pattern)}, {sql_text(rw.replacement)})"
    return column


def sql_first_match(column: str, rules) -> str:
    branches = " ".join(
        f"WHEN regexp_matches({column}, {sql_text(r.pattern)}) THEN {sql_text(r.label)}"
        for r in rules
    )
    return f"CASE {branches} END"


def sql_case(column: str, mapping, default: str) -> str:
    branches = " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in mapping.items())
    return f"CASE {column} {branches} ELSE {default} END"


def sql_rows(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(sql_text, r)) + ")" for r in rows)


def sql_list(values) -> str:
    return "[" + ", ".join(map(sql_text, values)) + "]"


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


SQL: dict[str, str] = {}

# --- two releases of one panel ------------------------------------------------
SNAP_KEY = ["entity", "source", "obs", "yr"]
SNAP_OLD_END = "2000-01-01"
SNAP_NEW_START = "1996-01-01"


def _snapshot(orders: DataFrame, value: Column) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.select(
        F.col("o_custkey").alias("entity"),
        priority.alias("source"),
        F.col("o_orderkey").alias("obs"),
        F.when(~((priority == "3-MEDIUM") & (status == "P")), F.year("o_orderdate")).alias("yr"),
        value.alias("value"),
    )


def snap_old(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").filter(
        F.col("o_orderdate") < F.lit(SNAP_OLD_END).cast("timestamp_ntz")
    )
    value = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    return _snapshot(orders, value)


def snap_new(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").filter(
        F.col("o_orderdate") >= F.lit(SNAP_NEW_START).cast("timestamp_ntz")
    )
    status, priority, price = (
        F.col(c) for c in ("o_orderstatus", "o_orderpriority", "o_totalprice")
    )
    value = (
        F.when(priority == "4-NOT SPECIFIED", F.lit(None).cast("double"))
        .when((priority == "5-LOW") & (status == "F"), F.lit(None).cast("double"))
        .when(status == "P", price + 1)
        .when(status == "O", price + 1e-7)
        .otherwise(price)
    )
    return _snapshot(orders, value)


_SNAP_COLUMNS = """o_custkey AS entity, o_orderpriority AS source, o_orderkey AS obs,
  CASE WHEN NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P')
       THEN CAST(year(o_orderdate) AS INTEGER) END AS yr"""
SQL["snap_old"] = f"""SELECT {_SNAP_COLUMNS},
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS value
  FROM orders WHERE o_orderdate < TIMESTAMP '{SNAP_OLD_END}'"""
SQL["snap_new"] = f"""SELECT {_SNAP_COLUMNS},
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
       WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL
       WHEN o_orderstatus = 'P' THEN o_totalprice + 1
       WHEN o_orderstatus = 'O' THEN o_totalprice + 1e-7
       ELSE o_totalprice END AS value
  FROM orders WHERE o_orderdate >= TIMESTAMP '{SNAP_NEW_START}'"""
SQL["snap_diff"] = """SELECT
    CASE WHEN o.obs IS NULL THEN n.entity ELSE o.entity END AS entity,
    CASE WHEN o.obs IS NULL THEN n.source ELSE o.source END AS source,
    CASE WHEN o.obs IS NULL THEN n.obs ELSE o.obs END AS obs,
    CASE WHEN o.obs IS NULL THEN n.yr ELSE o.yr END AS yr,
    o.value AS value_old, n.value AS value_new,
    CASE WHEN o.obs IS NULL THEN 'added' WHEN n.obs IS NULL THEN 'removed'
         WHEN (o.value IS NULL) <> (n.value IS NULL) THEN 'changed'
         WHEN abs(n.value - o.value) > 1e-6 THEN 'changed' ELSE 'unchanged' END AS status
  FROM snap_old o FULL JOIN snap_new n
    ON o.obs = n.obs AND o.entity = n.entity AND o.source = n.source
   AND o.yr IS NOT DISTINCT FROM n.yr"""
SNAP_DIFF = with_tables("snap_old", "snap_new", "snap_diff")

# --- yearly releases of one long table ------------------------------------------
RELEASES = ["r1995", "r1996", "r1997", "r1998", "r1999", "r2000", "r2001"]
RELEASE_KEY = ["entity", "kind"]


def release_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per customer and state, re-released every year."""
    orders = table(spark, folder, "orders")
    return orders.groupBy(
        F.concat(F.lit("r"), F.year("o_orderdate")).alias("release_id"),
        F.col("o_custkey").alias("entity"),
        F.col("o_orderstatus").alias("kind"),
    ).agg(F.count("*").cast("double").alias("value"))


SQL["release_panel"] = """SELECT 'r' || CAST(year(o_orderdate) AS VARCHAR) AS release_id,
  o_custkey AS entity, o_orderstatus AS kind,
  CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY ALL"""
SQL["release_pairs"] = "SELECT old, new FROM (VALUES " + ", ".join(
    f"('{a}', '{b}')" for a, b in zip(RELEASES, RELEASES[1:])
) + ") t(old, new)"
SQL["pair_diff"] = """SELECT old || '_vs_' || new AS pair, entity, kind, value_old, value_new,
    CASE WHEN value_old IS NULL THEN 'added' WHEN value_new IS NULL THEN 'removed'
         WHEN abs(value_new - value_old) > 1e-6 THEN 'changed' ELSE 'unchanged' END AS status
  FROM (SELECT p.old, p.new, r.entity, r.kind,
          max(CASE WHEN r.release_id = p.old THEN r.value END) AS value_old,
          max(CASE WHEN r.release_id = p.new THEN r.value END) AS value_new
        FROM release_pairs p JOIN release_panel r ON r.release_id IN (p.old, p.new)
        GROUP BY ALL)"""
PAIR_DIFF = with_tables("release_panel", "release_pairs", "pair_diff")

# --- variable codes ---------------------------------------------------------------
INDICATOR_STEMS = [
    "wat_basal", "wat_lim", "wat_unimp", "wat_ns", "wat_sm", "wat_imp_prem", "wat_imp_av",
    "wat_imp_qual", "wat_pip", "wat_imp_npip", "wat_arc_sm", "arc_wat_basal", "arc_san_ns",
    "san_basal", "san_ns", "san_sm", "san_sew_sm", "san_othimp", "san_sep", "san_sew", "san_imp",
    "hyg_bas", "hyg_ns", "hyg_bfacw", "hyg_bfac",
]
OBSERVATION_STEMS = [
    "s_imp", "s_lat", "s_lat_con", "s_lat_dtp", "s_lat_ebo", "s_lat_edl", "s_lat_ero",
    "s_lat_nemp", "s_ns", "s_od", "s_sep", "s_sep_con", "s_sep_dtp", "s_sep_nemp", "s_sew",
    "s_sew_net", "s_sew_rtp", "s_shared", "s_treat_fstp", "s_treat_wtp", "abc",
]
SUFFIXES = ["_t", "_r", "_u"]


def _coded_events(spark: SparkSession, folder: str, stems: list[str]) -> DataFrame:
    stem = pick(stems, F.col("event_id") % len(stems))
    suffix = pick(SUFFIXES, F.col("user_id") % len(SUFFIXES))
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.when(F.col("value") >= 1.0, F.concat(stem, suffix)).alias("code"),
    )


def indicator_codes(spark: SparkSession, folder: str) -> DataFrame:
    return _coded_events(spark, folder, INDICATOR_STEMS)


def observation_codes(spark: SparkSession, folder: str) -> DataFrame:
    return _coded_events(spark, folder, OBSERVATION_STEMS)


def _coded_events_sql(stems: list[str]) -> str:
    return f"""SELECT event_id, user_id, event_type, value, CASE WHEN value >= 1.0 THEN
      list_extract({sql_list(stems)}, CAST(event_id % {len(stems)} AS INTEGER) + 1)
      || list_extract({sql_list(SUFFIXES)}, CAST(user_id % {len(SUFFIXES)} AS INTEGER) + 1)
    END AS code FROM events"""


SQL["indicator_codes"] = _coded_events_sql(INDICATOR_STEMS)
SQL["observation_codes"] = _coded_events_sql(OBSERVATION_STEMS)


def lookup_table(spark: SparkSession) -> DataFrame:
    """The shipped labels; a list of fixed length."""
    return small_table(spark, indicator_lookup(), "var_short string, var_long string")


def variable_table(spark: SparkSession) -> DataFrame:
    return small_table(spark, observation_lookup(), "var_short string, var_long string")


SQL["lookup"] = f"SELECT * FROM ({sql_rows(indicator_lookup())}) t(var_short, var_long)"
SQL["variables"] = f"SELECT * FROM ({sql_rows(observation_lookup())}) t(var_short, var_long)"

# --- raw observations with several source editions -------------------------------
LABELS_BY_PRIORITY = {
    "1-URGENT": "Encuesta con microdatos",
    "2-HIGH": "Перепись населения",
    "3-MEDIUM": "Survey with microdata",
    "4-NOT SPECIFIED": "Other",
    "5-LOW": "مصدر إداري",
}
CODES_BY_STATUS = {"F": "s_ns_t", "O": "s_lat_nemp_u", "P": "s_od_n"}
RAW_COLUMNS = ["source", "type", "year", "var_short", "value"]


def editions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as survey observations; urgent pending ones are placeholders."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    filled = ~((priority == "1-URGENT") & (status == "P"))
    edition = F.date_format("o_orderdate", "dd")
    source = F.when(priority == "4-NOT SPECIFIED", edition).otherwise(F.concat(F.lit("CEN"), edition))
    labels = F.create_map(*[F.lit(x) for kv in LABELS_BY_PRIORITY.items() for x in kv])
    codes = F.create_map(*[F.lit(x) for kv in CODES_BY_STATUS.items() for x in kv])
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") % 200).cast("string").alias("iso3"),
        F.when(filled, source).alias("source"),
        F.when(filled, labels[priority]).alias("type"),
        F.when(filled, F.year("o_orderdate") + F.lit(0.5)).alias("year"),
        F.when(filled, codes[status]).alias("var_short"),
        F.when(filled, F.col("o_totalprice")).alias("value"),
    )


SQL["editions"] = f"""SELECT CAST(o_custkey % 200 AS VARCHAR) AS iso3,
    CASE WHEN filled THEN CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN edition
                               ELSE 'CEN' || edition END END AS source,
    CASE WHEN filled THEN {sql_case('o_orderpriority', LABELS_BY_PRIORITY, 'NULL')} END AS type,
    CASE WHEN filled THEN CAST(year(o_orderdate) AS DOUBLE) + 0.5 END AS year,
    CASE WHEN filled THEN {sql_case('o_orderstatus', CODES_BY_STATUS, 'NULL')} END AS var_short,
    CASE WHEN filled THEN o_totalprice END AS value
  FROM (SELECT *, strftime(o_orderdate, '%d') AS edition,
          NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS filled FROM orders)"""

# --- three wide sheets ---------------------------------------------------------------


def _sheet(df: DataFrame, entity: str, when: Column, measures: dict[str, Column]) -> DataFrame:
    grouped = df.groupBy(
        F.col(entity).alias("entity"), F.year(when).cast("double").alias("year")
    ).agg(*[F.max(column).alias(name) for name, column in measures.items()])
    number = F.col("entity").cast("double")
    return grouped.select(
        F.col("entity").cast("string").alias("iso3"),
        F.concat(F.lit("area "), F.col("entity")).alias("name"),
        F.lit("region").alias("region_code"),
        "year",
        (number * 10.0).alias("pop_t"),
        (F.col("entity") % 100).cast("double").alias("prop_u"),
        F.lit(1.0).alias("sl"),
        *measures,
    )


def _sheet_sql(source: str, entity: str, when: str, measures: dict[str, str]) -> str:
    columns = ", ".join(f"max({sql}) AS {name}" for name, sql in measures.items())
    return f"""SELECT CAST(entity AS VARCHAR) AS iso3, 'area ' || CAST(entity AS VARCHAR) AS name,
      'region' AS region_code, year, CAST(entity AS DOUBLE) * 10.0 AS pop_t,
      CAST(entity % 100 AS DOUBLE) AS prop_u, CAST(1.0 AS DOUBLE) AS sl, {', '.join(measures)}
    FROM (SELECT {entity} AS entity, CAST(year({when}) AS DOUBLE) AS year, {columns}
          FROM {source} GROUP BY 1, 2)"""


def wide_sheets(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Three sheets per entity and year; the second and third cover fewer rows."""
    orders, lineitem = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    price, status, priority = (
        F.col(c) for c in ("o_totalprice", "o_orderstatus", "o_orderpriority")
    )
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    water = _sheet(
        orders,
        "o_custkey",
        F.col("o_orderdate"),
        {
            "wat_basal_t": F.when(status == "F", price),
            "wat_lim_r": F.when(status == "O", price),
            "wat_ns_u": F.when(status == "P", price),
            "wat_imp_t": price,
            "year2": price,
        },
    )
    sanitation = _sheet(
        lineitem,
        "l_suppkey",
        F.col("l_shipdate"),
        {
            "san_basal_t": F.when(flag == "A", quantity),
            "san_ns_r": F.when(flag == "N", quantity),
            "san_sew_u": F.when(flag == "R", quantity),
            "san_sm_t": quantity,
        },
    )
    hygiene = _sheet(
        orders,
        "o_custkey",
        F.col("o_orderdate"),
        {
            "hyg_bas_t": F.when(priority == "1-URGENT", price),
            "hyg_ns_u": F.when(priority == "5-LOW", price),
            "arc_hyg_bas_u": F.when(priority == "2-HIGH", price),
        },
    )
    return [water, sanitation, hygiene]


SQL["sheet_water"] = _sheet_sql(
    "orders",
    "o_custkey",
    "o_orderdate",
    {
        "wat_basal_t": "CASE WHEN o_orderstatus = 'F' THEN o_totalprice END",
        "wat_lim_r": "CASE WHEN o_orderstatus = 'O' THEN o_totalprice END",
        "wat_ns_u": "CASE WHEN o_orderstatus = 'P' THEN o_totalprice END",
        "wat_imp_t": "o_totalprice",
        "year2": "o_totalprice",
    },
)
SQL["sheet_sanitation"] = _sheet_sql(
    "lineitem",
    "l_suppkey",
    "l_shipdate",
    {
        "san_basal_t": "CASE WHEN l_returnflag = 'A' THEN l_quantity END",
        "san_ns_r": "CASE WHEN l_returnflag = 'N' THEN l_quantity END",
        "san_sew_u": "CASE WHEN l_returnflag = 'R' THEN l_quantity END",
        "san_sm_t": "l_quantity",
    },
)
SQL["sheet_hygiene"] = _sheet_sql(
    "orders",
    "o_custkey",
    "o_orderdate",
    {
        "hyg_bas_t": "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END",
        "hyg_ns_u": "CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END",
        "arc_hyg_bas_u": "CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END",
    },
)
SQL["joined_sheets"] = """SELECT w.name, w.iso3, w.year, w.pop_t, w.prop_u, w.sl,
    w.wat_basal_t, w.wat_lim_r, w.wat_ns_u, w.wat_imp_t,
    s.san_basal_t, s.san_ns_r, s.san_sew_u, s.san_sm_t,
    h.hyg_bas_t, h.hyg_ns_u, h.arc_hyg_bas_u
  FROM sheet_water w
  LEFT JOIN sheet_sanitation s ON w.name = s.name AND w.iso3 = s.iso3 AND w.year = s.year
    AND w.pop_t = s.pop_t AND w.prop_u = s.prop_u AND w.sl = s.sl
  LEFT JOIN sheet_hygiene h ON w.name = h.name AND w.iso3 = h.iso3 AND w.year = h.year
    AND w.pop_t = h.pop_t AND w.prop_u = h.prop_u AND w.sl = h.sl"""
JOINED_SHEETS = with_tables("sheet_water", "sheet_sanitation", "sheet_hygiene", "joined_sheets")

# --- snapshot registry -----------------------------------------------------------------
NOTES_BY_PRIORITY = {
    "1-URGENT": "duplicate of an earlier file",
    "2-HIGH": "alias: undated latest",
    "4-NOT SPECIFIED": "tidied from the input",
}
RELEASE_ORDER = ["r1995", "r1996", "r1998", "r1999", "r2000"]


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One registered file per order; the listing decides which ones exist."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    pipeline = F.when(status == "F", "raw").otherwise("indicators")
    notes = F.create_map(*[F.lit(x) for kv in NOTES_BY_PRIORITY.items() for x in kv])
    return table(spark, folder, "orders").select(
        F.concat(F.lit("r"), F.year("o_orderdate")).alias("release_id"),
        F.when(~((priority == "3-MEDIUM") & (status == "P")), day).alias("snapshot_date"),
        pipeline.alias("pipeline"),
        F.concat(day, F.lit("_"), pipeline, F.lit("_"), F.col("o_orderkey"), F.lit(".csv")).alias(
            "file"
        ),
        F.when(status == "O", "live").otherwise("archive").alias("source"),
        notes[priority].alias("notes"),
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files that exist: those of orders with at least one line."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, folder, "orders").join(lines.distinct(), "o_orderkey", "left_semi")
    pipeline = F.when(F.col("o_orderstatus") == "F", "raw").otherwise("indicators")
    return orders.select(
        F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.lit("_"),
            pipeline,
            F.lit("_"),
            F.col("o_orderkey"),
            F.lit(".csv"),
        ).alias("file")
    )


def builtin(spark: SparkSession, folder: str) -> DataFrame:
    """Built-in rows: one per shipping year, flag and last order shipped."""
    flag = F.col("l_returnflag")
    return (
        table(spark, folder, "lineitem")
        .groupBy(
            F.concat(F.lit("r"), F.year("l_shipdate")).alias("release_id"),
            F.when(flag == "A", "raw")
            .when(flag == "N", "indicators")
            .otherwise("estimates")
            .alias("pipeline"),
            F.col("l_suppkey").alias("supplier"),
        )
        .agg(F.max("l_orderkey").alias("last"))
        .select(
            "release_id",
            F.lit(None).cast("string").alias("snapshot_date"),
            "pipeline",
            F.concat(F.lit("builtin_"), F.col("last"), F.lit(".csv")).alias("file"),
            F.lit(None).cast("string").alias("source"),
            F.lit(None).cast("string").alias("notes"),
        )
    )


_PIPELINE = "CASE WHEN o_orderstatus = 'F' THEN 'raw' ELSE 'indicators' END"
_FILE = (
    f"strftime(o_orderdate, '%Y-%m-%d') || '_' || {_PIPELINE} || '_' "
    "|| CAST(o_orderkey AS VARCHAR) || '.csv'"
)
SQL["manifest"] = f"""SELECT 'r' || CAST(year(o_orderdate) AS VARCHAR) AS release_id,
    CASE WHEN NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P')
         THEN strftime(o_orderdate, '%Y-%m-%d') END AS snapshot_date,
    {_PIPELINE} AS pipeline, {_FILE} AS file,
    CASE WHEN o_orderstatus = 'O' THEN 'live' ELSE 'archive' END AS source,
    {sql_case('o_orderpriority', NOTES_BY_PRIORITY, 'NULL')} AS notes FROM orders"""
SQL["listing"] = f"""SELECT {_FILE} AS file FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"""
SQL["builtin"] = """SELECT release_id, CAST(NULL AS VARCHAR) AS snapshot_date, pipeline,
    'builtin_' || CAST(last AS VARCHAR) || '.csv' AS file, CAST(NULL AS VARCHAR) AS source,
    CAST(NULL AS VARCHAR) AS notes
  FROM (SELECT 'r' || CAST(year(l_shipdate) AS VARCHAR) AS release_id,
          CASE l_returnflag WHEN 'A' THEN 'raw' WHEN 'N' THEN 'indicators'
               ELSE 'estimates' END AS pipeline,
          l_suppkey AS supplier, max(l_orderkey) AS last FROM lineitem GROUP BY 1, 2, 3)"""
SQL["flags"] = f"""SELECT CASE WHEN release_id IN ({', '.join(map(sql_text, RELEASE_ORDER))})
         THEN release_id END AS release_id, snapshot_date, pipeline, file, source, notes,
    file IN (SELECT file FROM listing) AS available,
    coalesce(regexp_matches(notes, '^(duplicate|alias|superseded|input)'), FALSE) AS excluded,
    CAST(CASE WHEN list_position({sql_list(RELEASE_ORDER)}, release_id) > 0
         THEN list_position({sql_list(RELEASE_ORDER)}, release_id) END AS INTEGER) AS release_ord
  FROM manifest"""
SQL["first_snapshots"] = """SELECT * FROM flags WHERE available AND NOT excluded
  QUALIFY row_number() OVER (PARTITION BY pipeline, release_id
    ORDER BY snapshot_date ASC NULLS LAST, file ASC) = 1"""
FLAGS = with_tables("manifest", "listing", "flags")
FIRST_SNAPSHOTS = with_tables("manifest", "listing", "flags", "first_snapshots")

# --- long panel for counting ---------------------------------------------------------------


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Events as observations; the type of failed ones is unknown."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("entity"),
        F.dayofmonth("ts").alias("day"),
        F.when(kind != "error", kind).alias("type"),
        F.get_json_object("props", "$.k").alias("source"),
        "value",
    )


SQL["panel"] = """SELECT event_id, user_id AS entity, CAST(day(ts) AS INTEGER) AS day,
    CASE WHEN event_type <> 'error' THEN event_type END AS type,
    json_extract_string(props, '$.k') AS source, value FROM events"""
