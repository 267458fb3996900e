"""Queries on scans, sources, sinks and column selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions import scalars
from panelweave.operators import dictionary, select, summary
from panelweave.operators.registry import latest_file
from panelweave.operators.reshape import union_all, unpivot_columns
from panelweave.plans import packaging
from panelweave.schema import INDICATOR_SCHEMA, cast_project
from panelweave.sources import files, snapshots
from panelweave.sources.scratch import scratch_path
from panelweave.sources.tables import small_table
from panelweave.suite import fixtures as fx
from panelweave.suite.registry import query


@query(
    "scan_snapshot",
    """SELECT o_orderkey, o_orderstatus, o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def scan_snapshot(spark, folder):
    df = snapshots.read_snapshot(spark, f"{folder}/orders.parquet")
    return df.select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )


@query(
    "raw_snapshot_normalized",
    fx.with_tables("editions")
    + f"""SELECT iso3, source, type, year, var_short, value FROM (
        SELECT *, row_number() OVER (PARTITION BY iso3, source, type, year, var_short
                    ORDER BY edition DESC NULLS LAST, value ASC NULLS LAST) AS rn
        FROM (SELECT iso3, source AS edition,
                regexp_replace(source, '[0-9]+$', '') AS source,
                {fx.sql_case('type', {
                    'Encuesta con microdatos': 'Survey', 'Survey with microdata': 'Survey',
                    'Перепись населения': 'Census', 'مصدر إداري': 'Admin'}, 'type')} AS type,
                CAST(trunc(year) AS INTEGER) AS year,
                regexp_replace(regexp_replace(var_short, '_t$', '_n'), '^s_ns_', 's_od_')
                  AS var_short,
                value
              FROM editions WHERE source IS NOT NULL OR type IS NOT NULL OR year IS NOT NULL
                OR var_short IS NOT NULL OR value IS NOT NULL)) WHERE rn = 1""",
)
def raw_snapshot_normalized(spark, folder):
    rows = snapshots.raw_rows(fx.editions(spark, folder))
    return snapshots.harmonise_raw(rows, [F.col("value").asc_nulls_last()])


@query(
    "indicator_snapshot",
    """SELECT 'E' || CAST(o_custkey AS VARCHAR) AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year,
         o_orderstatus AS residence, o_orderpriority AS var_short,
         CAST(NULL AS VARCHAR) AS indicator_type,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS DOUBLE) END AS percent
       FROM orders""",
)
def indicator_snapshot(spark, folder):
    text = fx.table(spark, folder, "orders").select(
        F.concat(F.lit("E"), "o_custkey").alias("iso3"),
        F.concat(F.year("o_orderdate"), F.lit(".9")).alias("year"),
        F.col("o_orderstatus").alias("residence"),
        F.col("o_orderpriority").alias("var_short"),
        F.lit(None).cast("string").alias("indicator_type"),
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias("percent"),
    )
    return cast_project(text, INDICATOR_SCHEMA)


@query(
    "multi_file_union",
    """SELECT 'customer' AS entity, c_custkey AS id, c_name AS name, c_acctbal AS balance,
         c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def multi_file_union(spark, folder):
    paths = [f"{folder}/customer.parquet", f"{folder}/supplier.parquet"]
    df = files.read_entity_files(spark, paths, entity="entity")
    return df.select(
        "entity",
        F.coalesce("c_custkey", "s_suppkey").alias("id"),
        F.coalesce("c_name", "s_name").alias("name"),
        F.coalesce("c_acctbal", "s_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )


@query(
    "first_present_source",
    """SELECT 'orders' AS chosen, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL""",
)
def first_present_source(spark, folder):
    name, df = snapshots.read_first_present(spark, folder, ["orders_data", "orders", "lineitem"])
    return summary.count_by(df, "o_orderstatus").withColumn("chosen", F.lit(name))


@query(
    "required_sources",
    """SELECT 'customer' AS chosen, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'orders', count(*) FROM orders
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
)
def required_sources(spark, folder):
    groups = [["customers", "customer"], ["orders", "orders_data"], ["lines", "lineitem"]]
    names = snapshots.required_sources(spark, folder, groups)
    return union_all(
        [
            fx.table(spark, folder, name)
            .agg(F.count("*").alias("n_rows"))
            .withColumn("chosen", F.lit(name))
            for name in names
        ]
    )


@query(
    "header_rows_to_lookup",
    """WITH cells AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS cell,
           generate_subscripts(string_split(text, ' '), 1) - 1 AS position
         FROM conversations WHERE turn IN (0, 1))
       SELECT coalesce(l.conv_id, c.conv_id) AS conv_id,
         CAST(coalesce(l.position, c.position) AS INTEGER) AS position,
         l.cell AS var_long, c.cell AS var_short
       FROM (SELECT * FROM cells WHERE turn = 0) l
       FULL JOIN (SELECT * FROM cells WHERE turn = 1) c
         ON l.conv_id = c.conv_id AND l.position = c.position""",
)
def header_rows_to_lookup(spark, folder):
    sheets = fx.table(spark, folder, "conversations").select(
        "conv_id", "turn", F.split("text", " ").alias("cells")
    )
    return files.header_rows_to_lookup(sheets, "conv_id", "turn", "cells")


@query(
    "preferred_header_file",
    """SELECT conv_id, turn, role FROM conversations WHERE conv_id = (
         SELECT conv_id FROM conversations
         ORDER BY CAST(conv_id AS VARCHAR) <> '42', conv_id LIMIT 1)""",
)
def preferred_header_file(spark, folder):
    sheets = fx.table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return files.preferred_file(sheets, "conv_id", "42")


@query(
    "file_magic_audit",
    """SELECT page_id, CAST(octet_length(encode(html)) AS INTEGER) AS n_bytes,
         octet_length(encode(html)) > 4 AND starts_with(html, '<!DO') AS is_valid FROM pages""",
)
def file_magic_audit(spark, folder):
    content = F.encode("html", "utf-8")
    return fx.table(spark, folder, "pages").select(
        "page_id",
        F.octet_length(content).alias("n_bytes"),
        files.has_magic(content, b"<!DO").alias("is_valid"),
    )


@query(
    "json_header_rows",
    """SELECT event_id, 1 AS row_number, event_type AS kind, CAST(event_id AS VARCHAR) AS event
       FROM events WHERE event_type <> 'error'
       UNION ALL SELECT event_id, 2, 'user', CAST(user_id AS VARCHAR)
       FROM events WHERE event_type <> 'error'""",
)
def json_header_rows(spark, folder):
    kind, event = F.col("event_type"), F.col("event_id").cast("string")
    user = F.col("user_id").cast("string")
    text = (
        F.when(kind == "error", F.to_json(F.array(F.array(F.lit("kind"), F.lit("event")))))
        .when(
            kind == "click",
            F.to_json(
                F.array(
                    F.array(F.lit("event"), F.lit("kind")),
                    F.array(event, kind),
                    F.array(user, F.lit("user")),
                )
            ),
        )
        .otherwise(
            F.to_json(
                F.array(
                    F.array(F.lit("kind"), F.lit("event")),
                    F.array(kind, event),
                    F.array(F.lit("user"), user),
                )
            )
        )
    )
    tables = fx.table(spark, folder, "events").select("event_id", text.alias("text"))
    return files.json_header_rows(tables, "text", ["kind", "event"])


@query(
    "snapshot_roundtrip",
    """SELECT o_orderkey, o_orderstatus, o_totalprice,
         'r' || CAST(year(o_orderdate) AS VARCHAR) AS release_id FROM orders""",
)
def snapshot_roundtrip(spark, folder):
    df = fx.table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        F.concat(F.lit("r"), F.year("o_orderdate")).alias("release_id"),
    )
    path = scratch_path(spark, "roundtrip") + ".parquet"
    snapshots.write_snapshot(df, path, partition_by=["release_id"])
    return snapshots.read_snapshot(spark, path).select(*df.columns)


@query(
    "csv_roundtrip",
    """SELECT event_id, event_type, value, CASE WHEN event_type <> 'error' THEN user_id END AS user_id
       FROM events""",
)
def csv_roundtrip(spark, folder):
    df = fx.table(spark, folder, "events").select(
        "event_id",
        "event_type",
        "value",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
    )
    path = scratch_path(spark, "roundtrip") + ".csv.gz"
    snapshots.write_snapshot(df, path)
    return cast_project(snapshots.read_snapshot(spark, path), df.schema)


@query(
    "package_latest",
    fx.with_tables("snap_new") + "SELECT * FROM snap_new",
)
def package_latest(spark, folder):
    base = scratch_path(spark, "packaging")
    dated = {"2000-01-01": fx.snap_old, "2001-08-01": fx.snap_new}
    for day, snapshot in dated.items():
        snapshots.write_snapshot(snapshot(spark, folder), f"{base}/{day}_raw.parquet")
    registered = [("r", day, "raw", f"{base}/{day}_raw.parquet", None, None) for day in dated]
    manifest = small_table(spark, registered, MANIFEST_DDL)
    schema = fx.snap_new(spark, folder).schema
    return packaging.package_latest(spark, manifest, r"_raw\.parquet$", schema, f"{base}/latest")


MANIFEST_DDL = (
    "release_id string, snapshot_date string, pipeline string, file string, source string, "
    "notes string"
)


@query(
    "latest_snapshot",
    fx.with_tables("manifest")
    + r"""SELECT max(file) AS file FROM manifest
          WHERE regexp_matches(file, '^\d{4}-\d{2}-\d{2}_raw_\d+\.csv$')""",
)
def latest_snapshot(spark, folder):
    return latest_file(fx.manifest(spark, folder), r"^\d{4}-\d{2}-\d{2}_raw_\d+\.csv$")


@query(
    "latest_view",
    fx.with_tables("manifest")
    + """SELECT * FROM manifest WHERE snapshot_date = (SELECT max(snapshot_date) FROM manifest)""",
)
def latest_view(spark, folder):
    return snapshots.latest_rows(fx.manifest(spark, folder))


@query(
    "select_by_type",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem""",
)
def select_by_type(spark, folder):
    df = fx.table(spark, folder, "lineitem")
    return select.select_by_type(df, ["l_orderkey", "l_linenumber"], drop=["l_tax", "blank"])


@query(
    "drop_optional_columns",
    """SELECT p_partkey, p_name, p_brand, p_type, p_retailprice AS price FROM part""",
)
def drop_optional_columns(spark, folder):
    df = fx.table(spark, folder, "part")
    price = select.first_present_column(df, ["p_price", "p_retailprice"])
    return select.drop_optional(
        df.withColumn("price", price), ["p_size", "p_retailprice", "year2", "blank"]
    )


@query(
    "relocate_columns",
    """SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders""",
)
def relocate_columns(spark, folder):
    df = fx.table(spark, folder, "orders").drop("o_orderdate")
    return select.relocate(df, ["o_orderstatus"])


@query(
    "dictionary_for_dataset",
    """SELECT p_name, p_brand, p_type FROM part WHERE p_type = 'ECONOMY'""",
)
def dictionary_for_dataset(spark, folder):
    entries = dictionary.dictionary_for(fx.table(spark, folder, "part"), "ECONOMY", "p_type")
    return select.select_range(entries, "p_name", "p_type")


ORDERS_DICTIONARY = [
    ("o_orderkey", "integer"),
    ("o_custkey", "integer"),
    ("o_orderstatus", "factor"),
    ("o_totalprice", "numeric"),
    ("o_orderdate", "date"),
    ("o_orderpriority", "character"),
    ("o_comment", "character"),
]


@query(
    "dictionary_check",
    """SELECT t.*, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES
         (1, 'o_orderkey', 'integer', 'bigint', TRUE),
         (2, 'o_custkey', 'integer', 'bigint', TRUE),
         (3, 'o_orderstatus', 'factor', 'string', TRUE),
         (4, 'o_totalprice', 'numeric', 'double', TRUE),
         (5, 'o_orderdate', 'date', 'timestamp_ntz', TRUE),
         (6, 'o_orderpriority', 'character', 'string', TRUE),
         (7, 'o_comment', 'character', NULL, FALSE)
       ) t(position, variable_name, variable_type, actual_type, matches)""",
)
def dictionary_check(spark, folder):
    orders = fx.table(spark, folder, "orders")
    checked = dictionary.check_dictionary(spark, orders, ORDERS_DICTIONARY)
    return checked.withColumn("n_rows", orders.agg(F.count("*")).scalar())


def _columns_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{c}' AS column_name, "
        f"count({c}) AS n_values FROM {table}"
        for i, c in enumerate(columns, start=1)
    )


@query(
    "columns_as_rows",
    _columns_sql("supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    + " UNION ALL "
    + _columns_sql("part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    + " UNION ALL "
    + _columns_sql("labels", ["doc_id", "quality", "toxic"]),
)
def columns_as_rows(spark, folder):
    names = ["supplier", "part", "labels"]
    return dictionary.columns_as_rows({n: fx.table(spark, folder, n) for n in names})


@query(
    "dataset_size",
    """SELECT 'orders' AS dataset, count(*) AS n_rows, 6 AS n_columns FROM orders
       UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem""",
)
def dataset_size(spark, folder):
    return union_all(
        [
            summary.dataset_size(fx.table(spark, folder, n)).withColumn("dataset", F.lit(n))
            for n in ("orders", "lineitem")
        ]
    )


@query(
    "drop_placeholder_rows",
    fx.with_tables("editions")
    + """SELECT * FROM editions WHERE NOT (source IS NULL AND type IS NULL AND year IS NULL
           AND var_short IS NULL AND value IS NULL)""",
)
def drop_placeholder_rows(spark, folder):
    return select.drop_placeholders(fx.editions(spark, folder), fx.RAW_COLUMNS)


_MEASURES = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax FROM lineitem"""
_UNPIVOT_SQL = (
    f"WITH measures AS ({_MEASURES}) "
    + " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{c}' AS var_short, {c} AS value "
        "FROM measures"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
)


def _measures(spark, folder):
    return fx.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )


@query("unpivot_keep_null", _UNPIVOT_SQL)
def unpivot_keep_null(spark, folder):
    return unpivot_columns(_measures(spark, folder), ["l_quantity", "l_discount", "l_tax"])


@query("unpivot_drop_null", f"SELECT * FROM ({_UNPIVOT_SQL}) WHERE value IS NOT NULL")
def unpivot_drop_null(spark, folder):
    df = _measures(spark, folder)
    return unpivot_columns(df, select.columns_with_prefix(df, ["L_QUAN", "l_dis", "l_tax"]),
                           drop_null=True)


@query(
    "filter_conjunction",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE year(o_orderdate) >= 1997 AND o_totalprice >= 100000 AND o_orderstatus = 'F'""",
)
def filter_conjunction(spark, folder):
    return (
        fx.table(spark, folder, "orders")
        .filter(
            (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
            & (F.col("o_totalprice") >= 100000)
            & (F.col("o_orderstatus") == "F")
        )
        .select("o_orderkey", "o_totalprice")
    )


@query(
    "filter_in_list",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders
       WHERE year(o_orderdate) IN (1996, 1998, 2000)""",
)
def filter_in_list(spark, folder):
    df = fx.table(spark, folder, "orders")
    return df.select("o_orderkey", F.year("o_orderdate").alias("yr")).filter(
        F.col("yr").isin(1996, 1998, 2000)
    )


@query(
    "regex_filter",
    """SELECT p_partkey, p_name, p_brand FROM part
       WHERE regexp_matches(p_name, '^(red|blue)') AND starts_with(p_brand, 'Brand#1')""",
)
def regex_filter(spark, folder):
    return (
        fx.table(spark, folder, "part")
        .filter(F.col("p_name").rlike("^(red|blue)") & F.col("p_brand").startswith("Brand#1"))
        .select("p_partkey", "p_name", "p_brand")
    )


@query(
    "not_equal_drops_null",
    fx.with_tables("panel") + "SELECT event_id, type FROM panel WHERE type <> 'click'",
)
def not_equal_drops_null(spark, folder):
    return fx.panel(spark, folder).filter(F.col("type") != "click").select("event_id", "type")


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment,
         CAST(NULL AS DOUBLE) AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_by_name(spark, folder):
    customers = fx.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = fx.table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    return union_all([customers, suppliers])


@query(
    "preview",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY o_totalprice, o_orderkey LIMIT 6""",
)
def preview(spark, folder):
    df = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return summary.preview(df, ["o_totalprice", "o_orderkey"], 6)


@query(
    "column_values",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def column_values(spark, folder):
    building = fx.table(spark, folder, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    wanted = select.column_values(building.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    orders = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return orders.join(wanted, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query(
    "iso_dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '2001-09-01'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS snapshot_date FROM orders""",
)
def iso_dates(spark, folder):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return fx.table(spark, folder, "orders").select(
        "o_orderkey", scalars.iso_date(known, "2001-09-01").alias("snapshot_date")
    )
