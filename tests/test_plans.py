"""The shape of the physical plans."""

import re

import pytest
from helpers import bag, formatted, plan

from pyspark.sql import functions as F

from panelweave.functions import vocabulary as vocab
from panelweave.operators import joins
from panelweave.operators.diff import diff_snapshots
from panelweave.operators.select import select_by_type
from panelweave.sources.snapshots import save_releases
from panelweave.suite import QUERIES
from panelweave.suite import fixtures as fx


def count(text, what):
    return len(re.findall(what, text))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cartesian_no_global_window(name, spark, data_dir):
    text = plan(QUERIES[name](spark, data_dir))
    assert "Python" not in text and "MapInArrow" not in text and "MapInPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"(?:Window|WindowGroupLimit) .*", text):
        assert not re.search(r"Window \[.*\], \[\]", window), "window without partition"


def test_diff_shuffles_once_with_partial_aggregation(spark, data_dir):
    text = plan(QUERIES["diff_snapshots"](spark, data_dir))
    assert count(text, "Exchange ") == 1
    assert count(text, "Exchange hashpartitioning") == 1
    assert "partial_count" in text and "partial_max" in text
    assert "Join" not in text and "SortAggregate" not in text


def test_diff_summary_adds_only_small_shuffles(spark, data_dir):
    text = plan(QUERIES["diff_by_year"](spark, data_dir))
    assert count(text, "Exchange hashpartitioning") == 2
    assert count(text, "Exchange rangepartitioning") == 1


def test_all_pairs_shuffle_the_rows_once(spark, data_dir):
    """One exchange builds the panel, one aligns all its releases."""
    text = plan(QUERIES["diff_all_pairs"](spark, data_dir))
    assert count(text, "Exchange hashpartitioning") == 2
    assert text.index("Generate inline") < text.index("Exchange")


def test_release_table_is_compared_without_a_shuffle(spark, data_dir):
    frame = QUERIES["diff_release_table"](spark, data_dir)
    text = plan(frame)
    assert "Exchange" not in text and "Bucketed: true" in text
    assert "PartitionFilters: [release_id" in formatted(frame)


def test_diff_of_bucketed_releases_does_not_shuffle(spark, data_dir, tmp_path):
    both = fx.snap_old(spark, data_dir).withColumn("release_id", F.lit("a")).unionByName(
        fx.snap_new(spark, data_dir).withColumn("release_id", F.lit("b"))
    )
    table = save_releases(
        both, "plan_releases", fx.SNAP_KEY, 6, path=str(tmp_path / "t"), mode="overwrite"
    )
    sides = [table.filter(F.col("release_id") == name) for name in "ab"]
    frame = diff_snapshots(*sides, fx.SNAP_KEY, "value")
    assert "Exchange" not in plan(frame)
    assert bag(frame) == bag(QUERIES["diff_snapshots"](spark, data_dir))
    spark.sql("DROP TABLE plan_releases")


def test_diff_reuses_the_partitioning_of_the_harmonised_sides(spark, data_dir):
    """One shuffle per side to keep the newest edition, none for the comparison."""
    text = plan(QUERIES["diff_harmonised_snapshots"](spark, data_dir))
    assert count(text, "Exchange ") == 2


def test_filters_reach_the_scan(spark, data_dir):
    text = formatted(QUERIES["filter_conjunction"](spark, data_dir))
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in text
    assert "EqualTo(o_orderstatus,F)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,"
                     r"o_totalprice:double,o_orderdate:timestamp_ntz>", text)


def test_snapshot_scan_reads_only_what_is_asked(spark, data_dir):
    text = QUERIES["scan_snapshot"](spark, data_dir).select("o_orderkey")
    assert "ReadSchema: struct<o_orderkey:bigint>" in text._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["lookup_left_join", "lookup_matched_rows", "classify_explode"])
def test_lookups_are_broadcast(name, spark, data_dir):
    text = plan(QUERIES[name](spark, data_dir))
    assert "BroadcastHashJoin" in text and "BuildRight" in text
    for _, build in re.findall(r"(BroadcastExchange)([^\n]*\n[^\n]*)", text):
        assert "FileScan" not in build, "the rows are broadcast instead of the lookup"
    # Only distinct codes are shuffled before they are looked up.
    for line in re.findall(r"Exchange hashpartitioning\(code[^\n]*\n([^\n]*)", text):
        assert "HashAggregate" in line


@pytest.mark.parametrize(
    "name", ["keep_newest_edition", "raw_snapshot_normalized", "manifest_merge",
             "first_snapshot_per_release"],
)
def test_keep_first_prunes_before_the_shuffle(name, spark, data_dir):
    text = plan(QUERIES[name](spark, data_dir))
    partial = re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", text)
    assert partial, text


@pytest.mark.parametrize(
    "name", ["normalize_codes", "unmatched_codes", "lookup_coverage_gate", "lookup_matched_rows"]
)
def test_code_rules_run_once_per_code(name, spark, data_dir):
    lines = plan(QUERIES[name](spark, data_dir)).splitlines()
    assert any("Join" in line for line in lines)
    for line, below in zip(lines, lines[1:], strict=False):
        assert "regexp_replace" not in line or "Scan" not in below


def test_wide_sheets_keep_their_partitioning(spark, data_dir):
    """Joined without broadcasts, the driving sheet is shuffled by its key once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sheets = [
            select_by_type(s, ["name", "iso3"], drop=vocab.HELPER_COLUMNS)
            for s in fx.wide_sheets(spark, data_dir)
        ]
        text = plan(joins.natural_left_join(sheets))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert count(text, "SortMergeJoin") == 2
    # three to build the sheets, three to join them
    assert count(text, "Exchange hashpartitioning") == 6


def test_tidy_unpivots_once(spark, data_dir):
    text = plan(QUERIES["tidy_wide_sheets"](spark, data_dir))
    assert count(text, r"\bExpand ") == 1 and count(text, r"\bUnion\b") == 0


def test_ranked_names_are_filtered_before_the_join(spark, data_dir):
    text = plan(QUERIES["topk_entities"](spark, data_dir))
    assert "TakeOrderedAndProject" in text and "LeftSemi, BuildRight" in text


def test_total_is_a_subquery(spark, data_dir):
    text = plan(QUERIES["share_of_total"](spark, data_dir))
    assert "Subquery" in text and "Window" not in text


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.mark.parametrize("kind", ["lookup", "available", "natural"])
def test_hot_key_of_a_large_join_is_split(kind, spark):
    """Beyond the broadcast threshold a key with a third of the rows gets several tasks."""
    session = spark.newSession()
    for name, value in SKEW_SETTINGS.items():
        session.conf.set(name, value)
    rows = session.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        "id",
        F.hash("id").alias("noise"),
    )
    other = session.range(0, 300_000, 1, 4).select(
        F.col("id").alias("k"), F.hash("id").alias("label")
    )
    joined = {
        "lookup": lambda: joins.lookup_join(rows, other, "k"),
        "available": lambda: joins.available_entities(rows, other, "k"),
        "natural": lambda: joins.natural_left_join([rows, other], on=["k"]),
    }[kind]()
    assert len(joined.collect()) == 300_000
    assert "skew=true" in plan(joined)
