"""Release comparison: edge cases, invariants and brute force."""

import math

import pytest
from helpers import bag, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from panelweave.operators import diff

SCHEMA = "k1 string, k2 int, value double"
KEYS = ["k1", "k2"]
NAN, INF = float("nan"), float("inf")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


CASES = [
    # old, new, status
    (1.0, 1.0, "unchanged"),
    (1.0, 1.0000001, "unchanged"),
    (1.0, 1.1, "changed"),
    (None, 1.0, "changed"),
    (1.0, None, "changed"),
    (None, None, "unchanged"),
    (NAN, None, "unchanged"),
    (NAN, 1.0, "changed"),
    (INF, INF, "unchanged"),
    (INF, -INF, "changed"),
    (-INF, -INF, "unchanged"),
    (INF, 1.0, "changed"),
]


def test_status_cases(spark):
    old = frame(spark, [(f"c{i}", i, o) for i, (o, _, _) in enumerate(CASES)] + [("gone", 0, None)])
    new = frame(spark, [(f"c{i}", i, n) for i, (_, n, _) in enumerate(CASES)] + [("here", 0, None)])
    found = {r["k1"]: r["status"] for r in diff.diff_snapshots(old, new, KEYS, "value").collect()}
    expected = {f"c{i}": status for i, (_, _, status) in enumerate(CASES)}
    assert found == {**expected, "gone": "removed", "here": "added"}


def test_distance_equal_to_tolerance_is_unchanged(spark):
    old, new = frame(spark, [("a", 1, 0.0)]), frame(spark, [("a", 1, 0.5)])
    assert diff.diff_snapshots(old, new, KEYS, "value", tol=0.5).first()["status"] == "unchanged"
    assert diff.diff_snapshots(old, new, KEYS, "value", tol=0.49).first()["status"] == "changed"


def test_null_keys_match_each_other(spark):
    old = frame(spark, [(None, 1, 1.0), ("a", None, 2.0), (None, None, 3.0)])
    new = frame(spark, [(None, 1, 1.0), ("a", None, 5.0), (None, None, 3.0)])
    found = bag(diff.diff_snapshots(old, new, KEYS, "value").select("k1", "k2", "status"))
    assert found == {
        (None, 1, "unchanged"): 1,
        ("a", None, "changed"): 1,
        (None, None, "unchanged"): 1,
    }


@pytest.mark.parametrize("side", ["old", "new"])
def test_duplicate_key_fails_the_job(spark, side):
    twice = frame(spark, [("a", 1, 1.0), ("a", 1, 1.0), ("b", 2, 1.0)])
    once = frame(spark, [("a", 1, 1.0)])
    old, new = (twice, once) if side == "old" else (once, twice)
    result = diff.diff_snapshots(old, new, KEYS, "value")
    with pytest.raises(Exception, match=f"more than once in snapshot {side}"):
        result.collect()
    with pytest.raises(Exception, match="more than once"):
        diff.summarise_diff_by(result, ["k2"]).collect()
    with pytest.raises(Exception, match="more than once"):
        result.select("k1").collect()


def test_duplicate_null_key_fails(spark):
    twice = frame(spark, [(None, None, 1.0), (None, None, 2.0)])
    with pytest.raises(Exception, match="more than once"):
        diff.diff_snapshots(twice, twice, KEYS, "value").collect()


def test_empty_inputs(spark):
    empty, some = frame(spark, []), frame(spark, [("a", 1, 1.0)])
    assert rows(diff.diff_snapshots(empty, empty, KEYS, "value")) == []
    assert diff.diff_snapshots(empty, some, KEYS, "value").first()["status"] == "added"
    assert diff.diff_snapshots(some, empty, KEYS, "value").first()["status"] == "removed"
    nothing = diff.diff_snapshots(empty, empty, KEYS, "value")
    summary = diff.summarise_diff_by(nothing, ["k2"])
    assert summary.columns == ["k2", "n_added", "n_removed", "n_changed", "n_unchanged"]
    assert rows(summary) == []
    assert dict(rows(diff.status_totals(nothing))) == dict.fromkeys(diff.STATUSES, 0)


def test_summary_sorts_missing_last(spark):
    old = frame(spark, [("a", None, 1.0), ("b", 2001, 1.0), ("c", 2000, 1.0)])
    summary = diff.summarise_diff_by(
        diff.diff_snapshots(old, frame(spark, []), KEYS, "value"), ["k2"]
    )
    assert [r["k2"] for r in summary.collect()] == [2000, 2001, None]


def test_value_can_be_integer_or_decimal(spark):
    for kind in ("int", "bigint", "decimal(12,2)"):
        old = frame(spark, [("a", 1, 1.0), ("b", 1, 2.0)]).withColumn("value", F.col("value").cast(kind))
        new = frame(spark, [("a", 1, 1.0), ("b", 1, 3.0)]).withColumn("value", F.col("value").cast(kind))
        found = {r["k1"]: r["status"] for r in diff.diff_snapshots(old, new, KEYS, "value").collect()}
        assert found == {"a": "unchanged", "b": "changed"}


def test_top_added_breaks_ties_by_entity(spark):
    new = frame(spark, [("b", i, 1.0) for i in range(3)] + [("a", i, 1.0) for i in range(3)]
                + [("c", 1, 1.0)])
    added = diff.diff_snapshots(frame(spark, []), new, KEYS, "value")
    assert rows(diff.top_added_entities(added, "k1", 2)) == [("a", 3), ("b", 3)]


def brute_force(old, new, tol=1e-6):
    missing = lambda v: v is None or math.isnan(v)
    result = {}
    for key in set(old) | set(new):
        if key not in old:
            status = "added"
        elif key not in new:
            status = "removed"
        elif missing(old[key]) != missing(new[key]):
            status = "changed"
        elif not missing(old[key]) and abs(new[key] - old[key]) > tol:
            status = "changed"
        else:
            status = "unchanged"
        result[key] = status
    return result


snapshot = st.dictionaries(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
        st.one_of(st.none(), st.integers(2000, 2003)),
    ),
    st.one_of(st.none(), st.sampled_from([0.0, 1.0, 1.0 + 1e-7, 2.5, NAN, INF, -INF])),
    max_size=12,
)


def to_rows(data):
    return [(k1, k2, v) for (k1, k2), v in data.items()]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=snapshot, new=snapshot)
def test_against_brute_force(spark, old, new):
    a, b = frame(spark, to_rows(old)), frame(spark, to_rows(new))
    result = diff.diff_snapshots(a, b, KEYS, "value").collect()
    assert {(r["k1"], r["k2"]): r["status"] for r in result} == brute_force(old, new)
    head = diff.diff_headline(diff.diff_snapshots(a, b, KEYS, "value")).first()
    assert head["old_rows"] == len(old) == head["n_removed"] + head["n_changed"] + head["n_unchanged"]
    assert head["new_rows"] == len(new) == head["n_added"] + head["n_changed"] + head["n_unchanged"]
    swapped = diff.diff_headline(diff.diff_snapshots(b, a, KEYS, "value")).first()
    assert (swapped["n_added"], swapped["n_removed"]) == (head["n_removed"], head["n_added"])
    same = diff.diff_headline(diff.diff_snapshots(a, a, KEYS, "value")).first()
    assert same["n_unchanged"] == len(old) and same["n_changed"] == 0


def test_row_order_is_irrelevant(spark):
    old = [("a", i, float(i)) for i in range(50)]
    new = [("a", i, float(i) + (i % 3)) for i in range(10, 60)]
    one = bag(diff.diff_snapshots(frame(spark, old), frame(spark, new), KEYS, "value"))
    two = bag(
        diff.diff_snapshots(
            frame(spark, old[::-1]).repartition(5), frame(spark, new[::-1]), KEYS, "value"
        )
    )
    assert one == two


def long_releases(spark):
    data = []
    for r in range(6):
        for i in range(30):
            if (i * 7 + r * 3) % 5:
                value = None if (i + r) % 11 == 0 else float(i + (r if i % 4 == 0 else 0))
                data.append((f"r{r}", f"e{i % 6}" if i % 9 else None, i, value))
    return spark.createDataFrame(data, "release_id string, k1 string, k2 int, value double")


@pytest.mark.parametrize("clustered", [False, True])
def test_all_pairs_equal_single_diffs(spark, clustered):
    """Forming the pairs per key gives what one diff per pair gives."""
    table = long_releases(spark)
    pairs = [("r0", "r1"), ("r1", "r2"), ("r2", "r5")]
    repeated = [*pairs, pairs[0]]
    found = bag(diff.diff_pairs(table, repeated, KEYS, "value", clustered=clustered))
    expected = bag(
        diff.union_all(
            [
                diff.diff_snapshots(
                    table.filter(F.col("release_id") == a),
                    table.filter(F.col("release_id") == b),
                    KEYS,
                    "value",
                ).withColumn("pair", F.lit(f"{a}_vs_{b}"))
                for a, b in pairs
            ]
        )
    )
    assert found == expected


def test_many_pairs_equal_single_diffs(spark):
    """Thirty releases, all consecutive pairs: one row per key and release at most."""
    table = spark.range(30 * 20).select(
        F.concat(F.lit("r"), (F.col("id") % 30).cast("string")).alias("release_id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") / 30).cast("int").cast("string")).alias("k1"),
        F.col("id").cast("int").alias("k2"),
        (F.col("id") % 4).cast("double").alias("value"),
    ).withColumn("k2", (F.col("k2") / 30).cast("int"))
    pairs = [(f"r{i}", f"r{i + 1}") for i in range(29)]
    found = bag(diff.diff_pairs(table, pairs, KEYS, "value"))
    singles = [
        diff.diff_snapshots(
            table.filter(F.col("release_id") == a), table.filter(F.col("release_id") == b), KEYS, "value"
        ).withColumn("pair", F.lit(f"{a}_vs_{b}"))
        for a, b in pairs
    ]
    assert found == bag(diff.union_all(singles))


def test_release_is_not_compared_with_itself(spark):
    with pytest.raises(ValueError):
        diff.diff_pairs(long_releases(spark), [("r1", "r1")], KEYS, "value")


def test_all_pairs_checks_keys(spark):
    table = spark.createDataFrame(
        [("r0", "a", 1, 1.0), ("r1", "a", 1, 1.0), ("r1", "a", 1, 2.0)],
        "release_id string, k1 string, k2 int, value double",
    )
    with pytest.raises(Exception, match="more than once in a snapshot of r0_vs_r1"):
        diff.diff_pairs(table, [("r0", "r1")], KEYS, "value").collect()


def test_hot_key_group_stays_whole(spark):
    """A third of all rows in one group: every row of it is compared."""
    n = 30_000
    old = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k1"),
        F.col("id").cast("int").alias("k2"),
        F.col("id").cast("double").alias("value"),
    )
    new = old.withColumn("value", F.col("value") + F.when(F.col("k1") == "hot", 1.0).otherwise(0.0))
    head = diff.diff_headline(diff.diff_snapshots(old, new, KEYS, "value")).first()
    assert (head["n_changed"], head["n_unchanged"]) == (n // 3, n - n // 3)
