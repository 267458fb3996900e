"""Generated inputs against plain Python."""

from collections import Counter, defaultdict

from helpers import bag
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from panelweave.functions import vocabulary as vocab
from panelweave.operators import audit, codes, dedup, joins, reshape, summary

few = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
key = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
number = st.one_of(st.none(), st.sampled_from([0.0, 1.5, -2.0]))


@few
@given(st.lists(st.tuples(key, st.one_of(st.none(), st.sampled_from(["ES9", "ES13", "CEN"])), number)))
def test_newest_edition(spark, data):
    data = [(i, *row) for i, row in enumerate(data)]
    frame = spark.createDataFrame(data, "rid int, k string, edition string, v double")
    best = {}
    for rid, k, edition, _ in data:
        rank = (edition is not None, edition or "", -rid)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, rid)
    for order in (frame, frame.orderBy(F.desc("rid")), frame.repartition(3)):
        kept = dedup.keep_newest_edition(order, ["k"], "edition", [F.col("rid").asc()])
        assert {r["k"]: r["rid"] for r in kept.collect()} == {k: rid for k, (_, rid) in best.items()}
    dropped = dedup.collapsed_rows(frame, ["k"]).first()
    assert (dropped["n_keys"], dropped["n_dropped"]) == (len(best), len(data) - len(best))


@few
@given(*[st.lists(st.tuples(key, number), max_size=5) for _ in range(3)])
def test_natural_join(spark, first, second, third):
    sheets = [
        spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], f"k string, p double, {name} int")
        for name, rows in (("x", first), ("y", second), ("z", third))
    ]
    expected = Counter()
    for i, a in enumerate(first):
        for j in [j for j, b in enumerate(second) if a == b] or [None]:
            for m in [m for m, c in enumerate(third) if a == c] or [None]:
                expected[(*a, i, j, m)] += 1
    assert bag(joins.natural_left_join(sheets).select("k", "p", "x", "y", "z")) == expected


@few
@given(st.lists(st.tuples(key, number, number)))
def test_unpivot(spark, data):
    frame = spark.createDataFrame(data, "k string, a double, b double")
    expected = Counter()
    for k, a, b in data:
        expected[(k, a, "a")] += 1
        expected[(k, b, "b")] += 1
    assert bag(reshape.unpivot_columns(frame, ["a", "b"]).select("k", "value", "var_short")) == expected
    dropped = Counter({row: n for row, n in expected.items() if row[1] is not None})
    found = reshape.unpivot_columns(frame, ["a", "b"], drop_null=True)
    assert bag(found.select("k", "value", "var_short")) == dropped


@few
@given(st.lists(key), st.lists(st.sampled_from(["a", "b", "d"])))
def test_entities_and_coverage(spark, listed, present):
    expected = spark.createDataFrame([(k,) for k in listed], "e string")
    seen = spark.createDataFrame([(k,) for k in present], "e string")
    missing = joins.missing_entities(expected, seen, "e")
    assert bag(missing) == Counter((k,) for k in set(listed) - set(present))
    available = joins.available_entities(expected, seen, "e")
    assert bag(available) == Counter((k,) for k in listed if k in present)
    row = audit.entity_coverage(expected, seen, "e").first()
    assert (row["n_entities"], row["n_present"]) == (len(listed), sum(k in present for k in listed))
    duplicates = audit.duplicate_keys(expected, ["e"])
    assert bag(duplicates) == Counter((k, n) for k, n in Counter(listed).items() if n > 1)


@few
@given(st.lists(st.one_of(st.none(), st.sampled_from(["s_lat_nemp_u", "s_ns_t", "abc", "s_sew_rtp_t"]))))
def test_counting_by_code_equals_counting_rows(spark, data):
    frame = spark.createDataFrame([(c,) for c in data], "code string")
    rules = {"stage": vocab.classify_stage, "residence": vocab.derive_residence}
    by_row = frame.select(*[rule(F.col("code")).alias(name) for name, rule in rules.items()])
    assert bag(codes.count_mapped(frame, "code", rules)) == bag(summary.count_by(by_row, *rules))
    total = frame.agg(summary.count_distinct_with_null("code")).first()[0]
    assert total == len(set(data))


@few
@given(st.lists(st.tuples(key, st.integers(0, 3), st.integers(0, 5))))
def test_shares_add_up(spark, data):
    totals = defaultdict(int)
    for k, _, n in data:
        totals[k] += n
    counts = spark.createDataFrame(data, "k string, t int, n long")
    for r in summary.share_within(counts, ["k"]).collect():
        expected = r["n"] / totals[r["k"]] * 100 if totals[r["k"]] else None
        assert r["prop"] == expected
    grand = sum(totals.values())
    for r in summary.share_of_total(counts).collect():
        assert r["prop"] == (r["n"] / grand * 100 if grand else None)
