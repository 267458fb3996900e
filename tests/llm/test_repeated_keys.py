"""Keys that several items have, against plain Python."""

from collections import Counter

import numpy as np

from panelweave.llm import near
from panelweave.llm.workers import ship


def test_repeated_keys(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(2)
    # One key is in every other row.
    rows = [(i, [int(k) for k in rng.integers(-3000, 3000, 3)] + [7] * (i % 2)) for i in range(1000)]
    n, rep = Counter(), {}
    for i, keys in rows:
        for k in keys:
            n[k] += 1
            rep[k] = min(i, rep.get(k, i))
    expected = {k: (n[k], rep[k]) for k in n if n[k] > 1}
    monkeypatch.setattr(near, "AT_ONCE", 300)
    frame = spark.createDataFrame(rows, "item long, key array<long>").repartition(5)
    assert {r.key: (r.n, r.rep) for r in near.repeated_keys(frame).collect()} == expected
    single = spark.createDataFrame([(i, k) for i, keys in rows for k in keys], "item long, key long")
    assert {r.key: (r.n, r.rep) for r in near.repeated_keys(single).collect()} == expected
    assert near.repeated_keys(frame.where("item < 0")).count() == 0


def test_few_rows_of_common_keys_are_shuffled(spark):
    """What is shuffled follows the tasks and buckets, not the rows."""
    ship(spark)
    frame = spark.range(200_000, numPartitions=4).selectExpr("id AS item", "id % 50000 AS key")
    plan = near.repeated_keys(frame)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(bucket") == 1
