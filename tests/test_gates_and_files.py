"""Interval joins, file heads, gates in the writing job, and publication by views."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from helpers import bag, formatted, plan, rows
from pyspark.sql import functions as F

from panelweave.operators import audit, intervals
from panelweave.operators.intervals import interval_join
from panelweave.operators.reshape import any_present
from panelweave.plans.gates import GateFailed, Gates, write_gated
from panelweave.plans.observations import tidy_observations
from panelweave.plans.packaging import publish_latest, register_published
from panelweave.schema import MANIFEST_SCHEMA
from panelweave.sources import files, publication, snapshots
from panelweave.sources.file_heads import SHARE, file_heads
from panelweave.suite import QUERIES, SCAN_QUERIES, written_files


def brute(points, intervals):
    return sorted(
        (p, i) for p, at in points for i, (a, b) in enumerate(intervals)
        if at is not None and (a is None or at >= a) and (b is None or at <= b)
    )


@pytest.mark.parametrize("kind", ["long", "int", "double", "timestamp_ntz", "timestamp", "date"])
def test_interval_join(spark, kind):
    rng = random.Random(5)
    make = {
        "double": lambda v: v / 4, "timestamp_ntz": lambda v: datetime(1970, 1, 1) + timedelta(seconds=v / 7),
        "timestamp": lambda v: datetime(2000, 1, 1) + timedelta(seconds=v), "date": lambda v: date(1970, 1, 1) + timedelta(days=v),
    }.get(kind, lambda v: v)
    def some(v):
        return None if v is None else make(v)

    intervals = []
    for _ in range(150):
        a = rng.randint(-3000, 3000)
        b = a + rng.choice([0, 1, 2, 3, 7, 8, 9, 100, 2500, -1])
        intervals.append((None if rng.random() < 0.03 else a, None if rng.random() < 0.03 else b))
    points = [(k, rng.choice([None, 0, -1, *range(-3100, 3100)])) for k in range(400)]
    left = spark.createDataFrame([(k, some(v)) for k, v in points], f"p long, at {kind}")
    right = spark.createDataFrame([(i, some(a), some(b)) for i, (a, b) in enumerate(intervals)], f"i long, opens {kind}, closes {kind}")
    found = interval_join(left, "at", right, "opens", "closes")
    assert sorted((r.p, r.i) for r in found.collect()) == brute(points, intervals)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    assert interval_join(left, "at", right.where("false"), "opens", "closes").count() == 0


def test_interval_join_at_the_ends_of_the_scale(spark):
    ends = [(-(2**63), 2**63 - 1), (2**63 - 1, 2**63 - 1), (-(2**63), -(2**63)), (0, 2**62)]
    right = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ends)], "i long, opens long, closes long")
    points = [(0, -(2**63)), (1, 2**63 - 1), (2, 0)]
    left = spark.createDataFrame(points, "p long, at long")
    found = interval_join(left, "at", right, "opens", "closes")
    assert sorted((r.p, r.i) for r in found.collect()) == brute(points, ends)
    with pytest.raises(ValueError, match="both sides have at"):
        interval_join(left, "at", right.withColumn("at", F.lit(1)), "opens", "closes")
    with pytest.raises(TypeError):
        interval_join(left.withColumn("at", F.lit("x")), "at", right, "opens", "closes")


def test_no_task_gets_one_interval_s_points_or_all_open_intervals(spark, monkeypatch):
    monkeypatch.setattr(intervals, "CELL", 16)
    rng = random.Random(6)
    # Two thirds of the points lie at one place, the others far apart.
    points = [(k, 77 if k % 3 else rng.randint(0, 10**6)) for k in range(900)]
    bounds = [(None, None), (None, 500_000), (300, None), (0, 10**6), (77, 77), (76, 78), (5, 4), (-9, -1)]
    left = spark.createDataFrame(points, "p long, at long")
    right = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(bounds)], "i long, opens long, closes long")
    found = interval_join(left, "at", right, "opens", "closes")
    assert sorted((r.p, r.i) for r in found.collect()) == brute(points, bounds)
    assert "__slice" in plan(found)
    # Long and open intervals lie in many cells of few points.
    cells = []
    kind, join = type(left), type(left).join
    monkeypatch.setattr(kind, "join", lambda self, other, on=None, how=None: (
        cells.append((self, on)) or join(self, other, on, how)))
    interval_join(left, "at", right, "opens", "closes")
    dealt, keys = cells[-1]
    assert max(r["count"] for r in dealt.groupBy(*keys).count().collect()) < 100


def test_first_valid_in_windows(spark, monkeypatch):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    at = lambda k: None if k is None else start + timedelta(minutes=k)
    captures = [(at(rng.choice([None, *range(300)])), rng.choice([None, 2000, 2001, 2002])) for _ in range(500)]
    windows = []
    for k in range(120):
        a = rng.choice([None, *range(-20, 320)])
        b = None if a is None or rng.random() < 0.1 else a + rng.choice([-1, 0, 1, 5, 40, 400])
        windows.append((rng.choice([None, f"r{k % 70}"]) if k % 9 == 0 else f"r{k % 70}", at(a), at(b),
                        rng.choice([None, 2000, 2001, 2002, 2003])))
    left = spark.createDataFrame(captures, "ts timestamp_ntz, max_year int").repartition(3)
    columns = "release_id string, opens timestamp_ntz, closes timestamp_ntz, expected_max_year int"
    right = spark.createDataFrame(windows, columns)
    wanted = bag(audit.first_valid_capture(audit.capture_verdicts(left, right, "ts", "max_year"), "ts", listed=False))
    monkeypatch.setattr(audit, "interval_join", None)
    assert bag(audit.first_valid_in_windows(left, right, "ts", "max_year")) == wanted
    for a, b in ((left.where("false"), right), (left, right.where("false"))):
        assert audit.first_valid_in_windows(a, b, "ts", "max_year").count() == 0
    with pytest.raises(TypeError, match="different types"):
        audit.first_valid_in_windows(left, right.withColumn("closes", F.lit(1)), "ts", "max_year")


def test_first_valid_capture_of_windows_forms_no_pairs(spark, data_dir, monkeypatch):
    def refuse(*args):
        raise AssertionError("captures were joined to windows")

    monkeypatch.setattr(audit, "interval_join", refuse)
    assert QUERIES["capture_windows_first"](spark, data_dir).count()


def test_files_by_value_are_written_by_several_tasks(spark, data_dir, tmp_path, monkeypatch):
    made = str(tmp_path / "audit")
    monkeypatch.setattr(written_files, "scratch_path", lambda *a: made)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    try:
        SCAN_QUERIES["file_audit"](spark, data_dir)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = list(Path(made).glob("good/o_orderpriority=*/part-*.parquet"))
    assert len(files) == len({f.parent for f in files}) == 5
    assert len({f.name.split("-")[1] for f in files}) > 1
    assert spark.read.parquet(f"{made}/good/o_orderpriority=*").count() == spark.read.parquet(f"{data_dir}/orders.parquet").count()


def test_file_heads(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "x").write_bytes(b"hidden")
    contents = {"a.bin": b"PK\x03\x04rest", "deep/er/b.bin": b"PK", "deep/c.bin": b""}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    with open(tmp_path / "huge.bin", "wb") as huge:
        huge.write(b"PK\x03\x04")
        huge.truncate(3 << 30)  # takes no room on disk
    found = {r.file: (r.length, bytes(r.head)) for r in file_heads(spark, str(tmp_path)).collect()}
    assert found == {n: (len(d), d[:4]) for n, d in contents.items()} | {"huge.bin": (3 << 30, b"PK\x03\x04")}
    listed = spark.createDataFrame([(n,) for n in [*contents, "huge.bin", "gone", "gone"]], "file string")
    audited = {r.file: (r.length, r.is_valid) for r in files.audit_files(spark, f"file://{tmp_path}", listed).collect()}
    assert audited == {
        "a.bin": (8, True), "deep/er/b.bin": (2, False), "deep/c.bin": (0, False), "huge.bin": (3 << 30, True),
        "gone": (None, False),
    }


def test_files_are_dealt_to_tasks(spark, tmp_path):
    for k in range(SHARE + 5):
        (tmp_path / f"{k}.x").touch()
    heads = file_heads(spark, str(tmp_path))
    assert heads.count() == SHARE + 5 and heads.rdd.getNumPartitions() == 2
    (tmp_path / "none").mkdir()
    assert file_heads(spark, str(tmp_path / "none")).count() == 0


@pytest.fixture
def view(spark):
    name = "gates_test_view"
    yield name
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_gates_count_while_writing(spark, tmp_path, view):
    # One key holds most rows, some keys are missing.
    data = [("hot", "c1", i) for i in range(500)] + [(f"k{i}", f"c{i % 3}", i) for i in range(50)] + [(None, None, 1)] * 2
    frame = spark.createDataFrame(data, "k string, code string, v int").repartition(4)
    lookup = spark.createDataFrame([("c0", "zero"), ("c1", "one"), ("c2", None)], "code string, label string")
    gates = Gates(key=["k"], keep_first=[F.asc("v")], code="code", lookup=lookup)
    counts = write_gated(frame, view, str(tmp_path), gates)
    assert (counts["n_rows"], counts["n_written"], counts["n_dropped"], counts["n_repeated_keys"]) == (552, 52, 500, 0)
    # c2 has no label and a missing code is not known.
    assert (counts["n_unmatched_rows"], counts["n_codes"], counts["n_unmatched"]) == (17, 4, 2)
    assert publication.published(spark, view).count() == 52
    assert {r.k: r.v for r in publication.published(spark, view).where("k = 'hot'").collect()} == {"hot": 0}

    with pytest.raises(GateFailed, match="keeps its version before: 2 keys occur more than once") as failed:
        write_gated(frame, view, str(tmp_path), Gates(key=["k"]))
    assert spark.read.parquet(failed.value.path).where("k = 'hot'").count() == 2
    with pytest.raises(GateFailed, match="3 of 4 code values are not in the lookup"):
        write_gated(frame, view, str(tmp_path), Gates(code="code", lookup=lookup.where("code = 'c1'")))
    with pytest.raises(GateFailed, match="552 rows instead of at least 600"):
        write_gated(frame, view, str(tmp_path), Gates(least_rows=600))
    assert publication.published(spark, view).count() == 52
    none = write_gated(frame.where("false"), view, str(tmp_path), gates)
    assert none["n_rows"] == none["n_dropped"] == 0 and publication.published(spark, view).count() == 0


def test_gates_read_the_input_once(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(100).select("id", (F.col("id") % 7).cast("string").alias("code")).write.parquet(path)
    from pyspark.sql import Observation

    lookup = spark.createDataFrame([("1", "x")], "code string, label string")
    gates = Gates(key=["id"], keep_first=[F.asc("code")], code="code", lookup=lookup)
    observed = gates.observed(spark.read.parquet(path), Observation("a"), Observation("b"))
    text = formatted(observed)
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "WindowGroupLimit" in text


def test_a_reader_keeps_its_version(spark, tmp_path, view):
    assert publication.published(spark, view) is None
    publication.publish(spark.range(10), view, str(tmp_path))
    reader = publication.published(spark, view)
    publication.publish(spark.range(3), view, str(tmp_path))
    assert reader.count() == 10 and publication.published(spark, view).count() == 3
    with pytest.raises(Exception):
        publication.publish(spark.range(3).select(F.raise_error(F.lit("lost")).alias("id")), view, str(tmp_path))
    assert publication.published(spark, view).count() == 3
    with pytest.raises(ValueError, match="no name of a view"):
        publication.publish(spark.range(1), "x; DROP VIEW y", str(tmp_path))


def test_register_and_publish(spark, tmp_path, view):
    def row(file, note):
        return spark.createDataFrame([("r", "2020-01-01", "raw", file, None, note)], MANIFEST_SCHEMA)

    register_published(spark, view, str(tmp_path), row("a", "first"))
    before = publication.published(spark, view)
    for _ in range(2):
        after = register_published(spark, view, str(tmp_path), row("a", "again").union(row("b", None)))
    assert {(r.file, r.notes) for r in after.collect()} == {("a", "again"), ("b", None)}
    assert [r.notes for r in before.collect()] == ["first"]

    path = str(tmp_path / "2020_raw.parquet")
    frame = spark.createDataFrame([(1, "x"), (2, None)], "k int, t string")
    snapshots.write_snapshot(frame, path)
    shown = publish_latest(spark, row(path, None), "raw", frame.schema, view, str(tmp_path / "latest"))
    assert bag(shown) == bag(frame)
    (text,) = (tmp_path / "latest").glob("*.csv.gz")
    assert bag(snapshots.read_snapshot(spark, str(text)).select(F.col("k").cast("int"), "t")) == bag(frame)


def test_odd_cells_are_missing_values(spark):
    sheets = spark.createDataFrame([("A", "n/a", None), ("B", "1.5", "x"), ("C", None, None)], "iso3 string, s_a_t string, s_b_t string")
    assert [r.iso3 for r in sheets.where(any_present(["s_a_t", "s_b_t"])).collect()] == ["B"]
    entities = spark.createDataFrame([("A",), ("B",), ("C",)], "iso3 string")
    variables = spark.createDataFrame([("s_a_t", "a")], "var_short string, var_long string")
    tidy = tidy_observations(sheets, entities, variables, context=())
    assert {(r.iso3, r.var_short, r.value) for r in tidy.collect()} == {("A", None, None), ("B", "s_a_t", 1.5), ("C", None, None)}


def test_line_breaks_in_entity_files(spark, tmp_path):
    (tmp_path / "UGA.csv").write_text('source,note\nCEN,"two\nlines, and ""quotes"""\nNA,\n')
    read = files.read_entity_files(spark, str(tmp_path), fmt="csv", extension="csv")
    assert rows(read) == [("UGA", "CEN", 'two\nlines, and "quotes"'), ("UGA", None, None)]
