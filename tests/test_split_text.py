"""CSV files read in parallel, with line breaks in quotes, against Spark's whole-file reader."""

import csv
import io
import random

import pytest
from helpers import bag, formatted, plan
from pyspark.sql import functions as F

from panelweave.sources import snapshots
from panelweave.sources.snapshots import CSV_OPTIONS
from panelweave.suite import SCAN_QUERIES
from panelweave.sources.split_text import PLACE, larger_than_a_split, read_split_csv, split_lines, survey


@pytest.fixture
def tiny_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def whole(spark, path):
    return spark.read.options(**CSV_OPTIONS).csv(path)


def field(rng, breaks):
    text = "".join(rng.choices(["a", "é", " ", ",", breaks, '"', "NA", "x" * 9], k=rng.randint(0, 7)))
    quoted = '"' + text.replace('"', '""') + '"'
    return quoted if any(c in text for c in ',"\n\r') or rng.random() < 0.2 else text


def filled(rows):
    """Python's reader does not tell an empty text from a missing one."""
    return [tuple(v or "" for v in r) for r in rows]


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_whole_file_readers(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    folder, expected = tmp_path / "x.csv", []
    folder.mkdir()
    # Spark's whole-file reader takes one kind of line break in a file only.
    mixed = seed % 2 == 1
    for k in range(3):
        end = rng.choice(["\n", "\r\n"])
        rows = ["a,b,\"c\n1\""]
        for _ in range(rng.choice([1, 40])):
            rows.append(",".join(field(rng, rng.choice(["\n", "\r\n"]) if mixed else "\n") for _ in range(3)))
        rows.insert(rng.randint(1, len(rows)), '"' + "long\nquoted\n" * 40 + '",y,')
        text = (end if mixed else "\n").join(rows) + rng.choice(["", "\n"])
        (folder / f"part-{k}.csv").write_bytes(text.encode())
        expected += [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    read = read_split_csv(spark, str(folder), CSV_OPTIONS)
    assert read.columns == ["a", "b", "c\n1"]
    if not mixed:
        assert bag(read) == bag(whole(spark, str(folder)))
    # Places give the order of the files.
    placed = read_split_csv(spark, str(folder), CSV_OPTIONS, places=True)
    assert filled(tuple(r)[3:] for r in placed.orderBy(*PLACE).collect()) == filled(expected)


def test_every_split_is_a_task(spark, tmp_path, tiny_splits):
    path = str(tmp_path / "x.csv")
    text = F.when(F.col("id") % 7 == 0, F.lit('two\nlines, "quoted"')).otherwise("plain")
    frame = spark.range(2000).select("id", text.alias("text"))
    snapshots.write_snapshot(frame.coalesce(1), path)
    assert whole(spark, path).rdd.getNumPartitions() == 1
    assert larger_than_a_split(spark, path)
    splits = len(survey(split_lines(spark, path)).files)
    read = snapshots.read_snapshot(spark, path)
    assert splits > 100 and read.rdd.getNumPartitions() >= splits
    assert bag(read.select(F.col("id").cast("long"), "text")) == bag(frame)


def test_without_line_breaks_spark_parses_the_lines(spark, tmp_path, tiny_splits):
    path = str(tmp_path / "x.csv")
    frame = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit('a "b", c').alias("text"))
    snapshots.write_snapshot(frame.coalesce(1), path)
    read = snapshots.read_snapshot(spark, path)
    assert "MapInArrow" not in formatted(read) and read.rdd.getNumPartitions() > 50
    assert bag(read) == bag(frame)
    placed = read_split_csv(spark, path, CSV_OPTIONS, places=True)
    assert "MapInArrow" not in formatted(placed)
    assert [r.id for r in placed.orderBy(*PLACE).collect()] == [str(i) for i in range(500)]


def test_small_and_compressed_files_are_read_whole(spark, tmp_path):
    for name in ("x.csv", "x.csv.gz"):
        path = str(tmp_path / name)
        frame = spark.createDataFrame([("1", "a\nb"), ("2", None)], "id string, text string")
        snapshots.write_snapshot(frame, path)
        assert bag(snapshots.read_snapshot(spark, path)) == bag(frame)
        assert "MapInArrow" not in formatted(snapshots.read_snapshot(spark, path))
        assert bag(read_split_csv(spark, path, CSV_OPTIONS, places=True).drop(*PLACE).fillna("")) == bag(
            frame.fillna("NA")
        )


def test_quotes_that_do_not_pair_up(spark, tmp_path, tiny_splits):
    (tmp_path / "x.csv").write_text('a,b\n1,"open\n2,x\n')
    with pytest.raises(ValueError, match="do not pair up"):
        read_split_csv(spark, str(tmp_path / "x.csv"), CSV_OPTIONS)


def test_empty_files(spark, tmp_path, tiny_splits):
    (tmp_path / "x.csv").write_text("a,b\n")
    assert read_split_csv(spark, str(tmp_path / "x.csv"), CSV_OPTIONS, places=True).count() == 0
    (tmp_path / "y.csv").write_text("\n\na,b\n\n1,2\n\r\n")
    assert [tuple(r) for r in read_split_csv(spark, str(tmp_path / "y.csv"), CSV_OPTIONS, places=True).drop(*PLACE).collect()] == [("1", "2")]


def test_the_first_row_of_a_text_file_survives(spark, tmp_path, tiny_splits):
    values = [float((i * 37 + 11) % 300) for i in range(300)]
    rows = [("A", "ES12", "Survey", 2015, "s_imp_t", v) for v in values] + [("B", "two\nlines", "Survey", 1, "s", 1.0)]
    frame = spark.createDataFrame(rows, snapshots.RAW_SCHEMA).coalesce(1)
    for name in ("x.csv", "x.csv.gz", "x.parquet"):
        snapshots.write_snapshot(frame, str(tmp_path / name))
        found = {r.iso3: (r.value, r.source) for r in snapshots.read_raw_snapshot(spark, str(tmp_path / name)).collect()}
        assert found == {"A": (11.0, "ES"), "B": (1.0, "two\nlines")}


@pytest.mark.parametrize("name", sorted(SCAN_QUERIES))
def test_python_reads_and_nothing_else(spark, data_dir, name):
    text = plan(SCAN_QUERIES[name](spark, data_dir))
    assert "MapInArrow" in text or "FileHeads" in text or "file_heads" in text
    for other in ("MapInPandas", "EvalPython", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert other not in text
