"""Files of differing types, and an ingest that is interrupted between its outputs."""

import pandas as pd
import pytest
from helpers import bag, formatted
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from panelweave.operators.audit import failure_log
from panelweave.sources.schema_survey import join_schemas, join_types, read_mixed_files, survey_schemas
from panelweave.streaming.incremental import ingest_results, ingest_with_rejects


@pytest.mark.parametrize(
    "a, b, joined",
    [("byte", "long", "long"), ("int", "double", "double"), ("long", "double", "string"), ("float", "double", "double"),
     ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp", "timestamp_ntz", "string"), ("boolean", "int", "string"),
     ("string", "int", "string"), ("void", "int", "int"), ("int", "int", "int")],
)
def test_joined_types(spark, a, b, joined):
    a, b, joined = (T.StructType.fromDDL(f"x {t}")["x"].dataType for t in (a, b, joined))
    assert join_types(a, b) == join_types(b, a) == joined
    # No matter in which order the files come.
    text = T.StringType()
    assert join_types(join_types(a, b), text) == join_types(a, join_types(b, text)) == text


def test_columns_in_order_of_appearance(spark):
    one, two = (T.StructType.fromDDL(s) for s in ("a int, b string", "c double, a long"))
    assert join_schemas([one, two]).simpleString() == "struct<a:bigint,b:string,c:double>"


def test_files_of_differing_types(spark, tmp_path):
    big = 2**53 + 1
    frames = {
        "A": pd.DataFrame({"v": [1, big], "w": ["x", None]}),
        "B": pd.DataFrame({"v": [1.5, None]}),
        "C": pd.DataFrame({"v": ["n/a"], "odd name.`x`": [True]}),
        "D": pd.DataFrame({"v": pd.Series([7], dtype="int64"), "w": ["y"]}),
        "E": pd.DataFrame({"v": pd.Series([], dtype="int64")}),
    }
    for name, frame in frames.items():
        frame.to_parquet(tmp_path / f"{name}.parquet")
    read = read_mixed_files(spark, str(tmp_path))
    assert read.columns == ["iso3", "v", "w", "odd name.`x`"]
    assert bag(read.select("iso3", "v", "w")) == {
        ("A", "1", "x"): 1, ("A", str(big), None): 1, ("B", "1.5", None): 1, ("B", None, None): 1,
        ("C", "n/a", None): 1, ("D", "7", "y"): 1,
    }
    assert sorted(len(f) for f in survey_schemas(spark, str(tmp_path)).values()) == [1, 1, 1, 2]
    # Only the wanted column is read, and filters on a column of one type reach the files.
    narrow = read.where(F.col("w") == "y").select("w")
    text = formatted(narrow)
    assert "ReadSchema: struct<w:string" in text and "v:" not in text and "PushedFilters: [IsNotNull(w), EqualTo(w,y)]" in text
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no .parquet files"):
        read_mixed_files(spark, str(tmp_path / "none"))


def sheets(folder, names):
    folder.mkdir(exist_ok=True)
    for n in names:
        cells = {"s_a": ["1.5", "n/a"] if n == "BAD" else ["1.5", None], "s_b": ["NA", ""], "year": [2000, 2001]}
        pd.DataFrame(cells).to_parquet(folder / f"{n}.parquet")


SCHEMA = T.StructType().add("s_a", "string").add("s_b", "string").add("year", "long")


def test_an_interrupted_batch_is_written_again(spark, tmp_path):
    sheets(tmp_path / "in", ["A", "B", "BAD", "C"])
    stopped = []

    def stop(number):
        if len(stopped) < 2:
            stopped.append(number)
            raise RuntimeError("interrupted")

    def run(target, between=None):
        return ingest_with_rejects(
            spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / target), str(tmp_path / f"{target}-state"),
            files_per_batch=2, between=between,
        )

    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="interrupted"):
            run("a", stop).awaitTermination()
    run("a", stop).awaitTermination()
    run("b").awaitTermination()
    assert stopped == [0, 0]
    for table in ("observations", "rejects"):
        assert bag(spark.read.parquet(str(tmp_path / "a" / table))) == bag(spark.read.parquet(str(tmp_path / "b" / table)))
    rejects = spark.read.parquet(str(tmp_path / "a" / "rejects")).collect()
    assert [(r.iso3, r.var_short, r.cell, r.year) for r in rejects] == [("BAD", "s_a", "n/a", 2001)]

    # New files only; a file taken in before is not read again.
    sheets(tmp_path / "in", ["D"])
    run("a").awaitTermination()
    results = ingest_results(spark, str(tmp_path / "a"))
    assert {(r.iso3, r.n_values, r.n_rejects) for r in results.collect()} == {
        ("A", 1, 0), ("B", 1, 0), ("BAD", 1, 1), ("C", 1, 0), ("D", 1, 0)
    }
    assert [tuple(r) for r in failure_log(results, "iso3", ["BAD"]).collect()] == [
        ("BAD", "1 cells are no numbers", "known missing")
    ]
