"""Reading and writing files."""

import gzip

import pytest
from helpers import bag, formatted, rows
from pyspark.sql import functions as F

from panelweave.operators.dictionary import columns_as_rows
from panelweave.plans.packaging import package_latest, register_snapshots
from panelweave.schema import INDICATOR_SCHEMA, MANIFEST_SCHEMA, RAW_SCHEMA
from panelweave.sources import files, scratch, snapshots
from panelweave.streaming.incremental import ingest_new_files


@pytest.mark.parametrize(
    "path, fmt",
    [("a/x.csv", "csv"), ("x.CSV.GZ", "csv"), ("x.parquet", "parquet"), ("b/x.parquet/", "parquet")],
)
def test_format_by_extension(path, fmt):
    assert snapshots.snapshot_format(path) == fmt


@pytest.mark.parametrize("path", ["x.xlsx", "x", "x.gz", "dir.csv/x"])
def test_unsupported_format(path):
    with pytest.raises(ValueError, match="cannot read"):
        snapshots.snapshot_format(path)


def raw_frame(spark):
    return spark.createDataFrame(
        [("UGA", "CEN02", "Census", 2002, "s_lat_t", 1.5), ("BLM", None, None, None, None, None),
         ("POL", "ES,12", "say \"x\"", 2015, "s_ns_u", None)],
        RAW_SCHEMA,
    )


@pytest.mark.parametrize("name", ["x.parquet", "x.csv", "x.csv.gz"])
def test_round_trip(spark, tmp_path, name):
    path = str(tmp_path / name)
    snapshots.write_snapshot(raw_frame(spark), path)
    assert bag(snapshots.read_raw_snapshot(spark, path, normalize=False)) == bag(
        raw_frame(spark).filter("source is not null")
    )
    normalized = snapshots.read_raw_snapshot(spark, path)
    assert {r["source"]: r["var_short"] for r in normalized.collect()} == {
        "CEN": "s_lat_n", "ES,": "s_od_u",
    }


def test_text_export_spells_missing_as_na(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    snapshots.write_snapshot(raw_frame(spark).coalesce(1), path)
    text = "".join(p.read_text() for p in (tmp_path / "x.csv").glob("part-*"))
    assert "BLM,NA,NA,NA,NA,NA" in text


def test_reads_a_foreign_gzip_export(spark, tmp_path):
    path = tmp_path / "est.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write("percent,name,iso3,year,residence,var_short,indicator_type\n")
        out.write("NA,Uganda,UGA,2000,national,san_sm,t\n")
        out.write('50.25,Uganda,UGA,2010.7,rural,san_sm,"a ""quoted"", text"\n')
    found = snapshots.read_indicator_snapshot(spark, str(path))
    assert found.schema == INDICATOR_SCHEMA
    assert rows(found) == [
        ("UGA", 2000, "national", "san_sm", "t", None), 
        ("UGA", 2010, "rural", "san_sm", 'a "quoted", text', 50.25),
    ]


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "all.parquet")
    frame = spark.range(100).select(
        F.when(F.col("id") % 3 == 0, "r2").otherwise("r1").alias("release_id"), "id"
    )
    snapshots.write_snapshot(frame, path, partition_by=["release_id"])
    one = snapshots.read_snapshot(spark, path).filter(F.col("release_id") == "r2")
    assert one.count() == 34
    assert "PartitionFilters: [isnotnull(release_id" in one._jdf.queryExecution().toString()


def test_first_row_of_the_file_survives_among_equals(spark, tmp_path):
    import pandas as pd

    n = 500
    frame = pd.DataFrame(
        {"iso3": ["A"] * n, "source": ["ES12"] * n, "type": ["Survey"] * n, "year": [2015.0] * n,
         "var_short": ["s_imp_t"] * n, "value": [float((i * 37 + 11) % n) for i in range(n)]}
    )
    (tmp_path / "x.parquet").mkdir()
    frame.to_parquet(tmp_path / "x.parquet" / "part-0.parquet", row_group_size=50)
    found = snapshots.read_raw_snapshot(spark, str(tmp_path / "x.parquet"))
    assert [r["value"] for r in found.collect()] == [11.0]
    assert found.columns == RAW_SCHEMA.names


def test_empty_side_report_keeps_its_header(spark, tmp_path):
    path = str(tmp_path / "none.csv")
    snapshots.write_snapshot(raw_frame(spark).filter("iso3 = 'none'"), path)
    back = snapshots.read_snapshot(spark, path)
    assert back.columns == RAW_SCHEMA.names and back.count() == 0


def test_releases_are_appended_to_a_bucketed_table(spark, tmp_path):
    from panelweave.operators.diff import diff_pairs, diff_snapshots

    def release(name, step):
        return spark.range(0, 400, step).select(
            F.lit(name).alias("release_id"), F.col("id").alias("k"),
            (F.col("id") % (5 + step)).cast("double").alias("value"),
        )

    path = str(tmp_path / "releases")
    for name, step in (("r1", 2), ("r2", 3)):
        table = snapshots.save_releases(release(name, step), "release_test", ["k"], 4, path=path)
    assert table.count() == 200 + 134
    files_per_release = {p.parent.name for p in (tmp_path / "releases").glob("*/part-*")}
    assert files_per_release == {"release_id=r1", "release_id=r2"}
    assert len(list((tmp_path / "releases").glob("release_id=r1/part-*"))) == 4
    found = diff_pairs(table, [("r1", "r2")], ["k"], "value", clustered=True).drop("pair")
    assert bag(found) == bag(diff_snapshots(release("r1", 2), release("r2", 3), ["k"], "value"))
    spark.sql("DROP TABLE release_test")


def test_latest_rows_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "dated.parquet")
    frame = spark.range(30).select(
        F.concat(F.lit("2020-01-0"), F.col("id") % 3 + 1).alias("snapshot_date"), "id"
    )
    snapshots.write_snapshot(frame, path, partition_by=["snapshot_date"])
    latest = snapshots.latest_rows(snapshots.read_snapshot(spark, path))
    assert {str(r["snapshot_date"]) for r in latest.collect()} == {"2020-01-03"}
    assert latest.count() == 10
    scan = formatted(latest)
    assert "PartitionFilters: [isnotnull(snapshot_date" in scan and "Subquery" in scan


def test_latest_rows_is_a_view(spark):
    frame = spark.createDataFrame([("2020-01-01", 1), ("2021-01-01", 2), (None, 3)], "snapshot_date string, v int")
    assert rows(snapshots.latest_rows(frame)) == [("2021-01-01", 2)]


def entity_folder(spark, tmp_path):
    folder = tmp_path / "entities"
    folder.mkdir(exist_ok=True)
    import pandas as pd

    pd.DataFrame({"source": ["CEN"], "year": [2002.0], "s_lat_t": [1.0]}).to_parquet(folder / "UGA.parquet")
    pd.DataFrame({"source": ["ES"], "year": [2015.0], "s_lat_t": [None], "s_ns_u": [2.0]}).astype(
        {"s_lat_t": "float64"}
    ).to_parquet(folder / "POL.parquet")
    return folder


def test_entity_comes_from_the_file_name(spark, tmp_path):
    folder = entity_folder(spark, tmp_path)
    found = files.read_entity_files(spark, str(folder), text_columns=["year"])
    assert bag(found.select("iso3", "s_lat_t", "s_ns_u", "year")) == {
        ("UGA", 1.0, None, "2002.0"): 1, ("POL", None, 2.0, "2015.0"): 1,
    }
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("source string, year double, s_lat_t double, s_ns_u double")
    pinned = files.read_entity_files(spark, str(folder), schema=schema)
    assert bag(pinned.drop("year")) == bag(found.drop("year"))
    names = files.file_names(spark, str(folder), "parquet")
    assert {r["name"] for r in names.collect()} == {"UGA", "POL"}


def test_files_with_differing_types_are_stacked_as_text(spark, tmp_path):
    import pandas as pd

    from panelweave.operators.reshape import union_all

    pd.DataFrame({"source": ["CEN"], "v": [1.0]}).to_parquet(tmp_path / "A.parquet")
    pd.DataFrame({"source": [7], "v": [2.0]}).to_parquet(tmp_path / "B.parquet")
    parts = [
        files.read_entity_files(spark, [f"{tmp_path}/{name}.parquet"], text_columns=["source"])
        for name in "AB"
    ]
    assert bag(union_all(parts)) == {("A", "CEN", 1.0): 1, ("B", "7", 2.0): 1}


def test_text_files_with_missing_values_are_unpivoted(spark, tmp_path):
    from panelweave.operators.reshape import unpivot_columns

    (tmp_path / "NA.csv").write_text("source,s_a,s_b\nCEN,1.5,NA\nNA,,2\n")
    (tmp_path / "POL.csv").write_text("source,s_a,s_b\nES,3,unknown\n")
    sheets = files.read_entity_files(spark, str(tmp_path), fmt="csv", extension="csv")
    long = unpivot_columns(sheets, ["s_a", "s_b"], drop_null=True)
    assert bag(long.select("iso3", "source", "var_short", "value")) == {
        ("NA", "CEN", 1.5, "s_a"): 1, ("NA", None, 2.0, "s_b"): 1, ("POL", "ES", 3.0, "s_a"): 1,
    }


def test_preferred_file(spark):
    frame = spark.createDataFrame([("UGA", 1), ("ALB", 2), ("UGA", 3)], "file string, row int")
    assert bag(files.preferred_file(frame, "file", "UGA")) == {("UGA", 1): 1, ("UGA", 3): 1}
    assert bag(files.preferred_file(frame, "file", "XXX")) == {("ALB", 2): 1}


def test_header_rows_of_unequal_length(spark):
    frame = spark.createDataFrame(
        [("f", 0, ["Label A", "Label B", None]), ("f", 1, ["a", "b", "c", "d"]), ("f", 2, ["1"]),
         ("g", 0, ["only label"])],
        "file string, row int, cells array<string>",
    )
    found = files.header_rows_to_lookup(frame, "file", "row", "cells")
    assert bag(found) == {
        ("f", 0, "Label A", "a"): 1, ("f", 1, "Label B", "b"): 1, ("f", 2, None, "c"): 1,
        ("f", 3, None, "d"): 1, ("g", 0, "only label", None): 1,
    }


def test_json_tables(spark):
    frame = spark.createDataFrame(
        [(1, '[["b","a"],["2","1"],["4"]]'), (2, '[["a","b"]]'), (3, "no json"), (4, None), (5, "[]"),
         (6, '[["x"],["9"]]')],
        "id int, text string",
    )
    found = files.json_header_rows(frame, "text", ["a", "b"])
    assert bag(found.select("id", "a", "b")) == {
        ("1", "2", 1): 1, (None, "4", 1): 1, (None, None, 6): 1,
    }


def test_file_audit_flags_every_listed_file(spark, tmp_path):
    (tmp_path / "good.xlsx").write_bytes(b"PK\x03\x04" + b"x" * 10)
    (tmp_path / "page.xlsx").write_bytes(b"<html>error</html>")
    (tmp_path / "short.xlsx").write_bytes(b"PK\x03\x04")
    (tmp_path / "empty.xlsx").write_bytes(b"")
    (tmp_path / "with space.xlsx").write_bytes(b"PK\x03\x04more")
    (tmp_path / "not listed.xlsx").write_bytes(b"PK\x03\x04more")
    expected = {
        "good": True, "page": False, "short": False, "empty": False, "absent": False, "with space": True,
    }
    listed = spark.createDataFrame([(f"{name}.xlsx", 1) for name in [*expected, "good"]], "file string, n int")
    audited = files.audit_files(spark, str(tmp_path), listed).collect()
    assert len(audited) == len(expected)
    assert {r["file"].split(".")[0]: r["is_valid"] for r in audited} == expected
    assert {r["file"] for r in audited if not r["length"]} == {"empty.xlsx", "absent.xlsx"}


def test_first_present_and_required_sources(spark, data_dir, tmp_path):
    name, frame = snapshots.read_first_present(spark, data_dir, ["missing", "nation", "orders"])
    assert name == "nation" and frame.count() == 25
    with pytest.raises(ValueError, match="holds no missing"):
        snapshots.read_first_present(spark, data_dir, ["missing"])
    with pytest.raises(ValueError, match="holds no a or b"):
        snapshots.required_sources(spark, data_dir, [["nation"], ["a", "b"]])


def test_materialize_ends_the_lineage(spark):
    frame = scratch.materialize(spark.range(10).withColumn("x", F.col("id") * 2), "test")
    assert frame.count() == 10
    assert "Range" not in frame._jdf.queryExecution().toString()
    assert scratch.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_only_a_local_session_may_use_a_temporary_folder():
    class Settings(dict):
        def set(self, name, value):
            self[name] = value

    class Session:
        def __init__(self, **settings):
            self.conf = Settings({k.replace("__", "."): v for k, v in settings.items()})

    local = Session(spark__master="local[2]")
    assert scratch.shared_dir(local) == scratch.shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session(spark__master="yarn"))
    cluster = Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///work/")
    assert scratch.scratch_path(cluster, "diff").startswith("hdfs:///work/diff-")


def test_packaging_publishes_the_newest_file(spark, tmp_path):
    for day, value in (("2020-01-01", 1.0), ("2021-01-01", 2.0)):
        frame = raw_frame(spark).withColumn("value", F.lit(value))
        snapshots.write_snapshot(frame, f"{tmp_path}/{day}_raw.parquet")
    manifest = spark.createDataFrame(
        [("r", None, "raw", f"{tmp_path}/{day}_raw.parquet", None, None) for day in ("2020-01-01", "2021-01-01")],
        MANIFEST_SCHEMA,
    )
    package_latest(spark, manifest, r"_raw\.parquet$", RAW_SCHEMA, f"{tmp_path}/out")
    for name in ("out.parquet", "out.csv.gz"):
        published = snapshots.read_raw_snapshot(spark, f"{tmp_path}/{name}", normalize=False)
        assert {r["value"] for r in published.collect()} == {2.0}


def test_registry_file_is_updated_in_place(spark, tmp_path):
    path = str(tmp_path / "manifest.csv")

    def rows_of(*data):
        return spark.createDataFrame(list(data), MANIFEST_SCHEMA)

    first = rows_of(("r1", "2020-01-01", "raw", "a.csv", "live", None),
                    ("r1", None, "raw", "in/a", "live", 'input: not "yet", tidied'))
    again = rows_of(("r2", "2021-01-01", "raw", "a.csv", "live", "moved"))
    assert register_snapshots(spark, path, first).count() == 2
    register_snapshots(spark, path, first)
    found = register_snapshots(spark, path, again)
    assert bag(found) == bag(snapshots.read_snapshot(spark, path))
    assert {(r["file"], r["release_id"], r["notes"]) for r in found.collect()} == {
        ("a.csv", "r2", "moved"), ("in/a", "r1", 'input: not "yet", tidied'),
    }


def test_ingest_resumes_with_new_files(spark, tmp_path):
    folder = entity_folder(spark, tmp_path)
    schema = "source string, year double, s_lat_t double, s_ns_u double"
    from pyspark.sql.types import StructType

    def run():
        query = ingest_new_files(
            spark, str(folder), StructType.fromDDL(schema), str(tmp_path / "long"), str(tmp_path / "cp")
        )
        query.awaitTermination(120)
        assert query.exception() is None
        return bag(spark.read.parquet(str(tmp_path / "long")).select("iso3", "var_short", "value"))

    first = {("POL", 2.0, "s_ns_u"): 1, ("UGA", 1.0, "s_lat_t"): 1}  # iso3, value, var_short
    assert run() == first
    assert run() == first
    import pandas as pd

    pd.DataFrame({"source": ["X"], "year": [2020.0], "s_lat_t": [7.0], "s_ns_u": [8.0]}).to_parquet(
        folder / "KEN.parquet"
    )
    assert run() == {**first, ("KEN", 7.0, "s_lat_t"): 1, ("KEN", 8.0, "s_ns_u"): 1}


def test_columns_as_rows_reads_tables(spark, data_dir):
    nation = spark.read.parquet(f"{data_dir}/nation.parquet")
    assert {r["n_values"] for r in columns_as_rows({"nation": nation}).collect()} == {25}


def test_csv_keeps_line_breaks_and_blanks(spark, tmp_path):
    texts = [("1", "a\nb"), ("2", " lead"), ("3", "tail "), ("4", 'a "quoted", text'), ("5", None)]
    path = str(tmp_path / "texts.csv")
    snapshots.write_snapshot(spark.createDataFrame(texts, "k string, t string"), path)
    assert sorted(tuple(r) for r in snapshots.read_snapshot(spark, path).collect()) == texts
