"""Read and write snapshot files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelweave.functions.scalars import strip_trailing_digits
from panelweave.functions.vocabulary import map_source_type, normalize_raw_codes
from panelweave.operators.dedup import keep_newest_edition
from panelweave.operators.select import drop_placeholders
from panelweave.schema import (
    CSV_OPTIONS,
    INDICATOR_SCHEMA,
    MISSING_TEXT,
    RAW_KEY,
    RAW_SCHEMA,
    cast_project,
    clean_missing,
)
from panelweave.sources.split_text import PLACE, larger_than_a_split, read_split_csv

RAW_DATA_COLUMNS = ["source", "type", "year", "var_short", "value"]
FORMATS = {"csv": "csv", "parquet": "parquet"}


def snapshot_format(path: str) -> str:
    """Reader for a path by extension, ignoring case and a ``.gz`` suffix."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    stem = name[:-3] if name.lower().endswith(".gz") else name
    extension = stem.rsplit(".", 1)[-1].lower() if "." in stem else ""
    if extension not in FORMATS:
        raise ValueError(f"cannot read {name}: not a .parquet, .csv or .csv.gz file")
    return FORMATS[extension]


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Scan one snapshot; missing values of text exports become NULL.

    Typed files are scanned as they are, so filters reach the files; a given
    ``schema`` saves looking into them for it. Text files are read as strings by
    header name. Types are pinned by :func:`panelweave.schema.cast_project`,
    never guessed from the data. Text files of more than one split are read split by
    split, whether or not their quoted texts hold line breaks.
    """
    if snapshot_format(path) == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    if larger_than_a_split(spark, path):
        return clean_missing(read_split_csv(spark, path, CSV_OPTIONS))
    return clean_missing(spark.read.options(**CSV_OPTIONS).csv(path))


def write_snapshot(
    df: DataFrame,
    path: str,
    compress: bool = False,
    partition_by: Sequence[str] = (),
    null_text: str = MISSING_TEXT,
    mode: str = "errorifexists",
) -> None:
    """Write a snapshot in the format its extension names.

    Partitioned output is rebalanced first: adaptive execution then gives a
    partition with most of the rows several writers instead of one.
    """
    fmt = snapshot_format(path)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
        return
    writer = writer.options(**CSV_OPTIONS, nullValue=null_text, emptyValue="")
    if compress or path.lower().endswith(".gz"):
        writer = writer.option("compression", "gzip")
    writer.csv(path)


#: Files a task of :func:`write_by_value` holds open, and bytes of rows that each of them gathers.
OPEN_FILES, ROW_GROUP_BYTES = 64, 16 << 20


def write_by_value(df: DataFrame, column: str, path: str) -> None:
    """One Parquet file per value of a column, in folders as ``partitionBy`` names them.

    A task writes the rows of its values as they come, unsorted, so its memory does not grow with
    them; only a task with more than ``OPEN_FILES`` values sorts.
    """
    conf, setting = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(setting)
    conf.set(setting, str(OPEN_FILES))
    try:
        dealt = df.repartition(column)
        dealt.write.partitionBy(column).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    finally:
        conf.set(setting, before)


def save_releases(
    df: DataFrame,
    table: str,
    key_cols: Sequence[str],
    buckets: int,
    release_col: str = "release_id",
    path: str | None = None,
    mode: str = "append",
) -> DataFrame:
    """Add releases to a table laid out for comparing them.

    The table is partitioned by release and bucketed by the identity key, so
    ``diff_pairs`` on it reads the compared releases only and shuffles nothing:
    the rows of a key already lie in the same bucket of every release. Rows are
    brought into bucket order first, which gives one file per bucket and release.
    Choose ``buckets`` once for the largest release (a few hundred MB per bucket).
    """
    writer = (
        df.repartition(buckets, *key_cols)
        .write.mode(mode)
        .partitionBy(release_col)
        .bucketBy(buckets, *key_cols)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def raw_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the rows that only mark an entity without data, and pin the types."""
    return cast_project(drop_placeholders(df, RAW_DATA_COLUMNS), RAW_SCHEMA, keep)


def harmonise_raw(df: DataFrame, tie_break: Sequence[Column]) -> DataFrame:
    """Bring raw observations of any release onto one vocabulary.

    Source codes lose their edition number, type labels and variable codes
    their release-specific spelling. Where editions then share a key the newest
    survives; ``tie_break`` decides between rows of the same edition.
    """
    normalized = df.withColumns(
        {
            "source_edition": F.col("source"),
            "source": strip_trailing_digits("source"),
            "type": map_source_type("type"),
            "var_short": normalize_raw_codes("var_short"),
        }
    )
    return keep_newest_edition(normalized, RAW_KEY, "source_edition", tie_break).drop(
        "source_edition"
    )


def read_raw_snapshot(spark: SparkSession, path: str, normalize: bool = True) -> DataFrame:
    """Raw observations of one snapshot, harmonised unless told otherwise.

    Of the rows of one edition that share a key the first one in the file
    survives. Parquet scans number their rows; the rows of text files are told apart
    by their split and their line in it.
    """
    if not normalize:
        return raw_rows(read_snapshot(spark, path))
    if snapshot_format(path) == "parquet":
        place = {"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")}
        data = read_snapshot(spark, path).withColumns(place)
    else:
        place = PLACE
        data = clean_missing(read_split_csv(spark, path, CSV_OPTIONS, places=True))
    rows = raw_rows(data, keep=list(place))
    return harmonise_raw(rows, [F.col(name).asc() for name in place]).drop(*place)


def read_indicator_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Estimates of one snapshot with pinned types; nothing is harmonised."""
    return cast_project(read_snapshot(spark, path), INDICATOR_SCHEMA)


def latest_rows(df: DataFrame, date_column: str = "snapshot_date") -> DataFrame:
    """The undated "latest" view: rows of the newest snapshot, without a copy.

    The date comes from a scalar subquery, so on a table partitioned by date
    only the newest partition is read.
    """
    newest = df.agg(F.max(date_column)).scalar()
    return df.filter(F.col(date_column) == newest)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can read something at the path."""
    try:
        spark.read.format("binaryFile").load(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_first_present(
    spark: SparkSession, folder: str, candidates: Sequence[str], extension: str = "parquet"
) -> tuple[str, DataFrame]:
    """Read the first candidate table that exists in the folder."""
    for name in candidates:
        path = f"{folder}/{name}.{extension}"
        if path_exists(spark, path):
            return name, read_snapshot(spark, path)
    raise ValueError(f"{folder} holds no {' or '.join(candidates)}")


def required_sources(
    spark: SparkSession, folder: str, groups: Sequence[Sequence[str]], extension: str = "parquet"
) -> list[str]:
    """The source found for each group of alternatives; raises if one has none."""
    found = []
    for candidates in groups:
        present = [
            name for name in candidates if path_exists(spark, f"{folder}/{name}.{extension}")
        ]
        if not present:
            raise ValueError(f"{folder} holds no {' or '.join(candidates)}")
        found.append(present[0])
    return found
