"""Register snapshots and publish the latest ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from panelweave.operators.registry import manifest_upsert, require_latest_file
from panelweave.schema import MANIFEST_SCHEMA, cast_project
from panelweave.sources.publication import point_view, publish, published, version_path
from panelweave.sources.scratch import materialize
from panelweave.sources.snapshots import path_exists, read_snapshot, write_snapshot


def register_snapshots(
    spark: SparkSession, path: str, rows: DataFrame, sequence: str | None = None
) -> DataFrame:
    """Add rows to the registry file, replacing those of the same files.

    The new registry is complete in the shared work folder before the old one is
    overwritten, so a lost executor cannot leave half of it. Registering the same
    rows again changes nothing. Missing values are written as empty text.
    """
    if path_exists(spark, path):
        registry = cast_project(read_snapshot(spark, path), MANIFEST_SCHEMA)
    else:
        registry = spark.createDataFrame([], MANIFEST_SCHEMA)
    updated = materialize(manifest_upsert(registry, rows, sequence), "registry")
    write_snapshot(updated, path, null_text="", mode="overwrite")
    return updated


def package_latest(
    spark: SparkSession, manifest: DataFrame, pattern: str, schema: T.StructType, target: str
) -> DataFrame:
    """Write the newest registered file that matches in typed and in text form.

    Produces ``<target>.parquet`` and ``<target>.csv.gz`` and returns the rows.
    """
    rows = cast_project(read_snapshot(spark, require_latest_file(manifest, pattern)), schema)
    write_snapshot(rows, f"{target}.parquet", mode="overwrite")
    write_snapshot(rows, f"{target}.csv.gz", mode="overwrite")
    return rows


def register_published(
    spark: SparkSession, view: str, folder: str, rows: DataFrame, sequence: str | None = None
) -> DataFrame:
    """Add rows to a registry that is read through a view.

    The new registry is a version of its own below the folder; the view is pointed at it last,
    so whoever reads the registry meanwhile sees all of the old version. Registering
    the same rows again changes nothing but the version. One writer at a time.
    """
    registry = published(spark, view)
    if registry is None:
        registry = spark.createDataFrame([], MANIFEST_SCHEMA)
    updated = manifest_upsert(cast_project(registry, MANIFEST_SCHEMA), rows, sequence)
    publish(updated, view, folder, "registry")
    return published(spark, view)


def publish_latest(
    spark: SparkSession, manifest: DataFrame, pattern: str, schema: T.StructType, view: str, folder: str
) -> DataFrame:
    """Publish the newest registered file that matches as a view, with a text copy.

    The text form ``<version>.csv.gz`` lies next to the version that the view shows and is complete before.
    Returns the rows of the view.
    """
    rows = cast_project(read_snapshot(spark, require_latest_file(manifest, pattern)), schema)
    path = version_path(folder, "latest")
    write_snapshot(rows, path)
    write_snapshot(spark.read.schema(schema).parquet(path), path.removesuffix(".parquet") + ".csv.gz")
    point_view(spark, view, path, "latest")
    return published(spark, view)
