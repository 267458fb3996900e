"""Versions of a table in folders of their own, and a view that readers use.

A version is written completely before the view is pointed at it, as the last step. Files that
somebody may be reading are never overwritten: a reader sees the old version or the new one,
and one that began with the old version ends with it. Old versions stay until they are removed
by hand.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


def version_path(folder: str, name: str, extension: str = "parquet") -> str:
    """A path for a new version; names sort by the time they were made."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{folder.rstrip('/')}/{stamp}_{uuid.uuid4().hex[:8]}_{name}.{extension}"


def _quoted(view: str) -> str:
    if not re.fullmatch(r"\w+(\.\w+){0,2}", view):
        raise ValueError(f"{view!r} is no name of a view")
    return view


def point_view(spark: SparkSession, view: str, path: str, version: str = "") -> None:
    """Let a catalog view read the Parquet files at the path."""
    place = path.replace("`", "``")
    note = version.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(view)} COMMENT '{note}' AS SELECT * FROM parquet.`{place}`")


def published(spark: SparkSession, view: str) -> DataFrame | None:
    """The rows of the current version, None before the first one."""
    return spark.table(view) if spark.catalog.tableExists(_quoted(view)) else None


def publish(rows: DataFrame, view: str, folder: str, name: str = "table") -> str:
    """Write a new version and point the view at it; returns the path of the version."""
    path = version_path(folder, name)
    rows.write.parquet(path)
    point_view(rows.sparkSession, view, path, name)
    return path
