"""Shared work space for tables written between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


LOCAL_SETTING = "panelweave.local.scratch"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of the machine:
    on a cluster the executors would not see the same one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.conf.get("spark.master", "").startswith("local"):
        folder = spark.conf.get(LOCAL_SETTING, None) or tempfile.mkdtemp(prefix="panelweave-")
        spark.conf.set(LOCAL_SETTING, folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a frame that several results need, and continue from the files.

    The lineage ends at the written table, so losing an executor afterwards
    costs a re-read and not a recomputation. With ``by``, readers that want some
    values of that column only read their files.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    if by:
        written = written.select(*df.columns)
    written._scratch_path = path
    return written


def discard(*frames: DataFrame) -> None:
    """Remove tables that :func:`materialize` wrote, once everything read from them is written.

    Frames derived from a written table are not to be used afterwards.
    """
    for frame in frames:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame._scratch_path)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
