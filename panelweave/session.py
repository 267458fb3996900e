"""Session settings the operators are written for.

Nothing here fixes a cluster size. Adaptive execution coalesces small shuffle
partitions and splits skewed ones at run time, but never makes more of them than
it started with; :func:`size_shuffles` sets that start from the size of the input.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession, functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python call site of every column expression makes building
    # the wide plans of this library several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "panelweave", master: str | None = None, **extra: str
) -> SparkSession:
    """Create (or reuse) a session; ``extra`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# A shuffle partition of this size sorts and aggregates in the memory of one
# ordinary executor core.
SHUFFLE_PARTITION_BYTES = 512 * 1024**2


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files below the paths, from their listing alone."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return listing.load(list(paths)).agg(F.sum("length")).first()[0] or 0


def shuffle_partitions(n_bytes: int, expansion: float = 4.0) -> int:
    """Partitions for a shuffle of the whole input.

    ``expansion`` is how much larger rows are in a shuffle than in compressed
    columnar files.
    """
    wanted = math.ceil(n_bytes * expansion / SHUFFLE_PARTITION_BYTES)
    return max(wanted, 1)


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Start shuffles of this session with partitions that fit into memory.

    Never goes below the number the session was configured with.
    """
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(configured, shuffle_partitions(input_bytes(spark, *paths)))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted
