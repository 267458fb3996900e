"""Small tables that start out on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of a few known rows, such as a rule list or a lookup.

    Passed on as an Arrow table it becomes a local relation, whose exact size
    Spark knows while it plans: joins to it are broadcast without any hint.
    """
    import pyarrow as pa

    struct = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], struct)
    columns = {name: [row[i] for row in rows] for i, name in enumerate(struct.names)}
    return spark.createDataFrame(pa.table(columns), struct)
