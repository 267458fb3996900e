"""Resumable ingest of per-entity files.

Fetching a release file by file skips what is already there and can be started
again at any time. On Spark that is a file stream run until nothing is left:
its checkpoint remembers the files that were taken, and the same column
expressions as in the batch plans apply. There is no windowed or stateful
processing; a release is only compared once it is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from panelweave.operators.reshape import union_all, unpivot_columns
from panelweave.operators.select import columns_with_prefix
from panelweave.schema import blank_to_null


def stream_entity_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    entity: str = "iso3",
    extension: str = "parquet",
) -> DataFrame:
    """Streaming scan of a folder of per-entity files, entity from the file name."""
    files = spark.readStream.schema(schema).format("parquet").load(folder)
    name = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*)\.{extension}$", 1)
    return files.select(name.alias(entity), *schema.names)


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    prefixes: Sequence[str] = ("s_",),
    entity: str = "iso3",
) -> StreamingQuery:
    """Append the observations of files not ingested before, then stop."""
    sheets = stream_entity_files(spark, folder, schema, entity)
    long = unpivot_columns(
        sheets, columns_with_prefix(sheets, prefixes), "var_short", "value", drop_null=True
    )
    return (
        long.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


def split_cells(sheets: DataFrame, prefixes: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Observations of sheets whose cells are text, and the cells that are no numbers.

    An empty cell and ``NA`` are missing values, neither of the two.
    """
    values = columns_with_prefix(sheets, prefixes)
    ids = [c for c in sheets.columns if c not in set(values)]
    cells = sheets.select(*ids, *[blank_to_null(F.col(c).cast("string")).alias(c) for c in values])
    cells = cells.unpivot(ids, values, "var_short", "cell").filter(F.col("cell").isNotNull())
    number = F.col("cell").try_cast("double")
    found = cells.withColumn("value", number).filter(number.isNotNull()).drop("cell")
    return found, cells.filter(number.isNull())


def ingest_with_rejects(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    prefixes: Sequence[str] = ("s_",),
    entity: str = "iso3",
    files_per_batch: int | None = None,
    between: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Take in files not ingested before, then stop: observations and rejected cells.

    A batch has two outputs, ``<target>/observations/batch=<id>`` and
    ``<target>/rejects/batch=<id>``. Both are written over what the batch may have left there
    when it was interrupted, so a batch that is run again after a failure, also one between the
    two outputs, gives the same two tables. ``between`` is called there.
    """
    stream = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.parquet$", 1)
    sheets = stream.load(folder).select(name.alias(entity), *schema.names)

    def write(batch: DataFrame, number: int) -> None:
        found, rejects = split_cells(batch, prefixes)
        found.write.mode("overwrite").parquet(f"{target}/observations/batch={number}")
        if between:
            between(number)
        rejects.write.mode("overwrite").parquet(f"{target}/rejects/batch={number}")

    return (
        sheets.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_results(spark: SparkSession, target: str, entity: str = "iso3") -> DataFrame:
    """One row per entity that was taken in: how many values and rejects, and a status.

    Entities with rejected cells are failures in the sense of ``audit.failure_log``. A file without
    any cell leaves no row here; compare with the list of files for those.
    """
    counts = union_all(
        [
            spark.read.parquet(f"{target}/{name}").groupBy(entity).agg(F.count(F.lit(1)).alias(column))
            for name, column in (("observations", "n_values"), ("rejects", "n_rejects"))
        ]
    )
    counts = counts.groupBy(entity).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_values", "n_rejects")]
    )
    status = F.when(F.col("n_rejects") == 0, "ok").otherwise(
        F.concat(F.col("n_rejects").cast("string"), F.lit(" cells are no numbers"))
    )
    return counts.withColumn("status", status)
