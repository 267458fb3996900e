"""Parquet files whose columns differ, read into one table.

Spark takes the schema of many files from one of them, or merges schemas of equal types. Here
tasks read the footers; files of one schema form a group, and a column that has several types
gets the least type that holds them all: a wider integer, ``double`` for fractions next to
integers that a double holds exactly, the later of date and time, text for everything
else. Each group is scanned with its own schema and its columns are cast to the joined ones,
so filters and column pruning still reach the files.

What comes to the driver is one row per file, as Spark's own listing does.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelweave.schema import quoted
from panelweave.workers import ship

FOOTERS_PER_TASK = 200
_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text holds every type."""
    if a == b:
        return a
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.NullType):
            return other
        if one in _INTEGERS and other in _INTEGERS:
            return max(a, b, key=_INTEGERS.index)
        if isinstance(one, T.FloatType) and isinstance(other, T.DoubleType):
            return other
        # 32-bit integers are exact in a double, 64-bit ones are not.
        if one in _INTEGERS[:3] and isinstance(other, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        if isinstance(one, T.DateType) and isinstance(other, T.TimestampNTZType):
            return other
    return T.StringType()


def join_schemas(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns in the order in which they first appear, each with its joined type."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            known = found.get(field.name)
            found[field.name] = field.dataType if known is None else join_types(known, field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    from panelweave.sources.file_heads import open_folder

    for batch in batches:
        paths = batch.column("path").to_pylist()
        schemas = []
        for path in paths:
            folder, name = path.rsplit("/", 1)
            system, root = open_folder(folder)
            with system.open_input_file(f"{root.rstrip('/')}/{name}") as source:
                schemas.append(from_arrow_schema(pq.read_schema(source), prefer_timestamp_ntz=True).json())
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(schemas, pa.string())], names=["path", "schema"])


def survey_schemas(spark: SparkSession, paths: str | Sequence[str], extension: str = "parquet") -> dict[str, list[str]]:
    """Files by schema, in the order of their names."""
    ship(spark)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}")
    found = listing.load([paths] if isinstance(paths, str) else list(paths)).select("path")
    tasks = -(-found.count() // FOOTERS_PER_TASK)
    if not tasks:
        raise ValueError(f"no .{extension} files below {paths}")
    groups = defaultdict(list)
    rows = found.repartition(tasks).mapInArrow(_footers, "path string, schema string").collect()
    for r in sorted(rows, key=lambda r: r.path):
        groups[r.schema].append(r.path)
    return dict(groups)


def read_mixed_files(
    spark: SparkSession, paths: str | Sequence[str], entity: str = "iso3", extension: str = "parquet"
) -> DataFrame:
    """One row per row of the files; the entity is the file name.

    Columns that exist in some files only are NULL for the others; a column that has several types
    gets their joined type. A missing value stays one.
    """
    import json

    groups = survey_schemas(spark, paths, extension)
    schemas = {text: T.StructType.fromJson(json.loads(text)) for text in groups}
    joined = join_schemas(list(schemas.values()))
    name = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*)\.{extension}$", 1)
    frames = []
    for text, files in groups.items():
        own = {f.name for f in schemas[text].fields}
        columns = [
            (F.col(quoted(f.name)) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in joined.fields
        ]
        frames.append(spark.read.schema(schemas[text]).parquet(*files).select(name.alias(entity), *columns))
    return reduce(DataFrame.unionByName, frames)
