"""Multi-file scans, header rows and file checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelweave.functions.rules import as_column
from panelweave.schema import CSV_OPTIONS, blank_to_null
from panelweave.sources.file_heads import file_heads

ZIP_MAGIC = bytes([0x50, 0x4B, 0x03, 0x04])


def read_entity_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    entity: str = "iso3",
    fmt: str = "parquet",
    extension: str = "parquet",
    text_columns: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan one file per entity; the entity is the file name.

    Columns that exist in some files only are NULL for the others. With many
    files pass the ``schema``, or Spark looks into each of them to find it.

    A column whose type differs between files is named in ``text_columns``; files
    of equal types are then read by one call each and stacked with ``union_all``.
    In text files ``NA`` and empty text are missing.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    if fmt == "csv":
        # One file per entity: quoted line breaks are kept, and no file needs to be split.
        reader = reader.options(**CSV_OPTIONS)
    files = reader.load(list(paths) if not isinstance(paths, str) else paths)
    name = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*)\.{extension}$", 1)
    named = files.select(
        name.alias(entity),
        *[
            F.col(c).cast("string").alias(c) if c in text_columns else F.col(c)
            for c in files.columns
        ],
    )
    if fmt != "csv":
        return named
    # The entity is a file name, never missing: one may be called NA.
    return named.select(
        entity,
        *[
            blank_to_null(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in named.schema.fields[1:]
        ],
    )


def file_names(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """Names of the files of a folder without extension; contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}")
    return listing.load(folder).select(
        F.regexp_extract("path", rf"([^/]+)\.{extension}$", 1).alias("name"), "length"
    )


def header_rows_to_lookup(
    df: DataFrame,
    file: str,
    row: str,
    cells: str,
    label_row: int = 0,
    code_row: int = 1,
) -> DataFrame:
    """Turn the two header rows of each file into (label, code) rows.

    ``cells`` is the array of cell texts of one sheet row. The label row and the
    code row are paired by position; a shorter one is filled with NULL.
    """
    position = F.col(row)
    headers = (
        df.filter(position.isin(label_row, code_row))
        .groupBy(file)
        .agg(
            F.max(F.when(position == label_row, F.col(cells))).alias("var_long"),
            F.max(F.when(position == code_row, F.col(cells))).alias("var_short"),
        )
    )
    empty = F.array().cast("array<string>")
    paired = F.arrays_zip(
        F.coalesce("var_long", empty).alias("var_long"),
        F.coalesce("var_short", empty).alias("var_short"),
    )
    return headers.select(file, F.posexplode(paired).alias("position", "cell")).select(
        file, "position", "cell.var_long", "cell.var_short"
    )


def preferred_file(df: DataFrame, file: str, preferred: str) -> DataFrame:
    """Rows of the preferred file, or of the first one by name if it is absent."""
    rank = F.struct((F.col(file).cast("string") != preferred).alias("other"), F.col(file).alias("name"))
    chosen = df.agg(F.min(rank).alias("best")).select("best.name").scalar()
    return df.filter(F.col(file) == chosen)


def json_header_rows(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Rows of JSON tables whose first inner array is the header.

    Columns are found by header name, whatever their position; a table without
    data rows, or text that is not such a table, gives no rows.
    """
    ids = [c for c in df.columns if c != text]
    table = F.from_json(text, "array<array<string>>")
    parsed = df.select(*ids, table.alias("__table")).filter(F.size("__table") >= 2)
    rows = parsed.select(
        *ids,
        F.element_at("__table", 1).alias("__header"),
        F.posexplode("__table").alias("row_number", "__cells"),
    ).filter(F.col("row_number") > 0)
    return rows.select(
        *ids,
        "row_number",
        *[
            F.try_element_at(
                "__cells", F.nullif(F.array_position("__header", F.lit(c)), F.lit(0)).cast("int")
            ).alias(c)
            for c in columns
        ],
    )


def has_magic(content: Column | str, magic: bytes = ZIP_MAGIC) -> Column:
    """Whether a file's bytes are long enough and start with the magic number."""
    content = as_column(content)
    return F.coalesce(
        (F.octet_length(content) > len(magic))
        & (F.substring(content, 1, len(magic)) == F.lit(magic)),
        F.lit(False),
    )


def audit_files(
    spark: SparkSession, folder: str, listed: DataFrame, magic: bytes = ZIP_MAGIC
) -> DataFrame:
    """Flag every listed file of a folder that is not of the expected kind.

    ``listed`` has a column ``file`` with names below the folder, as in the
    registry; each distinct name gets one row. A file that does not exist or is
    empty is not valid; an absent one has no ``length``. Only the first bytes of the files are read.
    """
    found = file_heads(spark, folder, len(magic)).select(
        "file",
        "length",
        ((F.col("length") > len(magic)) & (F.col("head") == F.lit(magic))).alias("is_valid"),
    )
    return listed.select("file").distinct().join(found, "file", "left").select(
        "file", "length", F.coalesce("is_valid", F.lit(False)).alias("is_valid")
    )
