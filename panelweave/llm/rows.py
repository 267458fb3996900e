"""Rows told apart by where they lie, so that ids may be missing or repeated."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from panelweave.llm.url_filters import bloom_filter, possible_hits
from panelweave.schema import quoted
from panelweave.sources.scratch import materialize

def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column has."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def _place(docs: DataFrame) -> tuple[Column, Column]:
    """File and row number of every row, also where a column is named like Spark's own."""
    metadata = docs.metadataColumn("_metadata")
    return metadata["file_path"], metadata["row_index"]


def from_files(docs: DataFrame) -> DataFrame:
    """The frame itself if it comes straight from Parquet files, else a written copy."""
    try:
        docs.select(*_place(docs)).schema
    except AnalysisException:  # the frame has no file metadata
        return materialize(docs, "rows")
    return docs


def with_place(docs: DataFrame, file: str, place: str) -> DataFrame:
    """All columns and the row's place, under names that ``free_names`` found."""
    return docs.withColumns(dict(zip((file, place), _place(docs), strict=True)))


def located(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, ``file`` and ``place`` of every row."""
    docs = from_files(docs)
    file, place = _place(docs)
    return docs.select(*columns, file.alias("file"), place.alias("place"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """All columns of the rows of ``docs``, which lie in files, but those at ``file, place`` of ``gone``."""
    file, place = free_names(docs, "row_file", "row_place")
    gone = gone.select(F.col("file").alias(file), F.col("place").alias(place))
    kept = with_place(docs, file, place).join(gone, [file, place], "left_anti")
    return kept.select(*[F.col(quoted(c)) for c in docs.columns])


def texts_at(source: DataFrame, places: DataFrame) -> DataFrame:
    """``source`` joined to the rows of ``places`` by ``file`` and ``place``.

    A Bloom filter of the places, of bounded size, keeps most other texts out of the
    shuffle.
    """
    at = F.concat_ws("#", "file", "place")
    bloom = bloom_filter(places.select(at.alias("key")))
    likely = possible_hits(source.withColumn("key", at), bloom).drop("key")
    return likely.join(places, ["file", "place"])
