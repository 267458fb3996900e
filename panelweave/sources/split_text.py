"""CSV files with line breaks inside quotes, read by as many tasks as they have splits.

Spark splits a CSV file only if no record may hold a line break. Here the split text scan
reads lines, and records are put together afterwards:

1. One pass counts the quotes of every split. Their parity, summed up over the splits of a
   file, tells whether a split begins inside quotes.
2. A line break outside quotes ends a record. The lines of a record within a split are joined
   where they are read; what is left at the end of a split that stops inside quotes, and
   the beginning of the next one, are joined by file in a small shuffle.
3. ``from_csv`` parses the records.

Without a line that has an odd number of quotes nothing needs joining, and Spark parses the
lines without Python.

Quotes must be used as CSV writers do: around whole fields, doubled inside. A file whose
quotes do not pair up is refused. What comes to the driver is one row per split, as many as
Spark plans tasks for.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelweave.schema import quoted
from panelweave.workers import ship

#: Place of a row: its file, the offset of its split and, within that, what grows from row to row.
PLACE = ["__file", "__start", "__line"]
RECORD = "__file string, __start long, __line long, kind string, record string"
_SCHEMA = pa.schema(
    [("__file", pa.string()), ("__start", pa.int64()), ("__line", pa.int64()), ("kind", pa.string()),
     ("record", pa.string())]
)
WHOLE, OPENS, INNER, ENDS = "whole", "opens", "inner", "ends"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their split; carriage returns stay, so that quoted ones are not lost."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


@dataclass
class Splits:
    """All splits of a scan in file order, looked up by a hash of file and offset."""

    hashed: np.ndarray
    files: list[str]
    starts: list[int]
    inside: np.ndarray
    broken: bool
    open_files: list[str]

    def __post_init__(self):
        self.order = np.argsort(self.hashed)

    def find(self, hashed: int) -> tuple[str, int, bool, bool]:
        """File and offset of a split, whether it begins the file, and whether inside quotes."""
        k = int(self.order[np.searchsorted(self.hashed, hashed, sorter=self.order)])
        first = not k or self.files[k - 1] != self.files[k]
        return self.files[k], self.starts[k], first, bool(self.inside[k])

    @property
    def crossed(self) -> np.ndarray:
        """Hashes of the splits that begin or end inside quotes."""
        return self.hashed[self.inside | np.r_[self.inside[1:], False]]


def _hashed():
    return F.xxhash64("path", "start")


def survey(lines: DataFrame) -> Splits:
    """Count the quotes of every split."""
    quotes = F.length("line") - F.length(F.translate("line", '"', ""))
    rows = (
        lines.select("path", "start", quotes.alias("quotes"))
        .groupBy("path", "start")
        .agg(F.sum("quotes").alias("quotes"), F.max(F.col("quotes") % 2).alias("odd"))
        .select(_hashed().alias("hashed"), "path", "start", "quotes", "odd")
        .collect()
    )
    rows.sort(key=lambda r: (r.path, r.start))
    inside, open_files = [], []
    for k, r in enumerate(rows):
        first = not k or rows[k - 1].path != r.path
        inside.append(False if first else bool(inside[-1] ^ (rows[k - 1].quotes % 2)))
        last = k + 1 == len(rows) or rows[k + 1].path != r.path
        if last and inside[-1] ^ (r.quotes % 2):
            open_files.append(r.path)
    hashed = np.array([r.hashed for r in rows], np.int64)
    if len(np.unique(hashed)) < len(hashed):
        raise RuntimeError("two splits share a hash: read the files in two calls")
    return Splits(
        hashed, [r.path for r in rows], [r.start for r in rows], np.array(inside, bool),
        any(r.odd for r in rows), open_files,
    )


class _Split:
    """The records of one split, batch by batch."""

    def __init__(self, file: str, start: int, first: bool, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.header = first  # the first split of a file begins with its header
        self.line, self.parity = 0, int(inside)
        self.held: list[str] = []
        self.held_from = 0

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quotes = pc.count_substring(lines, pattern='"').to_numpy(zero_copy_only=False)
        parity = (self.parity + np.cumsum(quotes)) & 1
        ends = np.flatnonzero(parity == 0)
        first = 0
        if len(ends) and (self.held or self.inside):
            # The first record began in an earlier batch or split.
            text = "\n".join([*self.held, *lines.slice(0, int(ends[0]) + 1).to_pylist()])
            yield from self.put([self.held_from if self.held else self.line], [text], ENDS if self.inside else WHOLE)
            self.held, self.inside, first, ends = [], False, int(ends[0]) + 1, ends[1:]
        if len(ends):
            starts = np.r_[first, ends[:-1] + 1]
            if len(ends) == ends[-1] + 1 - first:
                records = lines.slice(first, len(ends))
            else:
                cuts = pa.array(np.r_[starts, ends[-1] + 1].astype(np.int32))
                records = pc.binary_join(pa.ListArray.from_arrays(cuts, lines), "\n")
            yield from self.put(starts + self.line, records, WHOLE)
            first = int(ends[-1]) + 1
        rest = lines.slice(first).to_pylist()
        if rest:
            if not self.held:
                self.held_from = self.line + first
            self.held += rest
        self.line += len(lines)
        self.parity = int(parity[-1]) if len(parity) else self.parity

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self.put([self.held_from], ["\n".join(self.held)], INNER if self.inside else OPENS)

    def put(self, line, records, kind: str) -> Iterator[pa.RecordBatch]:
        line, records = pa.array(line, pa.int64()), pa.array(records, pa.string())
        if self.header and kind in (WHOLE, OPENS):
            # Empty lines may come before the header.
            filled = np.flatnonzero(~np.isin(records.slice(0, 64).to_numpy(zero_copy_only=False), ["", "\r"]))
            skip = int(filled[0]) + 1 if len(filled) else min(64, len(records))
            self.header = not len(filled)
            if self.header and len(records) > skip:
                yield from self.put(line.slice(skip), records.slice(skip), kind)
                return
            if kind == OPENS and not self.header:
                raise ValueError("the header of a CSV file is longer than a split")
            line, records = line.slice(skip), records.slice(skip)
        n = len(records)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.file] * n, pa.string()), pa.array(np.full(n, self.start)), line,
                 pa.array([kind] * n, pa.string()), records],
                schema=_SCHEMA,
            )


def _join_lines(splits: Splits):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, split = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            hashed = batch.column("split").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(hashed)) + 1, len(hashed)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if hashed[a] != own:
                    if split:
                        yield from split.close()
                    own, split = hashed[a], _Split(*splits.find(hashed[a]))
                yield from split.add(batch.column("line").slice(a, b - a))
        if split:
            yield from split.close()

    return join


def records(lines: DataFrame, splits: Splits) -> DataFrame:
    """Text of every record but the headers, with its place."""
    # A carriage return before the break belongs to it.
    record = F.expr("if(endswith(record, '\\r'), left(record, length(record) - 1), record)").alias("record")
    marked = lines.select(_hashed().alias("split"), "line")
    joined = marked.mapInArrow(_join_lines(splits), RECORD)
    found = joined.where(F.col("kind") == WHOLE).select(*PLACE, "record")
    crossed = splits.crossed
    if len(crossed):
        spark = lines.sparkSession
        wanted = spark.createDataFrame(pa.table({"split": pa.array(crossed)}))
        parts = marked.join(F.broadcast(wanted), "split").mapInArrow(_join_lines(splits), RECORD)
        parts = parts.where(F.col("kind") != WHOLE)
        order = Window.partitionBy("__file").orderBy("__start", "__line")
        chain = F.count_if(F.col("kind") == OPENS).over(order)
        pieces = parts.withColumn("chain", chain).groupBy("__file", "chain").agg(
            F.sort_array(F.collect_list(F.struct("__start", "__line", "record"))).alias("pieces")
        )
        whole = F.array_join(F.transform("pieces", lambda p: p["record"]), "\n")
        first = [F.col("pieces")[0][c].alias(c) for c in PLACE[1:]]
        found = found.unionByName(pieces.select("__file", *first, whole.alias("record")))
    return found.select(*PLACE, record).where("record <> ''")


def read_split_csv(spark: SparkSession, path: str, options: Mapping, places: bool = False) -> DataFrame:
    """The rows of CSV files as text columns named by the header of the first file.

    ``options`` are those of a reader that takes line breaks in quotes. With ``places`` the
    columns ``PLACE`` tell the order of the rows in the files.
    """
    reader = spark.read.options(**options)
    names = reader.csv(path).columns
    lines = split_lines(spark, path)
    splits = survey(lines)
    if splits.open_files:
        raise ValueError(f"quotes do not pair up in {', '.join(splits.open_files[:5])}")
    if not splits.broken:
        found = reader.option("multiLine", False).csv(path)
        if not places:
            return found
        place = ["_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()]
        place = [(F.col(p) if isinstance(p, str) else p).alias(c) for p, c in zip(place, PLACE, strict=True)]
        return found.select(*place, *[F.col(quoted(n)) for n in names])
    ship(spark)
    kinds = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    schema = ", ".join(f"{quoted(n)} string" for n in names)
    parsed = records(lines, splits).select(*PLACE, F.from_csv("record", schema, kinds).alias("row"))
    columns = [F.col("row").getField(n).alias(n) for n in names]
    return parsed.select(*(PLACE if places else []), *columns)


def larger_than_a_split(spark: SparkSession, path: str) -> bool:
    """Whether Spark would split one of the files if records could not hold line breaks."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    plain = ~F.lower("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)
    return not listing.where(plain & (F.col("length") > most)).isEmpty()
