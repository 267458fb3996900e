"""Checks that run while a result is written, and decide whether it is published.

The writing job counts what the checks need with ``DataFrame.observe``: repeated keys, rows that
de-duplication drops, rows whose code a lookup does not know. The input is read once. A result
that fails stays in its own folder, the view still shows the version before.

Repeated keys are told by the second row of a key, so at most two rows per key and input
partition are shuffled, whatever a key holds; dropped rows are those read less those written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from panelweave.operators.audit import known_codes, lookup_coverage
from panelweave.sources.publication import point_view, version_path

_TURN, _KNOWN, _CODE = "__turn", "__known", "__code"


class GateFailed(ValueError):
    """A result was written but not published; ``path`` tells where it lies."""

    def __init__(self, message: str, path: str, counts: dict):
        super().__init__(message)
        self.path, self.counts = path, counts


@dataclass
class Gates:
    """What to check. Without ``keep_first`` a repeated key fails, with it the first row stays.

    ``lookup`` must know at least half of the distinct codes in ``code``.
    """

    key: Sequence[str] = ()
    keep_first: Sequence[Column] = ()
    code: str | None = None
    lookup: DataFrame | None = None
    least_rows: int = 0

    def observed(self, rows: DataFrame, read: Observation, written: Observation) -> DataFrame:
        """The rows to write, counted on their way."""
        names, metrics = rows.columns, [F.count(F.lit(1)).alias("n_written")]
        rows = rows.observe(read, F.count(F.lit(1)).alias("n_rows"))
        if self.key:
            order = [*self.keep_first] or [F.lit(0)]
            rows = rows.withColumn(_TURN, F.row_number().over(Window.partitionBy(*self.key).orderBy(*order)))
            # Of a key that fails the check a second row is enough to see that.
            rows = rows.where(F.col(_TURN) <= (1 if self.keep_first else 2))
            metrics.append(F.count_if(F.col(_TURN) == 2).alias("n_repeated_keys"))
        if self.code is not None:
            known = known_codes(self.lookup, self.code).select(F.col(self.code).alias(_CODE), F.lit(True).alias(_KNOWN))
            rows = rows.join(known, F.col(self.code) == F.col(_CODE), "left")
            metrics.append(F.count_if(F.col(_KNOWN).isNull()).alias("n_unmatched_rows"))
        return rows.observe(written, *metrics).select(*names)

    def failures(self, counts: dict) -> list[str]:
        found = []
        if counts["n_rows"] < self.least_rows:
            found.append(f"{counts['n_rows']} rows instead of at least {self.least_rows}")
        if counts["n_repeated_keys"]:
            found.append(f"{counts['n_repeated_keys']} keys occur more than once")
        if counts["n_unmatched"] * 2 > counts["n_codes"]:
            found.append(f"{counts['n_unmatched']} of {counts['n_codes']} {self.code} values are not in the lookup")
        return found


def write_gated(rows: DataFrame, view: str, folder: str, gates: Gates, name: str = "table") -> dict:
    """Write a version of the rows and publish it if it passes; returns what was counted.

    ``n_rows`` were read, ``n_dropped`` left out as repeats, ``n_unmatched_rows`` have an unknown
    code; only if there are any, ``n_codes`` and ``n_unmatched`` count the distinct ones in
    the written column.
    """
    spark, path = rows.sparkSession, version_path(folder, name)
    read, written = Observation("read"), Observation("written")
    gates.observed(rows, read, written).write.parquet(path)
    counts = dict.fromkeys(("n_rows", "n_written", "n_repeated_keys", "n_unmatched_rows", "n_codes", "n_unmatched"), 0)
    # Spark drops the counting from the plan of an empty result.
    if not spark.read.schema(rows.schema).parquet(path).isEmpty():
        counts |= read.get | written.get
    counts["n_dropped"] = counts["n_rows"] - counts["n_written"] if gates.keep_first else 0
    if counts["n_unmatched_rows"]:
        found = lookup_coverage(spark.read.parquet(path), gates.lookup, gates.code).first()
        counts |= {"n_codes": found["n_codes"], "n_unmatched": found["n_unmatched"]}
    failed = gates.failures(counts)
    if failed:
        raise GateFailed(f"{view} keeps its version before: {'; '.join(failed)}", path, counts)
    point_view(spark, view, path, name)
    return counts | {"path": path}
