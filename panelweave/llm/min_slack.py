"""Pack documents whole into sequences of a fixed length by minimum bin slack.

Only documents longer than a sequence are cut: into full sequences after a first piece that
holds the remainder. How the pieces fill sequences depends on their lengths alone, and there
are at most ``capacity`` different ones; so the plan is made from the number of pieces of
every length, a table whose size does not depend on the input. Each sequence begins with the
longest piece left, which would fit worst later on. For its rest a bitset holds the sums that the
available lengths can form, long ones first, until the whole rest is among them; the fullest
combination is read back from the bitsets and removed. A combination is used as often as
its lengths last, so the plan has at most some thousand entries.

A piece then finds its place by its rank among the pieces of its length: its number in its task
plus the counts of the tasks before. Nothing but counts is gathered for that.

Missing text is empty: such a document is its end id alone. Missing or repeated ``doc_id``
are carried along; columns other than ``doc_id`` and ``text`` are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from panelweave.llm.byte_pairs import byte_encoder
from panelweave.sources.scratch import materialize

END_ID = 0
#: Rows of one Arrow batch, fewer where ids are kept.
ROWS = 2000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task long, number long"
_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("task", pa.int64()), ("number", pa.int64())]
)


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``total`` ids."""
    head = total % capacity
    pieces = [(0, head)] if head else []
    return pieces + [(s, capacity) for s in range(head, total, capacity)]


def fullest(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int]]:
    """Lengths and their numbers in the fullest combination that fits.

    Of equally full ones the one that needs no shorter lengths than necessary.
    """
    every = (1 << (capacity + 1)) - 1
    reach, stages = 1, []
    for length in sorted(counts, reverse=True):
        stages.append((length, reach))
        left, share = min(counts[length], capacity // length), 1
        while left > 0:
            share = min(share, left)
            reach |= (reach << (share * length)) & every
            left, share = left - share, 2 * share
        if reach >> capacity:
            break
    goal, taken = reach.bit_length() - 1, []
    for length, before in reversed(stages):
        times = 0
        while not before >> goal & 1:
            goal, times = goal - length, times + 1
        if times:
            taken.append((length, times))
    return taken


def sequence_of(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int]]:
    """Lengths and their numbers in the fullest sequence that holds the longest one."""
    longest = max(counts)
    room = capacity - longest
    rest = {length: n - (length == longest) for length, n in counts.items() if length <= room}
    taken = dict(fullest({length: n for length, n in rest.items() if n}, room))
    return [(longest, taken.pop(longest, 0) + 1), *taken.items()]


def plan(counts: Mapping[int, int], capacity: int) -> np.ndarray:
    """Rows ``length, first rank, times in a sequence, first sequence, first offset``."""
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        combination = sequence_of(left, capacity)
        repeats = min(left[length] // times for length, times in combination)
        offset = 0
        for length, times in combination:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += repeats * times
            left[length] -= repeats * times
            offset += length * times
            if not left[length]:
                del left[length]
        sequence += repeats
    return np.array(rows, np.int64).reshape(-1, 5)


def _pieces(path: str, capacity: int, ids: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = byte_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECE, strict=True)], schema=_PIECE
            )

        for given in batches:
            for doc_id, text in zip(given.column(0).to_pylist(), given.column(1), strict=True):
                own = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                for number, (start, length) in enumerate(cuts(len(own), capacity)):
                    part = own[start : start + length].tobytes()
                    rows.append(
                        (doc_id, number, start, length, zlib.crc32(part), part if ids else None, task, seen[length])
                    )
                    seen[length] += 1
                if len(rows) >= ROWS:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()

    return emit


def _place(entries: np.ndarray, names: list[str]):
    """Sequence and offset of pieces from the plan's entry that holds their rank."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((entries[:, 1], entries[:, 0]))
        length, first, times, sequence, offset = entries[order].T
        # Ranks are below 2^48, lengths below 2^15.
        keys = (length << 48) + first
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (size << 48) + rank, side="right") - 1
            turn, slot = np.divmod(rank - first[at], times[at])
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence[at] + turn), pa.array(offset[at] + slot * size)],
                names=[*names, "sequence_id", "offset"],
            )

    return place


def pack_whole(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of all pieces.

    ``ids_crc32`` is over the piece's ids as little-endian unsigned 32-bit integers; with
    ``ids`` a column of that name holds them.
    """
    if not 0 < capacity < 1 << 15:
        raise ValueError("a sequence holds between 1 and 32767 ids")
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer_path, capacity, ids), PIECE)
    pieces = materialize(pieces, "pieces")
    counts = materialize(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # At most one row per length comes to the driver.
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(starts, ["length", "task"]).withColumn("rank", F.col("first") + F.col("number"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if ids else [])
    schema = ", ".join(c for c in PIECE.split(", ") if c.split()[0] in names)
    return ranked.select(*names, "rank").mapInArrow(
        _place(plan(totals, capacity), names), f"{schema}, sequence_id long, offset long"
    )
