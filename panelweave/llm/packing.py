"""Pack documents into sequences of a fixed length with bounded-space best fit.

Every task keeps at most ``open_windows`` partly filled windows. The rest of a document
(what full windows leave) goes into the window with the least free space that still takes
it. When none does and all windows are open, the fullest is filled up with the first ids
of that rest, and emitted. Windows left at the end of a task travel with their ids to a
second step that merges those of ``MERGE_TASKS`` tasks; the last ids of a merge become
sequences whose lengths are powers of two, so nothing is padded.

Missing text is empty: such a document is its end id alone. Missing or repeated
``doc_id`` are carried along unchanged. Columns other than ``doc_id`` and ``text`` are
not read, so extra ones cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelweave.llm.text import Chunk, chunks, span_hashes, span_heads, word_spans
from panelweave.llm.workers import releasing, remembered
from panelweave.sources.scratch import materialize

END_ID = (1).to_bytes(4, "little")
MERGE_TASKS = 32
#: Words and signs a worker remembers, about 200 bytes each.
CACHED_PIECES = 250_000

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


# How the word tokenizer normalises and splits.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISED = ["NFC", "Replace", "Lowercase"]
# The same splitting for units of Latin-1 alone, where lower case and NFC need no context.
LATIN_LETTER, LATIN_NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTER}]+|[{LATIN_NUMBER}]|[^{LATIN_LETTER}{LATIN_NUMBER}]+"
)
LATIN_TEXT = re.compile("[\x20-\x7e\xa1-\xff]*")


def _said(step) -> dict:
    """A step of a tokenizer as its file has it, without the vocabulary beside it."""
    return {} if step is None else json.loads(step.__getstate__())


class UnitEncoder:
    """Ids of texts from ids of their blank-separated units, remembering recent units.

    Right for tokenizers that drop white space: no piece then crosses a blank. Units
    that are new are split into words and signs, of which far fewer are new.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The same model, which holds the vocabulary, without what happens to a text before.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        steps = _said(self.tokenizer.normalizer).get("normalizers", [])
        splits = _said(self.tokenizer.pre_tokenizer).get("pretokenizers", [{}])
        self.latin = (
            [x["type"] for x in steps] == NORMALISED
            and splits[0].get("pattern") == {"Regex": SPLIT}
        )
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = UnitTable()
        self.pieces: dict[str, bytes] = {}

    def _encode_pieces(self, pieces: list[str]) -> None:
        """Words and signs, each encoded by itself, many in one call."""
        for first in range(0, len(pieces), 1000):
            part = pieces[first : first + 1000]
            coded = self.words.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(coded.ids, "<u4").tobytes()
            cuts = np.searchsorted(coded.word_ids, np.arange(len(part) + 1)) * 4
            for piece, a, b in zip(part, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                self.pieces[piece] = ids[a:b]

    def _encode_units(self, units: list[bytes]) -> dict[bytes, bytes]:
        plain = self._plain(b" ".join(units).decode())
        if not plain:
            kinds: dict[bool, list[bytes]] = {True: [], False: []}
            for unit in units:
                kinds[self._plain(unit.decode())].append(unit)
            units, whole = kinds[True], kinds[False]
        found: dict[bytes, bytes] = {}
        if units:
            lower = b" ".join(units).decode().lower().split(" ")
            split = list(map(LATIN_SPLIT.findall, lower))
            have = self.pieces
            wanted = set(chain.from_iterable(split))
            fresh = [p for p in wanted if p not in have]
            if len(have) + len(fresh) > CACHED_PIECES:
                have.clear()
                fresh = list(wanted)
            self._encode_pieces(fresh)
            get = have.__getitem__
            found = {u: b"".join(map(get, parts)) for u, parts in zip(units, split, strict=True)}
        if not plain and whole:
            coded = self.tokenizer.encode_batch_fast(
                [u.decode() for u in whole], add_special_tokens=False
            )
            found.update((u, np.array(e.ids, "<u4").tobytes()) for u, e in zip(whole, coded, strict=True))
        return found

    def _plain(self, text: str) -> bool:
        """Whether units may be split here."""
        return bool(self.latin and LATIN_TEXT.fullmatch(text)) and not any(
            t in text for t in self.special
        )

    def __call__(self, chunk: Chunk) -> list[bytes]:
        """Ids of every text of a chunk, as little-endian unsigned 32-bit integers."""
        start, end, owner = word_spans(chunk)
        hashed = span_hashes(chunk, start, end) | np.uint64(1)
        head = span_heads(chunk, start, end)
        entry = self.known.find(hashed, head)
        if (entry < 0).any():
            gaps = np.flatnonzero(entry < 0)
            # Equal units have equal hash and head; each is encoded once.
            order = np.lexsort((head[gaps], hashed[gaps]))
            gaps = gaps[order]
            first = np.r_[True, (np.diff(hashed[gaps]) != 0) | (np.diff(head[gaps]) != 0)]
            new = gaps[first]
            units = [chunk.data[a:b].tobytes() for a, b in zip(start[new], end[new], strict=True)]
            coded = self._encode_units(list(set(units)))
            if self.known.full(len(new)):
                self.known = UnitTable()
                return self(chunk) if len(new) < len(np.unique(hashed)) else self._uncached(chunk)
            self.known.add(hashed[new], head[new], [coded[u] for u in units])
            entry = self.known.find(hashed, head)
        cuts, ids = self.known.gather(entry)
        last = np.searchsorted(owner, np.arange(chunk.n + 1))
        return [ids[cuts[a] : cuts[b]].tobytes() for a, b in zip(last[:-1], last[1:], strict=True)]

    def _uncached(self, chunk: Chunk) -> list[bytes]:
        """For a chunk with more distinct units than the table takes."""
        texts = [chunk.text(i).split() for i in range(chunk.n)]
        coded = self._encode_units(list({u for units in texts for u in units}))
        return [b"".join([coded[u] for u in units]) for units in texts]


class UnitTable:
    """Ids of units by two 64-bit keys, looked up for whole arrays at a time."""

    def __init__(self, slots: int = 1 << 20):
        self.mask, self.used = np.uint64(slots - 1), 0
        self.hashes, self.heads = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.begin, self.size = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        self.pool, self.filled = np.empty(1 << 20, "<u4"), 0

    def full(self, more: int) -> bool:
        return 10 * (self.used + more) > 6 * len(self.hashes)

    def find(self, hashed: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Slots of the units, -1 for unknown ones."""
        found = np.full(len(hashed), -1, np.int64)
        active, slot = np.arange(len(hashed)), hashed & self.mask
        while len(active):
            there = self.hashes[slot]
            hit = (there == hashed[active]) & (self.heads[slot] == head[active])
            found[active[hit]] = slot[hit].astype(np.int64)
            go = ~hit & (there != 0)
            active, slot = active[go], (slot[go] + np.uint64(1)) & self.mask
        return found

    def add(self, hashed: np.ndarray, head: np.ndarray, ids: list[bytes]) -> None:
        """Units that are not yet known, each once."""
        size = np.array([len(x) // 4 for x in ids], np.int64)
        value = np.frombuffer(b"".join(ids), "<u4")
        while self.filled + len(value) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.filled : self.filled + len(value)] = value
        begin = self.filled + np.cumsum(size) - size
        self.filled += len(value)
        active, slot = np.arange(len(hashed)), hashed & self.mask
        while len(active):
            # Of the units that want an empty slot one gets it; the others go on.
            free = np.flatnonzero(self.hashes[slot] == 0)
            _, pick = np.unique(slot[free], return_index=True)
            own = free[pick]
            at, unit = slot[own], active[own]
            self.hashes[at], self.heads[at] = hashed[unit], head[unit]
            self.begin[at], self.size[at] = begin[unit], size[unit]
            go = np.ones(len(active), dtype=bool)
            go[own] = False
            active, slot = active[go], (slot[go] + np.uint64(1)) & self.mask
        self.used += len(hashed)

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each unit's ids begin, and the ids of all units in a row."""
        size = self.size[slots]
        cuts = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.begin[slots] - cuts[:-1], size) + np.arange(cuts[-1])
        return cuts, self.pool[at]


@remembered
def unit_encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


class Windows:
    """The open windows of one task."""

    def __init__(self, capacity: int, limit: int, base: int):
        self.capacity, self.limit, self.next = capacity, limit, base
        self.open: list[list] = []  # [ids held, [(doc_id, start, ids, doc_tokens)]]

    def emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for doc_id, start, ids, total in pieces:
            length = len(ids) // 4
            yield (doc_id, start, length, zlib.crc32(ids), total, self.next, at)
            at += length
        self.next += 1

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        total, room = len(ids) // 4, self.capacity
        start = total - total % room
        for s in range(0, start, room):
            yield from self.emit([(doc_id, s, ids[4 * s : 4 * (s + room)], total)])
        while start < total:
            rest = total - start
            fitting = [w for w in self.open if room - w[0] >= rest]
            if fitting:
                window = max(fitting, key=lambda w: w[0])
            elif len(self.open) < self.limit:
                window = [0, []]
                self.open.append(window)
            else:
                window = max(self.open, key=lambda w: w[0])
            take = min(rest, room - window[0])
            window[0] += take
            window[1].append((doc_id, start, ids[4 * start : 4 * (start + take)], total))
            start += take
            if window[0] == room:
                self.open.remove(window)
                yield from self.emit(window[1])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema
    )


_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in PIECE.split(", ")])
_STAGED = _ARROW.append(pa.field("task", pa.int64())).append(pa.field("ids", pa.binary()))


def _pack_task(path: str, capacity: int, open_windows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        windows = Windows(capacity, open_windows, task << 32)
        encode = unit_encoder(path)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            # Rows leave with their chunk, so that a batch of texts never stands beside all its rows.
            for chunk in chunks(batch.column(1)):
                rows = []
                for i, coded in enumerate(encode(chunk)):
                    rows.extend(windows.add(ids[chunk.first + i], coded + END_ID))
                if rows:
                    yield _batch([(*r, None, None) for r in rows], _STAGED)
        left = [
            (doc_id, start, len(ids) // 4, None, total, None, None, task, ids)
            for _, pieces in windows.open
            for doc_id, start, ids, total in pieces
        ]
        if left:
            yield _batch(left, _STAGED)

    return pack


def _merge(capacity: int):
    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("task", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        task = table.column("task")[0].as_py() if table.num_rows else 0
        pieces = list(
            zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True)
        )
        left = sum(len(p[2]) // 4 for p in pieces)
        windows = Windows(capacity, 1, (1 << 62) + ((task // MERGE_TASKS) << 32))
        rows, current, room = [], [], 0
        for doc_id, start, ids, total in pieces:
            at = 0
            while at < len(ids) // 4:
                if not room:
                    # The largest power of two that what is left fills.
                    room = capacity if left >= capacity else 1 << (left.bit_length() - 1)
                take = min(room, len(ids) // 4 - at)
                current.append((doc_id, start + at, ids[4 * at : 4 * (at + take)], total))
                at, room, left = at + take, room - take, left - take
                if not room:
                    rows.extend(windows.emit(current))
                    current = []
        return pa.Table.from_batches([_batch(rows, _ARROW)], schema=_ARROW)

    return merge


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, open_windows: int = 16
) -> DataFrame:
    """Pieces of all documents with their place: see the module's description.

    ``ids_crc32`` is over the piece's ids as little-endian unsigned 32-bit integers.
    """
    staged = materialize(
        docs.select("doc_id", "text").mapInArrow(
            releasing(_pack_task(tokenizer_path, capacity, open_windows), unit_encoder),
            f"{PIECE}, task long, ids binary",
        ),
        "packing",
    )
    placed = staged.where(F.col("ids").isNull()).drop("task", "ids")
    merged = (
        staged.where(F.col("ids").isNotNull())
        .groupBy(F.expr(f"task div {MERGE_TASKS}").alias("tasks"))
        .applyInArrow(_merge(capacity), PIECE)
    )
    return placed.unionByName(merged)
