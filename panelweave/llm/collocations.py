"""Phrases that occur together, counted through a weighted de Bruijn graph per language.

Nodes are runs of three words, edges the runs of four words that lead from one node to the
next, weighted by how often they occur. Only edges are counted in texts. Where a piece of text ends, its
last words begin no edge; they are counted as the piece's end. All shorter counts follow:
a node occurs as often as its outgoing edges plus the pieces that end with it, two
words as often as the nodes that begin with them plus the pieces that end with them, and so on.

Texts are cut at signs into pieces and pieces into words. Two neighbouring words that occur
fewer than ``least`` times together cannot both lie in a candidate, so pieces are cut there as well:
neighbours are counted by hash, the frequent ones enter a Bloom filter of bounded size, and
what it lets through by mistake, or because too many are frequent for it, only costs time.
Each task builds the graphs of its blocks of text with numpy and compacts them: a chain of nodes
with one way in and one way out, where no piece begins or ends, is one path whose words are sent
once with one weight, however long it is and however often it is repeated. Paths are taken apart into
edges again where the blocks' graphs are added up.

Missing texts are empty, a missing language is ``und``. Repeated rows count each time. Other
columns than ``text`` and ``lang`` are not read. An empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.llm.text import CHUNK_BYTES, Chunk, chunks, mix, span_hashes, span_heads
from panelweave.sources.scratch import materialize

LONGEST, LEAST, CLOSED, SCALE, TOP = 4, 30, 80, 2_000_000, 2000
UNKNOWN = "und"
#: Text of one graph; a worker needs about 40 times as much memory.
BLOCK_BYTES = 6 << 20
#: Bits of the Bloom filter of frequent neighbours: 16 for each, at most 2^28 (32 MB).
BITS_EACH, MOST_BITS, PART_BITS = 16, 28, 18
PROBES = 2

SIGN = np.zeros(256, dtype=bool)
SIGN[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
BETWEEN = SIGN.copy()
BETWEEN[[0x20, 0x09]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of every word with its next one."""
    return mix(words[:-1] * _STEP + (words[1:] ^ (words[1:] >> np.uint64(29))))


class _Words:
    """Words of one chunk with their pieces, and hashes that tell languages apart."""

    def __init__(self, chunk: Chunk, langs: np.ndarray):
        inside = ~BETWEEN[chunk.data]
        cut = np.zeros(len(inside) + 1, dtype=bool)
        cut[chunk.offsets] = True
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1] | cut[1:-1]
        ends[:-1] &= ~inside[1:] | cut[1:-1]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(chunk.offsets, self.start, side="right") - 1
        signs = np.concatenate([[0], np.cumsum(SIGN[chunk.data])])
        place = np.stack([signs[self.start], self.text])
        #: Whether a word and the next one lie in one piece.
        self.joined = (place[:, 1:] == place[:, :-1]).all(axis=0)
        self.lang = langs[self.text]
        hashed = span_hashes(chunk, self.start, self.end)
        self.hashed = mix(hashed ^ ((self.lang.astype(np.uint64) + np.uint64(1)) * _STEP))
        self.head = span_heads(chunk, self.start, self.end)


def _language_numbers(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.fill_null(UNKNOWN).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _stable(names: list[str]) -> np.ndarray:
    """Numbers of languages that are the same in every task."""
    import hashlib

    digests = [hashlib.sha256(n.encode()).digest()[:8] for n in names]
    return np.frombuffer(b"".join(digests), "<u8") if digests else np.empty(0, np.uint64)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, _Words, dict[int, str]]]:
    for batch in batches:
        index, names = _language_numbers(batch.column("lang"))
        numbers = _stable(names)
        langs = numbers[index] if len(names) else np.zeros(len(index), np.uint64)
        known = dict(zip(numbers.tolist(), names, strict=True))
        for chunk in chunks(batch.column("text"), lower=True, size=CHUNK_BYTES):
            yield chunk, _Words(chunk, langs[chunk.first : chunk.first + chunk.n]), known


def _neighbours(size: int):
    """Hashes of neighbouring words with their number in a block."""

    def emit(batches):
        held, read = [], 0

        def closed():
            value, count = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(value), 200_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[a : a + 200_000].view(np.int64)), pa.array(count[a : a + 200_000])],
                    names=["pair", "n"],
                )

        for chunk, words, _ in _read(batches):
            held.append(pair_hashes(words.hashed)[words.joined])
            read += len(chunk.data)
            if read >= size:
                yield from closed()
                held, read = [], 0
        if held:
            yield from closed()

    return emit


def _bit_places(pair: np.ndarray, bits: int) -> list[np.ndarray]:
    scattered = mix(pair.view(np.uint64) + _STEP)
    return [(scattered >> np.uint64(32 * k)) & np.uint64((1 << bits) - 1) for k in range(PROBES)]


def _filter_rows(bits: int):
    def emit(batches):
        for batch in batches:
            place = np.concatenate(_bit_places(batch.column(0).to_numpy(), bits))
            part, at = place >> np.uint64(PART_BITS), place & np.uint64((1 << PART_BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(at.astype(np.int32))], names=["part", "at"]
            )

    return emit


def _filter_part(table: pa.Table) -> pa.Table:
    bits = np.zeros(1 << PART_BITS, np.uint8)
    bits[table.column("at").to_numpy()] = 1
    data = np.packbits(bits, bitorder="little").tobytes()
    return pa.table([table.column("part").slice(0, 1), pa.array([data], pa.binary())], names=["part", "bits"])


class Likely:
    """A Bloom filter of hashes, of a size that its parameters bound."""

    def __init__(self, frequent: DataFrame):
        n = frequent.count()
        self.bits = min(max((n * BITS_EACH).bit_length(), PART_BITS), MOST_BITS)
        places = frequent.mapInArrow(_filter_rows(self.bits), "part int, at int").distinct()
        parts = places.groupBy("part").applyInArrow(_filter_part, "part int, bits binary")
        self.data = np.zeros(1 << (self.bits - 3), np.uint8)
        size = 1 << (PART_BITS - 3)
        for r in parts.toLocalIterator():
            self.data[r.part * size : (r.part + 1) * size] = np.frombuffer(r.bits, np.uint8)
        self.shared = frequent.sparkSession.sparkContext.broadcast(self.data)

    def lookup(self):
        """What tells in a task which hashes may be frequent."""
        shared, bits = self.shared, self.bits

        def has(pair: np.ndarray) -> np.ndarray:
            found = np.ones(len(pair), bool)
            for place in _bit_places(pair, bits):
                found &= (shared.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
            return found

        return has


def _grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of every distinct row of the columns, and a row of each number."""
    key = columns[0].astype(np.int64)
    first = None
    for c in columns[1:]:
        _, first, key = np.unique((key << 32) | c, return_index=True, return_inverse=True)
    if first is None:
        _, first, key = np.unique(key, return_index=True, return_inverse=True)
    return key, first


class Graph:
    """The de Bruijn graph of runs of word numbers; ``joined`` tells which neighbours hang together."""

    def __init__(self, words: np.ndarray, joined: np.ndarray):
        self.words = words
        n = len(words)
        link = np.r_[joined[: max(n - 1, 0)], False]  # word i hangs together with word i + 1
        pair, three = link[:-1], (link[:-2] & link[1:-1])
        self.at2 = np.flatnonzero(pair)
        key2 = np.full(n, -1, np.int64)
        if len(self.at2):
            key2[self.at2], _ = _grouped(words[self.at2], words[self.at2 + 1])
        self.at3 = np.flatnonzero(three)
        self.node = np.full(n, -1, np.int64)
        self.n_nodes = 0
        if len(self.at3):
            self.node[self.at3], first = _grouped(key2[self.at3], words[self.at3 + 2])
            self.n_nodes = len(first)
        self.begins = np.r_[True, ~link[:-1]][:n]
        self.link = link

    def ends(self) -> Iterator[Runs]:
        """Distinct last one, two and three words of runs, with their numbers."""
        last = np.flatnonzero(~self.link)
        for size in (1, 2, 3):
            own = last[last >= size - 1]
            for k in range(1, size):
                own = own[self.link[own - k]]
            columns = [self.words[own - k] for k in range(size - 1, -1, -1)]
            if len(own):
                key, first = _grouped(*columns)
                words = np.stack([c[first] for c in columns], axis=1).ravel()
                yield Runs(words, np.arange(len(first) + 1) * size, np.bincount(key))

    def paths(self) -> Runs:
        """Words of every compacted path, and its weight."""
        at = np.flatnonzero(self.link[:-3] & self.link[1:-2] & self.link[2:-1]) if len(self.words) > 3 else self.at3[:0]
        if not len(at):
            return Runs(self.words[:0], np.zeros(1, np.int64), np.zeros(0, np.int64))
        key, first = _grouped(self.node[at], self.words[at + 3])
        weight = np.bincount(key)
        begin = at[first]
        source, target, last = self.node[begin], self.node[begin + 1], self.words[begin + 3]
        edges = len(weight)
        # Runs that begin or end at a node.
        broken = np.zeros(self.n_nodes, bool)
        broken[self.node[self.at3[self.begins[self.at3]]]] = True
        broken[self.node[self.at3[~self.link[self.at3 + 2]]]] = True
        unary = (np.bincount(source, minlength=self.n_nodes) == 1) & (
            np.bincount(target, minlength=self.n_nodes) == 1
        ) & ~broken
        into = np.full(self.n_nodes, -1, np.int64)
        into[target] = np.arange(edges)
        before = np.where(unary[source], into[source], -1)
        # First edge of every edge's path and its place in it, by doubling the steps back.
        head = np.where(before < 0, np.arange(edges), before)
        place = (before >= 0).astype(np.int64)
        for _ in range(edges.bit_length() + 1):
            if (before[head] < 0).all():
                break
            place, head = place + place[head], head[head]
        ring = before[head] >= 0  # a circle has no first edge: each edge by itself
        head[ring], place[ring] = np.flatnonzero(ring), 0
        # A path is the three words of its first node, then the last word of every edge.
        order = np.lexsort((place, head))
        firsts = np.flatnonzero(place[order] == 0)
        size = np.diff(np.r_[firsts, edges])
        offsets = np.r_[0, np.cumsum(size + 3)]
        words = np.empty(offsets[-1], np.int64)
        for k in range(3):
            words[offsets[:-1] + k] = self.words[begin[order[firsts]] + k]
        words[np.repeat(offsets[:-1] + 3, size) + place[order]] = last[order]
        return Runs(words, offsets, weight[order[firsts]])


@dataclass
class Runs:
    """Runs of word numbers, one after the other, with their weights."""

    words: np.ndarray
    offsets: np.ndarray
    weight: np.ndarray


PATHS = "lang string, words array<string>, n long, whole boolean"


def _block_paths(size: int, has):
    """Paths and run ends of the graph of each block, and its number of words per language.

    ``whole`` is true for paths, false for run ends and missing for the number of words.
    """

    def emit(batches):
        held, known, read = [], {}, 0

        def closed():
            hashed, head, length, lang, joined = (np.concatenate([h[k] for h in held]) for k in range(5))
            data = np.concatenate([h[5] for h in held])
            shift = np.cumsum([0, *(len(h[5]) for h in held[:-1])])
            start = np.concatenate([h[6] + s for h, s in zip(held, shift, strict=True)])
            held.clear()
            seed = np.uint64(0)
            while True:
                _, first, number = np.unique(hashed, return_index=True, return_inverse=True)
                same = (head[first][number] == head) & (length[first][number] == length)
                if same.all():
                    break
                # Two words share a hash: tell them apart by what else is known of them.
                seed += np.uint64(1)
                hashed = mix(hashed ^ mix(head + seed) ^ length.astype(np.uint64))
            spelt = _strings(data, start[first], length[first])
            of = lang[first]
            del data, start, head, length, hashed
            graph = Graph(number, joined)
            for runs, whole in [(graph.paths(), True), *((r, False) for r in graph.ends())]:
                for a in range(0, len(runs.weight), 20_000):
                    cuts = runs.offsets[a : a + 20_001]
                    ids = runs.words[cuts[0] : cuts[-1]]
                    found, index = np.unique(of[runs.words[cuts[:-1]]], return_inverse=True)
                    named = pa.array([known[int(v)] for v in found], pa.string()).take(pa.array(index))
                    n = len(cuts) - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            named,
                            pa.ListArray.from_arrays(pa.array((cuts - cuts[0]).astype(np.int32)), spelt.take(pa.array(ids))),
                            pa.array(runs.weight[a : a + n].astype(np.int64)),
                            pa.array(np.full(n, whole)),
                        ],
                        names=["lang", "words", "n", "whole"],
                    )
            values, counts = np.unique(lang, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([known[int(v)] for v in values], pa.string()),
                    pa.array([None] * len(values), pa.list_(pa.string())),
                    pa.array(counts, pa.int64()),
                    pa.array([None] * len(values), pa.bool_()),
                ],
                names=["lang", "words", "n", "whole"],
            )

        for chunk, words, names in _read(batches):
            known.update(names)
            if len(words.start):
                joined = words.joined.copy()
                joined[joined] = has(pair_hashes(words.hashed)[joined])
                held.append(
                    (words.hashed, words.head, words.end - words.start, words.lang, np.r_[joined, False],
                     chunk.data, words.start)
                )
            read += len(chunk.data)
            if read >= size:
                if held:
                    yield from closed()
                held, read = [], 0
        if held:
            yield from closed()

    return emit


def _strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The texts of spans of UTF-8 bytes."""
    offsets = np.r_[0, np.cumsum(length)]
    body = data[np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])]
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())]
    return pa.Array.from_buffers(pa.string(), len(length), buffers)


def _first(n: int) -> list[str]:
    return [f"w{k}" for k in range(1, n + 1)]


def graph_counts(paths: DataFrame) -> list[DataFrame]:
    """``lang, w1.., n`` of runs of four, three, two and one words: edges, then what flows through nodes."""
    last = LONGEST - 1
    parts = F.expr(f"explode(transform(sequence(1, size(words) - {last}), i -> slice(words, i, {LONGEST})))")
    edges = paths.where("whole").select("lang", parts.alias("words"), "n")
    edges = edges.select("lang", *[F.col("words")[k].alias(w) for k, w in enumerate(_first(LONGEST))], "n")
    edges = materialize(edges.groupBy("lang", *_first(LONGEST)).agg(F.sum("n").alias("n")), "edges")
    ends = paths.where("NOT whole")
    found, flow = [edges], edges
    for size in range(last, 0, -1):
        words = _first(size)
        stops = ends.where(F.size("words") == size).select(
            "lang", *[F.col("words")[k].alias(w) for k, w in enumerate(words)], "n"
        )
        flow = flow.select("lang", *words, "n").unionByName(stops).groupBy("lang", *words)
        flow = materialize(flow.agg(F.sum("n").alias("n")), f"flow-{size}")
        found.append(flow)
    return found


def _phrase(size: int) -> Column:
    return F.concat_ws(" ", *_first(size))


def collocations(
    docs: DataFrame, least: int = LEAST, closed: int = CLOSED, top: int = TOP, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut with the lowest score, ``n``
    all words of the language. A phrase inside a longer one that holds at least ``closed``
    percent of its occurrences is left out.
    """
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    pairs = rows.mapInArrow(_neighbours(block_bytes), "pair long, n long")
    # Dealt by hash before they are added up: blocks have few pairs in common.
    pairs = pairs.repartition("pair").groupBy("pair").agg(F.sum("n").alias("n"))
    likely = Likely(materialize(pairs.where(F.col("n") >= least).select("pair"), "frequent-pairs"))
    paths = materialize(rows.mapInArrow(_block_paths(block_bytes, likely.lookup()), PATHS), "paths")

    counts = graph_counts(paths)
    phrases = [
        c.where(F.col("n") >= least).select(
            "lang", F.lit(size).alias("size"), _phrase(size).alias("phrase"), F.col("n").alias("a"),
            F.array(*_first(size)).alias("words"),
        )
        for size, c in zip(range(LONGEST, 0, -1), counts, strict=True)
    ]
    grams = phrases[0]
    for p in phrases[1:]:
        grams = grams.unionByName(p)
    grams = materialize(grams, "grams")
    sizes = grams.select("lang", "phrase", "a")
    candidates = grams.where("size > 1")

    cut = candidates.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("front"),
        F.expr("array_join(slice(words, k + 1, size(words)), ' ')").alias("back"),
    )
    cut = cut.join(sizes.select("lang", F.col("phrase").alias("front"), F.col("a").alias("l")), ["lang", "front"])
    cut = cut.join(sizes.select("lang", F.col("phrase").alias("back"), F.col("a").alias("r")), ["lang", "back"])
    # Products may pass 64 bits.
    score = F.expr(f"cast(cast(a AS decimal(20, 0)) * {SCALE} AS decimal(38, 0)) div cast(l + r AS decimal(20, 0))")
    lowest = cut.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    )

    inner = candidates.where("size > 2").select(
        "lang", "a", "words", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("held")
    )
    inner = inner.select(
        "lang", "a", "words", "held", F.explode(F.expr("sequence(1, size - held + 1)")).alias("first")
    ).select("lang", F.expr("array_join(slice(words, first, held), ' ')").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    open_ones = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("longer") * 100 < F.col("a") * closed, F.lit(True))
    )

    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = open_ones.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    words = paths.where("whole IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(words, "lang").select(
        "lang", "rank", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"),
    )
