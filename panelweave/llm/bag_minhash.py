"""Near duplicates by BagMinHash signatures of shingle multisets.

Each distinct five-word shingle of a text is an element whose weight is its count. Weights
are discretised into the dyadic intervals (0, 1], (1, 2], (2, 4], ...; each interval of an
element is a Poisson process of points over time, of a rate equal to the interval's
width, and a point inside the last, partly filled interval counts if its place there,
found by halving, is below the weight. Every point falls into one of ``COMPONENTS``
components, which keeps its earliest point. Two texts agree in a component with a
probability equal to their weighted Jaccard similarity. Points are made in order of time
and only up to the time by which nearly all components have one; texts with a gap go on.

Signatures are banded; colliding texts are verified by the exact similarity of the shingle
multisets (sum of smaller counts over sum of larger, 0.8 or more, on lower-cased words)
and joined into components. Texts with the same multiset are one item, so exact copies
are never paired.

With ``BANDS`` bands of ``ROWS`` rows a pair at the threshold collides with probability
0.9995. A text of fewer than five words has one shingle of all its words; missing
texts and those without a word are classes of their own. Missing or repeated ids
are harmless: rows are told apart by their place. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm.near import SIMILAR, classes, multisets
from panelweave.llm.rows import from_files, located, texts_at, without
from panelweave.llm.text import chunks, mix, unit
from panelweave.llm.workers import releasing
from panelweave.sources.scratch import materialize

BANDS, ROWS = 32, 7
COMPONENTS = BANDS * ROWS
MASK = (1 << 64) - 1
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LEVEL, _PLACE, _SLOT = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def _processes(value, owner, weight):
    """The processes of all elements: seed, text, weight, lower end, width."""
    rows = []
    level, low, width = 0, 0, 1
    left = np.arange(len(value))
    while len(left):
        rows.append((mix(value[left] + np.uint64(level * int(_LEVEL) & MASK)), owner[left], weight[left],
                     np.full(len(left), low), np.full(len(left), width)))
        low, width, level = low + width, max(1, low + width), level + 1
        left = left[weight[left] > low]
    return tuple(np.concatenate(c) for c in zip(*rows, strict=True)) if rows else None


def _points(signature, processes, limit, m: int) -> None:
    """Add the points of all processes up to the time limit of their texts."""
    seed, owner, weight, low, width = processes
    time = np.zeros(len(seed))
    k = 0
    while len(seed):
        k += 1
        drawn = mix(seed + np.uint64(k * int(_GOLDEN) & MASK))
        time = time - np.log(unit(drawn)) / width
        go = time <= limit[owner]
        seed, owner, weight, low, width = seed[go], owner[go], weight[go], low[go], width[go]
        time, drawn = time[go], drawn[go]
        # Halving the interval until one unit is left draws that unit uniformly.
        place = low + (mix(drawn ^ _PLACE) % width.astype(np.uint64)).astype(np.int64)
        counts = place < weight
        slot = ((mix(drawn ^ _SLOT) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        at = owner[counts] * m + slot[counts].astype(np.int64)
        np.minimum.at(signature, at, time[counts])


def signatures(value, owner, weight, n: int, m: int = COMPONENTS) -> np.ndarray:
    """Times of the earliest point of every component, one row per text (inf: no element)."""
    total = np.bincount(owner, weights=weight, minlength=n)
    signature = np.full(n * m, np.inf)
    todo = np.flatnonzero(total)
    spare = 3.0
    while len(todo):
        mine = np.isin(owner, todo) if len(todo) < n else np.ones(len(owner), bool)
        limit = m * (np.log(m) + spare) / np.maximum(total, 1)
        signature.reshape(n, m)[todo] = np.inf
        own = _processes(value[mine], owner[mine], weight[mine])
        _points(signature, own, limit, m)
        todo = todo[np.isinf(signature.reshape(n, m)[todo]).any(axis=1)]
        spare = spare + 6.0
    return signature.reshape(n, m)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN), bits.shape[:2])
    for k in range(rows):
        keys = mix(keys ^ bits[:, :, k]) + _GOLDEN
    return keys.view(np.int64)


def _digests(value, owner, weight, n: int) -> np.ndarray:
    """128 bits of each multiset, as two sums over its elements."""
    out = np.zeros((n, 2), np.uint64)
    if len(value):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for k, salt in enumerate((_LEVEL, _PLACE)):
            each = mix(mix(value ^ salt) + weight.astype(np.uint64) * _GOLDEN)
            out[owner[first], k] = np.add.reduceat(each, first)
    return out


_SIGNED = "doc_id long, file string, place long, digest binary, weight long, keys array<long>"


def _sign(bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                value, owner, weight = multisets(chunk)
                total = np.bincount(owner, weights=weight, minlength=chunk.n).astype(np.int64)
                keys = band_keys(signatures(value, owner, weight, chunk.n, bands * rows), bands, rows)
                digest = _digests(value, owner, weight, chunk.n)
                some = total > 0
                cuts = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(chunk.first, chunk.n) for c in ("doc_id", "file", "place")],
                        pa.array([d.tobytes() if s else None for d, s in zip(digest, some, strict=True)], pa.binary()),
                        pa.array(total),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys[some].ravel())),
                    ],
                    names=["doc_id", "file", "place", "digest", "weight", "keys"],
                )

    return sign


def near_duplicates(
    docs: DataFrame, bands: int = BANDS, rows: int = ROWS, at_least: float = SIMILAR
) -> DataFrame:
    """``doc_id, file, place, class_id, class_size, kept`` of every row.

    ``class_id`` is the ``doc_id`` of the row of the class that stays: the smallest id,
    of equal ids the first place; a missing id counts as largest.
    """
    docs = from_files(docs)
    source = located(docs, "doc_id", "text")
    signed = materialize(source.mapInArrow(releasing(_sign(bands, rows)), _SIGNED), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "place")
    # One item for each different multiset.
    items = materialize(
        signed.where("digest IS NOT NULL").groupBy("digest")
        .agg(F.min(F.struct("file", "place")).alias("at"), F.first("weight").alias("weight"),
             F.first("keys").alias("keys"))
        .select(F.monotonically_increasing_id().alias("item"), "digest", "at.file", "at.place",
                "weight", "keys"),
        "items",
    )

    def texts(wanted: DataFrame) -> DataFrame:
        places = items.select("item", "file", "place").join(wanted, "item", "left_semi")
        return texts_at(source, places).select("item", "text")

    labels = classes(items.select("item", "weight", "keys"), texts, True, at_least)
    named = items.select("digest", "item")
    if labels is not None:
        named = named.join(labels, "item", "left")
    label = F.coalesce("label", "item") if labels is not None else F.col("item")
    rowed = materialize(
        signed.select("doc_id", "file", "place", "digest")
        .join(named.select("digest", label.alias("label")), "digest", "left"),
        "labelled",
    )
    grouped = rowed.where("label IS NOT NULL")
    firsts = grouped.groupBy("label").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("class_size"))
    firsts = materialize(firsts, "classes")
    placed = grouped.join(firsts, "label").select(
        "doc_id", "file", "place", F.col("first.doc_id").alias("class_id"), "class_size",
        F.expr("file = first.file AND place = first.place").alias("kept"),
    )
    alone = rowed.where("label IS NULL").select(
        "doc_id", "file", "place", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"),
    )
    return placed.unionByName(alone)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns."""
    docs = from_files(docs)
    return without(docs, near_duplicates(docs).where("NOT kept"))
