"""Repeated passages: paragraph MinHash banding and shared windows of words.

Paragraphs are lines, and runs of several lines up to an empty one (hard-wrapped text), of at
least ``LEAST_WORDS`` words, the length of a shingle; so a line of such a run counts both by
itself and as a part of the run. Each has a MinHash of its set of
five-word shingles in ``BANDS`` bands of ``ROWS`` rows (a pair at similarity 0.8 collides
with probability 0.997); colliding paragraphs are verified by exact Jaccard similarity, 0.8 or
more, and joined into components. Equal paragraphs are one item.

A passage may also begin and end inside paragraphs. So every text is covered by windows of
``WINDOW`` words that start at anchors: places whose shingle has the smallest hash among
``SPAN`` in a row. Any run of ``SPAN + WINDOW - 1`` words, wherever it lies, holds a whole
window, and equal runs hold equal windows. Windows found in several places are laid together
to passages where they overlap and are first found in the same text, there too overlapping.
A passage is then extended word by word on both sides as far as that text agrees. Windows that
overlap in some text are one component, its label is the ``class_id`` of their passages, and
``class_size`` counts all of these. Windows that overlap where they are kept are joined there; only
such runs go through the turns of ``components``.

Of each class the occurrence with the smallest ``doc_id`` (a missing one counts as largest), place
and start stays; the others are to be removed. Texts are compared in lower case.
Missing texts and lines of fewer words have no passages. Positions are code points. Rows are told apart
by their place, so missing or repeated ids are harmless; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelweave.llm.near import SHINGLE, SIMILAR, classes, components, repeated_keys
from panelweave.llm.rows import located
from panelweave.llm.text import Chunk, chunks, mix, span_hashes, window_hashes, word_spans
from panelweave.llm.url_filters import bloom_filter, possible_hits
from panelweave.sources.scratch import discard, materialize

BANDS, ROWS = 8, 3
LEAST_WORDS = SHINGLE
SPAN, WINDOW = 21, 25
_SEEDS = mix(np.arange(1, BANDS * ROWS + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TWIN = np.uint64(0xA0761D6478BD642F)
INNER = (np.arange(256) & 0xC0) == 0x80

PARAGRAPH = (
    "doc_id long, row long, start int, length int, words int, digest long, twin long, keys array<long>, "
    "passage boolean"
)
_COLUMNS = [c.split()[0] for c in PARAGRAPH.split(", ")]


def _runs(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Order-dependent hash of runs of word hashes that begin at ``first``."""
    begin = np.repeat(first, np.diff(np.r_[first, len(value)]))
    place = (np.arange(len(value)) - begin).astype(np.uint64)
    return np.add.reduceat(mix(value + (place + np.uint64(1)) * _TWIN), first)


def lines(chunk: Chunk, start, end, owner, hashed, bands: int, rows: int):
    """Owner, first and last word, two hashes and band keys of every paragraph."""
    breaks = np.concatenate([[0], np.cumsum(chunk.data == 0x0A)])
    line = breaks[start]
    parts = []
    # Lines, then runs of lines without an empty one between.
    for least in (1, 2):
        first = np.flatnonzero(np.r_[True, (np.diff(line) >= least) | (owner[1:] != owner[:-1])])
        size = np.diff(np.r_[first, len(start)])
        keep = size >= LEAST_WORDS
        if least > 1:
            keep &= line[first] != line[first + size - 1]
        digest, twin = _runs(hashed, first)[keep], _runs(mix(hashed ^ _TWIN), first)[keep]
        parts.append((first[keep], size[keep], digest, twin))
    first, size, digest, twin = (np.concatenate(x) for x in zip(*parts, strict=True))
    # Shingles of all words, scattered once for lines and runs; the last one only ends the slices, of which
    # every second one is a paragraph.
    whole = np.append(window_hashes(hashed, SHINGLE), np.uint64(0))
    slices = np.column_stack([first, first + size - SHINGLE + 1]).ravel()
    keys = np.empty((len(first), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(first), _SEEDS[-1] + np.uint64(b), np.uint64)
        for r in range(rows):
            seed = _SEEDS[b * rows + r]
            key = mix(key ^ np.minimum.reduceat(mix(whole ^ seed), slices)[::2]) if len(first) else key
        keys[:, b] = key
    return owner[first], first, first + size - 1, digest, twin, keys


def first_least(value: np.ndarray, size: int) -> np.ndarray:
    """Place of the smallest value, of equal ones the first, in every run of ``size`` neighbours.

    Runs are put together from two of up to half as many more.
    """
    place, least, have = np.arange(len(value)), value, 1
    while have < size:
        step = min(have, size - have)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.minimum(least[step:], least[:-step])
        have += step
    return place


def windows(owner, hashed):
    """Owner, first and last word and hash of every anchored window."""
    shingle = window_hashes(hashed, SHINGLE)
    if len(shingle) < SPAN:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    least = first_least(shingle, SPAN)
    inside = owner[: len(least)] == owner[SPAN + SHINGLE - 2 :][: len(least)]
    # Where the smallest lies never falls from one run to the next.
    anchor = least[inside]
    anchor = anchor[np.r_[True, anchor[1:] != anchor[:-1]]] if len(anchor) else anchor
    anchor = anchor[anchor + WINDOW <= len(owner)]
    anchor = anchor[owner[anchor] == owner[anchor + WINDOW - 1]]
    value = window_hashes(hashed, WINDOW)[anchor] if len(hashed) >= WINDOW else np.empty(0, np.uint64)
    return owner[anchor], anchor, anchor + WINDOW - 1, value


def _cut(bands: int, rows: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                start, end, owner = word_spans(chunk)
                if not len(start):
                    continue
                hashed = span_hashes(chunk, start, end)
                points = np.concatenate([[0], np.cumsum(~INNER[chunk.data])])
                lo, lf, ll, ld, lt, lk = lines(chunk, start, end, owner, hashed, bands, rows)
                wo, wf, wl, wd = windows(owner, hashed)
                who, first, last = (np.concatenate(x) for x in ((lo, wo), (lf, wf), (ll, wl)))
                begin = points[start[first]]
                size = np.r_[np.full(len(lo), bands), np.zeros(len(wo), np.int64)]
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                take = pa.array(who + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take),
                        batch.column("row").take(take),
                        pa.array((begin - points[chunk.offsets[who]]).astype(np.int32)),
                        pa.array((points[end[last]] - begin).astype(np.int32)),
                        pa.array((last - first + 1).astype(np.int32)),
                        pa.array(np.r_[ld, wd].view(np.int64)),
                        pa.array(np.r_[lt, np.zeros(len(wo), np.uint64)].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(lk.ravel().view(np.int64))),
                        # A window, not a paragraph: told without reading the keys.
                        pa.array(np.arange(len(who)) >= len(lo)),
                    ],
                    names=_COLUMNS,
                )

    return cut


def _occurrences(found: DataFrame, kind: str) -> DataFrame:
    """Mark the occurrence of each class that stays."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start")
    firsts = found.groupBy("label").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = materialize(firsts.where("n > 1"), "first-occurrences")
    return found.join(firsts, "label").select(
        "doc_id", F.lit(kind).alias("kind"), "start", "length", "words",
        F.col("label").alias("class_id"), F.col("n").alias("class_size"),
        F.col("first.doc_id").alias("keep_doc_id"),
        F.expr("row = first.row AND start = first.start").alias("kept"),
    )


def near_paragraphs(parts: DataFrame, source: DataFrame, at_least: float) -> DataFrame:
    own = parts.where("NOT passage")
    items = materialize(
        own.groupBy("digest", "twin")
        .agg(F.min(F.struct("row", "start", "length")).alias("at"), F.first("words").alias("words"),
             F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n"))
        .select(F.monotonically_increasing_id().alias("item"), "digest", "twin", "at", "n",
                (F.col("words") - SHINGLE + 1).cast("long").alias("weight"), "keys"),
        "paragraph-items",
    )

    def texts(wanted: DataFrame) -> DataFrame:
        likely = possible_hits(items.select("item", "at"), bloom_filter(wanted, "item"), "item")
        # No semi-join: that one Spark would run before the filter.
        places = likely.join(wanted, "item").select("item", "at.row", "at.start", "at.length")
        places = materialize(places, "places")
        likely = possible_hits(source, bloom_filter(places.select("row").distinct(), "row"), "row")
        return likely.join(places, "row").select(
            "item", F.substring(F.col("text"), F.col("start") + 1, F.col("length")).alias("text")
        )

    labels = classes(items.select("item", "weight", "keys"), texts, False, at_least)
    named = items.select("digest", "twin", "item", "n")
    if labels is None:
        named = named.withColumn("label", F.col("item")).where("n > 1")
    else:
        named = named.join(labels, "item", "left").where("n > 1 OR label IS NOT NULL")
        named = named.withColumn("label", F.coalesce("label", "item"))
    named = materialize(named.select("digest", "twin", "label"), "named")
    likely = possible_hits(own.drop("keys", "passage"), bloom_filter(named, "digest"), "digest")
    found = materialize(likely.join(named, ["digest", "twin"]), "found")
    discard(items, named)
    return _occurrences(found, "paragraph")


_BLANK = "\x20\t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {k: k + 32 for k in range(65, 91)}


def _agreeing(text: str, at: int, other: str, there: int, way: int) -> int:
    """Code points in which both texts surely agree from these places on, ``way`` -1 backwards."""

    def piece(of: str, begin: int, length: int) -> str:
        return of[begin : begin + length] if way > 0 else of[max(0, begin - length) : begin]

    agreed, size, growing = 0, 64, True
    while size >= 16:
        own = piece(text, at + way * agreed, size)
        if len(own) == size and own == piece(other, there + way * agreed, size):
            agreed += size
            size = size * 2 if growing else size // 2
        else:
            size, growing = size // 2, False
    return agreed


def _before(text: str, at: int, other: str, there: int) -> tuple[int, int, int, int] | None:
    """Words before these places, which begin words, that agree at sight; else one word of each text.

    Their starts and stops in both texts; all but a single word is equal.
    """
    agreed = text[at - _agreeing(text, at, other, there, -1) : at]
    # Up to the first blank a word may be cut.
    cut = min((k for k in map(agreed.find, _BLANK) if k >= 0), default=len(agreed))
    whole = len(agreed[cut:].lstrip(_BLANK))
    if whole:
        return at - whole, at, there - whole, there
    found = []
    for of, stop in ((text, at), (other, there)):
        while stop > 0 and of[stop - 1] in _BLANK:
            stop -= 1
        start = stop
        while start > 0 and of[start - 1] not in _BLANK:
            start -= 1
        found += [start, stop]
    return tuple(found) if found[0] < found[1] and found[2] < found[3] else None


def _after(text: str, at: int, other: str, there: int) -> tuple[int, int, int, int] | None:
    """The same behind these places, which end words."""
    agreed = text[at : at + _agreeing(text, at, other, there, 1)]
    whole = len(agreed[: max(map(agreed.rfind, _BLANK)) + 1].rstrip(_BLANK))
    if whole:
        return at, at + whole, there, there + whole
    word, opposite = _WORD.search(text, at), _WORD.search(other, there)
    return word and opposite and (*word.span(), *opposite.span())


def _equal(a: str, b: str) -> bool:
    return a == b or len(a) == len(b) and a.translate(_LOWER) == b.translate(_LOWER)


def _alike(words: list[str], x: int, y: int, most: int, way: int) -> int:
    """How many words, ``most`` at most, agree from these places on, ``way`` -1 backwards."""
    agreed, size, growing = 0, 16, True
    while agreed < most and size:
        size = min(size, most - agreed)
        a, b = x + way * agreed - (size if way < 0 else 0), y + way * agreed - (size if way < 0 else 0)
        if words[a : a + size] == words[b : b + size]:
            agreed += size
            size = size * 2 if growing else size // 2 or 1
        else:
            size, growing = size // 2, False
    return agreed


def _grown_within(
    words: list[str], starts: list[int], stops: list[int], start: int, stop: int, kept_start: int, kept_stop: int
) -> tuple[int, int, int, int]:
    """Two passages of one text, whose ``words`` lie at ``starts``, grow by words and not into each other."""
    i, k = bisect_left(starts, start), bisect_left(starts, kept_start)
    j, m = bisect_left(stops, stop), bisect_left(stops, kept_stop)
    n = _alike(words, i, k, min(k, i - 1 - m), -1)
    i, k = i - n, k - n
    n = _alike(words, j + 1, m + 1, min(len(starts) - 1 - j, i - 1 - m), 1)
    return starts[i], stops[j + n], starts[k], stops[m + n]


_EXTENDED = "row long, keep_row long, start int, stop int, keep_start int, keep_stop int, label long"


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and what they equal in the keeper's text, as far as both texts agree."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            same = r["row"] == r["keep_row"]
            text, kept_text = r["text"], r["text"] if same else r["keep_text"]
            found = list(_WORD.finditer(text.translate(_LOWER))) if same else []
            words, starts, stops = [m.group() for m in found], [m.start() for m in found], [m.end() for m in found]
            # What was passed while a span grew, by how far the places lie apart.
            passed = {}
            for s in r["spans"]:
                start, stop, kept_start, kept_stop = (s[k] for k in ("start", "stop", "keep_start", "keep_stop"))
                known = passed.get(kept_start - start, ())
                reach = next((x for first, last, x in known if first <= start < last), None)
                if same:
                    reach = _grown_within(words, starts, stops, start, stop, kept_start, kept_stop)
                elif reach is None:
                    steps = []
                    while found := _before(text, start, kept_text, kept_start):
                        if not _equal(text[found[0] : found[1]], kept_text[found[2] : found[3]]):
                            break
                        steps.append(found)
                        start, kept_start = found[0], found[2]
                    while found := _after(text, stop, kept_text, kept_stop):
                        if not _equal(text[found[0] : found[1]], kept_text[found[2] : found[3]]):
                            break
                        steps.append(found)
                        stop, kept_stop = found[1], found[3]
                    reach = (start, stop, kept_start, kept_stop)
                    for f in steps:
                        passed.setdefault(f[2] - f[0], []).append((f[0], f[1], reach))
                out.append((r["row"], r["keep_row"], *reach, s["label"]))
        if out:
            kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                names=[c.split()[0] for c in _EXTENDED.split(", ")],
            )


def _numbered(rows: DataFrame, over, fresh) -> DataFrame:
    """Rows with the number of the run they belong to; ``fresh`` ones begin a run."""
    marked = rows.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int"))
    return marked.withColumn("number", F.sum("fresh").over(over.rowsBetween(Window.unboundedPreceding, 0)))


def shared_passages(parts: DataFrame, source: DataFrame) -> DataFrame:
    own = parts.where("passage").select("doc_id", "row", "start", "length", "digest")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start", "length")
    # Digests alone are counted first; of the windows only those that may be repeated are shuffled.
    digests = own.select(F.col("digest").alias("item"), F.col("digest").alias("key"))
    counts = materialize(repeated_keys(digests).select(F.col("key").alias("digest")), "window-counts")
    likely = materialize(possible_hits(own, bloom_filter(counts, "digest"), "digest"), "likely-windows")
    again = likely.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    # Written, so that the join can be split where one window is very common.
    again = materialize(again.where("n > 1"), "window-groups")
    repeated = likely.join(again, "digest").select(
        "doc_id", "row", "start", F.expr("start + length").alias("stop"), "digest",
        F.expr("row = first.row AND start = first.start").alias("kept"),
        F.col("first.row").alias("keep_row"), F.col("first.start").alias("keep_start"),
        F.expr("first.start + first.length").alias("keep_stop"),
    )
    # One row is one text, so its windows are bounded by its length.
    text = Window.partitionBy("row").orderBy("start")
    copy = ~F.col("kept")

    def lately(column: str):
        """Of the copy before this one."""
        return F.last(F.when(copy, F.col(column)), True).over(text.rowsBetween(Window.unboundedPreceding, -1))

    parted = (
        (F.col("start") > lately("stop"))
        | (F.col("keep_row") != lately("keep_row"))
        | (F.col("keep_start") < lately("keep_start"))
        | (F.col("keep_start") > lately("keep_stop"))
    )
    # Windows that overlap are a run; its copies that also overlap in the text that is kept are a span.
    repeated = repeated.withColumns({
        "part": copy & F.coalesce(parted, F.lit(True)),
        "apart": F.coalesce(F.col("start") > F.lag("stop").over(text), F.lit(True)),
    })
    so_far = text.rowsBetween(Window.unboundedPreceding, 0)
    repeated = repeated.withColumns({
        "number": F.sum(F.col("part").cast("int")).over(so_far),
        "run": F.sum(F.col("apart").cast("int")).over(so_far),
    }).drop("part", "apart")
    repeated = materialize(repeated, "repeated-windows")
    discard(counts, likely, again)

    spans = repeated.where(copy).groupBy("row", "run", "number").agg(
        F.first("keep_row").alias("keep_row"), F.min_by("digest", "start").alias("digest"),
        F.min("start").alias("start"), F.max("stop").alias("stop"),
        F.min_by("keep_start", "start").alias("keep_start"), F.max_by("keep_stop", "start").alias("keep_stop"),
    )
    # The windows of a run that are kept there are one node, named like their smallest digest. Windows of a span
    # overlap in the text that is kept, so they belong to one node, and only nodes are to be joined.
    kept = repeated.where("kept").select("row", "run", "digest")
    kept = kept.withColumn("node", F.min("digest").over(Window.partitionBy("row", "run")))
    kept = materialize(kept, "window-nodes")
    spans = materialize(spans.join(kept.select("digest", "node"), "digest"), "spans")
    runs = spans.select("row", "run", "node").unionByName(kept.select("row", "run", "node")).distinct()
    least = F.min("node").over(Window.partitionBy("row", "run"))
    links = runs.select(least.alias("a"), F.col("node").alias("b")).where("a <> b").distinct()
    labels = materialize(components(links), "window-classes")

    together = spans.join(labels.withColumnRenamed("item", "node"), "node", "left").groupBy("row", "keep_row").agg(
        F.sort_array(F.collect_list(F.struct(
            "start", "stop", "keep_start", "keep_stop", F.coalesce("label", "node").alias("label")
        ))).alias("spans")
    )
    # Written, so that the joins can be split where many texts have one keeper.
    together = materialize(together, "passage-spans")
    discard(kept, spans)

    def texts(column: str, name: str) -> DataFrame:
        wanted = together.select(F.col(column).alias("row")).distinct()
        likely = possible_hits(source, bloom_filter(wanted, "row"), "row")
        return likely.select(F.col("row").alias(column), F.col("text").alias(name))

    # The filters alone keep other texts out of the shuffles; the joins drop what they let through.
    both = together.join(texts("row", "text"), "row").join(texts("keep_row", "keep_text"), "keep_row")
    extended = materialize(
        both.select("row", "keep_row", "text", "keep_text", "spans").mapInArrow(_extend, _EXTENDED), "passages"
    )
    discard(together, labels)

    # A kept passage is what its copies agree with.
    sides = extended.select("row", "keep_row", "start", "stop", "label", F.lit(False).alias("kept")).unionByName(
        extended.select(
            F.col("keep_row").alias("row"), "keep_row", F.col("keep_start").alias("start"),
            F.col("keep_stop").alias("stop"), "label", F.lit(True).alias("kept"),
        )
    ).distinct()
    side = Window.partitionBy("row", "kept", "keep_row", "label").orderBy("start", "stop")
    reach = F.max("stop").over(side.rowsBetween(Window.unboundedPreceding, -1))
    merged = _numbered(sides, side, F.col("start") > reach).groupBy(
        "row", "kept", "keep_row", "label", "number"
    ).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    merged = materialize(merged, "merged-passages")
    discard(extended)
    sizes = materialize(merged.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "passage-classes")
    # A row that keeps a window also has it.
    ids = materialize(repeated.select("row", "doc_id").distinct(), "passage-ids")
    discard(repeated)
    return (
        merged.join(sizes, "label").join(ids, "row")
        .join(ids.select(F.col("row").alias("keep_row"), F.col("doc_id").alias("keep_doc_id")), "keep_row")
        .select(
            "doc_id", F.lit("passage").alias("kind"), "start", (F.col("stop") - F.col("start")).alias("length"),
            F.lit(None).cast("int").alias("words"), F.col("label").alias("class_id"),
            F.col("n").alias("class_size"), "keep_doc_id", "kept",
        )
    )


def repeated_passages(
    docs: DataFrame, bands: int = BANDS, rows: int = ROWS, at_least: float = SIMILAR
) -> DataFrame:
    """One row per occurrence of a repeated paragraph or passage.

    ``doc_id, kind, start, length, words, class_id, class_size, keep_doc_id, kept``;
    ``words`` is null for passages. Occurrences that are not ``kept`` are to be removed.
    """
    source = located(docs, "doc_id", "text").select(
        "doc_id", "text", F.xxhash64("file", "place").alias("row")
    )
    parts = materialize(source.mapInArrow(_cut(bands, rows), PARAGRAPH), "paragraphs")
    near = near_paragraphs(parts, source.select("row", "text"), at_least)
    shared = shared_passages(parts, source.select("row", "text"))
    discard(parts)
    return near.unionByName(shared)
