"""Classes of similar items: candidates that share a key, checked pairs, components.

Items that share a key are first compared with one representative each; what that links
is one class, and keys within one class are done, so a large group of copies costs one
comparison per copy. Items of keys that still hold several classes are compared with all
others of the key, in blocks of ``BLOCK`` items of which two meet in a task; of the links
found there only those that join classes are put out, as pairs of these. Keys with the same items are
compared once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from panelweave.llm.text import Chunk, chunks, mix, shingles, span_hashes, word_spans
from panelweave.llm.url_filters import bloom_filter, possible_hits
from panelweave.llm.workers import releasing
from panelweave.sources.scratch import discard, materialize

SHINGLE = 5
SIMILAR = 0.8
#: Items of one block; two blocks meet in one task.
BLOCK = 256
#: Elements of the 0/1 matrix handled at a time.
COLUMNS = 2048
#: Keys that are counted at once before they are shuffled.
AT_ONCE = 1 << 20
#: Bytes of text whose groups are cut into shingles together.
TOGETHER = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def by_text(value: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The order by text and value, like ``np.lexsort((value, text))`` but for equal rows."""
    if not len(text) or text.max() >= 1 << 16:
        return np.lexsort((value, text))
    # Sorting 16-bit numbers stably takes no comparisons.
    order = np.argsort(value)
    return order[np.argsort(text[order].astype(np.uint16), kind="stable")]


def multisets(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles with text and count, ordered by text and shingle."""
    start, end, owner = word_spans(chunk)
    value, text = shingles(span_hashes(chunk, start, end), owner, size)
    order = by_text(value, text)
    value, text = value[order], text[order]
    if not len(value):
        return value, text, np.empty(0, np.int64)
    new = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])])
    return value[new], text[new], np.diff(np.r_[new, len(value)])


def overlap(left: pa.Array, right: pa.Array, counted: bool) -> np.ndarray:
    """Jaccard similarity of two columns of texts, row by row, on lower-cased words.

    Of multisets (sum of smaller counts over sum of larger) or, not ``counted``, of sets.
    Two texts without words have similarity 0.
    """
    n = len(left)
    parts = []
    for column in (left, right):
        value, text, count = [], [], []
        for chunk in chunks(column, lower=True, size=4 << 20):
            v, t, c = multisets(chunk)
            value.append(v)
            text.append(t + chunk.first)
            count.append(c if counted else np.ones_like(c))
        parts.append([np.concatenate(x) for x in (value, text, count)])
    total = [np.bincount(p[1], weights=p[2], minlength=n) for p in parts]
    value, text, count = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = by_text(value, text)
    value, text, count = value[order], text[order], count[order]
    both = (value[1:] == value[:-1]) & (text[1:] == text[:-1])
    least = np.minimum(count[1:], count[:-1])[both]
    shared = np.bincount(text[1:][both], weights=least, minlength=n)
    return shared / np.maximum(total[0] + total[1] - shared, 1)


def checked(counted: bool, at_least: float = SIMILAR):
    """Marks pairs (``a, b, text_a, text_b``) as similar or not, in Arrow batches."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                same = overlap(part.column("text_a"), part.column("text_b"), counted)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(same >= at_least - 1e-12)],
                    names=["a", "b", "similar"],
                )

    return check


def components(links: DataFrame) -> DataFrame:
    """``item, label`` of all items of ``links(a, b)``: the smallest item of each component.

    Alternates the large-star and small-star steps until every item points at the
    smallest one; edges are written after each turn.
    """

    def pointing(edges: DataFrame) -> DataFrame:
        return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")

    def finished(edges: DataFrame) -> bool:
        n, children = edges.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        if n != children:
            return False
        parents = edges.select(F.col("v").alias("u")).distinct()
        return edges.join(parents, "u", "left_semi").isEmpty()

    edges = materialize(
        pointing(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct(), "edges"
    )
    while not finished(edges):
        before = edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join can be split where an item has very many neighbours.
        least = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(pointing(large).distinct(), "edges")
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lower.select("u", F.col("m").alias("v")))
        edges = materialize(pointing(small).distinct(), "edges")
        discard(before, least, large)
    members = edges.select(F.col("u").alias("item"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("item"), F.col("v").alias("label")).distinct()
    return members.unionByName(roots)


def occurrences(value, text, count) -> tuple[np.ndarray, np.ndarray]:
    """Multisets as sets: the k-th occurrence of a shingle is an element of its own."""
    again = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return mix(np.repeat(value, count) + again.astype(np.uint64) * _STEP), np.repeat(text, count)


def elements(column: pa.Array, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Elements of the texts' sets with their rows, in the order of the rows."""
    value, text = [], []
    for chunk in chunks(column, lower=True, size=4 << 20):
        v, t, c = multisets(chunk)
        v, t = occurrences(v, t, c) if counted else (v, t)
        value.append(v)
        text.append(t + chunk.first)
    return np.concatenate(value), np.concatenate(text)


def forest(value: np.ndarray, text: np.ndarray, label: np.ndarray, at_least: float) -> list[tuple[int, int]]:
    """Rows to link so that all similar texts of different labels hang together.

    Compares every row with every other one: the numbers of shared elements are products
    of a 0/1 matrix, a block of its columns at a time.
    """
    n = len(label)
    size = np.bincount(text, minlength=n)
    _, place, often = np.unique(value, return_inverse=True, return_counts=True)
    common = often > 1
    place = (np.cumsum(common) - 1)[place[(keep := common[place])]]
    text = text[keep]
    order = np.argsort(place, kind="stable")
    place, text = place[order], text[order]
    shared = np.zeros((n, n), np.float32)
    n_common = int(common.sum())
    for first in range(0, n_common, COLUMNS):
        a, b = np.searchsorted(place, [first, first + COLUMNS])
        block = np.zeros((n, min(COLUMNS, n_common - first)), np.float32)
        block[text[a:b], place[a:b] - first] = 1
        shared += block @ block.T
    union = size[:, None] + size[None, :] - shared
    near = (shared > 0) & (shared >= (at_least - 1e-9) * union)
    root = {x: x for x in label.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        a, b = find(int(label[i])), find(int(label[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((int(i), int(j)))
    return links


def _starts(rows: pa.Table) -> np.ndarray:
    """First rows of the groups of one key and two blocks."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("key", "low", "high"):
        column = rows.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _link_groups(counted: bool, at_least: float):
    """Links between the labels of groups that lie one after the other in a partition."""

    def links(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        label = rows.column("label").to_numpy()
        column, ends = rows.column("text").combine_chunks(), np.r_[starts[1:], rows.num_rows]
        length = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False))
        g = 0
        while g < len(starts):
            read = length[starts[g]] + TOGETHER
            last = max(g + 1, int(np.searchsorted(length[ends - 1], read)))
            first = int(starts[g])
            value, text = elements(column.slice(first, int(ends[last - 1]) - first), counted)
            cuts = np.searchsorted(text, np.r_[starts[g:last], ends[last - 1]] - first)
            found = []
            for k in range(g, last):
                a, b = int(starts[k]), int(ends[k])
                if (label[a:b] == label[a]).all():
                    continue
                own = slice(cuts[k - g], cuts[k - g + 1])
                found += [
                    (a + i, a + j) for i, j in forest(value[own], text[own] - (a - first), label[a:b], at_least)
                ]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[pairs[:, 0]]), pa.array(label[pairs[:, 1]])], names=["a", "b"]
            )
            g = last

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            starts = _starts(held)
            # The last group may go on in the next batch.
            if len(starts) > 1:
                yield from links(held.slice(0, int(starts[-1])), starts[:-1])
                held = held.slice(int(starts[-1]))
        if held is not None and held.num_rows:
            yield from links(held, _starts(held))

    return link


def _summed(key: np.ndarray, rep: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, each with the smallest ``rep`` and the sum of ``n``."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.minimum.reduceat(rep[order], first), np.add.reduceat(n[order], first)


def _key_counts(buckets: int):
    """Counts of the keys of many rows at a time, an array for each bucket of keys."""

    def emit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        key, item = rows.column("key").combine_chunks(), rows.column("item").to_numpy()
        if pa.types.is_list(key.type):
            item = np.repeat(item, key.value_lengths().to_numpy())
            key = key.flatten()
        key, rep, n = _summed(key.to_numpy(), item, np.ones(len(item), np.int64))
        bucket = (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        own = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket[o[0]] for o in own], pa.int32())]
            + [pa.array([x[o].tobytes() for o in own], pa.binary()) for x in (key, rep, n)],
            names=["bucket", "key", "rep", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            column = batch.column("key")
            n = len(column.flatten()) if pa.types.is_list(column.type) else len(column)
            if n:
                held.append(batch)
                size += n
            if size >= AT_ONCE:
                yield emit(held)
                held, size = [], 0
        if held:
            yield emit(held)

    return run


def _repeated(table):
    key, rep, n = (
        np.concatenate([np.frombuffer(x, np.int64) for x in table.column(c).to_pylist()]) for c in ("key", "rep", "n")
    )
    key, rep, n = _summed(key, rep, n)
    several = n > 1
    return pa.table({"key": key[several], "n": n[several], "rep": rep[several]})


def repeated_keys(rows: DataFrame) -> DataFrame:
    """``key, n, rep`` of the keys that ``rows(item, key)`` have several times: how often, and the smallest item.

    ``key`` is a long or an array of longs. Keys are counted in the tasks that read them first, so of a common key
    a bucket gets a few numbers.
    """
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.select("item", "key").mapInArrow(
        releasing(_key_counts(buckets)), "bucket int, key binary, rep binary, n binary"
    )
    return counted.groupBy("bucket").applyInArrow(_repeated, "key long, n long, rep long")


def classes(
    items: DataFrame, texts: Callable[[DataFrame], DataFrame], counted: bool, at_least: float = SIMILAR
) -> DataFrame | None:
    """``item, label`` of all items with a link to another; None if nothing collides.

    ``items`` has ``item`` (a long), ``weight`` (its shingles) and ``keys`` (an array of
    longs); ``texts`` returns ``item, text`` of the items of a frame.
    """
    rows = items.select("item", "weight", F.explode("keys").alias("key"))
    # Written, so that the join can be split where a key is very common.
    shared = materialize(repeated_keys(items.select("item", F.col("keys").alias("key"))), "shared-keys")
    likely = possible_hits(rows, bloom_filter(shared, "key"), "key")
    rows = materialize(likely.join(shared, "key"), "colliding")
    if rows.isEmpty():
        discard(shared, rows)
        return None
    fetched = materialize(texts(rows.select("item").distinct()), "texts")

    # Every item against one representative.
    compared = rows.groupBy("item").agg(F.min("rep").alias("compared"))
    pairs = compared.where("item <> compared").withColumnRenamed("compared", "rep")
    sides = pairs.join(fetched.withColumnsRenamed({"item": "rep", "text": "text_b"}), "rep").join(
        fetched.withColumnRenamed("text", "text_a"), "item"
    )
    found = sides.select(F.col("item").alias("a"), F.col("rep").alias("b"), "text_a", "text_b").mapInArrow(
        releasing(checked(counted, at_least)), "a long, b long, similar boolean"
    )
    links = materialize(found.where("similar").select("a", "b"), "links")
    labels = materialize(components(links), "labels")

    # All items of keys that still hold several classes, block by block; of keys with the same items one,
    # and no key of two items that were compared above.
    labelled = rows.select("key", "item", "rep").join(compared, "item").join(labels, "item", "left")
    labelled = materialize(labelled.withColumn("label", F.coalesce("label", "item")), "labelled")
    several = (
        labelled.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
            F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y"),
            F.max(F.expr("item <> rep AND rep = compared")).alias("done"),
        )
        .where("low < high AND NOT (n = 2 AND done)")
        .groupBy("n", "x", "y")
        .agg(F.min("key").alias("key"))
        .select("key", F.expr(f"cast(ceil(n / {BLOCK}) AS int)").alias("blocks"))
    )
    several = materialize(several, "open-keys")
    dealt = (
        labelled.join(several, "key")
        .withColumn("own", F.expr("cast(pmod(xxhash64(item), blocks) AS int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                "item", "label")
    )
    more = (
        dealt.join(fetched, "item")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .mapInArrow(releasing(_link_groups(counted, at_least)), "a long, b long")
    )
    more = materialize(more.distinct(), "more-links")
    discard(shared, rows, fetched, labelled, several)
    discard(links)
    if more.isEmpty():
        discard(more)
        return labels
    # Only labels that were linked now are joined anew; a label is the smallest item of its class.
    joined = materialize(components(more), "joined")
    discard(more)
    fresh = joined.join(labels, "item", "left_anti")
    renamed = labels.join(joined.select(F.col("item").alias("label"), F.col("label").alias("least")), "label", "left")
    return renamed.select("item", F.coalesce("least", "label").alias("label")).unionByName(fresh)
