"""Score texts with a hierarchical Pitman-Yor model sampled by Gibbs.

Every word is a context, and so is the start of a text: a restaurant over the words that
follow it. All contexts share one parent restaurant over words, whose base is uniform over
the known words and one unknown. There is one row per context and word, so what contexts
learn grows with the corpus.

A Gibbs sweep seats the customers of every row again, given everyone else: the row's own tables
are taken out of its context and out of the parent before. How many tables its n customers take then
has the probability

    P(t) ~ product of p (strength + discount (tables of the others + i)), i < t,  times S(n, t)

with the parent's probability p and a generalised Stirling number S. Up to ``EXACT`` customers the
number is drawn from just that. Beyond, the first ``EXACT`` customers get
their tables so and the others follow in blocks of 1/``BLOCK`` of those seated, with one binomial draw each; both
allow for what one table more takes from the weight of all customers still to come (``_seated``). A test compares both with P. Rows of one sweep see each other as
the sweep before left them. A pair that was seen once has one table whatever happens; such pairs only
enter the totals and no sweep. Predictive probabilities are averaged over ``SAMPLES`` sweeps.

Counts come from all training documents, whole texts, lower-cased A-Z, words between ASCII
blanks and one end per text. Missing text is empty: its
only token is its end. Missing ids count as empty text for the fold. Words are told apart
by 64-bit hashes. Repeated rows count each time; other columns are not read.

What travels are arrays. Documents are read in blocks; a block sends the distinct pairs of each cell of
a grid there, and its words to their bucket. Rows of the grid are ranges of contexts and columns
ranges of words, so the pairs of a hot context lie in many cells. A cell holds its pairs and a bucket the
totals of its words, both as words and as contexts; in each sweep cells send their tables, a
sum per word, to the buckets and get the totals back. Who asked for which words is told once, so afterwards the
numbers go without the words. In the end cells and buckets answer the blocks in the order of their
questions. ``_Kind`` lists the rows that cells, buckets and blocks get.
"""

from __future__ import annotations

from collections.abc import Iterator
from enum import IntEnum
from functools import lru_cache
from math import ceil, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelweave.llm.text import chunks, held_out, mix, span_hashes, unit, word_spans
from panelweave.llm.workers import releasing
from panelweave.sources.scratch import discard, materialize

BLOCK_BYTES = 16 << 20
#: Bytes of text, and rows of counts, per cell and per bucket.
CELL_BYTES, CELL_ROWS = 8 << 20, 1 << 20
DISCOUNT, STRENGTH = 0.75, 1.0  # of contexts
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
BURN_IN, SAMPLES = 1, 3
#: Customers of a row up to which its tables are drawn from their exact distribution; beyond, the share of
#: seated customers that is seated by one draw.
EXACT, BLOCK = 512, 64
#: Places at which the view to later customers is taken.
GRID = 64
ROWS = 1 << 18  # seated at once
END = np.uint64(0x6C62272E07BB0142)
START = np.uint64(0x2545F4914F6CDD1D)


class _Kind(IntEnum):
    """Rows by what they hold, arrays in ``data``. ``to`` and ``frm`` are buckets, cells or blocks."""

    VOCABULARY = 0  # block to bucket: keys, training counts as words, as contexts
    PAIRS = 1  # block to cell: contexts, their runs, words, places in these, training counts
    KEYS = 2  # of a bucket: keys, counts as words, as contexts, pairs seen once as words, as contexts
    PLACES = 3  # of a bucket, from a block: where its words lie in the keys
    ASKED = 4  # of a bucket, from a cell: where the words lie that it asks for
    ONCE = 5  # cell to bucket: keys, pairs seen once as contexts, as words
    ASK = 6  # cell to bucket: keys, first tables as contexts, as words
    PAIRED = 7  # of a cell: keys it asks for, context and word of its pairs as places there, counts
    INDEX = 8  # of a cell, from a block: count of each of its pairs, or 2 and the place among those seen again
    SEATS = 9  # of a cell: tables of its pairs, their sum over the samples
    SUMS = 10  # cell to bucket: tables as contexts, as words, in the order asked
    ROOT = 11  # of a bucket: tables of contexts, tables of words, of these in the parent
    REPLY = 12  # bucket to cell: the same, in the order asked
    VALUES = 13  # cell to block: counts and summed tables of its pairs
    TOTALS = 14  # bucket to block: counts as words, as contexts, then the ROOT arrays of each sample


#: ``numbers`` sum up ROOT rows: tokens, customers and tables of the parent, words.
_ROW = pa.schema(
    [("to", pa.int64()), ("kind", pa.int32()), ("frm", pa.int64()), ("data", pa.binary()), ("numbers", pa.list_(pa.int64()))]
)
ROW = "to long, kind int, frm long, data binary, numbers array<long>"


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*[(*r, None)[:5] for r in rows], strict=True)) or [()] * 5
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ROW, strict=True)], schema=_ROW)


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers, each array in as many planes of bytes as its largest one needs."""
    shape, parts = [len(arrays)], []
    for x in arrays:
        x = np.ascontiguousarray(x).astype("<u8", copy=False)
        width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        shape += [len(x), width]
        parts.append(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return b"".join([np.array(shape, "<i8").tobytes(), *parts])


def _unpacked(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    at, out = 8 + 16 * n, []
    for length, width in np.frombuffer(data, "<i8", 2 * n, 8).reshape(n, 2).tolist():
        x = np.zeros((length, 8), np.uint8)
        x[:, :width] = np.frombuffer(data, np.uint8, length * width, at).reshape(width, length).T
        out.append(x.view("<i8").ravel())
        at += length * width
    return out


def _range(keys: np.ndarray, n: int) -> np.ndarray:
    """Which of n ranges of equal length keys lie in; never falls as keys rise."""
    return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


class Grid(NamedTuple):
    """Cells of ranges of contexts and of words, and buckets of words."""

    buckets: int
    across: int
    down: int

    @staticmethod
    def of(parts: float) -> Grid:
        n = max(1, ceil(parts))
        across = ceil(sqrt(n))
        return Grid(n, across, ceil(n / across))

    def cells(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return _range(context, self.down) * self.across + _range(word, self.across)

    def sliced(self, keys: np.ndarray) -> list[tuple[int, int, int]]:
        """Buckets that sorted keys lie in, each with its first key and the one behind."""
        cuts = np.searchsorted(_range(keys, self.buckets), np.arange(self.buckets + 1)).tolist()
        return [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]


class _Pairs:
    """The distinct pairs of a block by cell, context and word, which are places in sorted keys."""

    def __init__(self, grid: Grid, keys: np.ndarray, context: np.ndarray, word: np.ndarray):
        code, at = np.unique(context.astype(np.int64) * len(keys) + word, return_inverse=True)
        context, word = np.divmod(code, max(1, len(keys)))
        cell = grid.cells(keys[context], keys[word])
        order = np.argsort(cell.astype(np.uint16 if grid.across * grid.down < 1 << 16 else np.int64), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        self.grid, self.keys, self.at = grid, keys, rank[at]
        self.context, self.word, self.cell = context[order], word[order], cell[order]

    def messages(self, number: int, trained: np.ndarray) -> pa.Table:
        """Rows for cells and buckets, given how often each pair was seen."""
        rows, n = [], len(self.keys)
        as_word = np.bincount(self.word, trained, n).astype(np.int64)
        as_context = np.bincount(self.context, trained, n).astype(np.int64)
        for bucket, a, b in self.grid.sliced(self.keys):
            rows.append((bucket, _Kind.VOCABULARY, number, _packed(self.keys[a:b], as_word[a:b], as_context[a:b])))
        cuts = np.r_[np.flatnonzero(np.diff(self.cell, prepend=-1)), len(self.cell)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            context = self.context[a:b]
            head = np.flatnonzero(np.diff(context, prepend=-1))
            words, place = np.unique(self.word[a:b], return_inverse=True)
            data = _packed(
                self.keys[context[head]], np.diff(head, append=b - a), self.keys[words], place, trained[a:b]
            )
            rows.append((self.grid.buckets + int(self.cell[a]), _Kind.PAIRS, number, data))
        return _rows(rows)


class _Block(NamedTuple):
    """Documents with their tokens, one after the other, as places in sorted keys."""

    number: int
    ids: list
    out: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray
    keys: np.ndarray


def _contexts(sizes: np.ndarray, tokens: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The word before each token, or the start of its text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = np.searchsorted(keys, START)
    return before


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[_Block]:
    number = TaskContext.get().partitionId() << 24
    ids, words, sizes, held, read = [], [], [], [], 0

    def close():
        every = np.concatenate([[START], *words])
        words.clear()
        keys, tokens = np.unique(every, return_inverse=True)
        return _Block(number, ids, np.concatenate(held), np.concatenate(sizes), tokens[1:].astype(np.int32), keys)

    for batch in batches:
        out = held_out(batch.column("doc_id"), 10, 0)
        for chunk in chunks(batch.column("text"), lower=True):
            start, end, owner = word_spans(chunk)
            # A text's tokens: its words, then its end.
            n = np.bincount(owner, minlength=chunk.n) + 1
            found = np.full(len(start) + chunk.n, END, np.uint64)
            inner = np.ones(len(found), bool)
            inner[np.cumsum(n) - 1] = False
            found[inner] = span_hashes(chunk, start, end)
            words.append(found)
            sizes.append(n)
            ids.extend(batch.column("doc_id").slice(chunk.first, chunk.n).to_pylist())
            held.append(out[chunk.first : chunk.first + chunk.n])
            read += len(chunk.data)
            if read >= size:
                yield close()
                number += 1
                ids, words, sizes, held, read = [], [], [], [], 0
    if ids:
        yield close()


def _counted_blocks(size: int, grid: Grid):
    """What blocks tell cells and buckets of their training documents."""

    def emit(batches):
        for block in _blocks(batches, size):
            pairs = _Pairs(grid, block.keys, _contexts(block.sizes, block.tokens, block.keys), block.tokens)
            trained = np.bincount(pairs.at, np.repeat(~block.out, block.sizes), len(pairs.cell)).astype(np.int64)
            yield from pairs.messages(block.number, trained).to_batches()

    return emit


def _counted_rows(grid: Grid):
    """The same of rows of pairs and their counts."""

    def emit(batches):
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            both = np.concatenate([batch.column(c).to_numpy().view(np.uint64) for c in ("context", "word")])
            keys, place = np.unique(both, return_inverse=True)
            pairs = _Pairs(grid, keys, place[: batch.num_rows], place[batch.num_rows :])
            n = np.bincount(pairs.at, batch.column("n").to_numpy(), len(pairs.cell)).astype(np.int64)
            yield from pairs.messages(number, n).to_batches()
            number += 1

    return emit


_TEXTS = "block long, ids array<long>, held_out array<boolean>, data binary"


def _text_rows(size: int):
    def emit(batches):
        for block in _blocks(batches, size):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.number], pa.int64()),
                    pa.array([block.ids], pa.list_(pa.int64())),
                    pa.array([block.out], pa.list_(pa.bool_())),
                    pa.array([_packed(block.sizes, block.tokens, block.keys)], pa.binary()),
                ],
                names=["block", "ids", "held_out", "data"],
            )

    return emit


@lru_cache(maxsize=2)
def log_stirling(discount: float, n: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers of up to n customers, by customers and tables."""
    table = np.full((n + 1, n + 1), -np.inf)
    table[1, 1] = 0
    t = np.arange(1, n + 1)
    for m in range(1, n):
        stay = np.full(n, -np.inf)
        stay[:m] = np.log(m - discount * t[:m]) + table[m, 1 : m + 1]
        table[m + 1, 1:] = np.logaddexp(stay, table[m, :-1])
    return table


def _drawn(n, others, p, strength: float, discount: float, seed, cost=None) -> np.ndarray:
    """Tables of rows of up to ``EXACT`` customers from their distribution.

    ``cost`` is the logarithm of what each table more takes from the weight of customers still to come.
    """
    stirling, t = log_stirling(discount), np.ones(len(n), np.int64)
    order = np.argsort(n, kind="stable")
    cuts = np.r_[np.flatnonzero(np.r_[True, np.diff(n[order]) > 0]), len(n)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        size = int(n[order[a]])
        share = max(1, (1 << 21) // size)
        for first in range(a, b, share):
            own = order[first : min(b, first + share)]
            weight = p[own, None] * (strength + discount * (others[own, None] + np.arange(size)))
            log_p = np.cumsum(np.log(weight), axis=1) + stirling[size, 1 : size + 1]
            if cost is not None:
                log_p += cost[own, None] * np.arange(size)
            total = np.cumsum(np.exp(log_p - log_p.max(axis=1, keepdims=True)), axis=1)
            goal = unit(mix(seed[own])) * total[:, -1]
            t[own] = np.minimum(1 + (total < goal[:, None]).sum(axis=1), size)
    return t


def _seated(n, others, p, strength: float, discount: float, seed) -> np.ndarray:
    """Tables of rows of more customers, seated in order with a view to those that follow.

    A customer at place m weighs m - discount t + r (weight + p discount t) in all, where r is what one
    table more leaves of the weight of those after it. So log r falls by discount (1 - p r) over that
    weight with each of them; it is summed up from the last customer backwards, at places that grow by
    equal factors.
    """
    generator = np.random.default_rng([int(x) for x in mix(seed[:4])])
    weight = p * (strength + discount * others)
    places = EXACT * (n[None, :] / EXACT) ** (np.arange(GRID + 1)[:, None] / GRID)
    log_r = np.zeros((GRID + 1, len(n)))
    for k in range(GRID - 1, -1, -1):
        r, middle = np.exp(log_r[k + 1]), (places[k] + places[k + 1]) / 2
        fall = discount * (1 - p * r) / (middle + weight * r)
        log_r[k] = log_r[k + 1] - fall * (places[k + 1] - places[k])

    t = _drawn(np.full(len(n), EXACT), others, p, strength, discount, seed, log_r[0])
    there = EXACT
    while True:
        own = np.flatnonzero(n > there)
        if not len(own):
            return t
        size = there // BLOCK
        take = np.minimum(size, n[own] - there)
        middle = there + (take - 1) / 2
        step = GRID * np.log(middle / EXACT) / np.log(n[own] / EXACT)
        low = np.minimum(step.astype(np.int64), GRID - 1)
        r = np.exp(log_r[low, own] + (step - low) * (log_r[low + 1, own] - log_r[low, own]))
        new = (weight[own] + p[own] * discount * t[own]) * r
        t[own] += generator.binomial(take, np.clip(new / (new + middle - discount * t[own]), 0, 1))
        there += size


def reseat(customers, others, p, strength: float, discount: float, seed) -> np.ndarray:
    """Table counts of rows given everyone else, see the module's text.

    ``others`` are the other tables of the restaurant and ``p`` the parent's probability
    without the row's own tables.
    """
    n = customers.astype(np.int64)
    t = np.minimum(n, 1)
    for own, draw in ((np.flatnonzero((n > 1) & (n <= EXACT)), _drawn), (np.flatnonzero(n > EXACT), _seated)):
        if len(own):
            t[own] = draw(n[own], others[own], p[own], strength, discount, seed[own])
    return t


def _turned(hashed: np.ndarray, turn: int) -> np.ndarray:
    return mix(hashed + np.uint64((turn + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))


def parent(k, t, tokens, spread):
    """The parent's probability of words with k of its customers at t tables there."""
    return (k - t * ROOT_DISCOUNT + spread) / (ROOT_STRENGTH + tokens)


def _held(table: pa.Table, *kinds: _Kind) -> list[tuple]:
    """``frm`` and arrays of the rows of each kind, by ``frm``."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "frm", "data")), strict=True), key=lambda r: r[:2])
    found = [[(r[1], _unpacked(r[2])) for r in rows if r[0] == kind] for kind in kinds]
    return found[0] if len(kinds) == 1 else tuple(found)


def _joined(parts: list[list[np.ndarray]], n: int) -> list[np.ndarray]:
    """The first, second and so on arrays of all parts, one after the other."""
    return [np.concatenate([np.empty(0, np.int64), *[p[k] for p in parts]]) for k in range(n)]


def _merged_words(to: int, table: pa.Table) -> list[tuple]:
    blocks = _held(table, _Kind.VOCABULARY)
    keys, n, customers = _joined([x for _, x in blocks], 3)
    keys, at = np.unique(keys.view(np.uint64), return_inverse=True)
    n, customers = (np.bincount(at, x, len(keys)).astype(np.int64) for x in (n, customers))
    rows, first = [(to, _Kind.KEYS, to, _packed(keys, n, customers))], 0
    for block, (own, *_) in blocks:
        rows.append((to, _Kind.PLACES, block, _packed(at[first : first + len(own)])))
        first += len(own)
    return rows


def _merged_pairs(to: int, table: pa.Table, grid: Grid) -> list[tuple]:
    blocks = _held(table, _Kind.PAIRS)
    contexts, runs, words, _, seen = _joined([x for _, x in blocks], 5)
    contexts, context = np.unique(contexts.view(np.uint64), return_inverse=True)
    words, word = np.unique(words.view(np.uint64), return_inverse=True)
    first = np.cumsum([0, *[len(x[2]) for _, x in blocks]])
    place = np.concatenate([x[3] + f for f, (_, x) in zip(first[:-1], blocks, strict=True)])
    pairs, at = np.unique(np.repeat(context, runs) * len(words) + word[place], return_inverse=True)
    n = np.bincount(at, seen, len(pairs)).astype(np.int64)
    context, word = np.divmod(pairs, len(words))
    rows = []

    def tell(kind: _Kind, own: np.ndarray) -> np.ndarray:
        """Tell the buckets how many of some pairs their words are in."""
        c, w = np.bincount(context[own], minlength=len(contexts)), np.bincount(word[own], minlength=len(words))
        keys = np.union1d(contexts[c > 0], words[w > 0])
        sums = np.zeros((2, len(keys)), np.int64)
        sums[0, np.searchsorted(keys, contexts[c > 0])] = c[c > 0]
        sums[1, np.searchsorted(keys, words[w > 0])] = w[w > 0]
        for bucket, a, b in grid.sliced(keys):
            rows.append((bucket, kind, to, _packed(keys[a:b], sums[0, a:b], sums[1, a:b])))
        return keys

    tell(_Kind.ONCE, n == 1)
    again = n > 1
    keys = tell(_Kind.ASK, again)
    own = [np.searchsorted(keys, x) for x in (contexts[context[again]], words[word[again]])]
    rows.append((to, _Kind.PAIRED, to, _packed(keys, *own, n[again])))
    index, first = np.where(again, 1 + np.cumsum(again), n)[at], 0
    for block, x in blocks:
        rows.append((to, _Kind.INDEX, block, _packed(index[first : first + len(x[3])])))
        first += len(x[3])
    return rows


def _merge(grid: Grid):
    """Words and pairs of all blocks, each once."""

    def run(key, table):
        to = key[0].as_py()
        return _rows(_merged_words(to, table) if to < grid.buckets else _merged_pairs(to, table, grid))

    return run


def _told(to: int, n, tables, k, t, asked: list[tuple]) -> list[tuple]:
    """A bucket's totals and what it replies to cells."""
    numbers = [int(n.sum()), int(k.sum()), int(t.sum()), int((n > 0).sum())]
    rows = [(to, _Kind.ROOT, to, _packed(tables, k, t), numbers)]
    return rows + [(cell, _Kind.REPLY, to, _packed(tables[x], k[x], t[x])) for cell, x in asked]


def _first_words(key, table):
    """Totals of words and contexts before the first sweep, when every pair has one table."""
    to = key[0].as_py()
    kept, once, ask = _held(table, _Kind.KEYS, _Kind.ONCE, _Kind.ASK)
    keys, n, customers = kept[0][1]
    keys = keys.view(np.uint64)
    alone = np.zeros((2, len(keys)), np.int64)
    for _, (own, *sums) in once:
        alone[:, np.searchsorted(keys, own.view(np.uint64))] += sums
    all_tables, asked = alone.copy(), []
    for cell, (own, *sums) in ask:
        asked.append((cell, np.searchsorted(keys, own.view(np.uint64))))
        all_tables[:, asked[-1][1]] += sums
    tables, k = all_tables
    rows = _told(to, n, tables, k, np.minimum(k, 1), asked)
    rows.append((to, _Kind.KEYS, to, _packed(keys, n, customers, *alone)))
    return _rows(rows + [(to, _Kind.ASKED, cell, _packed(x)) for cell, x in asked])


def _seat_pairs(turn: int, customers: int, spread: float, grid: Grid):
    """Tables of the pairs of a cell, and their sum over the samples."""

    def run(key, table):
        to = key[0].as_py()
        paired, seats, replies = _held(table, _Kind.PAIRED, _Kind.SEATS, _Kind.REPLY)
        keys, context, word, n = paired[0][1]
        keys = keys.view(np.uint64)
        t, sums = seats[0][1] if seats else (np.ones(len(n), np.int64), np.zeros(len(n), np.int64))
        tables, k, at = _joined([x for _, x in replies], 3)
        # The parent without this row's customers.
        left = k[word] - t
        p = parent(left, np.minimum(at[word], left), customers - t, spread)
        t = reseat(n, tables[context] - t, p, STRENGTH, DISCOUNT, mix(_turned(keys[word], turn) ^ keys[context]))
        rows = [(to, _Kind.SEATS, to, _packed(t, sums + (t if turn >= BURN_IN else 0)))]
        own = [np.bincount(x, t, len(keys)).astype(np.int64) for x in (context, word)]
        for bucket, a, b in grid.sliced(keys):
            rows.append((bucket, _Kind.SUMS, to, _packed(*[x[a:b] for x in own])))
        return _rows(rows)

    return run


def _seat_words(turn: int, tables: int, n_words: int):
    """Totals of a bucket, and its words' tables in the parent."""

    def run(key, table):
        kept, asked, sums, root = _held(table, _Kind.KEYS, _Kind.ASKED, _Kind.SUMS, _Kind.ROOT)
        keys, n, _, *alone = kept[0][1]
        asked = [(cell, x) for cell, (x,) in asked]
        totals = np.array(alone)
        # Whoever asked has sent sums.
        for (_, x), (_, own) in zip(asked, sums, strict=True):
            totals[:, x] += own
        t = np.minimum(root[0][1][2], totals[1])
        p = np.full(len(n), 1 / (n_words + 1))
        t = reseat(totals[1], tables - t, p, ROOT_STRENGTH, ROOT_DISCOUNT, _turned(keys.view(np.uint64), turn))
        return _rows(_told(key[0].as_py(), n, *totals, t, asked))

    return run


def _of(rows: DataFrame, *kinds: _Kind) -> DataFrame:
    return rows.where(F.col("kind").isin([int(k) for k in kinds]))


def _grouped(run, *frames: DataFrame, schema: str = ROW) -> DataFrame:
    """What a function makes of the rows that go to a cell, a bucket or a block."""
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    return rows.groupBy("to").applyInArrow(run, schema)


class State:
    """Restaurants after a sweep: tables of contexts, and of words in the parent."""

    def __init__(self, rows: DataFrame, keys: DataFrame | None = None):
        self.rows, self.keys = rows, _of(rows if keys is None else keys, _Kind.KEYS)
        numbers = _of(rows, _Kind.ROOT).agg(*[F.sum(F.col("numbers")[k]) for k in range(4)]).first()
        self.n_tokens, self.customers, self.tables, self.n_words = (x or 0 for x in numbers)
        #: What all unseen words weigh in the parent, shared out evenly.
        self.spread = (ROOT_STRENGTH + ROOT_DISCOUNT * self.tables) / (self.n_words + 1)

    @property
    def contexts(self) -> DataFrame:
        def run(_, table):
            kept, root = _held(table, _Kind.KEYS, _Kind.ROOT)
            (keys, _, customers, *_), (tables, _, _) = kept[0][1], root[0][1]
            return pa.table({"context": keys, "customers": customers, "tables": tables})

        found = _grouped(run, self.keys, _of(self.rows, _Kind.ROOT), schema="context long, customers long, tables long")
        return found.where("customers > 0")

    @property
    def words(self) -> DataFrame:
        def run(_, table):
            kept, root = _held(table, _Kind.KEYS, _Kind.ROOT)
            (keys, n, *_), (_, k, t) = kept[0][1], root[0][1]
            return pa.table({"word": keys, "n": n, "k": k, "root_tables": t})

        found = _grouped(run, self.keys, _of(self.rows, _Kind.ROOT), schema="word long, n long, k long, root_tables long")
        return found.where("n > 0")


class Fitted(NamedTuple):
    """Pairs and their places (``merged``), words (``first``), tables of pairs after all sweeps, the samples."""

    merged: DataFrame
    first: DataFrame
    seats: DataFrame
    samples: list[State]

    def pairs(self) -> DataFrame:
        """Pairs seen more than once, with their tables summed over the samples."""

        def run(_, table):
            paired, seats = _held(table, _Kind.PAIRED, _Kind.SEATS)
            (keys, context, word, n), (_, sums) = paired[0][1], seats[0][1]
            return pa.table({"context": keys[context], "word": keys[word], "n": n, "sums": sums})

        schema = "context long, word long, n long, sums long"
        return _grouped(run, _of(self.merged, _Kind.PAIRED), _of(self.seats, _Kind.SEATS), schema=schema)


def _fit(messages: DataFrame, grid: Grid, sweeps: int) -> Fitted:
    merged = materialize(_grouped(_merge(grid), messages), "merged", by="kind")
    words = _grouped(_first_words, _of(merged, _Kind.KEYS, _Kind.ONCE, _Kind.ASK))
    first = materialize(words, "first-words", by="kind")
    states, seats = [State(first)], None
    for turn in range(sweeps):
        state = states[-1]
        given = [_of(merged, _Kind.PAIRED), _of(state.rows, _Kind.REPLY)]
        if seats is not None:
            given.append(_of(seats, _Kind.SEATS))
        before, seated = seats, _grouped(_seat_pairs(turn, state.customers, state.spread, grid), *given)
        seats = materialize(seated, "seats", by="kind")
        if before is not None:
            discard(before)
        given = [_of(first, _Kind.KEYS, _Kind.ASKED), _of(seats, _Kind.SUMS), _of(state.rows, _Kind.ROOT)]
        words = _grouped(_seat_words(turn, state.tables, state.n_words), *given)
        states.append(State(materialize(words, "words", by="kind"), first))
        if 0 < turn <= BURN_IN:
            discard(state.rows)
    return Fitted(merged, first, seats, states[BURN_IN + 1 :])


def fit(counts: DataFrame, sweeps: int = BURN_IN + SAMPLES) -> tuple[DataFrame, list[State]]:
    """Seated pairs with their tables summed over the samples, and the samples' states.

    ``counts`` are ``context, word, n``. The pairs are those seen more than once; ``sums`` covers the sweeps after
    ``BURN_IN``.
    """
    grid = Grid.of(counts.count() / CELL_ROWS)
    fitted = _fit(counts.select("context", "word", "n").mapInArrow(_counted_rows(grid), ROW), grid, sweeps)
    return fitted.pairs(), fitted.samples


def predictive(n, sums, customers, tables: list, p: list):
    """Probability of words after contexts: own customers, then what the context leaves to the parent.

    ``sums`` are a pair's tables over all samples, ``tables`` and ``p`` the context's and the parent's
    probability in each. A context without customers leaves everything.
    """
    rest = customers + STRENGTH
    total = (n - sums * (DISCOUNT / len(p))) / rest
    for own, above in zip(tables, p, strict=True):
        total = total + (own * DISCOUNT + STRENGTH) / rest * above / len(p)
    return total


def _log_p(counts: DataFrame, pairs: DataFrame, samples: list[State]) -> DataFrame:
    """``context, word, known, log_p`` of all pairs of a frame of counts."""
    # One table in every sample, or none.
    others = counts.where("n < 2").withColumn("sums", F.col("n") * len(samples))
    found = pairs.select("context", "word", "n", "sums").unionByName(others.select("context", "word", "n", "sums"))
    tables, p = [], []
    for i, s in enumerate(samples):
        contexts = s.contexts.select("context", F.col("customers").alias(f"c{i}"), F.col("tables").alias(f"t{i}"))
        above = parent(F.col("k"), F.col("root_tables"), s.customers, s.spread)
        words = s.words.select("word", F.col("n").alias(f"n{i}"), above.alias(f"p{i}"))
        found = found.join(contexts, "context", "left").join(words, "word", "left")
        tables.append(F.coalesce(f"t{i}", F.lit(0)))
        p.append(F.coalesce(f"p{i}", F.lit(s.spread / (ROOT_STRENGTH + s.customers))))
    chance = predictive(F.col("n"), F.col("sums"), F.coalesce("c0", F.lit(0)), tables, p)
    return found.select("context", "word", F.coalesce("n0", F.lit(0)).alias("known"), F.log10(chance).alias("log_p"))


def _pair_answers(key, table):
    """What a cell answers to blocks."""
    to = key[0].as_py()
    paired, seats, index = _held(table, _Kind.PAIRED, _Kind.SEATS, _Kind.INDEX)
    # Pairs never seen and pairs seen once first.
    n, sums = np.r_[0, 1, paired[0][1][3]], np.r_[0, SAMPLES, seats[0][1][1]]
    return _rows([(block, _Kind.VALUES, to, _packed(n[x], sums[x])) for block, (x,) in index])


def _word_answers(key, table):
    """What a bucket answers to blocks."""
    to = key[0].as_py()
    kept, places, roots = _held(table, _Kind.KEYS, _Kind.PLACES, _Kind.ROOT)
    totals = [*kept[0][1][1:3], *[x for _, root in roots for x in root]]
    return _rows([(block, _Kind.TOTALS, to, _packed(*[x[at] for x in totals])) for block, (at,) in places])


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_OUT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(grid: Grid, n_tokens: int, n_words: int, parents: list[tuple[int, float]]):
    """``parents`` are customers of the parent and what an unseen word weighs there, of each sample."""
    spread = n_tokens + 0.1 * (n_words + 1)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _OUT_ARROW.empty_table()
        sizes, tokens, keys = _unpacked(texts.column("data")[0].as_py())
        keys = keys.view(np.uint64)
        tokens = tokens.astype(np.int32)
        pairs = _Pairs(grid, keys, _contexts(sizes, tokens, keys), tokens)
        values, totals = _held(answers, _Kind.VALUES, _Kind.TOTALS)
        n, sums = _joined([x for _, x in values], 2)
        known, customers, *roots = _joined([x for _, x in totals], 2 + 3 * len(parents))
        if len(n) != len(pairs.cell) or len(known) != len(keys):
            raise RuntimeError("a block's texts and words come from different rows: do not change the input while it is read")
        tables = [x[pairs.context] for x in roots[::3]]
        above = [parent(*x, *of) for *x, of in zip(roots[1::3], roots[2::3], parents, strict=True)]
        chance = predictive(n, sums, customers[pairs.context], tables, [x[pairs.word] for x in above])
        log_p, base = np.log10(chance)[pairs.at], np.log10((known + 0.1) / spread)[tokens]
        first = np.cumsum(sizes) - sizes
        added = [np.add.reduceat(x, first) for x in ((known > 0).astype(np.int64)[tokens], base, log_p)]
        columns = [texts.column(c).combine_chunks().flatten() for c in ("ids", "held_out")]
        return pa.table([*columns, sizes, added[0], np.full(len(sizes), n_tokens), *added[1:]], schema=_OUT_ARROW)

    return run


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Token counts, base score and the model's log10 probability of every text."""
    rows = docs.select("doc_id", "text")
    grid = Grid.of((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / CELL_BYTES)
    merged, first, seats, samples = _fit(
        rows.mapInArrow(releasing(_counted_blocks(block_bytes, grid)), ROW), grid, BURN_IN + SAMPLES
    )
    pairs = _grouped(_pair_answers, _of(merged, _Kind.PAIRED, _Kind.INDEX), _of(seats, _Kind.SEATS))
    # The samples in their order.
    roots = [_of(s.rows, _Kind.ROOT).withColumn("frm", F.lit(i).cast("long")) for i, s in enumerate(samples)]
    words = _grouped(_word_answers, _of(first, _Kind.KEYS), _of(merged, _Kind.PLACES), *roots)
    texts = rows.mapInArrow(releasing(_text_rows(block_bytes)), _TEXTS)
    score = _score(grid, samples[-1].n_tokens, samples[-1].n_words, [(s.customers, s.spread) for s in samples])
    answers = pairs.unionByName(words).withColumnRenamed("to", "block")
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, _OUT)
    return scored.withColumn("perplexity", F.expr("pow(10, -score / n_tokens)"))
