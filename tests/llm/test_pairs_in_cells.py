"""Counting and scoring of word pairs in cells, against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from panelweave.llm import pitman_yor
from panelweave.llm.workers import ship

WORDS = [f"w{k}" for k in range(300)]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    share = 1 / np.arange(1, 301)
    return [(i, " ".join(rng.choice(WORDS, 120, p=share / share.sum()))) for i in range(200)]


def test_no_row_per_pair_is_written(spark, texts, tmp_path, monkeypatch):
    ship(spark)
    monkeypatch.setattr("panelweave.sources.scratch.shared_dir", lambda spark: str(tmp_path))
    found = pitman_yor.score_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    trained = [t.split() + ["."] for i, t in texts if zlib.crc32(str(i).encode()) % 10]
    n = Counter(w for t in trained for w in t)
    pairs = {p for t in trained for p in zip([None, *t], t)}
    rows = sum(pq.read_metadata(f).num_rows for f in tmp_path.rglob("*.parquet"))
    assert 0 < rows < len(pairs) / 4
    spread = sum(n.values()) + 0.1 * (len(n) + 1)
    for r in found:
        tokens = dict(texts)[r.doc_id].split() + ["."]
        assert (r.n_tokens, r.train_tokens) == (len(tokens), sum(n.values()))
        assert r.n_known == sum(n[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((n[w] + 0.1) / spread) for w in tokens))


def test_counts_of_many_blocks_and_cells(spark, monkeypatch):
    """However the rows are dealt out, pairs, contexts and words add up."""
    ship(spark)
    rng = np.random.default_rng(5)
    key = pitman_yor.mix(np.arange(60, dtype=np.uint64)).view(np.int64).tolist()
    # One context has most pairs.
    rows = [(key[0] if rng.random() < 0.6 else key[int(rng.integers(60))], key[int(rng.integers(60))], int(rng.integers(4)))
            for _ in range(900)]
    monkeypatch.setattr(pitman_yor, "CELL_ROWS", 60)
    pairs, contexts, words = Counter(), Counter(), Counter()
    for c, w, n in rows:
        pairs[c, w] += n
        contexts[c] += n
        words[w] += n
    counts = spark.createDataFrame(rows, "context long, word long, n long").repartition(5)
    seated, samples = pitman_yor.fit(counts)
    found = {(r.context, r.word): (r.n, r.sums) for r in seated.collect()}
    assert {p: n for p, (n, _) in found.items()} == {p: n for p, n in pairs.items() if n > 1}
    assert all(len(samples) <= s <= len(samples) * n for n, s in found.values())
    for s in samples:
        assert {r.context: r.customers for r in s.contexts.collect()} == {c: n for c, n in contexts.items() if n}
        assert {r.word: r.n for r in s.words.collect()} == {w: n for w, n in words.items() if n}
        # Tables of all contexts are the customers of the parent.
        assert sum(r.tables for r in s.contexts.collect()) == s.customers == sum(r.k for r in s.words.collect())


def test_a_hot_context_lies_in_many_cells():
    grid = pitman_yor.Grid.of(100)
    keys = np.unique(pitman_yor.mix(np.arange(5000, dtype=np.uint64)))
    cells = grid.cells(np.full(len(keys), keys[7]), keys)
    assert np.bincount(cells).max() < 1.5 * len(keys) / grid.across
    buckets = grid.sliced(keys)
    assert [a for _, a, _ in buckets] == [0, *[b for _, _, b in buckets[:-1]]] and buckets[-1][2] == len(keys)


def test_whole_numbers_in_bytes():
    for x in ([], [0, 0], [1, 255, 256], [1 << 40, 3], [2**64 - 1, 0]):
        (back,) = pitman_yor._unpacked(pitman_yor._packed(np.array(x, np.uint64)))
        assert back.view(np.uint64).tolist() == x
