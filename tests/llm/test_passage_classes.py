"""Classes of passages are joined from few nodes, and texts without passages stay out of the shuffles."""

from __future__ import annotations

import random

import numpy as np
import pytest

pa = pytest.importorskip("pyarrow")
from panelweave.llm import near, substring_dedup  # noqa: E402
from panelweave.llm.text import chunks, span_hashes, word_spans  # noqa: E402
from panelweave.llm.workers import ship  # noqa: E402


def some(n, seed):
    chance = random.Random(seed)
    return [f"w{chance.randrange(10**9)}" for _ in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    ship(spark)
    a, b, c = (some(400, k) for k in range(3))
    # Rows 4 and 6 join the passages of 1 and 3 by windows over the end of one and the start of the other.
    both = a[-200:] + b[:200]
    texts = [a + some(50, 10), some(50, 11) + a, b + some(50, 12), some(30, 13) + both, b, both, c]
    return spark.createDataFrame([(k + 1, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")


def test_runs_of_windows_are_joined_not_windows(frame, monkeypatch):
    links, components = [], near.components

    def counted(edges):
        links.append(edges.count())
        return components(edges)

    monkeypatch.setattr(substring_dedup, "components", counted)
    found = [r for r in substring_dedup.repeated_passages(frame).collect() if r.kind == "passage"]
    assert {r.doc_id for r in found} == {1, 2, 3, 4, 5, 6}
    assert len({r.class_id for r in found}) == 1 and {r.class_size for r in found} == {len(found)}
    assert {(r.doc_id, r.keep_doc_id) for r in found if not r.kept} == {
        (2, 1), (4, 1), (4, 3), (5, 3), (6, 1), (6, 3), (6, 4)
    }
    # Hundreds of windows, but one run that is kept in row 1, one in row 3 and what lies over their border.
    assert len(links) == 1 and links[0] <= 2


def test_texts_without_passages_are_not_shuffled(frame, monkeypatch):
    plans, materialize = {}, substring_dedup.materialize

    def noted(rows, name, *by):
        plans.setdefault(name, []).append(rows._jdf.queryExecution().optimizedPlan().toString())
        return materialize(rows, name, *by)

    monkeypatch.setattr(substring_dedup, "materialize", noted)
    assert substring_dedup.repeated_passages(frame).count() > 0
    # Spark would run a semi-join before the Bloom filter and shuffle every text for it.
    assert not [name for name, found in plans.items() for plan in found if "LeftSemi" in plan]
    assert "passages" in plans


def test_growth_within_a_text_equals_word_by_word():
    chance = random.Random(5)
    for _ in range(500):
        words = [chance.choice("ab") if chance.random() < 0.2 else "a" for _ in range(chance.randint(2, 150))]
        starts, stops = [2 * k for k in range(len(words))], [2 * k + 1 for k in range(len(words))]
        m, i = sorted(chance.sample(range(len(words)), 2))
        k, j = chance.randint(0, m), chance.randint(i, len(words) - 1)
        found = substring_dedup._grown_within(words, starts, stops, starts[i], stops[j], starts[k], stops[m])
        while k > 0 and i - 1 > m and words[i - 1] == words[k - 1]:
            i, k = i - 1, k - 1
        while j + 1 < len(words) and m + 1 < i and words[j + 1] == words[m + 1]:
            j, m = j + 1, m + 1
        assert found == (starts[i], stops[j], starts[k], stops[m])


def test_keys_of_a_line_do_not_depend_on_its_neighbours():
    lines = [" ".join(some(n, k)) for k, n in enumerate((5, 6, 7, 30, 4, 5))]

    def keys(texts):
        found = {}
        for chunk in chunks(pa.array(texts), lower=True):
            start, end, owner = word_spans(chunk)
            out = substring_dedup.lines(chunk, start, end, owner, span_hashes(chunk, start, end), 8, 3)
            for digest, key in zip(out[3].tolist(), out[5].tolist(), strict=True):
                found[digest] = key
        return found

    alone, together = keys(lines), keys(["\n".join(lines), "\n\n".join(lines)])
    assert len(alone) == 5 and alone.items() <= together.items() and len(together) == 6


def test_order_by_text_and_value():
    numbers = np.random.default_rng(2)
    for texts in (1, 7, 1 << 17):
        value, text = numbers.integers(0, 50, 2000).astype(np.uint64), numbers.integers(0, texts, 2000)
        order, plain = near.by_text(value, text), np.lexsort((value, text))
        assert sorted(order.tolist()) == list(range(2000))
        assert (value[order] == value[plain]).all() and (text[order] == text[plain]).all()
    assert near.by_text(np.empty(0, np.uint64), np.empty(0, np.int64)).tolist() == []
