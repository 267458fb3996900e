"""Passages grow as far as a word-by-word comparison of whole texts says."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

pa = pytest.importorskip("pyarrow")
from panelweave.llm import near, substring_dedup  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLACES = ("start", "stop", "keep_start", "keep_stop")
SCHEMA = pa.schema(
    [("row", pa.int64()), ("keep_row", pa.int64()), ("text", pa.string()), ("keep_text", pa.string()),
     ("spans", pa.list_(pa.struct([(c, pa.int32()) for c in PLACES] + [("label", pa.int64())])))]
)


def written(words, chance):
    return "".join(w + chance.choice([" ", " ", "  ", "\n", "\t"]) for w in words)


def expected(a, b, i, k, n):
    wa, wb = ([m.span() for m in WORD.finditer(x)] for x in (a, b))
    la, lb = ([x[s:e].lower() for s, e in w] for x, w in ((a, wa), (b, wb)))
    j, m = i + n - 1, k + n - 1
    while i > 0 and k > 0 and la[i - 1] == lb[k - 1]:
        i, k = i - 1, k - 1
    while j + 1 < len(la) and m + 1 < len(lb) and la[j + 1] == lb[m + 1]:
        j, m = j + 1, m + 1
    return wa[i][0], wa[j][1], wb[k][0], wb[m][1]


def test_growth_equals_word_by_word():
    chance = random.Random(11)
    rows, wanted = [], []
    for number in range(400):
        vocabulary = chance.choice([["a", "b"], ["aa", "Bb", "cd"], [f"w{i}" for i in range(90)]])
        words = [chance.choice(vocabulary) for _ in range(chance.randint(3, 120))]
        other = [w.upper() if chance.random() < 0.05 else w for w in words]
        for _ in range(chance.randint(0, 3)):
            other[chance.randrange(len(other))] = chance.choice(vocabulary)
        a = written(words, chance)
        b = a if chance.random() < 0.2 else written(other, chance)
        wa, wb = ([m.span() for m in WORD.finditer(x)] for x in (a, b))
        spans = []
        for _ in range(20):
            i = chance.randrange(len(wa))
            k = min(max(i + chance.randint(-1, 1), 0), len(wb) - 1)
            if a[slice(*wa[i])].lower() != b[slice(*wb[k])].lower():
                continue
            label = len(wanted)
            spans.append(dict(zip(PLACES, (*wa[i], *wb[k]), strict=True)) | {"label": label})
            wanted.append((number, -number - 1, *expected(a, b, i, k, 1), label))
        rows.append({"row": number, "keep_row": -number - 1, "text": a, "keep_text": b, "spans": spans})
    batch = pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
    found = [tuple(r.values()) for b in substring_dedup._extend([batch]) for r in b.to_pylist()]
    assert len(found) > 2000 and found == wanted


def test_passages_of_one_text_do_not_grow_into_each_other():
    text = "a a a a a a a a"
    span = {"start": 10, "stop": 11, "keep_start": 2, "keep_stop": 3, "label": 7}
    batch = pa.RecordBatch.from_pylist(
        [{"row": 1, "keep_row": 1, "text": text, "keep_text": text, "spans": [span]}], schema=SCHEMA
    )
    (found,) = [r for b in substring_dedup._extend([batch]) for r in b.to_pylist()]
    assert found["keep_stop"] < found["start"]


def test_first_least_is_the_first_smallest_of_every_run():
    random = np.random.default_rng(3)
    for size in (1, 2, 5, 21):
        for values in (1, 3, 10**6):
            value = random.integers(0, values, 300).astype(np.uint64)
            runs = np.lib.stride_tricks.sliding_window_view(value, size)
            expected = runs.argmin(axis=1) + np.arange(len(runs))
            assert substring_dedup.first_least(value, size).tolist() == expected.tolist()


def test_links_of_open_keys_join_labels_not_items():
    text = "one two three four five six seven eight nine ten"
    columns = {
        "key": pa.array([7, 7, 7]), "low": pa.array([0, 0, 0], pa.int32()), "high": pa.array([0, 0, 0], pa.int32()),
        "item": pa.array([21, 22, 23]), "label": pa.array([11, 12, 12]), "text": pa.array([text] * 3),
    }
    link = near._link_groups(False, near.SIMILAR)
    found = [b for batch in link(pa.table(columns).to_batches()) for b in batch.to_pylist()]
    assert found == [{"a": 11, "b": 12}]


def test_classes_that_open_keys_join_bear_the_smallest_item(spark):
    texts = {
        1: "a b c d e f g h i j k l m n o p q r s t",
        2: "z y x w v u z y x w v u t s r q p o n m",
        3: "z y x w v u z y x w v u t s r q p o n m",
        4: "a b c d e f g h i j k l m n o p q r s t",
        5: "z y x w v u z y x w v u t s r q p o n m",
        6: "a b c d e f g h i j k l m n o p q r s t",
    }
    # 2 is compared with 1 alone; only the open key 8 tells that it equals 3 and 5, 1 that it equals 4 and 6.
    keys = {1: [8], 2: [8], 3: [8, 9], 4: [8, 10], 5: [9], 6: [10]}
    items = spark.createDataFrame([(i, 16, keys[i]) for i in texts], "item long, weight long, keys array<long>")
    held = spark.createDataFrame(list(texts.items()), "item long, text string")
    found = near.classes(items, lambda wanted: held.join(wanted, "item"), False)
    assert dict(map(tuple, found.collect())) == {1: 1, 4: 1, 6: 1, 2: 2, 3: 2, 5: 2}
