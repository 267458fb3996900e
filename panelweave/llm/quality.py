"""Keep or drop documents by fixed rules and a calibrated n-gram classifier.

Base rules: word and symbol counts, repeated lines and repeated runs of eight words, over
whole texts. The verdict of documents that pass them is logistic regression over hashed
word and byte n-grams, fitted on at most ``TRAIN_ROWS`` labelled quality rows,
calibrated (Platt) on at most ``CALIBRATION_ROWS`` others, and held against a fixed
threshold of the probability, batch by batch.

Missing text has no words and fails the base rules. Labels without a document or
without a quality are ignored; a document labelled both ways counts as poor. Without
labels of both kinds the classifier lets everything pass (probability 1). Repeated rows
are judged alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm.linear import Grams, fit_logistic
from panelweave.llm.text import Chunk, chunks, span_hashes, window_hashes, word_spans

GRAMS = Grams(chars=(3, 5), words=(1, 2), bits=14)
TRAIN_ROWS = 1500
CALIBRATION_ROWS = 750
KEEP_FROM = 0.5
WINDOW = 8
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
INNER = (np.arange(256) & 0xC0) == 0x80  # bytes that do not begin a code point


def repeated_words(hashed: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per text, words inside runs of ``WINDOW`` words that occur twice or more in it."""
    own = window_hashes(hashed, WINDOW)
    if not len(own):
        return np.zeros(n, np.int64)
    at = np.flatnonzero(owner[: len(own)] == owner[WINDOW - 1 :])
    order = at[np.lexsort((own[at], owner[at]))]
    same = (own[order][1:] == own[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    step = np.zeros(len(hashed) + 1, np.int64)
    np.add.at(step, order[twice], 1)
    np.add.at(step, order[twice] + WINDOW, -1)
    covered = np.cumsum(step)[:-1] > 0
    return np.bincount(owner[covered], minlength=n)


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def statistics(chunk: Chunk) -> dict[str, np.ndarray]:
    """The base counts of every text of a chunk."""
    start, end, owner = word_spans(chunk)
    first, last = chunk.offsets[:-1], chunk.offsets[1:]
    points = np.concatenate([[0], np.cumsum(~INNER[chunk.data])])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[chunk.data])])
    return {
        "n_words": np.bincount(owner, minlength=chunk.n),
        "word_chars": np.bincount(
            owner, weights=points[end] - points[start], minlength=chunk.n
        ).astype(np.int64),
        "n_symbols": symbols[last] - symbols[first],
        "n_dup_lines": np.array([repeated_lines(chunk.text(i)) for i in range(chunk.n)]),
        "n_repeat_words": repeated_words(span_hashes(chunk, start, end), owner, chunk.n),
    }


class Model:
    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def probability(self, chunk: Chunk) -> np.ndarray:
        z = GRAMS.scores(chunk, self.weights)[:, 0] + self.bias
        return 1 / (1 + np.exp(-(self.slope * z + self.shift).clip(-30, 30)))


def _calibrate(z: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt's sigmoid, with his softened targets, by Newton steps."""
    good, poor = truth.sum(), (1 - truth).sum()
    target = np.where(truth > 0.5, (good + 1) / (good + 2), 1 / (poor + 2))
    x = np.stack([z, np.ones_like(z)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ theta).clip(-30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(bend, x.T @ (p - target))
        theta = theta - move * min(1.0, 2.0 / (np.abs(move).max() + 1e-12))
    return float(max(theta[0], 1e-3)), float(theta[1])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            rows = GRAMS.sparse(chunk)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rank").slice(chunk.first, chunk.n),
                    batch.column("quality").slice(chunk.first, chunk.n),
                    pa.array([r[0].tobytes() for r in rows], pa.binary()),
                    pa.array([r[1].tobytes() for r in rows], pa.binary()),
                ],
                names=["rank", "quality", "columns", "values"],
            )


def fit(
    docs: DataFrame, labels: DataFrame, train: int = TRAIN_ROWS, calibration: int = CALIBRATION_ROWS
) -> Model | None:
    """A model from labelled documents; None without labels of both kinds.

    The sample is the ``train + calibration`` labelled ids with the smallest hashes.
    """
    marks = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .withColumn("rank", F.xxhash64("doc_id"))
        .orderBy("rank", "doc_id")
        .limit(train + calibration)
    )
    # Of rows that share an id one is taken, so the sample is as small as said.
    texts = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    texts = texts.groupBy("rank", "doc_id", "quality").agg(F.min("text").alias("text"))
    found = (
        texts.select("rank", "quality", "text")
        .mapInArrow(_features, "rank long, quality int, columns binary, values binary")
        .toArrow()
        .sort_by([("rank", "ascending"), ("quality", "ascending")])
    )
    truth = np.array(found.column("quality").to_pylist(), dtype=np.float64)
    rows = [
        (np.frombuffer(c, np.int32), np.frombuffer(v, np.float32))
        for c, v in zip(found.column("columns").to_pylist(), found.column("values").to_pylist(), strict=True)
    ]
    cut = max(1, len(rows) * train // (train + calibration))
    if len(set(truth[:cut])) < 2:
        return None
    weights, bias = fit_logistic(rows[:cut], truth[:cut, None], GRAMS.width)
    z = np.array([v.astype(np.float64) @ weights[c, 0] for c, v in rows[cut:]]) + bias[0]
    slope, shift = _calibrate(z, truth[cut:]) if len(set(truth[cut:])) == 2 else (1.0, 0.0)
    return Model(weights, float(bias[0]), slope, shift)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``probability`` and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                counts = statistics(chunk)
                n_words = counts["n_words"]
                failed = (n_words < 20) | (100 * counts["n_repeat_words"] > 30 * n_words)
                good = np.ones(chunk.n) if own is None else own.probability(chunk)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, chunk.n),
                        *[pa.array(counts[c].astype(np.int64)) for c in COUNTS],
                        pa.array(failed),
                        pa.array(good),
                        pa.array(~failed & (good >= keep_from)),
                    ],
                    names=["doc_id", *COUNTS, "base_failed", "probability", "kept"],
                )

    schema = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id long, {schema}, base_failed boolean, probability double, kept boolean"
    )
