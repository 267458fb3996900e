"""Linear models over hashed n-grams: features, fitting on a sample, scoring in Arrow batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from panelweave.llm.text import Chunk, mix, span_hashes, window_hashes, word_spans


@dataclass(frozen=True)
class Grams:
    """Which n-grams are counted, each kind in its own ``1 << bits`` columns.

    ``chars`` are lengths in bytes of UTF-8, ``words`` lengths in words. A text's value
    for a column is the column's share among the text's n-grams of that kind, times
    ``scale``.
    """

    chars: tuple[int, ...]
    words: tuple[int, ...] = ()
    bits: int = 14
    scale: float = 32.0

    @property
    def width(self) -> int:
        return (len(self.chars) + len(self.words)) << self.bits

    def indices(self, chunk: Chunk):
        """For each kind: column of every n-gram and the text it is from."""
        shift = np.uint64(64 - self.bits)
        size = len(chunk.data)
        starts, ends = chunk.offsets[:-1], chunk.offsets[1:]
        kind = 0
        if self.chars:
            owner = np.repeat(np.arange(chunk.n), ends - starts)
            eights = np.ndarray((size,), "<u8", chunk.padded.tobytes(), 0, (1,))
            for n in self.chars:
                valid = np.ones(size, dtype=bool)
                for k in range(1, n):
                    valid[(ends - k)[ends - k >= starts]] = False
                value = (eights[valid] << np.uint64(64 - 8 * n)) * np.uint64(0x9E3779B97F4A7C15)
                column = ((value ^ (value >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)) >> shift
                yield column.astype(np.int64) + (kind << self.bits), owner[valid]
                kind += 1
        if self.words:
            start, end, owner = word_spans(chunk)
            hashed = span_hashes(chunk, start, end)
            for n in self.words:
                own = window_hashes(hashed, n)
                same = owner[: len(own)] == owner[n - 1 :] if len(own) else np.empty(0, bool)
                column = (mix(own[same]) >> shift).astype(np.int64)
                yield column + (kind << self.bits), owner[: len(own)][same]
                kind += 1

    def sparse(self, chunk: Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
        """Columns and values of every text."""
        keys, values = [], []
        for column, owner in self.indices(chunk):
            key, n = np.unique(owner * self.width + column, return_counts=True)
            total = np.bincount(owner, minlength=chunk.n)
            keys.append(key)
            values.append(n * self.scale / total[key // self.width])
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        cut = np.searchsorted(key, np.arange(chunk.n + 1) * self.width)
        return [
            ((key[a:b] % self.width).astype(np.int32), value[a:b].astype(np.float32))
            for a, b in zip(cut[:-1], cut[1:], strict=True)
        ]

    def scores(self, chunk: Chunk, weights: np.ndarray) -> np.ndarray:
        """Texts times models: sum of value times weight, whole texts."""
        out = np.zeros((chunk.n, weights.shape[1]))
        for column, owner in self.indices(chunk):
            total = np.maximum(np.bincount(owner, minlength=chunk.n), 1)
            for model in range(weights.shape[1]):
                own = np.bincount(owner, weights=weights[column, model], minlength=chunk.n)
                out[:, model] += own * self.scale / total
        return out


def fit_logistic(
    rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, width: int,
    steps: int = 120, rate: float = 0.1, penalty: float = 1e-4,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (width x models) and intercepts by full-batch Adam; targets are 0 or 1.

    The rows are a bounded sample. Rows of either class weigh the same in total.
    """
    models = targets.shape[1]
    column = np.concatenate([r[0] for r in rows]).astype(np.int64)
    value = np.concatenate([r[1] for r in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    used, column = np.unique(column, return_inverse=True)
    weights, bias = np.zeros((len(used), models)), np.zeros(models)
    share = targets.mean(axis=0).clip(1e-6, 1 - 1e-6)
    balance = np.where(targets > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(rows)
    first = [np.zeros_like(weights), np.zeros_like(bias)]
    second = [np.zeros_like(weights), np.zeros_like(bias)]
    for step in range(1, steps + 1):
        z = np.empty((len(rows), models))
        for m in range(models):
            z[:, m] = np.bincount(row, weights=value * weights[column, m], minlength=len(rows))
        gap = (1 / (1 + np.exp(-(z + bias).clip(-30, 30))) - targets) * balance
        slope = penalty * weights
        for m in range(models):
            slope[:, m] += np.bincount(column, weights=value * gap[row, m], minlength=len(used))
        for k, (what, g) in enumerate(((weights, slope), (bias, gap.sum(axis=0)))):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            what -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-9)
    full = np.zeros((width, models), np.float32)
    full[used] = weights
    return full, bias
