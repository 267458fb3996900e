"""Language of texts by error-correcting output codes.

Every language has a codeword; one binary n-gram classifier per bit says on which side
of that bit a text lies; the codeword with the least loss over all bits, each weighted by
how well its classifier separates the training rows, is the prediction. A text is
ambiguous when the loss of the second codeword is not clearly above that of the best.

The classifiers are fitted on at most ``ROWS_PER_LANGUAGE`` labelled rows of every
language (those with the smallest hash of their place), whole texts. Missing texts and
texts without a letter are ``und`` with score 0, as is everything if no row has a label;
with a single language every other text is that language. Missing ``doc_id`` counts as
empty text for the fold. ``lang``, ``source`` and ``doc_id`` are no inputs of a
prediction. Repeated rows are rows of their own; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.llm.linear import Grams, fit_logistic
from panelweave.llm.rows import located
from panelweave.llm.text import chunks
from panelweave.llm.workers import releasing

GRAMS = Grams(chars=(1, 2, 3), bits=12)
ROWS_PER_LANGUAGE = 250
UNKNOWN = "und"
#: Difference in loss to the second language below which a text is ambiguous. It does not
#: depend on the number of languages; of two, the scores then are 0.55 and 0.45.
LEAD = float(np.log(0.55 / 0.45))


def fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo a number."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def codewords(n: int) -> np.ndarray:
    """Codewords of +1 and -1, one row per language.

    All splits of up to six languages; beyond, the best of random codes of
    ``10 log2 n`` bits, by least distance between any two rows.
    """
    if n <= 6:
        bits = [b for b in product((1, -1), repeat=n) if b[0] == 1 and -1 in b]
        return np.array(bits, dtype=np.int8).reshape(len(bits), n).T
    length, random, best, widest = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7), None, -1
    for _ in range(200):
        code = random.choice(np.array([1, -1], np.int8), size=(n, length))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        far = min(int((code[i] != code[i + 1 :]).sum(axis=1).min()) for i in range(n - 1))
        if far > widest:
            best, widest = code, far
    return best


class Model:
    def __init__(self, languages: list[str], code, weights, bias, trust):
        self.languages, self.code = languages, code
        self.weights, self.bias, self.trust = weights, bias, trust

    def predict(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and loss below that of the second, from margins of all bits."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust
        # A language differs from another in about half of the bits.
        z = -loss.sum(axis=2) / max(1.0, self.trust.sum() / 2)
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        # The best has z = 0.
        lead = -np.sort(z, axis=1)[:, -2] if z.shape[1] > 1 else np.full(len(z), np.inf)
        return p.argmax(axis=1), p.max(axis=1), lead


_SAMPLE = pa.schema([("lang", pa.string()), ("columns", pa.binary()), ("values", pa.binary())])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text"), lower=True):
            rows = GRAMS.sparse(chunk)
            yield pa.record_batch(
                [
                    batch.column("lang").slice(chunk.first, chunk.n).cast(pa.string()),
                    pa.array([r[0].tobytes() for r in rows], pa.binary()),
                    pa.array([r[1].tobytes() for r in rows], pa.binary()),
                ],
                schema=_SAMPLE,
            )


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """A model from rows with a language outside the held-out fold; None without any."""
    labelled = (fold(4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    rows = located(docs, "doc_id", "text", "lang").where(labelled)
    place = F.xxhash64("file", "place")
    first = Window.partitionBy("lang").orderBy(place, "file", "place")
    chosen = (
        rows.select("lang", "file", "place")
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= rows_per_language)
        .select("file", "place")
    )
    # At most rows_per_language rows of every language.
    sample = rows.join(F.broadcast(chosen), ["file", "place"]).select("lang", "text")
    found = sample.mapInArrow(releasing(_features), "lang string, columns binary, values binary").toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    if not languages:
        return None
    code = codewords(len(languages))
    features = [
        (np.frombuffer(c, np.int32), np.frombuffer(v, np.float32))
        for c, v in zip(found.column("columns").to_pylist(), found.column("values").to_pylist(), strict=True)
    ]
    truth = np.array([languages.index(x) for x in found.column("lang").to_pylist()])
    if len(languages) == 1:
        return Model(languages, np.ones((1, 0), np.int8), np.zeros((GRAMS.width, 0)), np.zeros(0), np.zeros(0))
    targets = (code[truth] > 0).astype(np.float64)
    weights, bias = fit_logistic(features, targets, GRAMS.width)
    margins = np.array([v.astype(np.float64) @ weights[c] for c, v in features]) + bias
    right = ((margins > 0) == (targets > 0.5)).mean(axis=0)
    return Model(languages, code, weights, bias, np.clip(2 * right - 1, 0.01, 1.0))


def predict(docs: DataFrame, model: Model | None, *columns: str) -> DataFrame:
    """``lang_pred, score, ambiguous`` after the named columns, for every row."""
    kept = docs.select(*columns).schema
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields])
    schema = f"{out}, lang_pred string, score double, ambiguous boolean"
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*columns, F.col("text").alias("__text"), letters.alias("__letters"))
    if model is None:
        return rows.select(
            *columns, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(False).alias("ambiguous"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.languages, UNKNOWN], dtype=object)
        for batch in batches:
            n = batch.num_rows
            best, sure, lead = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            for chunk in chunks(batch.column("__text"), lower=True):
                at = slice(chunk.first, chunk.first + chunk.n)
                margins = GRAMS.scores(chunk, own.weights) + own.bias
                best[at], sure[at], lead[at] = own.predict(margins)
            known = np.array(batch.column("__letters").to_pylist(), dtype=bool)
            pred = names[np.where(known, best, len(own.languages))]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(columns))],
                    pa.array(pred.tolist(), pa.string()),
                    pa.array(np.where(known, sure, 0.0)),
                    pa.array(known & (lead < LEAD)),
                ],
                names=[*columns, "lang_pred", "score", "ambiguous"],
            )

    return rows.mapInArrow(releasing(score), schema)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` of every document."""
    found = predict(docs, fit(docs), "doc_id")
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
