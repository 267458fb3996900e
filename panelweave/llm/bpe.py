"""Encode texts through a table of distinct words, and decode through a table of pieces by id.

Texts are cut at the tokenizer's added tokens first, and between them where the tokenizer's own splitting always cuts: before a run of
non-blanks with the one space before it, and around runs of blanks. Documents of one
task are gathered into blocks of about ``BLOCK_BYTES``; a block travels as the positions
of its words in its own word list, short numbers for frequent words. Word lists are
shuffled by buckets of words, each distinct word of a bucket is encoded once, and its ids
return to the blocks that hold it, where they are joined to the positions. Decoding is an
array lookup of every id's piece in that same task, not a join in Spark. So a
word crosses the network once per block, not once per occurrence, however common it is.

Missing text is empty and has no ids. Missing or repeated ``doc_id`` are carried along.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 24 << 20
#: What Unicode calls white space, as the tokenizer's patterns read it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNITS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=2)
def piece_table(path: str) -> list[bytes]:
    """Bytes of every id's piece, by id; special tokens are their own text.

    Byte-level vocabularies write the 256 bytes as printable characters.
    """
    tokenizer = _tokenizer(path)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
    special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    pieces = [b""] * tokenizer.get_vocab_size()
    for piece, i in tokenizer.get_vocab().items():
        pieces[i] = (
            special[i].encode() if i in special else bytes(byte_of[c] for c in piece)
        )
    return pieces


@lru_cache(maxsize=2)
def _added(path: str) -> re.Pattern | None:
    """The added tokens, which the tokenizer takes out of a text before all else."""
    added = _tokenizer(path).get_added_tokens_decoder().values()
    for t in added:
        if t.lstrip or t.rstrip or t.single_word:
            raise ValueError(f"the added token {t.content!r} takes in or depends on its neighbours")
    longest = sorted((t.content for t in added), key=len, reverse=True)
    return re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None


def units(text: str, added: re.Pattern | None) -> list[str]:
    """Pieces of a text that the tokenizer encodes each by itself."""
    if added is None or not added.search(text):
        return UNITS.findall(text)
    found = []
    for k, part in enumerate(added.split(text)):
        found += [part] if k % 2 else UNITS.findall(part)
    return found


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in groups of seven bits, the lowest first; small numbers are short."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in (7, 14, 21, 28):
        size += values >= (1 << k)
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        own = size > k
        more = (size[own] > k + 1).astype(np.uint64) << np.uint64(7)
        out[first[own] + k] = ((values[own] >> np.uint64(7 * k)) & np.uint64(0x7F)) | more
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 0x80)
    first = np.r_[0, last[:-1] + 1] if len(last) else last
    values = np.zeros(len(last), np.int64)
    for k in range(int((last - first).max(initial=-1)) + 1):
        own = first + k <= last
        values[own] |= (raw[first[own] + k] & 0x7F).astype(np.int64) << (7 * k)
    return values


class _Block:
    def __init__(self, number: int, added: re.Pattern | None):
        self.number, self.size, self.added = number, 0, added
        self.words: dict[str, int] = {}
        self.ids: list = []
        self.at: list[np.ndarray] = []

    def add(self, doc_id, text: str) -> None:
        words = self.words
        put = words.setdefault
        self.at.append(np.array([put(u, len(words)) for u in units(text, self.added)], np.uint32))
        self.ids.append(doc_id)
        self.size += len(text)

    def ranks(self) -> np.ndarray:
        """Number of every word by how often it occurs here, the most frequent first."""
        often = np.bincount(np.concatenate(self.at), minlength=len(self.words))
        rank = np.empty(len(self.words), np.int64)
        rank[np.argsort(-often, kind="stable")] = np.arange(len(self.words))
        return rank


def _blocks(batches: Iterator[pa.RecordBatch], size: int, path: str) -> Iterator[_Block]:
    number = TaskContext.get().partitionId() << 24
    added = _added(path)
    block = _Block(number, added)
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            block.add(doc_id.as_py(), text.as_py() or "")
            if block.size >= size:
                yield block
                number += 1
                block = _Block(number, added)
    if block.ids:
        yield block


WORDS = "bucket int, block long, at binary, sizes binary, words binary"


def _word_rows(size: int, buckets: int, path: str):
    """The distinct words of a block, in order, as one row for each bucket of words."""

    def emit(batches):
        for block in _blocks(batches, size, path):
            rank = block.ranks()
            words = sorted(block.words)
            at = rank[[block.words[w] for w in words]] if words else rank
            coded = [w.encode() for w in words]
            bucket = np.array([zlib.crc32(w) % buckets for w in coded], np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[b] : cuts[b + 1]]
                part = [coded[i] for i in own]
                rows.append((b, block.number, packed(at[own]), packed(np.array([len(w) for w in part])), b"".join(part)))
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["bucket", "block", "at", "sizes", "words"],
                )

    return emit


def _text_rows(size: int, path: str):
    def emit(batches):
        for block in _blocks(batches, size, path):
            rank = block.ranks()
            for first in range(0, len(block.ids), 1000):
                rows = block.at[first : first + 1000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), block.number)),
                        pa.array(np.full(len(rows), len(block.words), dtype=np.int32)),
                        pa.array(block.ids[first : first + 1000], pa.int64()),
                        pa.array([packed(rank[r]) for r in rows], pa.binary()),
                    ],
                    names=["block", "n_words", "doc_id", "positions"],
                )

    return emit


def _cut(data: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _encode_words(path: str):
    """Ids of the words of each row; a word of several blocks is encoded once."""

    def encode(batches):
        tokenizer, kind = _tokenizer(path), _id_type(path)
        bucket, known = None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket or len(known) > 1_000_000:
                    bucket, known = row["bucket"], {}
                words = _cut(row["words"], unpacked(row["sizes"]))
                fresh = [w for w in words if w not in known]
                coded = tokenizer.encode_batch_fast([w.decode() for w in fresh], add_special_tokens=False)
                for word, e in zip(fresh, coded, strict=True):
                    known[word] = np.array(e.ids, kind).tobytes()
                ids = [known[w] for w in words]
                sizes = np.array([len(x) for x in ids]) // kind.itemsize
                out.append((row["block"], row["at"], packed(sizes), b"".join(ids)))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                    names=["block", "at", "sizes", "ids"],
                )

    return encode


def _id_type(path: str) -> np.dtype:
    return np.dtype("<u2" if _tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4")


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
)


def _ragged(values: np.ndarray, cuts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[cuts[r]:cuts[r + 1]]`` for all ``rows``."""
    size = cuts[rows + 1] - cuts[rows]
    total = int(size.sum())
    begin = np.cumsum(size) - size
    return values[np.repeat(cuts[rows] - begin, size) + np.arange(total)]


def _join_ids(path: str, digests: bool):
    def join(texts: pa.Table, words: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _schema(digests).empty_table()
        n_words = texts.column("n_words")[0].as_py()
        kind = _id_type(path)
        rows = words.to_pylist()
        at = np.concatenate([unpacked(r["at"]) for r in rows]) if rows else np.empty(0, np.int64)
        size = np.concatenate([unpacked(r["sizes"]) for r in rows]) if rows else at
        found = np.frombuffer(b"".join([r["ids"] for r in rows]), kind).astype("<u4")
        order = np.argsort(at, kind="stable")
        if len(at) != n_words or (n_words and (at[order] != np.arange(n_words)).any()):
            raise RuntimeError(
                "texts and words of a block differ: the input must not change while it is read"
            )
        begin = np.r_[0, np.cumsum(size)]
        ids = _ragged(found, begin, order)
        cuts = np.r_[0, np.cumsum(size[order])].astype(np.int64)
        pieces = piece_table(path)
        body = np.frombuffer(b"".join(pieces), np.uint8)
        piece_cuts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        rows = []
        for doc_id, positions in zip(texts.column("doc_id"), texts.column("positions"), strict=True):
            own = _ragged(ids, cuts, unpacked(positions.as_py()))
            decoded = _ragged(body, piece_cuts, own.astype(np.int64)).tobytes()
            # What is no UTF-8 is decoded to replacement characters.
            text = decoded.decode("utf-8", "replace").encode()
            coded = own.tobytes()
            if digests:
                coded = hashlib.sha256(coded).hexdigest()
                text = hashlib.sha256(text).hexdigest()
            rows.append((doc_id.as_py(), len(own), coded, text))
        columns = list(zip(*rows, strict=True))
        return pa.table(
            [pa.array(c, f.type) for c, f in zip(columns, _schema(digests), strict=True)],
            schema=_schema(digests),
        )

    return join


def _schema(digests: bool) -> pa.Schema:
    if not digests:
        return _OUT
    return pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()),
         ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )


def encode_decode(
    docs: DataFrame, tokenizer_path: str, digests: bool = False, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_tokens`` and the ids and decoded text of every document.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` is UTF-8; with
    ``digests`` their lower-case hexadecimal SHA-256 instead, as ``ids_sha256`` and
    ``decoded_sha256``.
    """
    rows = docs.select("doc_id", "text")
    # Several buckets for each shuffle partition, so that partitions are even.
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = rows.mapInArrow(_word_rows(block_bytes, 8 * partitions, tokenizer_path), WORDS)
    coded = (
        words.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encode_words(tokenizer_path), "block long, at binary, sizes binary, ids binary")
    )
    texts = rows.mapInArrow(
        _text_rows(block_bytes, tokenizer_path), "block long, n_words int, doc_id long, positions binary"
    )
    out = (
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        if digests
        else "doc_id long, n_tokens long, ids binary, decoded binary"
    )
    return (
        texts.groupBy("block")
        .cogroup(coded.groupBy("block"))
        .applyInArrow(_join_ids(tokenizer_path, digests), out)
    )
