"""Ids of byte-level tokenizer files, many times faster than by the file's own library.

A second library merges by rank instead of by a list of merges. Both agree where every merge
makes the next higher id, which is checked, and on texts of letters and signs that both
split alike. All other texts, very long ones, and those that hold an added token, go to the file's library.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from panelweave.llm.bpe import piece_table

# Fixed value: how byte-level tokenizers split.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class no version of Unicode has changed.
SETTLED = re.compile(
    "[\\x00-\\u024f\\u0391-\\u03a1\\u03a3-\\u03ce\\u0410-\\u044f\\u05d0-\\u05ea\\u0621-\\u063a\\u0641-\\u064a"
    "\\u2010-\\u2027\\u2030-\\u205e\\u20ac\\u3000-\\u3003\\u3041-\\u3093\\u30a1-\\u30f6\\u4e00-\\u9fa5\\uac00-\\ud7a3"
    "\\uff01-\\uff5e]*"
)


#: Longer texts go to the file's own library: the other one may give up on very long runs of blanks.
LONG = 500_000


class ByteEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        texts = sorted((t.content for t in added.values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, texts))) if texts else None
        self.ranked = self._ranked(path, set(added))

    def _ranked(self, path: str, added: set[int]):
        """The second library's encoder, None if it would not agree."""
        said = json.loads(self.tokenizer.to_str())
        model, split = said["model"], said["pre_tokenizer"] or {}
        alike = (
            said["normalizer"] is None
            and model["type"] == "BPE"
            and split.get("type") == "ByteLevel"
            and split.get("use_regex")
            and not split.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                               "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        )
        if not alike:
            return None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if any(a >= b for a, b in zip(made, made[1:])) or len(made) + 256 + len(added) != self.tokenizer.get_vocab_size():
            return None
        import tiktoken

        ranks = {piece: i for i, piece in enumerate(piece_table(path)) if i not in added}
        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        """Ids of a text, without special tokens around it."""
        plain = self.ranked and len(text) <= LONG and SETTLED.fullmatch(text)
        if plain and not (self.added and self.added.search(text)):
            return np.array(self.ranked.encode_ordinary(text), np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)
