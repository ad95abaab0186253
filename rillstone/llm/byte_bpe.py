"""Byte-level BPE ids from a vocabulary file in the tokenizers library's JSON format.

The ids are those of the tokenizers library. Texts go through tiktoken's encoder of the same vocabulary, which takes
about a seventh of that library's time; its pattern search runs out of stack on very long white space, so texts with
such a run go through the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: The pre-tokenizer's pattern of the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space of this length is not for tiktoken's pattern search: its time grows with the square, and from about
#: 600,000 characters on it fails. Every STEP-th character tells whether there may be such a run.
LONG_SPACE, STEP = 512, 64
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE // STEP}}}")


def _byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte: printable ones stand for themselves, others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder of a vocabulary file; files that ask for more than this encoder does raise a ValueError."""

    def __init__(self, path: str) -> None:
        self.path, self._library = path, None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        if model["type"] != "BPE" or file["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("only byte-level BPE without normalization and without a prefix space")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings aren't supported")
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError("merges aren't in the order of their ids")
        self.size = max([*ranks.values(), *special.values()]) + 1
        self.encoder = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text (uint32); special strings give their ids."""
        if _LONG_SPACE.search(text[::STEP]):
            if self._library is None:
                os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
                self._library = Tokenizer.from_file(self.path)
            return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.encoder.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """The worker's encoder of ``path``."""
    return ByteBpe(path)
