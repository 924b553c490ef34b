"""Pre-tokens and token ids of the byte-level vocabulary, as ``tokenizers`` gives them.

Texts go through a fast path while every character is one that the regular expression
engines at hand class alike; others go through the tokenizer itself. Both give the same
result, which ``tests/llm/test_tokens.py`` checks.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SPECIAL = "<|endoftext|>"
#: Characters whose class (letter, digit, space) may differ between Unicode versions or engines.
_UNSURE = re.compile("[^\\x00-ɏ]|[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0]")
_LOOSE_SPACE = re.compile(r"\s ")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def pre_tokens(text: str, path: str) -> list[str]:
    """The pre-tokens of a text without special strings, in order."""
    if _UNSURE.search(text):
        return [text[a:b] for _, (a, b) in tokenizer(path).pre_tokenizer.pre_tokenize_str(text)]
    return _pattern().findall(text)


class IdEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    Texts are cut before single spaces, where a pre-token always ends, and the ids of each
    such word are looked up in a bounded cache.
    """

    def __init__(self, path: str, max_words: int = 400_000):
        import public_tokenizers
        import tiktoken

        self.whole = tokenizer(path)
        ranks_path = os.path.splitext(path)[0] + ".tiktoken"
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = _Words(
            tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        )
        self.max_words = max_words

    def encode(self, text: str) -> bytes:
        if SPECIAL in text or _UNSURE.search(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return np.asarray(ids, dtype="<u4").tobytes()
        if _LOOSE_SPACE.search(text):
            return self.words.ids(text)
        if len(self.words) > self.max_words:
            self.words.clear()
        first, *rest = text.split(" ")
        return self.words.ids(first) + b"".join(map(self.words.__getitem__, rest))


class _Words(dict):
    """Ids of words that follow a space."""

    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def ids(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.ids(" " + word)
        return found
