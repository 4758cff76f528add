"""Sizes in tokens of a public tokenizer, whose file is a parameter; characters div 4 only where these are asked for."""

from __future__ import annotations

import base64
import importlib.util
import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows

#: Vocabulary used unless another path is given; the file stays where it is installed.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: In place of a path: sizes are characters div 4.
CHARACTERS = "characters"

# Fixed value: the public pattern by which byte-level BPE vocabularies of this family cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    """What QUILLSTONE_TOKENIZER names (a vocabulary file, or CHARACTERS), else the installed public vocabulary.

    A missing vocabulary is an error: sizes in another unit would look like a result.
    """
    if os.environ.get("QUILLSTONE_TOKENIZER"):
        return os.environ["QUILLSTONE_TOKENIZER"]
    spec = importlib.util.find_spec("public_tokenizers")
    folder = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    path = os.path.join(folder, VOCABULARY)
    if not os.path.exists(path):
        raise FileNotFoundError(f"no vocabulary at {path}: QUILLSTONE_TOKENIZER names another file, or '{CHARACTERS}' for sizes of characters div 4")
    return path


class Tokenizer:
    """Token counts and token boundaries of texts."""

    def __init__(self, path: str | None):
        self.encoding = None
        if path and path != CHARACTERS:
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.encoding = tiktoken.Encoding("quillstone", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, rank in ranks.items():
                self.lengths[rank] = len(token)

    def count(self, text: str) -> int:
        if self.encoding is None:
            return max(1, len(text) // 4) if text else 0
        return len(self.encoding.encode_ordinary(text))

    def starts(self, text: str) -> np.ndarray:
        """Character at which each token starts, and the text's length at the end: tokens + 1 numbers, rising.

        A token that starts within a character of several bytes gets that character's place, so that two tokens may
        share a place.
        """
        if self.encoding is None:
            # the last token takes the rest, so that there are as many as count says
            return np.append(4 * np.arange(self.count(text)), len(text)) if text else np.zeros(1, np.int64)
        ends = np.cumsum(self.lengths[np.array(self.encoding.encode_ordinary(text), np.int64)]) if text else np.zeros(0, np.int64)
        at = np.concatenate([np.zeros(1, np.int64), ends])
        if text.isascii():
            return at
        raw = np.frombuffer(text.encode(), np.uint8)
        begins = np.cumsum((raw & 0xC0) != 0x80)  # characters begun up to each byte
        return np.where(at < len(raw), begins[np.minimum(at, len(raw) - 1)] - 1, len(text))


_LOADED: dict[str | None, Tokenizer] = {}


def tokenizer(path: str | None) -> Tokenizer:
    """One tokenizer a worker process and path."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def with_sizes(df: DataFrame, key: str, text: str, path: str | None, name: str = "n_tokens") -> DataFrame:
    """(key, name): the size in tokens of each row's text; null texts have size 0."""

    def rows(source):
        t = tokenizer(path)
        for k, x in source:
            yield k, t.count(x) if x else 0

    return map_rows(df.select(key, text), T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(name, T.LongType())]), rows)
