"""Counts and chunks by a real tokenizer: any file of the tokenizers library, its path a parameter.

Texts go through the library in Arrow batches. Where the tokenizer cuts its input into words before it looks them up, a worker
encodes a word once as long as it remembers it; otherwise whole texts are encoded, copies once.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import chunk, sentences

_BATCH = 256


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, one in each worker; special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_padding()
    own.no_truncation()
    own.encode_special_tokens = True
    return own


@functools.lru_cache(maxsize=4)
def _cut_at_blanks(path: str) -> bool:
    """Whether the file cuts texts by the byte-level pattern alone. There a word takes the one blank before it along and nothing else
    reaches over that blank, so what lies between blanks can be counted piece by piece."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    cut = spec.get("pre_tokenizer") or {}
    return cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and spec.get("normalizer") is None


_BLANK = re.compile(r"(?= \S)")


#: Pieces a worker remembers, and how long one may be for that.
_REMEMBERED, _SHORT = 400_000, 64


@functools.lru_cache(maxsize=4)
def _sizes(path: str) -> dict[str, int]:
    """What a worker has counted with a file so far."""
    return {}


def _encoded(texts: list[str], path: str) -> list[int]:
    return [len(e.ids) for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def counts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text; short pieces between blanks are encoded once in a worker, not once in each batch."""
    if not texts:
        return np.zeros(0, np.int64)
    if not _cut_at_blanks(path):
        fresh = list(dict.fromkeys(texts))
        known = dict(zip(fresh, _encoded(fresh, path), strict=True))
        return np.fromiter(map(known.__getitem__, texts), np.int64, len(texts))
    pieces, known = [_BLANK.split(t) for t in texts], _sizes(path)
    fresh = list(set(itertools.chain.from_iterable(pieces)).difference(known))
    if len(known) + len(fresh) > _REMEMBERED:
        known.clear()
        fresh = list(set(itertools.chain.from_iterable(pieces)))
    known.update(zip(fresh, _encoded(fresh, path), strict=True))
    out = np.fromiter((sum(map(known.__getitem__, own)) for own in pieces), np.int64, len(texts))
    for piece in fresh:
        if len(piece) > _SHORT:
            del known[piece]
    return out


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text by the tokenizer file; null is empty."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            filled = texts.fillna("")
            parts = [counts(list(filled.iloc[a : a + _BATCH]), path) for a in range(0, len(filled), _BATCH)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return run(text)


def chunked(text: Column, path: str, most: int = 400, least: int = 200, split=sentences) -> Column:
    """array of chunks of about `most` tokens at ends of sentences, see text.chunk(); sizes are the tokenizer's."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out, filled = [], list(texts.fillna(""))
            for a in range(0, len(filled), _BATCH):
                block = list(dict.fromkeys(filled[a : a + _BATCH]))
                known = dict(zip(block, counts(block, path).tolist(), strict=True))
                parts = {t: split(t) for t in block if known[t] > most}  # the others are one chunk each
                fresh = list(dict.fromkeys(itertools.chain.from_iterable(parts.values())))
                known.update(zip(fresh, counts(fresh, path).tolist(), strict=True))
                made = {t: chunk(t, most, least, known.__getitem__, parts.get) for t in block}
                out += [made[t] for t in filled[a : a + _BATCH]]
            yield pd.Series(out)

    return run(text)


def spans(text: str, path: str, size: int, overlap: int = 0) -> list[tuple[int, int]]:
    """(start, end) in the text of stretches of `size` tokens, each sharing `overlap` tokens with the one before: the ids' own
    offsets are the cuts, so a stretch of the text is what its ids say."""
    if not 0 <= overlap < size:
        raise ValueError("0 <= overlap < size")
    offsets = tokenizer(path).encode(text, add_special_tokens=False).offsets
    out = []
    for a in range(0, len(offsets), size - overlap):
        b = min(a + size, len(offsets))
        out.append((offsets[a][0], offsets[b - 1][1]))
        if b == len(offsets):
            break
    return out


def windows_by_ids(text: Column, path: str, size: int, overlap: int = 0) -> Column:
    """array of (start, end, text) of stretches of `size` tokens by the ids' offsets; nothing for a null or empty text."""

    @F.pandas_udf("array<struct<start: int, end: int, text: string>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "text": t[a:b]} for a, b in spans(t, path, size, overlap)] for t in texts.fillna("")])

    return run(text)
