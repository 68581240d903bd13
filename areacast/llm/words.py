"""Words, shingles and MinHash values of texts, batch by batch inside Arrow tasks."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle

# The functions travel with the job: executors need the third-party packages only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_CHUNK = 1 << 15


class WordIds(dict):
    """64-bit hashes of words, remembered for the frequent ones."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return column.cast(pa.binary()).to_pylist()


def spaced_words(text: bytes | None) -> list[bytes]:
    """A-Z in lower case, cut at space and \\x09-\\x0D: what bytes do by themselves."""
    return text.lower().split() if text else []


def shingle_set(ids: np.ndarray, n: int) -> np.ndarray:
    """The distinct hashes of n consecutive words, sorted; all words as one if fewer; empty if none."""
    if not len(ids):
        return ids
    n = min(n, len(ids))
    width = len(ids) - n + 1
    mixed = np.full(width, n, np.uint64)
    for i in range(n):
        mixed = (mixed ^ ids[i : i + width]) * _MIX
        mixed ^= mixed >> _SHIFT
    return np.unique(mixed)


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of ``count`` hash functions."""
    draw = np.random.Generator(np.random.PCG64(seed))
    odd = draw.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], draw.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]


def minhashes(hashes: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of each hash function over a non-empty set."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    times, plus = functions
    least = None
    for start in range(0, len(high), _CHUNK):
        part = (high[None, start : start + _CHUNK] * times + plus).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return least


def joined(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key of each group of ``rows`` neighbouring values."""
    keys = np.zeros(len(values) // rows, np.uint64)
    for i in range(rows):
        keys = (keys ^ values[i::rows].astype(np.uint64)) * _MIX
        keys ^= keys >> _SHIFT
    return keys.view(np.int64)


def lists(arrays: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    """A list column of the arrays; an empty list where there is none."""
    sizes = [0 if a is None else len(a) for a in arrays]
    full = [a for a in arrays if a is not None and len(a)]
    flat = np.concatenate(full) if full else np.empty(0, kind.to_pandas_dtype())
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))
