"""Hashes of the words of many texts at once, by array arithmetic."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.Generator(np.random.PCG64(20240229))
_LETTER = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and all other ASCII that is neither letter nor digit.
NO_LETTER = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that lets each bit depend on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, n.bit_length())
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers


def word_spans(texts: list[bytes], gap: np.ndarray = SPACE, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, starts and ends of their words in it, offsets: text i has words offsets[i] to offsets[i + 1]).

    A word is a run of bytes outside ``gap``, which the line feed must be in; A-Z count as a-z.
    """
    if not texts:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    inside = ~gap[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, starts, ends, np.concatenate(([0], np.searchsorted(starts, np.cumsum(sizes))))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of parts of ``data``.

    Parts of equal bytes have equal hashes; for others that is as likely as for random numbers of
    about 58 bits.
    """
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def hash_words(texts: list[bytes], gap: np.ndarray = SPACE, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, offsets: those of text i stand from offsets[i] to offsets[i + 1])."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data, starts, ends, offsets = word_spans(texts, gap, lower)
    return hash_spans(data, starts, ends), offsets


def groups(texts: list[bytes], size: int = 1 << 19):
    """Ranges of texts with about ``size`` bytes in all, at least one text each: the work space of a task."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text) + 1
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def pieces(texts: pa.Array, size: int = 1 << 19) -> Iterator[list[bytes]]:
    """The texts as bytes, null as empty, in lists of about ``size`` bytes in all: never a whole batch at once."""
    data = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
    sizes = pc.fill_null(pc.binary_length(data), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        total += n + 1
        if total >= size or i + 1 == len(sizes):
            yield [t or b"" for t in data.slice(start, i + 1 - start).to_pylist()]
            start, total = i + 1, 0


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words; of fewer words, the one run of all."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            factor = np.uint64((int(factor) * 0xD6E8FEB86659FD93 + 2 * k) % 2**64 | 1)
            total += words[k : k + n] * factor
    return np.unique(mix(total))
