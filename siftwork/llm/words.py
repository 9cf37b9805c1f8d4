"""Words of whole batches of texts as numpy arrays, for the operators that work inside Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def portions(texts: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield at, to
        at = to


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many each text has. A null text has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = lists.flatten()
    filled = pc.not_equal(flat, "")
    empty = np.flatnonzero(~filled.to_numpy(zero_copy_only=False))
    if len(empty):
        owner = np.repeat(np.arange(len(lengths)), lengths)[empty]
        lengths = lengths - np.bincount(owner, minlength=len(lengths))
        flat = flat.filter(filled)
    return flat, lengths


def word_codes(flat: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Each word's place in the list of distinct words, and that list."""
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def hash_words(distinct: list[str], seed: int = 0) -> np.ndarray:
    """64-bit hashes, the same in every process."""
    of = xxhash.xxh64_intdigest
    return np.fromiter((of(w, seed) for w in distinct), np.uint64, len(distinct))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text's runs of ``width`` words, sorted within a text, and how many each text has.

    A text with fewer words has one shingle of all of them, a text without words has none.
    """
    flat, lengths = split_words(texts)
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(len(lengths), np.int64)
    codes, distinct = word_codes(flat)
    hashes = hash_words(distinct)[codes]
    starts = np.cumsum(lengths) - lengths
    number = np.where(lengths >= width, lengths - width + 1, (lengths > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(lengths)), number)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + starts[owner]
    out = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            inside = k < lengths[owner]
            at = np.where(inside, first + k, first)
            out = np.where(inside, mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[at] + np.uint64(k + 1)), out)
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[fresh], np.bincount(owner[fresh], minlength=len(lengths))
