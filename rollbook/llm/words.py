"""Words, lines and shingles of Arrow text columns, vectorised.

A word is a run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return; lower case means A-Z only. Both are what Arrow's
ASCII kernels do, so no Python loop runs over the words of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20
#: The same for operators that hold many numbers a word.
SMALL_SLICE_BYTES = 2 << 20
#: Whole texts that Spark hands to an Arrow step at once; what the executor's JVM takes for a batch, it keeps.
TEXT_ROWS = 1_000

ArrowStep = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)


class Words(NamedTuple):
    """Words of a column: text ``i`` has ``codes[offsets[i]:offsets[i + 1]]``, codes of ``vocabulary``."""

    offsets: np.ndarray
    codes: np.ndarray
    vocabulary: pa.Array


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one piece holds at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def freeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with memory that Arrow keeps for later given back after each; a worker lives on for other stages."""
    pool = pa.default_memory_pool()
    for batch in batches:
        yield batch
        del batch
        pool.release_unused()


def give_back() -> None:
    """Memory that Arrow or the C library keeps for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: ArrowStep) -> ArrowStep:
    """The Arrow function, its worker's free memory given back when a task is done: idle workers stay beside stages without Python."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column as plain strings, null as the empty text."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of every text, coded by a vocabulary of the slice."""
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    vocabulary = coded.dictionary
    blank = pc.index(vocabulary, pa.scalar("", vocabulary.type)).as_py()
    if blank is not None and blank >= 0:
        keep = codes != blank
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        codes = codes[keep]
    return Words(offsets, codes, vocabulary)


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes of a (small) array of strings."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(v) for v in values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def spread(offsets: np.ndarray) -> np.ndarray:
    """The row number of every element."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text: (offsets, hashes).

    A text of fewer words than ``size`` has its whole sequence as its only
    shingle; a text without words has none.
    """
    hashes = mix(hash_strings(words.vocabulary) + _A)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    counts = np.diff(words.offsets)
    rolled = np.zeros(len(hashes), np.uint64)
    for k in range(size):
        part = hashes[k:] * np.uint64(int(_A) * (2 * k + 1) % 2**64)
        rolled[: len(part)] = (rolled[: len(part)] ^ part) * _B
    rolled = mix(rolled)
    found: list[np.ndarray] = []
    for start, n in zip(words.offsets[:-1], counts):
        if n >= size:
            found.append(np.unique(rolled[start : start + n - size + 1]))
        elif n:
            whole = np.uint64(xxhash.xxh3_64_intdigest(hashes[start : start + n].tobytes(), seed=int(n)))
            found.append(np.array([whole]))
        else:
            found.append(np.zeros(0, np.uint64))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.concatenate(([0], np.cumsum(sizes))), np.concatenate(found) if found else np.zeros(0, np.uint64)


def as_long(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's signed long."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
