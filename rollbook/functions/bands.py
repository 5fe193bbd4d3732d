"""Band keys of names for Arrow steps: what ``blocking.band_keys`` says as a Spark expression, worked out in columns.

Spark's ``xxhash64`` is XXH64 over the bytes of a string; numbers are mixed in by its steps for four and eight bytes. A gram is
hashed once, however many names hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
_ALL = (1 << 64) - 1
_SEED = 42  # Spark's
_NAMES = 1 << 13  # names whose grams are looked up at once; they stay in cache


def _turn(x: int, by: int) -> int:
    x &= _ALL
    return (x << by | x >> (64 - by)) & _ALL


def _word(w: int) -> int:
    return _turn(w * _P2, 31) * _P1 & _ALL


def text_hash(text: str) -> int:
    """XXH64 of the UTF-8 bytes."""
    data = text.encode("utf-8", "surrogatepass")
    words = [int.from_bytes(data[i : i + 8], "little") for i in range(0, len(data) // 8 * 8, 8)]
    lanes = len(words) // 4 * 4
    if lanes:
        v = [_SEED + _P1 + _P2, _SEED + _P2, _SEED, _SEED - _P1]
        for i, w in enumerate(words[:lanes]):
            v[i % 4] = _turn(v[i % 4] + w * _P2, 31) * _P1
        h = sum(_turn(x, by) for x, by in zip(v, (1, 7, 12, 18)))
        for x in v:
            h = (h & _ALL ^ _word(x)) * _P1 + _P4
    else:
        h = _SEED + _P5
    h += len(data)
    for w in words[lanes:]:
        h = _turn(h & _ALL ^ _word(w), 27) * _P1 + _P4
    at = len(words) * 8
    if at + 4 <= len(data):
        h = _turn(h & _ALL ^ int.from_bytes(data[at : at + 4], "little") * _P1 & _ALL, 23) * _P2 + _P3
        at += 4
    for byte in data[at:]:
        h = _turn(h & _ALL ^ byte * _P5 & _ALL, 11) * _P1
    h &= _ALL
    h = (h ^ h >> 33) * _P2 & _ALL
    h = (h ^ h >> 29) * _P3 & _ALL
    return h ^ h >> 32


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * np.uint64(_P2)
    h = (h ^ h >> np.uint64(29)) * np.uint64(_P3)
    return h ^ h >> np.uint64(32)


def _with_int(value: int, seeds: np.ndarray) -> np.ndarray:
    h = seeds + np.uint64(_P5 + 4) ^ np.uint64(value * _P1 & _ALL)
    return _mixed(_turned(h, 23) * np.uint64(_P2) + np.uint64(_P3))


def _with_long(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    h = seeds + np.uint64(_P5 + 8) ^ _turned(values * np.uint64(_P2), 31) * np.uint64(_P1)
    return _mixed(_turned(h, 27) * np.uint64(_P1) + np.uint64(_P4))


def band_columns(names: list[str], gram: int, bands: int, rows: int) -> Iterator[np.ndarray]:
    """For one band after the other the keys of all names."""
    numbers: dict[str, int] = {}
    ids, counts = [], []
    for name in names:
        marked = "\u0001" * (gram - 1) + name + "\u0002" * (gram - 1)
        held = {marked[i : i + gram] for i in range(max(len(marked) - (gram - 1), 1))}
        counts.append(len(held))
        ids.append(np.fromiter((numbers.setdefault(g, len(numbers)) for g in held), np.intp, len(held)))
    # names of about as many grams together, as columns; a shorter one repeats its last gram
    sizes = np.array(counts, dtype=np.int64)
    flat, starts = np.concatenate([*ids, np.zeros(0, np.intp)]), np.cumsum(sizes) - sizes
    ids.clear()
    order = np.argsort(sizes, kind="stable")
    parts = [order[lo : lo + _NAMES] for lo in range(0, len(names), _NAMES)]
    held = [flat[starts[part] + np.minimum(np.arange(sizes[part].max())[:, None], sizes[part] - 1)] for part in parts]
    hashes = np.array([text_hash(g) for g in numbers], dtype=np.uint64)
    for band in range(bands):
        key = _with_int(band, np.full(len(names), _SEED, dtype=np.uint64))
        for row in range(rows):
            seeded = _with_int(band * rows + row, hashes).view(np.int64)
            least = np.empty(len(names), dtype=np.int64)
            for part, grams in zip(parts, held):
                least[part] = seeded.take(grams).min(axis=0)
            key = _with_long(least.view(np.uint64), key)
        yield key.view(np.int64)


def band_numbers(lefts: list[str], rights: list[str], gram: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of numbers per left and right name; in a column two are equal where the keys of the band are."""
    names = [*lefts, *rights]
    numbers = np.empty((len(names), bands), dtype=np.uint16)
    for band, keys in enumerate(band_columns(names, gram, bands, rows)):
        held = pa.array(keys).dictionary_encode()
        if len(held.dictionary) > 1 << 16 and numbers.dtype == np.uint16:
            numbers = numbers.astype(np.uint32)
        numbers[:, band] = held.indices.to_numpy()
    return numbers[: len(lefts)], numbers[len(lefts) :]
