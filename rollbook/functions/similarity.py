"""Normalised Indel similarity of two strings, 0..100.

``100 * 2 * LCS(a, b) / (len(a) + len(b))``, and 100 for two empty strings.
Spark has no built-in for it (``levenshtein`` also substitutes), so this is the
library's one Arrow UDF. Pairs are scored column-wise: the bit-parallel LCS
recurrence of Hyyro (2004) runs on lanes of 64-bit words, one lane per pair, with
as many words as its shorter string needs; carries go from word to word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = 64
_LANES = 4096  # pairs advanced together; their mask table stays in cache
_TABLE_CELLS = 1 << 22  # largest mask table, in 64-bit words


class Strings:
    """Distinct strings as one row of characters, coded by the alphabet they use."""

    def __init__(self, strings: list[str]):
        self.lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        self.starts = np.cumsum(self.lengths) - self.lengths
        codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        alphabet, self.codes = np.unique(codes, return_inverse=True)
        self.width = max(1, len(alphabet))

    def by_length(self, chosen: np.ndarray):
        """Lanes longest first, where each lane's string starts, and per character position the lanes still running."""
        lengths = self.lengths[chosen]
        order = np.argsort(-lengths, kind="stable")
        falling = -lengths[order]
        longest = int(-falling[0]) if len(falling) else 0
        return order, self.starts[chosen][order], np.searchsorted(falling, -np.arange(longest), side="left")


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of numbers of several words (lowest first) in every row; the last carry is dropped."""
    total = a + b
    if total.ndim == 1:
        return total
    carry = (total < a)[:, :-1]
    while carry.any():
        upper = total[:, 1:] + carry
        full = carry & (upper == 0)
        total[:, 1:] = upper
        carry = np.zeros_like(full)
        carry[:, 1:] = full[:, :-1]
    return total


def _lcs_lanes(strings: Strings, patterns: np.ndarray, texts: np.ndarray, words: int) -> np.ndarray:
    """LCS of each pattern, of at most ``words`` words and more than one word less, with the text beside it."""
    out = np.zeros(len(patterns), dtype=np.int64)
    step = max(1, min(_LANES // words, _TABLE_CELLS // (strings.width * words)))
    for lo in range(0, len(patterns), step):
        pattern, text = patterns[lo : lo + step], texts[lo : lo + step]
        lanes = len(pattern)
        masks = np.zeros((lanes * strings.width, words), dtype=np.uint64)
        order, starts, live = strings.by_length(pattern)
        for position, count in enumerate(live):
            rows = order[:count] * strings.width + strings.codes[starts[:count] + position]
            masks[rows, position // _WORD] |= np.uint64(1 << position % _WORD)
        # one word: plain vectors, no carries
        masks = masks[:, 0].copy() if words == 1 else masks

        order, starts, live = strings.by_length(text)
        base = order * strings.width
        row = np.full(lanes if words == 1 else (lanes, words), ~np.uint64(0), dtype=np.uint64)
        for position, count in enumerate(live):
            current = row[:count]
            hit = current & masks[base[:count] + strings.codes[starts[:count] + position]]
            row[:count] = _add(current, hit) | (current - hit)
        zeros = ~row.reshape(lanes, words)
        unused = words * _WORD - strings.lengths[pattern[order]]
        zeros[:, -1] <<= unused.astype(np.uint64)
        out[lo + order] = np.bitwise_count(zeros).sum(axis=1)
    return out


def pair_ratios(strings: Strings, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ratio 0..100 of the strings numbered ``a`` and ``b``, pair by pair."""
    swap = strings.lengths[a] > strings.lengths[b]
    shorter, longer = np.where(swap, b, a), np.where(swap, a, b)
    words = -(-strings.lengths[shorter] // _WORD)
    common = np.zeros(len(a), dtype=np.int64)
    for count in np.unique(words[words > 0]):
        here = np.flatnonzero(words == count)
        common[here] = _lcs_lanes(strings, shorter[here], longer[here], int(count))
    return ratio_of(common, strings.lengths[a] + strings.lengths[b])


def ratio_of(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Ratio 0..100 of pairs of strings of ``total`` characters, by the length of their longest common subsequence."""
    distance = total - 2 * common
    return np.where(total == 0, 1.0, 1.0 - distance / np.maximum(total, 1)) * 100.0


def indel_ratios(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Ratio of each pair of two aligned string arrays; NaN where either is null. A pair repeated is scored once."""
    both = pa.concat_arrays([left.cast(pa.large_string()), right.cast(pa.large_string())]).dictionary_encode()
    ids = both.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    first, second = ids[: len(left)], ids[len(left) :]
    ratios = np.full(len(left), np.nan)
    present = (first >= 0) & (second >= 0)
    if not present.any():
        return ratios
    strings = Strings(both.dictionary.to_pylist())
    pairs, inverse = np.unique(first[present] * len(strings.lengths) + second[present], return_inverse=True)
    a, b = pairs // len(strings.lengths), pairs % len(strings.lengths)
    scored = pair_ratios(strings, a, b)
    ratios[present] = scored[inverse]
    return ratios


@F.arrow_udf(T.DoubleType())
def _indel_ratio_batch(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(indel_ratios(left, right), from_pandas=True)  # NaN as null


def indel_ratio(left: Column, right: Column) -> Column:
    """Similarity 0..100; null if either side is null.

    Equal strings are answered in the JVM: the UDF is handed nulls for them,
    which it skips.
    """
    differ = left != right
    return F.when(left == right, F.lit(100.0)).otherwise(
        _indel_ratio_batch(F.when(differ, left), F.when(differ, right))
    )


def without_the(text: Column) -> Column:
    """Drop the inner word "the", in any case."""
    return F.regexp_replace(text, "(?i) the ", " ")


def title_similarity(left: Column, right: Column, left_short: Column, right_short: Column) -> Column:
    """Better of the ratio of two titles and of their forms without "the", 0..1.

    The short forms are passed in so that they are computed once per input row,
    not once per pair; where neither side loses anything the second ratio
    equals the first and is not computed.
    """
    shortened = (left != left_short) | (right != right_short)
    second = indel_ratio(F.when(shortened, left_short), F.when(shortened, right_short))
    # greatest() skips nulls: right for a second ratio not needed, and a null
    # title makes both null
    return F.greatest(indel_ratio(left, right), second) / F.lit(100.0)
