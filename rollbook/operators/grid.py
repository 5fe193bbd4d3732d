"""Nearest names of one cell: a block of left names against a block of right names.

The characters that two strings have in common, counted with repeats, are at least as many as those of their longest common
subsequence, so they bound the similarity from above. Names with like counts lie in groups, and the highest counts of a
group bound all pairs with its names at once. A left name meets only the groups whose bound reaches the score it has found so far,
groups with the best bounds first; there the bounds of all pairs are one product of matrices, and only pairs whose
bound reaches that score are scored. No pair that could be among the best is left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.similarity import Strings, pair_ratios, ratio_of
from rollbook.operators.skew import fan_out

LEFT_BLOCK, RIGHT_BLOCK = 65536, 131072
_LEAST_BLOCK, _TASKS = 4096, 48  # small inputs: blocks of at least so many left names, where there are fewer tasks than this
_LEFT_GROUP, _RIGHT_GROUP = 2048, 256  # names of a group, at most
_LOOKS = 8  # pairs of a left name scored first, at least
_FEATURES = 256  # columns of the matrices; beyond, characters share a column, which only loosens the bound
_SEEN = 2048  # names that say where a group is cut; no result depends on it
_ROWS = 1 << 14  # names counted at once
_KEYS = 1 << 14  # pairs whose keys are compared at once
_PAIRS = 1 << 15  # pairs scored at once
_MASKS = 1 << 22  # largest table of character masks, in words
_WORD = 64
_TIES = 10_000  # up to so many characters a bound in single precision says for sure that a pair can only tie
_RESULT = "left_name string, right_name string, score double"

Keyed = Callable[[list[str], list[str]], tuple[np.ndarray, np.ndarray]]


def _marks(strings: Strings, chosen: slice) -> tuple[np.ndarray, np.ndarray]:
    """Of every character of the chosen strings: (string, character and which of its kind it is in there)."""
    lengths = strings.lengths[chosen]
    first = strings.starts[chosen][0] if len(lengths) else 0
    codes = strings.codes[first : first + int(lengths.sum())].astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(owner * strings.width + codes, kind="stable")
    kind = (owner * strings.width + codes)[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(kind)), bool), kind[1:] != kind[:-1])))
    nth = np.arange(len(kind)) - np.repeat(starts, np.diff(np.append(starts, len(kind))))
    return owner[order], (codes[order] << 10) + np.minimum(nth, 1023)


def _counts(rows: int, owner: np.ndarray, mark: np.ndarray, known: np.ndarray) -> np.ndarray:
    columns = max(1, min(len(known), _FEATURES))
    place = np.searchsorted(known, mark)
    there = (place < len(known)) & (known[np.minimum(place, len(known) - 1)] == mark) if len(known) else np.zeros(len(mark), bool)
    counts = np.bincount(owner[there] * columns + place[there] % columns, minlength=rows * columns)
    return counts.reshape(rows, columns)


def _slices(lo: int, hi: int) -> list[slice]:
    return [slice(at, min(at + _ROWS, hi)) for at in range(lo, hi, _ROWS)]


def _table(strings: Strings, lo: int, hi: int, known: np.ndarray) -> np.ndarray:
    """How often each string has the known marks; the last column is 1 for an empty string, so that two of them share it."""
    held = np.min_scalar_type(max(1, int(strings.lengths[lo:hi].max(initial=0))))
    parts = [_counts(s.stop - s.start, *_marks(strings, s), known).astype(held) for s in _slices(lo, hi)]
    table = np.concatenate([*parts, np.zeros((0, max(1, min(len(known), _FEATURES))), held)])
    return np.concatenate((table, (strings.lengths[lo:hi] == 0)[:, None].astype(held)), axis=1)


def _grouped(table: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """An order in which rows of like counts lie together, and the starts of groups of at most ``most`` rows in it.

    A group too large is cut at the mean of the column that goes with most of the others; where no column cuts off a fair
    share, in the middle.
    """
    order, edges, open_groups = np.arange(len(table)), [], [(0, len(table))]
    while open_groups:
        lo, hi = open_groups.pop()
        if hi - lo <= most:
            edges.append(lo)
            continue
        rows = order[lo:hi]
        seen = table[rows[:: -(-len(rows) // _SEEN)]].astype(np.float32)
        mean = seen.mean(axis=0)
        share = (seen > mean).mean(axis=0)
        seen -= mean
        together = seen.T @ seen
        spread = together.diagonal()
        fair = (spread > 0) & (np.minimum(share, 1 - share) >= 1 / 64)
        cut = (hi - lo) // 2
        if fair.any():
            column = np.argmax(np.where(fair, np.square(together).sum(axis=0) / np.where(fair, spread, 1), -1))
            high = table[rows, column] > mean[column]
            order[lo:hi] = np.concatenate((rows[~high], rows[high]))
            cut = len(rows) - int(high.sum())
        open_groups += [(lo, lo + cut), (lo + cut, hi)]
    return order, np.array(sorted(edges), dtype=np.int64)


def _share_a_key(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    parts = [(left[a[i : i + _KEYS]] == right[b[i : i + _KEYS]]).any(axis=1) for i in range(0, len(a), _KEYS)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _first_of_each(owner: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows, sorted by owner, are among the first ``limit`` of theirs, and the place of each row among these."""
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1])))
    nth = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
    return nth < limit, nth


class _Scorer:
    """Ratios of the names of one left group with any right names.

    The masks of a left name are made once; a pair of names of at most one word takes them from there.
    """

    def __init__(self, strings: Strings, rows: np.ndarray):
        self.strings, self.rows = strings, rows
        lengths, starts = strings.lengths[rows], strings.starts[rows]
        short = np.flatnonzero(lengths <= _WORD)
        owner = np.repeat(short, lengths[short])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(lengths[short]) - lengths[short], lengths[short])
        codes = strings.codes[np.repeat(starts[short], lengths[short]) + at]
        letters = np.unique(codes)
        self.columns = len(letters) + 1  # the last one: any other character
        self.quick = len(rows) * self.columns <= _MASKS
        if self.quick:
            self.letters = np.full(strings.width, len(letters), dtype=np.int64)
            self.letters[letters] = np.arange(len(letters))
            self.masks = np.zeros(len(rows) * self.columns, dtype=np.uint64)
            np.bitwise_or.at(self.masks, owner * self.columns + self.letters[codes], np.uint64(1) << at.astype(np.uint64))

    def ratios(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``a``: places in the group, ``b``: strings."""
        lengths = self.strings.lengths
        out = np.empty(len(a))
        quick = (lengths[self.rows[a]] <= _WORD) & (lengths[b] <= _WORD) if self.quick else np.zeros(len(a), bool)
        slow = np.flatnonzero(~quick)
        out[slow] = pair_ratios(self.strings, self.rows[a[slow]], b[slow])
        chosen = np.flatnonzero(quick)
        for lo in range(0, len(chosen), _PAIRS):
            here = chosen[lo : lo + _PAIRS]
            out[here] = ratio_of(self._common(a[here], b[here]), lengths[self.rows[a[here]]] + lengths[b[here]])
        return out

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Characters of the longest common subsequences; each right name that occurs is looked up once."""
        strings = self.strings
        names, which = np.unique(b, return_inverse=True)
        lengths = strings.lengths[names]
        longest = int(lengths.max(initial=0))
        at = np.minimum(strings.starts[names] + np.arange(longest)[:, None], max(len(strings.codes) - 1, 0))
        texts = np.where(np.arange(longest)[:, None] < lengths, self.letters[strings.codes[at]], self.columns - 1) if longest else np.zeros((0, len(names)), np.int64)
        base = a * self.columns
        row = np.full(len(a), ~np.uint64(0))
        for position in range(longest):
            hit = row & self.masks[base + texts[position][which]]
            row = (row + hit) | (row - hit)
        return np.bitwise_count(~row).astype(np.int64)


class _Best:
    """The ``limit`` best rights so far of each name of a left group: scores, and places by name."""

    def __init__(self, count: int, limit: int, rights: int, cutoff: float):
        self.limit, self.cutoff = limit, cutoff
        self.score, self.place = np.full((count, limit), -1.0), np.full((count, limit), rights)
        self.floor = np.full(count, max(cutoff, 0.0) / 100.0)

    def add(self, a: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(a)
        a = np.concatenate((np.repeat(touched, self.limit), a))
        place = np.concatenate((self.place[touched].ravel(), place))
        score = np.concatenate((self.score[touched].ravel(), score))
        order = np.lexsort((place, -score, a))
        a, place, score = a[order], place[order], score[order]
        once = np.concatenate((np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (place[1:] != place[:-1])))
        a, place, score = a[once], place[once], score[once]
        first, nth = _first_of_each(a, self.limit)
        self.place[touched], self.score[touched] = np.iinfo(np.int64).max, -1.0
        self.place[a[first], nth[first]], self.score[a[first], nth[first]] = place[first], score[first]
        self.floor[touched] = np.maximum(self.score[touched, -1], self.cutoff) / 100.0


def nearest_in_cell(lefts: list[str], rights: list[str], limit: int, cutoff: float, keys: tuple[np.ndarray, np.ndarray] | None = None):
    """(left, right, score) of the ``limit`` best rights of every left: positions, ties by name; only of similarity above 0.

    With ``keys`` (a row of numbers per name) only pairs that have a number in common, in the same place, count.
    """
    n, m = len(lefts), len(rights)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    if not n or not m:
        return none
    strings = Strings([*lefts, *rights])
    named = np.array(sorted(range(m), key=rights.__getitem__), dtype=np.int64)  # the rights by name
    known = np.unique(np.concatenate([np.unique(_marks(strings, s)[1]) for s in _slices(n, n + m)]))
    left_table, table = _table(strings, 0, n, known), _table(strings, n, n + m, known)
    left_order, left_edges = _grouped(left_table, _LEFT_GROUP)
    # from here on the rights are numbered in the order of their groups
    right_order, edges = _grouped(table, _RIGHT_GROUP)
    table, right_sizes = table[right_order], strings.lengths[n:][right_order]
    place = np.empty(m, np.int64)
    place[named] = np.arange(m)
    place = place[right_order]
    hulls = np.maximum.reduceat(table, edges, axis=0).astype(np.float32)
    shortest = np.minimum.reduceat(right_sizes, edges)
    ends = np.append(edges[1:], m)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo, hi in zip(left_edges, np.append(left_edges[1:], n)):
        rows = left_order[lo:hi]
        own, sizes = left_table[rows].astype(np.float32), strings.lengths[rows]
        scorer, best = _Scorer(strings, rows), _Best(len(rows), limit, m, cutoff)
        outer = 2.0 * (own @ hulls.T) / np.maximum(sizes[:, None] + shortest, 1)

        def score(a: np.ndarray, b: np.ndarray) -> None:
            ratio = scorer.ratios(a, right_order[b] + n)
            while len(a):
                worst = best.score[a, -1]
                good = (ratio > 0) & (ratio >= cutoff) & ((ratio > worst) | ((ratio == worst) & (place[b] < best.place[a, -1])))
                a, b, ratio = a[good], b[good], ratio[good]
                if keys is None:
                    best.add(a, place[b], ratio)
                    break
                # the keys of as many of a left name as are wanted are compared at once
                order = np.lexsort((place[b], -ratio, a))
                a, b, ratio = a[order], b[order], ratio[order]
                first = _first_of_each(a, limit)[0]
                shared = np.flatnonzero(first)
                shared = shared[_share_a_key(*keys, rows[a[shared]], right_order[b[shared]])]
                best.add(a[shared], place[b[shared]], ratio[shared])
                a, b, ratio = a[~first], b[~first], ratio[~first]

        def common(g: int, chosen: np.ndarray) -> np.ndarray:
            """Twice the characters that the chosen left names share with the rights of a group."""
            return 2.0 * own[chosen] @ table[edges[g] : ends[g]].astype(np.float32).T

        def look(g: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The pairs of the best bounds of each chosen left name in a group."""
            ratio = common(g, chosen) / np.maximum(sizes[chosen][:, None] + right_sizes[edges[g] : ends[g]], 1)
            looks = min(ratio.shape[1], max(_LOOKS, limit))
            b = np.argpartition(-ratio, looks - 1, axis=1)[:, :looks]
            return np.repeat(chosen, looks), b.ravel() + edges[g]

        def reaching(g: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Pairs of chosen left names and rights of a group whose bound reaches the floor, and twice the characters they share."""
            inside, floor = right_sizes[edges[g] : ends[g]], best.floor[chosen]
            slack = 1e-3 + 1e-5 * (sizes[chosen] + inside.max())
            twice = common(g, chosen)
            # to be reached: floor * (left size + right size)
            least = np.where(floor > 0, floor * sizes[chosen] - slack, 0.5).astype(np.float32)
            met = np.flatnonzero(twice - floor.astype(np.float32)[:, None] * inside.astype(np.float32) >= least[:, None])
            return chosen[met // len(inside)], met % len(inside) + edges[g], twice.ravel()[met]

        def settle(waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
            a, b, twice = (np.concatenate(x) for x in zip(*waiting))
            total, floor = sizes[a] + right_sizes[b], best.floor[a]
            ratio = twice.astype(np.float64) / np.maximum(total, 1)
            # a pair that can only tie counts if its name goes first
            wanted = (total > _TIES) | (ratio > floor + 1e-12) | ((ratio >= floor - 1e-12) & (place[b] < best.place[a, -1]))
            score(a[wanted], b[wanted])

        nearest = outer.argmax(axis=1)
        looks = [look(g, np.flatnonzero(nearest == g)) for g in np.unique(nearest)]
        score(*(np.concatenate(x) for x in zip(*looks)))
        least = lambda: np.maximum(best.floor - 1e-4, 1e-9)
        counts = np.count_nonzero(outer >= least()[:, None], axis=0)
        waiting, held = [], 0
        for g in np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]:
            chosen = np.flatnonzero(outer[:, g] >= least())
            if len(chosen):
                waiting.append(reaching(g, chosen))
                held += len(waiting[-1][0])
            if held >= _PAIRS:
                settle(waiting)
                waiting, held = [], 0
        if held:
            settle(waiting)
        a, nth = np.nonzero(best.score > 0)
        found.append((rows[a], named[best.place[a, nth]], best.score[a, nth]))
    return tuple(np.concatenate(x) for x in zip(none, *found))


def _cell(limit: int, cutoff: float, keyed: Keyed | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lefts, rights = left.column("left_name"), right.column("right_name")
        if not len(lefts) or not len(rights):
            return pa.table({"left_name": pa.array([], pa.string()), "right_name": pa.array([], pa.string()), "score": pa.array([], pa.float64())})
        names = lefts.to_pylist(), rights.to_pylist()
        a, b, score = nearest_in_cell(*names, limit, cutoff, keyed(*names) if keyed else None)
        return pa.table({"left_name": lefts.take(pa.array(a)).cast(pa.string()), "right_name": rights.take(pa.array(b)).cast(pa.string()), "score": score})

    return run


def nearest_by_grid(
    lefts: DataFrame, rights: DataFrame, n_lefts: int, n_rights: int, limit: int, cutoff: float,
    left_block: int = LEFT_BLOCK, right_block: int = RIGHT_BLOCK, keyed: Keyed | None = None,
) -> DataFrame:
    """(left_name, right_name, score): for each cell of a grid over all pairs, the ``limit`` best rights of its left names.

    ``lefts`` (left_name) and ``rights`` (right_name) are distinct and not null. With ``keyed`` (from left and right names a row
    of numbers each) only pairs count that have the same number in a place. Pairs of similarity 0 are not listed.
    """
    across = -(-n_rights // right_block) or 1
    # rights are copied for every block of lefts: blocks are large, but not so few that cores are idle
    down = max(-(-n_lefts // left_block), min(-(-n_lefts // _LEAST_BLOCK), _TASKS)) or 1
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    own = lambda name, count: F.pmod(F.xxhash64(name), F.lit(count)).cast("int")
    left = lefts.select("left_name", own("left_name", down).alias("_row"), every(across).alias("_col"))
    right = rights.select("right_name", own("right_name", across).alias("_col"), every(down).alias("_row"))
    # a few cells a task
    left, right = (fan_out(side, "_row", "_col", least=down * across // 2) for side in (left, right))
    return left.groupBy("_row", "_col").cogroup(right.groupBy("_row", "_col")).applyInArrow(_cell(limit, cutoff, keyed), _RESULT)
