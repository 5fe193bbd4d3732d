"""Packing of tokenised documents into sequences of fixed length.

A document becomes token ids and a closing id; only a document longer than a
sequence is cut, into full pieces and a last one. Packing needs the number of
pieces of each length and nothing else, so the plan is made on a histogram of at
most ``capacity`` rows, whatever the size of the corpus:

1. the configuration linear program (fewest sequences, each filled by one of all
   possible multisets of lengths, so that every length is covered) is solved by
   multiplicative weights: each round prices lengths, finds the most valuable
   fillings by a knapsack dynamic program over the capacity, and lowers the prices
   of what those fillings cover;
2. amounts are rounded down to whole sequences, the pieces left over are packed by
   best fit on the histogram;
3. best fit alone is packed too, and the plan with fewer sequences is taken.

Then every piece gets a number among the pieces of its length (counted in blocks,
so a length that a third of all pieces share is not one task) and looks up its
place in the plan.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollbook.llm.words import TEXT_ROWS, freeing, slices, split_words, texts_of, tidy
from rollbook.session import land

CAPACITY = 2048
CLOSING_ID = 0
ROUNDS = 40
#: How fast the price of a covered length falls.
RATE = 0.02
#: Pieces of one length that are numbered in one block, about.
BLOCK = 10_000
#: Distinct words whose ids a task remembers, half of them at least the ones met last.
REMEMBERED = 300_000

# fixed values: bytes that a byte-level vocabulary shows as themselves; the others follow from code point 256 on
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
_CHAR_MAP = str.maketrans({chr(b): c for b, c in _BYTE_CHARS.items()})
# a word that the tokenizer's normaliser leaves alone and its splitter cuts in two at most
_PLAIN = re.compile(r"([a-zß-öø-ÿ]*)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)")


class Encoder:
    """Token ids of words of a slice, remembered across the slices of a task.

    A text's ids are those of its words one after the other, as neither the
    normaliser nor the splitter of the vocabulary looks across white space. Plain
    words go to the model directly, all others through the whole tokenizer. Ids are
    kept as 32-bit numbers in bytes, a third of what lists of them take.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _part(self, text: str) -> list[int]:
        return [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(_CHAR_MAP))]

    def word(self, word: str) -> bytes:
        known = self.known.get(word)
        if known is None:
            known = self.older.get(word)
            if known is None:
                plain = _PLAIN.fullmatch(word)
                if plain:
                    ids = (self._part(plain[1]) if plain[1] else []) + (self._part(plain[2]) if plain[2] else [])
                else:
                    ids = self.whole.encode(word, add_special_tokens=False).ids
                known = array("I", ids).tobytes()
            if len(self.known) >= REMEMBERED // 2:
                self.older, self.known = self.known, {}
            self.known[word] = known
        return known

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts, the closing id included."""
        # special strings are recognised before lower-casing, so a text that may hold one keeps its case
        special = pc.match_substring(texts, "<|")
        words = split_words(pc.if_else(special, texts, pc.ascii_lower(texts)))
        coded = [self.word(w) for w in words.vocabulary.to_pylist()]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.frombuffer(b"".join(coded), np.uint32)
        lengths = sizes[words.codes] if len(words.codes) else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        per_text = ends[words.offsets]
        where = np.arange(ends[-1]) - np.repeat(ends[:-1] - (starts[words.codes] if len(words.codes) else 0), lengths)
        ids = flat[where]
        return per_text + np.arange(len(per_text)), np.insert(ids, per_text[1:], np.uint32(CLOSING_ID))


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(freeing(batches), most=1 << 20):
            offsets, ids = encoder.texts(texts_of(batch))
            ids = ids.astype("<u4", copy=False)
            row, piece, start, length, crc = [], [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                for k, s in enumerate(range(a, b, capacity)):
                    e = min(s + capacity, b)
                    row.append(i)
                    piece.append(k)
                    start.append(s - a)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[s:e]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


class Plan(NamedTuple):
    """Fillings (tuples of lengths, longest first) and how many sequences have each."""

    fillings: list[tuple[int, ...]]
    times: list[int]

    @property
    def sequences(self) -> int:
        return sum(self.times)


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit, longest first, over counts of lengths; open sequences are kept by the room they have."""
    open_by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(filling: tuple[int, ...], times: int, room: int) -> None:
        if room not in open_by_room:
            rooms.insert(bisect_left(rooms, room), room)
        open_by_room.setdefault(room, []).append([filling, times])

    done: list[tuple[tuple[int, ...], int]] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                whole, rest = divmod(left, each)
                for k, times in ((each, whole), (rest, 1)):
                    if k and times:
                        put((length,) * k, times, capacity - k * length)
                break
            room = rooms[at]
            filling, times = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            each = min(room // length, left)
            used = min(times, left // each)
            if times > used:
                put(filling, times - used, room)
            left -= used * each
            new = room - each * length
            if new:
                put(filling + (length,) * each, used, new)
            else:
                done.append((filling + (length,) * each, used))
    done += [(f, t) for entries in open_by_room.values() for f, t in entries]
    return Plan([f for f, _ in done], [t for _, t in done])


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every room up to the capacity: greatest price that fits, and the length it takes first (-1: leaves one unit)."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        n = fits[room]
        if n:
            gains = value[room - lengths[:n]] + prices[:n]
            k = int(gains.argmax())
            if gains[k] >= value[room]:
                value[room], choice[room] = gains[k], lengths[k]
    return value, choice


def _filling(first: int, choice: list[int], capacity: int) -> tuple[int, ...]:
    found, room = [first], capacity - first
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            found.append(choice[room])
            room -= choice[room]
    return tuple(sorted(found, reverse=True))


def configuration_plan(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> Plan:
    """Multiplicative weights on the configuration program, rounded down, the rest by best fit.

    One knapsack table prices, for every length, the most valuable filling that
    has it. Fillings close to the most valuable one are taken, each as often as
    half of its scarcest length allows, in whole numbers; then the price of every
    length falls by the factor ``exp(-RATE * share of it now covered)``.
    """
    wanted = dict(counts)
    left = dict(counts)
    lengths = np.array(sorted(counts))
    log_price = np.log(lengths / capacity)
    slack = 0.002
    taken: dict[tuple[int, ...], int] = {}
    for _ in range(rounds):
        there = np.array([left[x] > 0 for x in lengths.tolist()])
        if not there.any():
            break
        here, prices = lengths[there], np.exp(log_price[there])
        value, choice = _knapsack(here, prices, capacity)
        steps = choice.tolist()
        best, some = value[capacity], False
        for length, worth in zip(here[::-1].tolist(), (prices + value[capacity - here])[::-1].tolist()):
            if worth < (1 - slack) * best or not left[length]:
                continue
            filling = _filling(length, steps, capacity)
            parts = {x: filling.count(x) for x in filling}
            most = min(left[x] // k for x, k in parts.items())
            if most:
                q = max(1, most // 2)
                some = True
                taken[filling] = taken.get(filling, 0) + q
                for x, k in parts.items():
                    left[x] -= q * k
        if not some:
            slack *= 2
            if slack > 0.05:
                break
        log_price = np.log(lengths / capacity) - RATE * np.array([1 - left[x] / wanted[x] for x in lengths.tolist()])
    more = best_fit({x: n for x, n in left.items() if n}, capacity)
    return Plan([*taken, *more.fillings], [*taken.values(), *more.times])


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """The better of the rounded configuration program and best fit."""
    full = counts.get(capacity, 0)
    part = {x: n for x, n in counts.items() if n and x < capacity}
    plans = [best_fit(part, capacity)]
    if part:
        plans.append(configuration_plan(part, capacity, rounds))
    plan = min(plans, key=lambda p: p.sequences)
    return Plan(plan.fillings + [(capacity,)] * bool(full), plan.times + [full] * bool(full))


def _places(plan: Plan):
    """Per length: first piece number, first sequence, pieces per sequence and first offset of each filling that has it."""
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for filling, times in zip(plan.fillings, plan.times):
        offset = 0
        for length in dict.fromkeys(filling):
            k = filling.count(length)
            table.setdefault(length, []).append((taken.get(length, 0), sequence, k, offset))
            taken[length] = taken.get(length, 0) + k * times
            offset += k * length
        sequence += times
    return {x: tuple(np.array(c) for c in zip(*rows)) for x, rows in table.items()}


def _placed(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.zeros_like(number), np.zeros_like(number)
            for x in np.unique(length):
                here = length == x
                first, base, each, begin = places[int(x)]
                k = np.searchsorted(first, number[here], side="right") - 1
                within = number[here] - first[k]
                sequence[here] = base[k] + within // each[k]
                offset[here] = begin[k] + within % each[k] * x
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return run


SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Pieces of all documents with the sequence and the offset each is packed at.

    ``docs`` needs ``doc_id`` and ``text``; ``vocabulary`` is the path of a tokenizer
    file that every executor can read. A null or empty text is its closing id
    alone. Repeated rows are packed as often as they come; an empty table gives
    an empty result. Per piece: ``doc_id, piece`` (from 0), ``start`` (ids of its
    document before it), ``length, ids_crc32`` (of its ids as little-endian 32-bit
    numbers), ``sequence_id`` and ``offset``. The function starts jobs.
    """
    pieces = land(docs.select("doc_id", "text").mapInArrow(tidy(_pieces(vocabulary, capacity)), SCHEMA), "pieces", TEXT_ROWS)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    plan = plan_packing(counts, capacity, rounds)
    blocks = max(1, sum(counts.values()) // BLOCK)
    # a piece's number among those of its length: counted within blocks, the blocks in order
    cut = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    sizes = cut.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = sizes.select("length", "block", (F.sum("n").over(W.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    inner = F.row_number().over(W.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")) - 1
    numbered = cut.withColumn("inner", inner).join(before, ["length", "block"]).withColumn("number", F.col("before") + F.col("inner"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(_placed(_places(plan)), SCHEMA + ", sequence_id long, offset long")
