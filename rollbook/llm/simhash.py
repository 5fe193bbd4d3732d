"""Near duplicates by SimHash: an inverted index over byte positions, with count filtering.

The fingerprint of a text is the bitwise majority of the 64-bit hashes of its shingles.
Two fingerprints that differ in at most four bits differ in at most four of their
eight bytes, so they share at least four bytes at the same positions. The index lists
fingerprints under three positional bytes at once (four, from ``WIDE`` fingerprints
on), for a system of byte triples of which any four positions contain one; it is the
intersection of the single bytes' lists, of which each would hold a 256th of the
corpus. For every two members of a list the positions with equal bytes are tallied;
pairs with the guaranteed four are kept and verified bit by bit.

Equal fingerprints are one node. In a list, members reached from one another by links
are found by search from one member after the other, which compares each only with
those not reached yet and returns a tree, not all pairs. A list is sorted to one task
as eight bytes a member; one with more than ``FULL`` members is not searched but
answered by another exact way: two fingerprints within four bits have a common neighbour
within two bits of both, so its members are listed under all their 2,081 neighbours,
and such a list has never more members than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.components import components
from rollbook.llm.sides import broadcast_if_few
from rollbook.llm.words import slices, texts_of
from rollbook.session import land

BYTES = 8
#: Differing bits at which fingerprints link, and the positional bytes that such a pair shares at least.
RADIUS, SHARED = 4, 4
SHINGLE, SEED = 4, 42
#: Fingerprints from which the index lists four positional bytes instead of three: then a list of three has four members by chance.
WIDE = 1 << 26
#: Members of a list up to which one task searches it (half a megabyte).
FULL = 1 << 16
#: Members up to which all pairs of a list are compared at once.
SHORT = 8

_LINKS = "a long, b long, full long"
_PART_BYTES = 1 << 20
_SPACE = b" \t\n\v\f\r"


def _parts_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in pieces of bounded size."""
    start = 0
    while start < len(data):
        stop = min(start + _PART_BYTES, len(data))
        while stop < len(data) and data[stop] not in _SPACE:
            stop += 1
        yield data[start:stop].split()
        start = stop


def _bit_counts(shingles: Iterator[bytes]) -> tuple[np.ndarray, int]:
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: str) -> int:
    """The text's fingerprint as an unsigned number; zero without words."""
    ones, total, held = np.zeros(64, np.int64), 0, []
    for words in _parts_of(text.encode().lower()):
        held += words
        if len(held) >= SHINGLE:
            found, n = _bit_counts(map(b" ".join, zip(*(held[k:] for k in range(SHINGLE)))))
            ones, total, held = ones + found, total + n, held[1 - SHINGLE :]
    if not total and held:
        ones, total = _bit_counts(iter([b" ".join(held)]))
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = np.fromiter((fingerprint(t.as_py()) for t in texts_of(batch)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])


def position_sets(size: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions (3 or 4) of which every four positions contain one.

    For three: cut the positions into three classes; of four positions two are in one class, and with a third
    one in the same or the next class they make a triple of the system.
    """
    if size == SHARED:
        return list(combinations(range(BYTES), size))
    classes = [range(0, 3), range(3, 6), range(6, 8)]
    within = [t for c in classes for t in combinations(c, 3)]
    return within + [(*pair, other) for k in range(3) for pair in combinations(classes[k], 2) for other in classes[(k + 1) % 3]]


def index_keys(size: int):
    """The keys of the column ``fingerprint``, one for each set of positions."""
    keys = []
    for number, positions in enumerate(position_sets(size)):
        key = F.lit(number).cast("long")
        for position in positions:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned("fingerprint", 8 * position).bitwiseAND(F.lit(255)))
        keys.append(key)
    return F.array(*keys)


def _near(x: np.ndarray) -> np.ndarray:
    """Which differences (exclusive ors) are links: by the tally of equal bytes, then by bits."""
    shared = np.count_nonzero(x.reshape(-1, 1).view(np.uint8) == 0, axis=1)
    near = shared >= SHARED
    near[near] = np.bitwise_count(x[near]) <= RADIUS
    return near


def _tree(members: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what any links connect: each member reached, with the one that reached it."""
    rest = members
    while len(rest) > 1:
        reached, rest = [rest[:1]], rest[1:]
        while reached and len(rest):
            for source in reached.pop():
                near = _near(rest ^ source)
                if near.any():
                    found = rest[near]
                    yield np.full(len(found), source), found
                    reached.append(found)
                    rest = rest[~near]
                    if not len(rest):
                        return


def _links_of(keys: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(first, len(keys)))
    size = np.repeat(sizes, sizes)
    left, right = [], []
    for apart in range(1, SHORT):
        at = np.flatnonzero((keys[apart:] == keys[:-apart]) & (size[apart:] <= SHORT)) if apart < len(keys) else np.zeros(0, np.int64)
        at = at[_near(members[at] ^ members[at + apart])]
        left.append(members[at])
        right.append(members[at + apart])
    for k in np.flatnonzero(sizes > SHORT):
        for a, b in _tree(members[first[k] : first[k] + sizes[k]]):
            left.append(a)
            right.append(b)
    return np.concatenate(left), np.concatenate(right)


def _search(full: int):
    """Links within the lists of a partition sorted by key; of a list over ``full`` members only its key is returned."""

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64())], names=["a", "b", "full"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, members, skipped = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            keys = np.concatenate((keys, batch.column("key").to_numpy()))
            members = np.concatenate((members, batch.column("fingerprint").to_numpy().view(np.uint64)))
            if skipped is not None:
                keys, members = keys[keys != skipped], members[keys != skipped]
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from complete(keys[:cut], members[:cut])
                keys, members = keys[cut:], members[cut:]
            if len(keys) > full:
                skipped = int(keys[0])
                yield overfull([skipped])
                keys, members = keys[:0], members[:0]
        if len(keys):
            yield from complete(keys, members)

    def overfull(keys: list[int]) -> pa.RecordBatch:
        none = pa.nulls(len(keys), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, pa.array(keys, pa.int64())], names=["a", "b", "full"])

    def complete(keys: np.ndarray, members: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, counts = np.unique(keys, return_counts=True)
        if (counts > full).any():
            yield overfull(found[counts > full].tolist())
            few = np.repeat(counts <= full, counts)
            keys, members = keys[few], members[few]
        if len(keys):
            yield out(*_links_of(keys, members))

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fingerprint under all values within half the radius of it."""
    one = [1 << k for k in range(64)]
    flips = np.array([0, *one, *(a | b for a, b in combinations(one, 2))], np.uint64)
    for batch in batches:
        members = batch.column("fingerprint").to_numpy().view(np.uint64)
        for start in range(0, len(members), 500):
            part = members[start : start + 500]
            keys = (part[:, None] ^ flips).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.repeat(part, len(flips)).view(np.int64))], names=["key", "fingerprint"])


def _by_key(index: DataFrame) -> DataFrame:
    return index.repartition("key").sortWithinPartitions("key")


def links(nodes: DataFrame, width: int | None = None, full: int = FULL) -> DataFrame:
    """Links ``(a, b)`` that connect whatever fingerprints of ``nodes`` within the radius connect.

    ``nodes`` has distinct ``fingerprint`` (signed long). ``width`` is the number of bytes of a list, by default
    from the number of nodes; ``full`` the largest list that is searched. Neither changes what is connected.
    """
    if width is None:
        width = 3 if nodes.count() < WIDE else 4
    index = nodes.select("fingerprint", F.explode(index_keys(width)).alias("key"))
    found = land(_by_key(index).mapInArrow(_search(full), _LINKS), "fingerprint-links")
    direct = found.where("full is null").select("a", "b")
    if found.where("full is not null").isEmpty():
        return direct
    lists = broadcast_if_few(found.where("full is not null").select(F.col("full").alias("key")).distinct())
    crowded = index.join(lists, "key", "left_semi").select("fingerprint").distinct()
    around = _by_key(crowded.mapInArrow(_neighbours, "key long, fingerprint long"))
    return direct.unionByName(land(around.mapInArrow(_search(FULL), _LINKS), "crowded-links").select("a", "b"))


def near_classes(docs: DataFrame, width: int | None = None, full: int = FULL) -> DataFrame:
    """Classes of documents whose fingerprints link, chains included: ``doc_id``, ``fingerprint`` (long), ``component_id``.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. A text of fewer than four words is
    one shingle; null, empty and wordless texts have the fingerprint zero and are linked by it like any other.
    Repeated rows are returned as often as they come; a null doc_id is in its class but never names it, unless
    the class has no other. The function starts jobs.
    """
    prints = land(docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fingerprint long"), "fingerprints")
    nodes = land(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "fingerprint-nodes")
    roots = components(links(nodes.select("fingerprint"), width, full)).withColumnRenamed("node", "fingerprint")
    placed = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    held = placed.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(held, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")
