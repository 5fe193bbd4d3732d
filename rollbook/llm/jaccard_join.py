"""Exact Jaccard self-join of word-shingle sets by universe partition and pigeonhole.

Two sets r, s (|s| <= |r|) reach a Jaccard similarity of t percent only if they
differ in at most ``H = floor((|r| + |s|) * (100 - t) / (100 + t))`` elements.
Sets are put into size bands ``[2^b, 2^(b+1))``; the universe of a band is cut by
hash into segments, and a set has one key per segment that is not empty in it (the
hash of what it has there). Of any H + 1 such segments of r, one holds no
difference, so s has the same key. A set has keys in its own band and in the one
above if a partner there can be similar.

Allocation. Per band: single elements as segments where that is the cheaper
(small sets), else segments alone, else segments with one-deletion
neighbourhoods (a segment of two or more elements then also has a key for each
element left out, and stands for two differences); the sizes met in the corpus
decide, so that H + 1 can always be reached. Per set: its H + 1 cheapest keys
are enough to find its partners; keys that nobody shares cost nothing, so most
sets need not look for partners at all, and frequent passages, which have the
dearest keys, are left out first. No partner is lost by it.

Groups. Equal sets are one node. Nodes that share a key are first compared with
the one of them that shares most, then only pairs that these links leave in
different components, and of these only pairs whose rarest elements allow a link
(prefix and positional filter). So a group of near copies costs comparisons in
proportion to its size, also where no text of the group is like most others.
Every candidate is verified on the sets themselves. Sets and elements are known
by 64-bit hashes: of n different sets two fall together with probability n^2/2^65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollbook.llm.components import components
from rollbook.llm.sides import broadcast_if_few
from rollbook.llm.words import SMALL_SLICE_BYTES, TEXT_ROWS, as_long, freeing, mix, shingles, slices, split_words, spread, texts_of, tidy
from rollbook.session import land

TOKENS, SEGMENTS, DELETIONS = 0, 1, 2
_BANDS = np.uint64(63)
#: Sets that a task of the index remembers, so as not to write the keys of copies again and again (some megabytes).
MET = 50_000


@dataclass(frozen=True)
class Allocation:
    """How many segments each band has, and what its keys are."""

    percent: int = 80
    spare: float = 2.0
    levels: tuple[tuple[int, int], ...] = ()

    def difference(self, sizes):
        """Most elements in which a set of this size and one no larger may differ."""
        return 2 * sizes * (100 - self.percent) // (100 + self.percent)

    def segments(self, band: int) -> int:
        most = self.difference((2 << band) - 1)
        return max(1, int(np.ceil(1.02 * most + self.spare * np.sqrt(1 << band))))

    def level(self, band: int) -> int:
        if self.segments(band) >= 0.75 * (1 << band):
            return TOKENS
        return dict(self.levels).get(band, SEGMENTS)


def _band(sizes: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(sizes, 1).astype(float))[1] - 1


def _segment_sums(hashes: np.ndarray, owner: np.ndarray, band: int, count: int):
    """Per non-empty (set, segment): owner, key, number of elements; and the order of elements and their group."""
    segment = ((mix(hashes + np.uint64(band + 1)) >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    group = (owner.astype(np.int64) << 32) | segment.astype(np.int64)
    order = np.argsort(group, kind="stable")
    group = group[order]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sums = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D))[order], first)
    return (group[first] >> 32), sums, segment[order][first], np.diff(np.append(first, len(group))), order, first


def _keys(sums: np.ndarray, segment: np.ndarray, band: int) -> np.ndarray:
    """A key's low six bits are its band."""
    return (mix(sums + segment * np.uint64(0xD1342543DE82EF95)) & ~_BANDS) | np.uint64(band)


def _node_ids(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(hashes[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])), np.uint64, len(offsets) - 1)


def _measure(allocation: Allocation):
    """Of every text: set size, node, and the units its own band offers without and with deletions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
            offsets, hashes = shingles(split_words(texts_of(batch), lower=True))
            sizes = np.diff(offsets)
            bands = _band(sizes)
            owner = spread(offsets)
            units = np.zeros((2, len(sizes)), np.int64)
            for band in np.unique(bands[sizes > 0]):
                here = bands[owner] == band
                if allocation.level(int(band)) == TOKENS:
                    units[:, bands == band] = sizes[bands == band]
                    continue
                own, _, _, held, _, _ = _segment_sums(hashes[here], owner[here], int(band), allocation.segments(int(band)))
                units[0] += np.bincount(own, minlength=len(sizes))
                units[1] += np.bincount(own, weights=1 + (held > 1), minlength=len(sizes)).astype(np.int64)
            nodes = _node_ids(offsets, hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(nodes.view(np.int64), mask=sizes == 0), pa.array(units[0]), pa.array(units[1])],
                names=["doc_id", "n_shingles", "node", "units", "units_deleted"],
            )

    return run


def _index(allocation: Allocation):
    """(key, node) of every set; a set that is among the last ``MET`` ones of the task is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
            offsets, hashes = shingles(split_words(texts_of(batch), lower=True))
            nodes = _node_ids(offsets, hashes)
            sizes = np.diff(offsets)
            fresh = np.zeros(len(nodes), bool)
            for i, node in enumerate(nodes.tolist()):
                if sizes[i] and node not in met:
                    if len(met) >= MET:
                        met.clear()
                    met.add(node)
                    fresh[i] = True
            bands = _band(sizes)
            owner = spread(offsets)
            for band in np.unique(bands[fresh]):
                for scheme in (int(band), int(band) + 1):
                    wanted = fresh & (bands == band)
                    if scheme > band:
                        wanted &= 100 * sizes >= allocation.percent << scheme
                    here = wanted[owner]
                    if not here.any():
                        continue
                    part, own = hashes[here], owner[here]
                    level = allocation.level(scheme)
                    if level == TOKENS:
                        found = [(own, _keys(mix(part), np.uint64(0), scheme))]
                    else:
                        of, sums, segment, held, order, first = _segment_sums(part, own, scheme, allocation.segments(scheme))
                        found = [(of, _keys(sums, segment, scheme))]
                        if level == DELETIONS:
                            group = np.repeat(np.arange(len(held)), held)
                            many = held[group] > 1
                            left = sums[group] - mix(part ^ np.uint64(0x5851F42D4C957F2D))[order]
                            found.append((of[group][many], _keys(left, segment[group], scheme)[many]))
                    for who, keys in found:
                        yield pa.RecordBatch.from_arrays([as_long(keys), as_long(nodes[who])], names=["key", "node"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
        offsets, hashes = shingles(split_words(texts_of(batch), lower=True))
        values = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), as_long(hashes))
        yield pa.RecordBatch.from_arrays([as_long(_node_ids(offsets, hashes)), values], names=["node", "elements"])


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` with the sizes of both sets and of their intersection."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", F.size("left").alias("n_a"), F.size("right").alias("n_b"), F.size(F.array_intersect("left", "right")).alias("common"))


def _linked(percent: int):
    return F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("common"))


def _apart_pairs(nodes: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of different ``root``, one of them ``outer``, that may be linked; ``nodes`` is ``(node, n, root, outer)``.

    Prefix and positional filter. All elements have one order: those of a single root first, which no pair asked for
    shares, then by the number of nodes that have them. At the first element that two sets share, what follows must
    suffice for the overlap a link needs. So the members of a group of near copies, whose own elements come first,
    do not meet by what the whole group has.
    """
    spelled = land(nodes.join(elements, "node").select("node", "n", "root", "outer", F.explode("elements").alias("element")), "spelled")
    counts = spelled.groupBy("element").agg(F.count("*").alias("holders"), F.min("root").alias("low"), F.max("root").alias("high"), F.max("outer").alias("any")).where("low <> high and any").select("element", "holders")
    here = W.partitionBy("node")
    ranked = spelled.join(counts, "element").withColumn("at", F.col("n") - F.count("*").over(here) + F.row_number().over(here.orderBy("holders", "element")))
    # elements from here on, this one included; the larger set of a pair needs percent of its size, the smaller one more
    ranked = ranked.withColumn("after", F.col("n") - F.col("at") + 1).where(F.lit(100) * F.col("after") >= F.lit(percent) * F.col("n"))
    ranked = land(ranked.select("node", "n", "root", "outer", "element", "after"), "prefixes")

    def step(size):
        return F.floor(F.log(size) / F.lit(math.log(1.1))).cast("int")

    most = F.least("n", F.floor(F.col("after") * (100 + percent) / F.lit(percent)) - F.col("n"))
    larger = ranked.withColumn("step", F.explode(F.sequence(step(F.ceil(F.col("n") * percent / F.lit(100))), step(most))))
    smaller = ranked.where(F.col("after") * (100 + percent) >= F.lit(2 * percent) * F.col("n"))
    smaller = smaller.select("element", step(F.col("n")).alias("step"), F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("root2"), F.col("outer").alias("outer2"), F.col("after").alias("after2"))
    order = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("other") < F.col("node")))
    enough = F.least("after", "after2") * (100 + percent) >= F.lit(percent) * (F.col("n") + F.col("m"))
    may = (F.col("root") != F.col("root2")) & order & enough
    met = larger.where("outer").join(smaller, ["element", "step"]).where(may)
    met = met.unionByName(larger.where("not outer").join(smaller.where("outer2"), ["element", "step"]).where(may))
    return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def shingle_classes(docs: DataFrame, percent: int = 80, spare: float = 2.0) -> DataFrame:
    """Classes of documents linked by shingle similarity, chains included.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. Per row:
    ``doc_id``, ``n_shingles`` (distinct five-word shingles of the lower-cased
    text; a shorter text is one shingle) and ``component_id`` (smallest id
    reachable, its own included). A null or wordless text has no shingle and no
    link. Repeated rows are returned as often as they come, and
    linked. ``percent`` is the least similarity, 51 to 99; ``spare`` adds
    segments beyond those the pigeonhole needs. The function starts jobs.
    """
    if not 51 <= percent <= 99:
        raise ValueError("percent must be 51 to 99")
    spark = docs.sparkSession
    allocation = Allocation(percent, spare)
    texts = docs.select("doc_id", "text")
    sets = land(texts.mapInArrow(tidy(_measure(allocation)), "doc_id long, n_shingles long, node long, units long, units_deleted long"), "sets", TEXT_ROWS)

    # what each band must offer: at most 63 rows
    size = F.col("n_shingles")
    need = F.floor(2 * size * (100 - percent) / F.lit(100 + percent)) + 1
    worst = (
        sets.where("node is not null")
        .groupBy(F.floor(F.log2(size + F.lit(0.5))).cast("int").alias("band"))
        .agg(F.min(F.col("units") - need).alias("plain"), F.min(F.col("units_deleted") - need).alias("deleted"))
        .collect()
    )
    levels = tuple((r["band"], SEGMENTS if r["plain"] >= 0 else DELETIONS if r["deleted"] >= 0 else TOKENS) for r in worst)
    allocation = Allocation(percent, spare, levels)
    plain = [b for b in range(63) if allocation.level(b) == SEGMENTS]

    nodes = land(
        sets.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n"), F.first("units").alias("units"), F.count("*").alias("copies")),
        "nodes",
    )
    by_key, by_node = W.partitionBy("key"), W.partitionBy("node", "own")
    shared = land(
        texts.mapInArrow(tidy(_index(allocation)), "key long, node long")
        .select("key", "node", F.min("node").over(by_key).alias("low"), F.max("node").over(by_key).alias("high"), F.count("*").over(by_key).alias("freq"))
        .where("low <> high")
        .groupBy("key", "node")
        .agg(F.first("freq").alias("freq")),
        "shared",
        TEXT_ROWS,
    )
    # a set looks for partners by its dearest keys only as far as the keys it shares with nobody do not suffice
    band = F.col("key").bitwiseAND(F.lit(63))
    own_band = F.floor(F.log2(F.col("n") + F.lit(0.5))).cast("long")
    units = F.when(band.isin(plain) | ~band.isin([b for b, level in levels if level == DELETIONS]), F.when(band.isin(plain), F.col("units")).otherwise(F.col("n")))
    least = F.floor(2 * F.col("n") * (100 - percent) / F.lit(100 + percent)) + 1
    ranked = (
        shared.join(nodes.select("node", "n", "units"), "node")
        .withColumn("own", band == own_band)
        .withColumn("rank", F.row_number().over(by_node.orderBy("freq", "key")))
        .withColumn("looks", F.col("own") & F.coalesce(F.col("rank") <= least - (units - F.count("*").over(by_node)), F.lit(True)))
    )
    live = land(ranked.withColumn("any", F.max("looks").over(by_key)).where("any").select("key", "node", "n", "looks", "freq"), "live")

    wanted = land(live.select("node").distinct().join(nodes.select("node", "first_doc"), "node"), "wanted")
    ids = broadcast_if_few(land(wanted.select(F.col("first_doc").alias("doc_id")).distinct(), "wanted-docs"))
    elements = land(texts.join(ids, "doc_id", "left_semi").mapInArrow(tidy(_sets), "node long, elements array<long>").dropDuplicates(["node"]), "elements", TEXT_ROWS)

    # first against the node of the key that shares most with others: the text that the rest of a group was copied from
    close = F.lit(100) * F.least("n", "m") >= F.lit(percent) * F.greatest("n", "m")
    weights = live.groupBy("node").agg(F.sum("freq").alias("weight"))
    weighted = land(live.join(weights, "node"), "weighted")
    centre = weighted.groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("c")).select("key", F.col("c.node").alias("other"), F.col("c.n").alias("m"))
    star = live.join(centre, "key").where((F.col("node") != F.col("other")) & close).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    first = land(_measured(star, elements).where(_linked(percent)).select("a", "b"), "first-links")

    # then pairs in different components that share a key; one of the two is not in the component that most of the key's nodes are in
    placed = land(live.join(components(first), "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root")), "placed")
    main = placed.groupBy("key", "root").agg(F.count("*").alias("here")).groupBy("key").agg(F.max(F.struct("here", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    mixed = placed.join(main, "key").groupBy("node", "n", "root").agg(F.max(F.col("root") != F.col("main.root")).alias("outer"))
    rest = _measured(_apart_pairs(land(mixed, "mixed"), elements, percent), elements).where(_linked(percent)).select("a", "b")
    links = land(first.unionByName(rest), "all-links")

    classes = components(links)
    placed = nodes.join(classes, "node", "left").select("node", "first_doc", "copies", F.coalesce("root", "node").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    held = placed.join(smallest, "root").select("node", "component_id")
    return sets.join(held, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without those that are linked to one of a smaller id; of rows with the same id all stay.

    Columns and rows are returned as they come. A null id is never linked.
    """
    copies = land(shingle_classes(docs, percent).where("component_id < doc_id").select("doc_id").distinct(), "copies")
    return docs.join(broadcast_if_few(copies), "doc_id", "left_anti")
