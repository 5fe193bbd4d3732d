"""Line dedup between documents: shared rare lines, patience diff, deletion from the later document; then passages that do not keep to lines.

A line is evidence only if it is rare. A short line repeats by itself, so its hash
is taken over the line and as many of the following ones as make ``min_words``
words (a long line stands alone): such a key is in two documents only where a
passage of that length repeats. The smallest document id that has a key is the one
that keeps the passage; every other document that has it is aligned with that one.
This takes one row per line, however many documents share it, and needs no limit on
how common a passage may be.

The alignment is a patience diff of line hashes: lines that occur once in both
documents, in the longest order they share, cut the documents in pieces that are
aligned in the same way. Aligned runs of at least ``min_words`` words are deleted
from the later document; passages that the alignment leaves out, because they were
moved or repeat, are then found by their keys. What is deleted is in a document of
a smaller id, and the smallest id that has a passage keeps it.

Passages that start or end inside a line, or whose line breaks moved, are found by
their words: every window of ``min_words`` words that a document of a smaller id has
is cut out. Windows are not all sent around. Each is known by the least hash of the
shorter grams in it, which equal windows share; only those whose least gram is in
several documents are compared as wholes. This loses no window.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.sides import FEW_ROWS, broadcast_if_few
from rollbook.llm.words import SMALL_SLICE_BYTES, TEXT_ROWS, as_long, freeing, hash_strings, mix, slices, split_words, texts_of, tidy
from rollbook.session import land

MIN_WORDS = 50
#: Where a cut by words starts or ends inside a line, fewer words of that line than this go on by chance and stay.
STRAY = 3

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _word_counts(lines: pa.Array) -> np.ndarray:
    parts = pc.ascii_split_whitespace(lines)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(parts.flatten()), 0).to_numpy(zero_copy_only=False)
    return np.diff(np.concatenate(([0], np.cumsum(full)))[offsets - offsets[0]])


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word: (offsets per text, line number in the text, hash, words)."""
    parts = pc.split_pattern(texts, "\n")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    lines = pc.ascii_trim_whitespace(parts.flatten())
    words = _word_counts(lines)
    number = np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))
    full = words > 0
    return np.concatenate(([0], np.cumsum(full)))[offsets], number[full], mix(hash_strings(lines.filter(pa.array(full)))), words[full]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def window_keys(hashes: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every line from which ``min_words`` words follow: (line, end of its window, key)."""
    n = len(hashes)
    before = np.concatenate(([0], np.cumsum(words)))
    end = np.searchsorted(before, before[:-1] + min_words, side="left")
    start = np.flatnonzero(end <= n)
    end = end[start]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, n)[:n], dtype=np.uint64)))
    keys = (sums[end] - sums[start]) * _powers(_INVERSE, n)[start]
    return start, end, mix(keys + (end - start).astype(np.uint64))


def _keys_of(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
            offsets, _, hashes, words = _lines(texts_of(batch))
            found = [np.unique(window_keys(hashes[a:b], words[a:b], min_words)[2]) for a, b in zip(offsets[:-1], offsets[1:])]
            rows = np.repeat(np.arange(len(found)), [len(k) for k in found])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), as_long(np.concatenate(found))], names=["doc_id", "key"])

    return run


def _line_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
        offsets, number, hashes, words = _lines(texts_of(batch))
        at = pa.array(offsets.astype(np.int32))
        arrays = [pa.ListArray.from_arrays(at, v) for v in (pa.array(number.astype(np.int32)), as_long(hashes), pa.array(words.astype(np.int32)))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("print"), *arrays], names=["doc_id", "print", "number", "hash", "words"])


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence, in the order of the first, whose seconds increase (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[at], piles[at] = j, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions of two sequences, increasing in both."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = _increasing([(i, where[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in where])
        if not anchors:
            continue
        matched += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(edges, edges[1:])]
    return sorted(matched)


def common_blocks(a: np.ndarray, words: np.ndarray, b: np.ndarray, b_words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Runs ``[start, end)`` of ``a``, of at least ``min_words`` words, that are in ``b``."""
    left, right = a.tolist(), b.tolist()
    before = np.concatenate(([0], np.cumsum(words))).tolist()
    covered = np.zeros(len(left) + 1, bool)
    blocks: list[tuple[int, int]] = []

    def take(start: int, end: int) -> None:
        if before[end] - before[start] >= min_words:
            blocks.append((start, end))
            covered[start:end] = True

    run: list[tuple[int, int]] = []
    for i, j in [*patience(left, right), (-1, -1)]:
        if run and (i, j) != (run[-1][0] + 1, run[-1][1] + 1):
            take(run[0][0], run[-1][0] + 1)
            run = []
        run.append((i, j))
    there = dict(zip(*(x.tolist() for x in window_keys(b, b_words, min_words)[2::-2])))
    for start, end, key in zip(*(x.tolist() for x in window_keys(a, words, min_words))):
        if key in there and not covered[start:end].all():
            j = there[key] + end - start
            while end < len(left) and j < len(right) and left[end] == right[j]:
                end, j = end + 1, j + 1
            take(start, end)
    return blocks


def _align(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("number", "hash", "words", "kept_hash", "kept_words")]
            rows, first, last = [], [], []
            for i in range(batch.num_rows):
                number, a, words, b, b_words = (c[i].values.to_numpy() for c in columns)
                for start, end in common_blocks(a.view(np.uint64), words, b.view(np.uint64), b_words, min_words):
                    rows.append(i)
                    first.append(number[start])
                    last.append(number[end - 1])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("print").take(at), pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=["doc_id", "print", "first", "last"])

    return run


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``print`` (hash of the text) and ``spans`` of lines to delete (first and last, from 0), only of documents that have any."""
    texts = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("print"), "text")
    keys = land(texts.select("doc_id", "text").mapInArrow(tidy(_keys_of(min_words)), "doc_id long, key long"), "line-keys", TEXT_ROWS)
    firsts = keys.groupBy("key").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")).where("keeper < last").select("key", "keeper")
    pairs = land(keys.join(firsts, "key").where("doc_id > keeper").select("doc_id", "keeper").distinct(), "line-pairs")
    met = land(pairs.select("doc_id").unionByName(pairs.select(F.col("keeper").alias("doc_id"))).distinct(), "line-docs")
    lines = land(texts.join(broadcast_if_few(met), "doc_id", "left_semi").mapInArrow(tidy(_line_arrays), "doc_id long, print long, number array<int>, hash array<long>, words array<int>"), "lines", TEXT_ROWS)
    kept = lines.select(F.col("doc_id").alias("keeper"), F.col("hash").alias("kept_hash"), F.col("words").alias("kept_words"))
    both = pairs.join(lines, "doc_id").join(kept, "keeper").select("doc_id", "print", "number", "hash", "words", "kept_hash", "kept_words")
    found = both.mapInArrow(tidy(_align(min_words)), "doc_id long, print long, first int, last int").distinct()
    return found.groupBy("doc_id", "print").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours."""
    done = 1
    while done < size:
        step = min(done, size - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def word_windows(texts: pa.Array, min_words: int, whole: bool = True) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Windows of ``min_words`` words: (their range per text, key of their least gram, key of all their words; none if not ``whole``)."""
    words = split_words(texts)
    n = len(words.codes)
    ranges = [(int(a), max(int(a), int(b) - min_words + 1)) for a, b in zip(words.offsets[:-1], words.offsets[1:])]
    if n < min_words:
        return ranges, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hashes = mix(hash_strings(words.vocabulary))[words.codes]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, n)[:n], dtype=np.uint64)))
    back = _powers(_INVERSE, n)

    def grams(size: int) -> np.ndarray:
        return mix((sums[size:] - sums[:-size]) * back[: n - size + 1])

    size = (min_words + 1) // 2
    return ranges, _least(grams(size), min_words - size + 1), grams(min_words) if whole else np.zeros(0, np.uint64)


def _least_grams_of(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
            texts = texts_of(batch)
            ranges, least, _ = word_windows(texts, min_words, whole=False)
            fresh = np.ones(len(least), bool)
            fresh[1:] = least[1:] != least[:-1]
            fresh[[a for a, b in ranges if a < b]] = True
            found = []
            for i, ((a, b), spans) in enumerate(zip(ranges, batch.column("spans"))):
                # neighbours mostly have the same least gram
                asked = np.ones(b - a, bool) if spans.is_valid else fresh[a:b]
                if b > a and spans.is_valid:
                    before = np.cumsum([0, *(len(_WORD.findall(x)) for x in texts[i].as_py().split("\n"))])
                    for s in spans.as_py():
                        # all of it is in one earlier document already
                        asked[before[s["first"]] : max(0, before[s["last"] + 1] - min_words + 1)] = False
                found.append(np.unique(least[a:b][asked]))
            rows = np.repeat(np.arange(len(found)), [len(k) for k in found])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), as_long(np.concatenate(found))], names=["doc_id", "gram"])

    return run


def _windows_of(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
            ranges, least, keys = word_windows(texts_of(batch), min_words)
            at, shared = [], batch.column("grams")
            for i, (a, b) in enumerate(ranges):
                at.append(a + np.flatnonzero(np.isin(least[a:b], shared[i].values.to_numpy().view(np.uint64))))
            rows = np.repeat(np.arange(len(at)), [len(k) for k in at])
            at = np.concatenate(at)
            start = at - np.array([a for a, _ in ranges])[rows]
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(taken), batch.column("print").take(taken), pa.array(start.astype(np.int32)), as_long(keys[at])], names=["doc_id", "print", "start", "key"])

    return run


def _few_ids(side: DataFrame, name: str) -> DataFrame | None:
    """The ids of a side for broadcast, unless they are many: by them, texts without a partner there are not shuffled."""
    ids = land(side.select("doc_id").distinct(), name)
    return F.broadcast(ids) if ids.count() <= FEW_ROWS else None


def repeated_windows(docs: DataFrame, spans: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``print`` and ``starts`` (words, from 0) of the windows of ``min_words`` words that a document of a smaller id has.

    Windows inside one of ``spans`` (of ``deleted_lines``) may be missing.
    """
    texts = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("print"), "text")
    marked = texts.join(broadcast_if_few(spans, weight="size(spans)"), ["doc_id", "print"], "left")
    grams = land(marked.select("doc_id", "text", "spans").mapInArrow(tidy(_least_grams_of(min_words)), "doc_id long, gram long"), "word-grams", TEXT_ROWS)
    shared = land(grams.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("gram"), "word-shared")
    asked = land(grams.join(broadcast_if_few(shared), "gram").groupBy("doc_id").agg(F.collect_set("gram").alias("grams")), "word-asked")
    ids = _few_ids(asked, "word-ids")
    wanted = texts if ids is None else texts.join(ids, "doc_id", "left_semi")
    windows = wanted.join(asked, "doc_id").select("doc_id", "print", "text", "grams")
    windows = land(windows.mapInArrow(tidy(_windows_of(min_words)), "doc_id long, print long, start int, key long"), "word-windows", TEXT_ROWS)
    firsts = land(windows.groupBy("key").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")).where("keeper < last").select("key", "keeper"), "word-firsts")
    found = windows.join(broadcast_if_few(firsts), "key").where("doc_id > keeper")
    return found.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("start")).alias("starts"))


def cut_words(text: str, spans: list[tuple[int, int]], starts: list[int], min_words: int) -> tuple[str, int, int]:
    """The text without the lines of ``spans`` and the windows at ``starts``; the lines removed and those cut in part."""
    lines = text.split("\n")
    words = [(i, *m.span()) for i, x in enumerate(lines) for m in _WORD.finditer(x)]
    runs: list[list[int]] = []
    for s in sorted(starts):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = s + min_words
        else:
            runs.append([s, s + min_words])
    gone = {i for a, b in spans for i in range(a, b + 1)}
    cut: dict[int, list[tuple[int, int]]] = {}
    for a, b in runs:
        head = next((k for k in range(a, b) if words[k][0] != words[a][0]), b) - a
        if a and words[a - 1][0] == words[a][0] and head < STRAY:
            a += head
        tail = b - 1 - next((k for k in range(b - 1, a - 1, -1) if words[k][0] != words[b - 1][0]), a - 1)
        if b < len(words) and words[b][0] == words[b - 1][0] and tail < STRAY:
            b -= tail
        # lines between the first and the last one of the run go, blank ones too
        gone.update(range(words[a][0] + 1, words[b - 1][0]))
        while a < b:
            line, end = words[a][0], a + 1
            while end < b and words[end][0] == line:
                end += 1
            if end < len(words) and words[end][0] == line:
                cut.setdefault(line, []).append((words[a][1], words[end][1]))
            else:
                before = words[a - 1][2] if a and words[a - 1][0] == line else 0
                cut.setdefault(line, []).append((before, len(lines[line])))
            a = end
    for line, parts in cut.items():
        left = lines[line]
        for a, b in sorted(parts, reverse=True):
            left = left[:a] + left[b:]
        if _WORD.search(left):
            lines[line] = left
        else:
            gone.add(line)
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone), len(cut.keys() - gone)


def _cut(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(freeing(batches), most=SMALL_SLICE_BYTES):
            left: list[tuple[str | None, int, int]] = []
            for text, spans, starts in zip(*(batch.column(c).to_pylist() for c in ("text", "__spans", "__starts"))):
                cut = text is not None and (spans or starts)
                left.append(cut_words(text, [(s["first"], s["last"]) for s in spans or []], starts or [], min_words) if cut else (text, 0, 0))
            texts, removed, partly = zip(*left)
            made = {"text": pa.array(texts, pa.string()), "n_removed": pa.array(removed, pa.int32()), "n_cut": pa.array(partly, pa.int32())}
            names = [c for c in batch.schema.names if c not in ("__spans", "__starts")]
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in names], names=names)

    return run


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, passages that a document of a smaller id has cut out of ``text``; with ``n_lines``, ``n_removed`` and ``n_cut``.

    A passage is a run of ``min_words`` words or more, however it is broken into
    lines and wherever in a line it starts or ends. Lines are compared without white
    space at their ends, lines without a word are passed over. Where a passage
    takes fewer than ``STRAY`` words of a line at one of its ends, but not the whole
    line, these stay. ``n_removed`` counts lines that are gone, ``n_cut`` those that
    lost some words. All other columns and all rows stay; a text of which nothing is
    left is empty. A null text stays null (no lines). Rows of the same id are one
    document and not compared with each other; a row without id is not compared. The
    function starts jobs.
    """
    spans = land(deleted_lines(docs, min_words), "line-spans")
    starts = repeated_windows(docs, spans, min_words)
    cuts = land(spans.join(starts, ["doc_id", "print"], "full"), "line-cuts")
    ids = _few_ids(cuts, "cut-ids")
    if ids is None:
        return _without(docs, cuts, min_words)
    whole = docs.join(ids, "doc_id", "left_anti").withColumns({"n_lines": F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)), "n_removed": F.lit(0), "n_cut": F.lit(0)})
    return whole.unionByName(_without(docs.join(ids, "doc_id", "left_semi"), cuts, min_words))


def _without(docs: DataFrame, cuts: DataFrame, min_words: int) -> DataFrame:
    """The documents cut. One Arrow step: of a UDF, a filter on the result would make a second one, with a Python worker of its own."""
    cuts = cuts.withColumnsRenamed({"doc_id": "__id", "print": "__print", "spans": "__spans", "starts": "__starts"})
    joined = docs.join(cuts, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__print")), "left").drop("__id", "__print")
    lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    counted = joined.withColumns({"text": F.col("text"), "n_lines": lines, "n_removed": F.lit(0), "n_cut": F.lit(0)})
    return counted.mapInArrow(tidy(_cut(min_words)), counted.drop("__spans", "__starts").schema)


def remaining(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their own passages only, without those of which no word was left; columns stay, ``n_chars`` is brought up to date."""
    cut = dedup_lines(docs, min_words)
    whole = (F.col("n_removed") == 0) & (F.col("n_cut") == 0)
    left = cut.where(whole | F.rlike("text", F.lit(r"[^ \t\n\x0B\f\r]")))
    changed = F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return left.withColumn("n_chars", changed).select(*docs.columns)
