"""Language of words and texts: a linear-chain conditional random field.

Every word has a score per language, the sum of learned weights of its features
(itself, prefixes and suffixes of one to three characters, character bigrams and
trigrams with word ends, and whether it is in the lexicon of frequent words of a
language); learned transitions tie neighbours together. Forward-backward over the
whole text labels every word, in texts that switch between languages too; a text's
language is the one with the most expected words.

The field is trained here, on the log-likelihood, from a sample of labelled texts
of documented size; sequences are put together from passages of several languages,
so that the transitions learn switches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollbook.llm.sides import broadcast_if_few
from rollbook.llm.words import freeing, hash_strings, mix, slices, split_words, spread, texts_of, tidy
from rollbook.session import land

#: Labelled texts per language in the training sample, words of a passage, and sequences made of them.
TEXTS, PASSAGE, SEQUENCES, PIECES = 300, 60, 1500, 3
#: Hashed features, words of each language's lexicon, passes and step of the training.
FEATURES, LEXICON, PASSES, STEP = 1 << 16, 1000, 4, 0.3
UNKNOWN = "und"
#: Share of its words that the language of a text must have for the text to be accepted.
LEAST = 0.4


class Field(NamedTuple):
    """A trained field: weights of hashed features and of lexicons, transitions (from, to) and first labels."""

    languages: list[str]
    lexicon: list[str]
    member: np.ndarray
    weights: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray
    first: np.ndarray


def word_features(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(word of every feature, feature, lower-cased words, whether a word has a letter)."""
    lower = pc.utf8_lower(vocabulary)
    n = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "\n" + "".join(w + "\n" for w in lower.to_pylist())
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.cumsum(np.concatenate(([1], n + 1)))[:-1]
    word = np.arange(len(n))
    owners, found = [word], [hash_strings(lower)]

    def add(who: np.ndarray, at: np.ndarray, size: int, salt: int) -> None:
        h = np.full(len(at), salt, np.uint64)
        for k in range(size):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + x[at + k])
        owners.append(who)
        found.append(h)

    for size in (1, 2, 3):
        long = n >= size
        add(word[long], start[long], size, 10 + size)
        add(word[long], (start + n - size)[long], size, 20 + size)
    for size in (2, 3):
        count = n + 3 - size
        who = np.repeat(word, count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start - 1, count)
        add(who, at, size, 30 + size)
    letters = pc.match_substring_regex(vocabulary, r"\p{L}").to_numpy(zero_copy_only=False)
    return np.concatenate(owners), (np.concatenate(found) % np.uint64(FEATURES)).astype(np.int64), lower, letters.astype(bool)


def _scores(field: Field, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Score of every word per language, and whether it has a letter; other words say nothing."""
    k = len(field.languages)
    if not len(vocabulary):
        return np.zeros((0, k), np.float32), np.zeros(0, bool)
    owner, feature, lower, letters = word_features(vocabulary)
    out = np.empty((len(vocabulary), k), np.float32)
    for j in range(k):
        out[:, j] = np.bincount(owner, weights=field.weights[feature, j], minlength=len(vocabulary))
    if field.lexicon:
        entry = pc.fill_null(pc.index_in(lower, pa.array(field.lexicon)), -1).to_numpy(zero_copy_only=False)
        known = entry >= 0
        out[known] += field.member[entry[known]] @ field.lexicon_weights
    out[~letters] = 0
    return out, letters


def marginals(scores: np.ndarray, starts: np.ndarray, transitions: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Forward-backward over texts laid end to end; ``starts`` marks first words.

    Per word the probability of each label; with ``pairs`` also, per word that is not
    a first word, that of each label together with the one before (from, to).

    A step is the matrix ``exp(transitions) * exp(score)``, at a first word one that
    forgets what came before. All words are cut into about as many runs as a run has
    words; a column of all runs is one array operation: the product of every run,
    then what enters each run, then every word.
    """
    n, k = scores.shape
    if not n:
        return (np.zeros((0, k)), np.zeros((0, k, k))) if pairs else np.zeros((0, k))
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    emit = np.ones((rows * width, k), np.float32)
    emit[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    emit = emit.reshape(rows, width, k)
    begin = np.zeros(rows * width, bool)
    begin[:n] = starts
    begin[n:] = True
    begin = begin.reshape(rows, width)
    go = np.exp(transitions - transitions.max()).astype(np.float32)
    fresh = np.broadcast_to(np.exp(first - first.max()).astype(np.float32), (k, k))

    def step(c: int) -> np.ndarray:
        return np.where(begin[:, c, None, None], fresh, go) * emit[:, c, None, :]

    product = np.broadcast_to(np.eye(k, dtype=np.float32), (rows, k, k)).copy()
    for c in range(width):
        product = product @ step(c)
        product /= product.sum(axis=(1, 2), keepdims=True)
    enter = np.empty((rows, k), np.float32)
    leave = np.empty((rows, k), np.float32)
    now = np.full(k, 1 / k, np.float32)
    for r in range(rows):
        enter[r] = now
        now = now @ product[r]
        now /= now.sum()
    now = np.full(k, 1 / k, np.float32)
    for r in range(rows - 1, -1, -1):
        leave[r] = now
        now = product[r] @ now
        now /= now.sum()
    forward = np.empty((rows, width, k), np.float32)
    now = enter
    for c in range(width):
        now = (now[:, None, :] @ step(c))[:, 0, :]
        now = now / now.sum(axis=1, keepdims=True)
        forward[:, c] = now
    alpha, beta = (forward.copy(), np.empty_like(forward)) if pairs else (None, None)
    now = leave
    for c in range(width - 1, -1, -1):
        if pairs:
            beta[:, c] = now
        both = forward[:, c] * now
        forward[:, c] = both / np.maximum(both.sum(axis=1, keepdims=True), 1e-30)
        now = (step(c) @ now[:, :, None])[:, :, 0]
        now = now / now.sum(axis=1, keepdims=True)
    belief = forward.reshape(-1, k)[:n].astype(np.float64)
    if not pairs:
        return belief
    inner = np.flatnonzero(~starts)
    to = (emit * beta).reshape(-1, k)[inner].astype(np.float64)
    joint = alpha.reshape(-1, k)[inner - 1][:, :, None] * go[None] * to[:, None, :]
    return belief, joint / joint.sum(axis=(1, 2), keepdims=True)


def train(sample: list[tuple[str, str]], seed: int = 7) -> Field:
    """A field from (language, passage) pairs."""
    languages = sorted({lang for lang, _ in sample})
    k = len(languages)
    field = Field(languages, [], np.zeros((0, k), np.float32), np.zeros((FEATURES, k), np.float32), np.zeros((k, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return field
    words = split_words(pa.array([text for _, text in sample]))
    label = np.array([languages.index(lang) for lang, _ in sample])
    owner, feature, lower, letters = word_features(words.vocabulary)
    order = np.argsort(owner, kind="stable")
    owner, feature = owner[order], feature[order]
    bounds = np.searchsorted(owner, np.arange(len(words.vocabulary) + 1))
    # lexicons: the most frequent words of each language
    names = lower.to_pylist()
    word_label = label[spread(words.offsets)]
    lists = [[names[c] for c, _ in Counter(words.codes[word_label == j].tolist()).most_common(LEXICON)] for j in range(k)]
    lexicon = sorted(set().union(*lists))
    member = np.stack([np.isin(lexicon, part) for part in lists], axis=1).astype(np.float32)
    entry = pc.fill_null(pc.index_in(lower, pa.array(lexicon)), -1).to_numpy(zero_copy_only=False)
    in_lists = np.zeros((len(names), k), np.float32)
    in_lists[entry >= 0] = member[entry[entry >= 0]]

    weights, listed = np.zeros((FEATURES, k)), np.zeros((k, k))
    transitions, first = np.zeros((k, k)), np.zeros(k)
    squares = [np.full(p.shape, 1e-6) for p in (weights, listed, transitions, first)]
    rng = np.random.default_rng(seed)
    by_label = [np.flatnonzero(label == j) for j in range(k)]
    for _ in range(PASSES):
        for _ in range(SEQUENCES // 50):
            codes, truth, starts = [], [], []
            for _ in range(50):
                starts.append(sum(map(len, codes)))
                for j in rng.integers(0, k, PIECES):
                    i = rng.choice(by_label[j])
                    a, b = int(words.offsets[i]), int(words.offsets[i + 1])
                    size = int(rng.integers(5, 20))
                    a = int(rng.integers(a, max(a, b - size) + 1))
                    codes.append(words.codes[a : min(a + size, b)])
                    truth.append(np.full(len(codes[-1]), j))
            code, true = np.concatenate(codes), np.concatenate(truth)
            if not len(code):
                continue
            begin = np.zeros(len(code), bool)
            begin[[s for s in starts if s < len(code)]] = True
            sizes = bounds[code + 1] - bounds[code]
            flat = feature[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(bounds[code], sizes)]
            position = np.repeat(np.arange(len(code)), sizes)
            speaks = letters[code][:, None]
            score = np.stack([np.bincount(position, weights=weights[flat, j], minlength=len(code)) for j in range(k)], axis=1)
            score = (score + in_lists[code] @ listed) * speaks
            belief, pair = marginals(score, begin, transitions, first, pairs=True)
            error = (np.eye(k)[true] - belief) * speaks
            gradient = np.stack([np.bincount(flat, weights=error[position, j], minlength=FEATURES) for j in range(k)], axis=1)
            inner = np.flatnonzero(~begin)
            seen = np.zeros((k, k))
            np.add.at(seen, (true[inner - 1], true[inner]), 1)
            start = np.bincount(true[begin], minlength=k) - belief[begin].sum(axis=0)
            for p, square, g in zip((weights, listed, transitions, first), squares, (gradient, in_lists[code].T @ error, seen - pair.sum(axis=0), start)):
                square += g * g
                p += STEP * g / np.sqrt(square)
    return Field(languages, lexicon, member, weights.astype(np.float32), listed.astype(np.float32), transitions, first)


def training_sample(labelled: DataFrame, texts: int = TEXTS, passage: int = PASSAGE) -> list[tuple[str, str]]:
    """At most ``texts`` passages of ``passage`` words per language, chosen by hashes of the texts, from anywhere in them."""
    rows = labelled.where("lang is not null and lang <> '' and rlike(text, '\\\\p{L}')").select("lang", "text", F.xxhash64("text").alias("h"))
    # the choice is made on hashes alone; texts are fetched for what was chosen
    best = rows.select("lang", "h").distinct().withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("h"))).where(F.col("rank") <= texts)
    best = broadcast_if_few(land(best.select("lang", "h"), "sample-keys"))
    words = F.split(F.trim("text"), r"[ \t\n\x0B\f\r]+")
    start = F.pmod("h", F.greatest(F.size(words) - passage, F.lit(0)).cast("long") + 1).cast("int") + 1
    picked = rows.join(best, ["lang", "h"]).select("lang", "h", F.array_join(F.slice(words, start, F.lit(passage)), " ").alias("passage"))
    picked = picked.groupBy("lang", "h").agg(F.min("passage").alias("passage"))
    return sorted((r["lang"], r["passage"]) for r in picked.collect())


def _labels(field: Field, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of its language (that of unknown: one past the last) and expected share of its words in it."""
    words = split_words(texts_of(batch))
    n, k = batch.num_rows, len(field.languages)
    best, share = np.full(n, k), np.zeros(n)
    if k and len(words.codes):
        scores, letters = _scores(field, words.vocabulary)
        owner = spread(words.offsets)
        starts = np.zeros(len(words.codes), bool)
        starts[words.offsets[:-1][np.diff(words.offsets) > 0]] = True
        belief = marginals(scores[words.codes], starts, field.transitions, field.first) if k > 1 else np.ones((len(owner), 1))
        speaks = letters[words.codes]
        sums = np.stack([np.bincount(owner, weights=belief[:, j] * speaks, minlength=n) for j in range(k)], axis=1)
        total = np.bincount(owner, weights=speaks, minlength=n)
        some = total > 0
        best[some] = sums[some].argmax(axis=1)
        share[some] = np.clip(sums[some].max(axis=1) / total[some], 0, 1)
    return best, share


def _predict(field: Field):
    names = np.array([*field.languages, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(freeing(batches), most=1 << 20):
            best, share = _labels(field, batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(share)], names=["doc_id", "lang_pred", "score"])

    return run


def _accept(field: Field, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # small slices: in the pipeline these workers run beside a JVM that other stages have filled
        for batch in slices(freeing(batches), most=1 << 18):
            if not field.languages:
                yield batch.filter(pc.match_substring_regex(texts_of(batch), r"\p{L}"))
                continue
            best, share = _labels(field, batch)
            yield batch.filter(pa.array((best < len(field.languages)) & (share >= least)))

    return run


def identify(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (expected share of its words in that language) of every row.

    A null text, one without a letter, and any text if the field knows no language
    have ``und`` and 0. Only the text is looked at; repeated rows stay. One pass, no
    shuffle.
    """
    return docs.select("doc_id", "text").mapInArrow(tidy(_predict(field)), "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, field: Field, least: float = LEAST) -> DataFrame:
    """The rows of which one language has at least that share of the words; all columns stay as they are.

    A field that knows no language rejects only texts without a letter.
    """
    return docs.mapInArrow(tidy(_accept(field, least)), docs.schema)


def held_out(doc_id: Column) -> Column:
    """Documents that no training may see: a third, by a checksum of the id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def field_of(docs: DataFrame) -> Field:
    """A field trained on the documents that are not held out."""
    return train(training_sample(docs.where(~held_out(F.col("doc_id")))))
