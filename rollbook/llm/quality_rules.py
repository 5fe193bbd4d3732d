"""Quality rules whose cutoffs are chosen under control of the risk to reject good documents.

Every rule has a feature and a grid of cutoffs; a document fails a rule if its
feature lies beyond the cutoff of its stratum. Per stratum, cutoffs are used only
if the labelled documents show, with confidence, that all rules together reject few
good ones: the exact (Clopper-Pearson) upper bound of that rate must be at most
``risk``. The joint settings of all rules are put in one order in advance, loosest
first, each stricter than the one before, and tested in this order at an error level
shared among the strata only, up to the first that fails (fixed-sequence testing):
the first test of a setting that loses too much is the only one that can err, so
that the number of settings costs nothing. With probability ``1 - error`` no stratum
loses more than ``risk`` of its good documents. A stratum with too few labels gets no
cutoff and rejects nothing beyond the base rules; with four strata, 86 good labels
without a rejection are enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.words import hash_strings, mix, slices, split_words, spread, texts_of
from rollbook.session import land

_SPACES = (" ", "\t", "\n", "\v", "\f", "\r")
_SYMBOLS = ("#", "*", "$", "%", "&", "|", "<", ">")


class Rule(NamedTuple):
    """A feature (SQL over the measures) that fails above a cutoff, and the cutoffs to choose from, strictest first."""

    name: str
    feature: str
    cutoffs: tuple[float, ...]


# fixed values: features and grids
RULES = (
    Rule("symbols", "try_divide(n_symbols, n_words)", (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 2.0)),
    Rule("repeats", "try_divide(n_repeat_words, n_words)", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4)),
    Rule("duplicate lines", "try_divide(n_dup_lines, n_lines)", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)),
    Rule("long words", "try_divide(word_chars, n_words)", (5.0, 5.5, 6.0, 6.5, 7.0, 8.0, 9.0, 10.0)),
    Rule("capitals", "try_divide(n_capitals, word_chars)", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
)
#: Share of good documents that may be lost per stratum, and the probability that this fails anywhere.
RISK, ERROR = 0.05, 0.05

MEASURES = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long"


def _count(texts: pa.Array, signs) -> np.ndarray:
    return sum(pc.count_substring(texts, s).to_numpy(zero_copy_only=False).astype(np.int64) for s in signs)


def _repeat_words(codes: np.ndarray, offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per text, words in a window of three that its text has twice or more."""
    n = len(codes)
    out = np.zeros(len(offsets) - 1, np.int64)
    if n < 3:
        return out
    h = hashes[codes]
    owner = spread(offsets)
    same = owner[:-2] == owner[2:]
    window = mix(mix(mix(h[:-2]) * np.uint64(3) + h[1:-1]) * np.uint64(5) + h[2:] + owner[2:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(same)
    order = at[np.argsort(window[at], kind="stable")]
    sorted_ = window[order]
    equal = sorted_[1:] == sorted_[:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    marked = np.zeros(n, bool)
    for k in range(3):
        marked[order[twice] + k] = True
    return out + np.bincount(owner[marked], minlength=len(out))


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier one of the text."""
    parts = pc.split_pattern(texts, "\n")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    coded = parts.flatten().dictionary_encode()
    blank = pc.equal(pc.utf8_length(pc.ascii_trim_whitespace(coded.dictionary)), 0).to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy()
    owner = spread(offsets)
    full = ~blank[codes] if len(codes) else np.zeros(0, bool)
    owner, codes = owner[full], codes[full].astype(np.int64)
    n = np.bincount(owner, minlength=len(offsets) - 1)
    distinct = np.unique(owner.astype(np.int64) << 32 | codes) >> 32
    return n, n - np.bincount(distinct, minlength=len(offsets) - 1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = texts_of(batch)
        words = split_words(texts)
        lines, repeated = _lines(texts)
        chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) - _count(texts, _SPACES)
        capitals = pc.utf8_length(texts).to_numpy(zero_copy_only=False) - pc.utf8_length(pc.replace_substring_regex(texts, "[A-Z]", "")).to_numpy(zero_copy_only=False)
        columns = [np.diff(words.offsets), chars, _count(texts, _SYMBOLS), repeated, _repeat_words(words.codes, words.offsets, hash_strings(words.vocabulary)), lines, capitals.astype(np.int64)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("stratum"), *map(pa.array, columns)],
            names=["doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"],
        )


def measures(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts of every whole text, one pass and no shuffle; a null text has no word and no line."""
    return docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text").mapInArrow(_measure, MEASURES)


def upper_bound(rejected: int, n: int, error: float) -> float:
    """Exact upper confidence bound of a rate of which ``rejected`` in ``n`` were seen."""
    if n <= 0 or rejected >= n:
        return 1.0

    def at_most(p: float) -> float:
        log_p, log_q = math.log(p), math.log1p(-p)
        base = math.lgamma(n + 1)
        return math.fsum(math.exp(base - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * log_p + (n - k) * log_q) for k in range(rejected + 1))

    low, high = rejected / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        if p <= 0 or (p < 1 and at_most(p) > error):
            low = p
        else:
            high = p
    return high


def base_failed() -> F.Column:
    """Too few words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def settings(rules: tuple[Rule, ...]) -> list[tuple[float | None, ...]]:
    """The joint settings in the order of their tests: from none, rule after rule one cutoff stricter, round by round."""
    now: list[float | None] = [None] * len(rules)
    out = []
    for back in range(1, max((len(r.cutoffs) for r in rules), default=0) + 1):
        for i, rule in enumerate(rules):
            if back <= len(rule.cutoffs):
                now[i] = rule.cutoffs[-back]
                out.append(tuple(now))
    return out


def _choose(rules: tuple[Rule, ...], risk: float, error: float):
    steps = settings(rules)

    def run(key, found):
        import pandas as pd

        row = found.iloc[0]
        n = int(row["good"])
        level = error / int(row["strata"])
        chosen: tuple[float | None, ...] = (None,) * len(rules)
        for k, step in enumerate(steps):
            if upper_bound(int(row[f"s{k}"]), n, level) > risk:
                break
            chosen = step
        out = {"stratum": row["stratum"]} | {f"cutoff{i}": c for i, c in enumerate(chosen)}
        return pd.DataFrame([out]).astype({f"cutoff{i}": "float64" for i in range(len(rules))})

    return run


def thresholds(measured: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Per stratum, the last joint setting in the order of ``settings`` that the labelled good documents allow (null: no cutoff).

    ``labels (doc_id, quality)``: quality 1 is good; other values and nulls are no
    evidence. Labels repeated for a document count once. Documents that the base
    rules reject are no evidence either, as no cutoff decides on them.
    """
    good = labels.where("quality = 1").select("doc_id").distinct()
    fails = [F.array(*(F.coalesce(F.expr(r.feature) > F.lit(c), F.lit(False)) for r, c in zip(rules, step) if c is not None)) for step in settings(rules)]
    rates = [F.sum(F.array_contains(f, True).cast("long")).alias(f"s{k}") for k, f in enumerate(fails)]
    seen = measured.where(~base_failed()).join(good, "doc_id", "left_semi")
    counts = seen.groupBy("stratum").agg(F.count("*").alias("good"), *rates)
    counts = land(counts, "rates")
    strata = max(1, counts.count())
    schema = "stratum string, " + ", ".join(f"cutoff{i} double" for i in range(len(rules)))
    return counts.withColumn("strata", F.lit(strata)).groupBy("stratum").applyInPandas(_choose(rules, risk, error), schema)


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Measures of every document, ``base_failed``, the rules it fails and ``kept``.

    Strata are the values of a column (null is a stratum of its own). One row per
    row of ``docs``. Without labels only the base rules decide. The function
    starts jobs.
    """
    measured = land(measures(docs, stratum), "measures")
    chosen = land(thresholds(measured, labels, rules, risk, error), "thresholds").withColumnRenamed("stratum", "of")
    joined = measured.join(chosen, F.col("stratum").eqNullSafe(F.col("of")), "left")
    failed = F.array_compact(F.array(*(F.when(F.expr(r.feature) > F.col(f"cutoff{i}"), F.lit(r.name)) for i, r in enumerate(rules))))
    return joined.withColumn("failed_rules", failed).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("of", *(f"cutoff{i}" for i in range(len(rules))))
