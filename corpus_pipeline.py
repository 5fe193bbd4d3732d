"""From raw documents to packed training sequences: five stages, each one operator.

Every stage takes all that its predecessor kept, as a table, and returns a table; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollbook.llm import decontaminate, jaccard_join, language, line_dedup, packing
from rollbook.llm.queries import read, tokenizer_path
from rollbook.session import new_path, remove, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language of their own, as told by a field trained on the labelled rows."""
    return language.accepted(docs, language.field_of(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out of the later documents that repeat them; documents of which nothing is left go."""
    return line_dedup.remaining(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies."""
    return jaccard_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL twin: language identification, alignment and tokenisation are not SQL. Tested against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again.

    What a stage lands on its way is removed when it is written, and the stage itself when the next one is. An
    empty benchmark drops nothing; without any labelled language, only texts without a letter go in the first stage.
    """
    docs, read_from = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with scratch(spark):
            done = stage(spark, docs, sf_dir)
            done.write.mode("errorifexists").parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        if read_from:
            remove(spark, read_from)
        read_from = path
    return STAGES[-1][1](spark, docs, sf_dir)
