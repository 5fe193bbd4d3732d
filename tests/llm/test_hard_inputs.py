"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollbook.llm import chat, decontaminate, html_blocks, jaccard_join, language, line_dedup, packing, pii, quality_rules, secret_scan
from rollbook.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) for i in range(6))
LONG = " ".join(f"w{i % 997}q{i % 31}" for i in range(120_000))
ROWS = [
    (1, PASSAGE, "en", "a", 1),
    (2, PASSAGE, None, "a", None),
    (2, PASSAGE, None, "a", None),
    (3, None, "en", None, None),
    (4, "", "de", "b", 0),
    (5, " \n\t\v\f\r ", "de", "b", 7),
    (6, LONG, "en", "c", len(LONG)),
    (7, "4111 1111 1111 1111 a@b.co token = abcdefghijkl0123", "en", "c", 1),
    (8, "0" * 50_000 + " " + "+" * 50_000 + "@" * 5_000, "en", "c", 1),
    (None, PASSAGE, "en", "c", 1),
    (9, "🙂 a@b.co 🙂", "en", "c", 1),
]
CLASHING = ("key", "node", "start", "end", "n", "length", "band", "spans", "row", "record", "layout", "turns", "print", "keeper", "root", "shingle", "at", "base", "tokens", "__pieces", "n_lines", "score", "stratum", "found", "limit", "offset", "component_id", "similarity")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING}).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (6, 1, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE.replace("\n", "  ").upper()), (2, None), (3, ""), (4, "two words"), (None, PASSAGE)], "item_id long, text string").withColumn("n", F.lit(1))


def by_id(df, *columns):
    found = {}
    for r in df.collect():
        found.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]])
    return found


def test_line_dedup(docs, none):
    found = by_id(line_dedup.dedup_lines(docs), "n_removed", "text")
    assert found[1] == [(0, PASSAGE)] and found[2] == [(6, "")] * 2 and found[3] == [(0, None)]
    assert found[None] == [(0, PASSAGE)] and found[4] == [(0, "")] and found[6] == [(0, LONG)]
    assert line_dedup.dedup_lines(none).count() == 0
    assert set(docs.columns) <= set(line_dedup.dedup_lines(docs).columns)
    kept = line_dedup.remaining(docs)
    assert kept.columns == docs.columns and sorted(by_id(kept, "text"), key=str) == sorted([1, 3, 4, 5, 6, 7, 8, 9, None], key=str)


def test_secret_scan(docs, none):
    found = by_id(secret_scan.scan(docs).select("doc_id", secret_scan.span_text(F.col("spans")).alias("s")), "s")
    assert found[7] == ["assign:27:51"] and found[3] == [""] and found[4] == [""] and len(found[2]) == 2
    assert found[8] == ["hex:0:50000"]
    assert secret_scan.scan(none).count() == 0


def test_pii(docs, none):
    found = by_id(pii.personal_spans(docs).select("doc_id", pii.span_text(F.col("found")).alias("s")), "s")
    assert found[7] == ["card:0:19,email:20:26"] and found[9] == ["email:2:8"] and found[3] == [""] and found[8] == [""]
    assert pii.personal_spans(none).count() == 0
    assert by_id(pii.masked(docs), "text")[9] == ["🙂 <email> 🙂"] and by_id(pii.masked(docs), "text")[3] == [None]


def test_html(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>" + "word " * 50_000), (3, "u", "<article>a &amp"), (3, "u", "<article>a &amp"), (4, "u", "<a \"" * 500), (5, "u", "a < b <" + "<" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    found = html_blocks.extract_main_text(pages).collect()
    assert len(found) == 7
    assert sorted(r["text"] for r in found if r["page_id"] == 3) == ["a &", "a &"]
    assert [r["n_chars"] for r in found if r["page_id"] is None] == [249_999]
    assert [r["text"] for r in found if r["page_id"] in (1, 2)] == ["", ""]
    assert html_blocks.extract_main_text(pages.where("false")).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x" * 200_000), (1, 1, "assistant", "a"), (2, None, None, "<|im_end|>\\<|"), (None, 0, "a\nb\\", "t"), (3, 0, "assistant", "<"), (3, 1, "assistant", "|x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"record": F.lit(1), "layout": F.lit(2)})
    back = {r["conv_id"]: r for r in chat.read_back(chat.formatted(chat.canonical_turns(chat.from_turn_rows(turns)))).collect()}
    assert [(t["role"], t["text"][:2]) for t in back[1]["turns"]] == [("user", ""), ("assistant", "a"), ("assistant", "xx")]
    assert back[1]["loss_texts"] == ["a", "x" * 200_000]
    assert [tuple(t) for t in back[2]["turns"]] == [("user", "<|im_end|>\\<|")] and [tuple(t) for t in back[None]["turns"]] == [("a\nb\\", "t")]
    assert back[3]["loss_texts"] == ["<", "|x"]
    assert chat.canonical_turns(chat.from_turn_rows(turns.where("false"))).count() == 0


def test_packing(docs, none):
    found = packing.pack(docs, tokenizer_path()).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    lengths = {}
    for r in found:
        lengths.setdefault(r["doc_id"], []).append(r["length"])
    assert lengths[3] == [1] and lengths[4] == [1] and lengths[5] == [1] and None in lengths and len(lengths[2]) == 2 * len(lengths[1])
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_jaccard(docs, none):
    found = by_id(jaccard_join.shingle_classes(docs), "n_shingles", "component_id")
    assert found[1] == [(68, 1)] and found[2] == [(68, 1)] * 2 and found[3] == [(0, 3)] and found[5] == [(0, 5)] and found[7][0][1] == 7
    assert found[None][0][0] == 68
    assert jaccard_join.shingle_classes(none).count() == 0
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns and 2 not in by_id(kept, "text") and None in by_id(kept, "text")


def test_decontamination(docs, none, benchmark):
    found = decontaminate.leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["similarity"], r["start"]) for r in found) == [(1, 1, 1.0, 0), (2, 1, 1.0, 0)]
    assert decontaminate.leaks(none, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.where("false")).count() == 0
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and not {1, 2} & set(by_id(kept, "text"))


def test_language(docs, none):
    field = language.field_of(docs)
    found = by_id(language.identify(docs, field), "lang_pred", "score")
    assert found[3] == [("und", 0.0)] and found[4] == [("und", 0.0)] and found[5] == [("und", 0.0)] and len(found[2]) == 2
    assert found[8] == [("und", 0.0)] and all(0 <= s <= 1 for rows in found.values() for _, s in rows)
    empty = language.field_of(none)
    assert empty.languages == [] and set(by_id(language.identify(docs, empty), "lang_pred")[1]) == {"und"}
    assert language.identify(none, field).count() == 0 and language.accepted(docs, field).columns == docs.columns
    # nothing learned, nothing to reject but texts without a letter
    assert sorted(by_id(language.accepted(docs, empty), "text"), key=str) == sorted([1, 2, 6, 7, 9, None], key=str)


def test_quality(docs, none, labels):
    found = by_id(quality_rules.judged(docs, labels), "n_words", "base_failed", "kept")
    assert found[1] == [(72, False, True)] and found[3] == [(0, True, False)] and found[5] == [(0, True, False)] and len(found[2]) == 2 and None in found
    assert quality_rules.judged(none, labels).count() == 0
    assert quality_rules.judged(docs, labels.where("false")).where("kept").count() == quality_rules.judged(docs, labels).where("kept").count()


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "no such words in any of the texts here")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    plain = spark.createDataFrame(ROWS, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, plain, folder).columns == plain.columns
        assert stage(spark, plain.where("false"), folder).count() == 0
    packed = corpus_pipeline.run(spark, folder)
    assert packed.where("doc_id = 1").count() == 1 and packed.where("doc_id = 2").count() == 0


def test_pipeline_removes_what_it_has_read_and_survives_empty_tables(spark, tmp_path, docs):
    folder, shared = str(tmp_path), spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    spark.createDataFrame([(k, PASSAGE + f" {k}", None, "a", 1) for k in range(1, 4)] + [(9, "12 34", None, "a", 1)], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    before = set(os.listdir(shared))
    packed = corpus_pipeline.run(spark, folder)
    # no label, so no language: what has letters stays; the copies but for their last word go in the next stages
    assert {r["doc_id"] for r in packed.collect()} >= {1} and packed.where("doc_id = 9").count() == 0
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert "decontamination" in left and not left & {"language_id", "line_dedup", "ngram_jaccard", "sample-keys", "word-grams", "nodes", "windows"}
