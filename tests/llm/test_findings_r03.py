"""What the findings of round 3 asked for: work in proportion to a group's size, and only what is needed shuffled."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollbook.llm import jaccard_join, language, line_dedup, packing, words
from rollbook.llm.queries import tokenizer_path
from rollbook.session import ARROW_ROWS, land

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    words = text.lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def test_group_without_its_original(spark, monkeypatch):
    """Near copies too far from each other, the text they were made from not among them: pairs looked at stay in proportion to their number."""
    dice = random.Random(3)
    base = [f"word{i}" for i in range(150)]
    rows = []
    for d in range(400):
        words = list(base)
        for at in dice.sample(range(150), dice.randint(4, 6)):
            words[at] += f"x{d}y{at}"
        rows.append((d, " ".join(words)))
    rows += [(1000 + d, rows[d][1].replace("word77 ", f"other{d} ")) for d in range(0, 400, 40)]
    looked = []
    measured = jaccard_join._measured

    def counted(pairs, sets):
        looked.append(pairs.count())
        return measured(pairs, sets)

    monkeypatch.setattr(jaccard_join, "_measured", counted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.shingle_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    sets = {d: shingle_set(t) for d, t in rows}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    assert got == {d: top(d) for d in sets}
    assert sum(looked) <= 15 * len(rows), looked


def test_least_grams_are_all_sent():
    """Of a text without spans, every least gram comes out once, although neighbours are looked at only where they change."""
    dice = random.Random(5)
    texts = [" ".join(f"w{dice.randint(0, 40)}" for _ in range(n)) for n in (0, 49, 50, 51, 300, 50, 1000)] + [None, "a " * 200]
    spans = pa.array([None] * len(texts), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), spans], names=["doc_id", "text", "spans"])
    got = [(r["doc_id"], r["gram"]) for b in line_dedup._least_grams_of(50)(iter([batch])) for r in b.to_pylist()]
    ranges, least, _ = line_dedup.word_windows(pa.array(["" if t is None else t for t in texts]), 50)
    assert len(got) == len(set(got))
    assert set(got) == {(i, g) for i, (a, b) in enumerate(ranges) for g in least[a:b].view("int64").tolist()}


def test_texts_without_a_cut_are_not_shuffled(spark):
    """The final join deals out only the documents that lose something; all rows come back as before."""
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, passage), (2, "own\n" + passage), (2, "another row\nof this id"), (3, "a\nb"), (4, None), (None, passage)]
    cut = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["n_lines"], r["n_removed"], r["n_cut"]) for r in cut.collect())
    assert got == [(0, passage, 1, 0, 0), (1, passage, 1, 0, 0), (2, "another row\nof this id", 2, 0, 0), (2, "own", 2, 1, 0), (3, "a\nb", 2, 0, 0), (4, "", 0, 0, 0)]
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_worker_gives_memory_back():
    """When a task's rows are through, what Arrow kept for later is given back."""
    given = []

    class Pool:
        def release_unused(self):
            given.append(True)

    texts = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c d e f"])], names=["doc_id", "text"])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(words.pa, "default_memory_pool", Pool)
        step = words.tidy(lambda batches: (b for b in batches))(iter([texts]))
        assert next(step) is texts and not given
        assert next(step, None) is None and given


def test_cut_of_the_pipeline_is_one_python_step(spark):
    """The filter of the stage does not make a second Python step, whose workers would stay beside the later stages."""
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, passage), (2, "own " + passage), (3, passage), (4, None), (5, "a b")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    left = line_dedup.remaining(docs)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") + plan.count("ArrowEvalPython") == 1, plan
    assert sorted(tuple(r) for r in left.collect()) == [(1, passage, len(passage)), (2, "own", 3), (4, None, None), (5, "a b", 3)]


def test_word_memory_is_bounded(monkeypatch):
    """The tokenizer's words stay within the bound, those in use are kept, and ids are as without memory."""
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    encoder = packing.Encoder(tokenizer_path())
    for i in range(100):
        for word in (f"word{i}", "often"):
            ids = encoder.whole.encode(word, add_special_tokens=False).ids
            assert np.frombuffer(encoder.word(word), np.uint32).tolist() == ids
            assert len(encoder.known) + len(encoder.older) <= 20 and word in encoder.known


def test_landing_in_small_batches(spark):
    """Arrow steps get few rows while their result is landed; the session's own setting is as before."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int32())})

    before = spark.conf.get(ARROW_ROWS)
    assert int(before) > 50
    found = land(spark.range(0, 200, 1, 1).mapInArrow(sizes, "n int"), "small", 50)
    assert [r["n"] for r in found.collect()] == [50] * 4 and spark.conf.get(ARROW_ROWS) == before


def test_language_step_takes_small_slices():
    """The pipeline's language step handles little text at once, and keeps the rows it kept."""
    field = language.train([])
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(["a bc " * 1000, "1 2 " * 10, None] * 100)], names=["doc_id", "text"])
    found = list(language._accept(field, language.LEAST)(iter([batch])))
    assert [d for b in found for d in b.column("doc_id").to_pylist()] == list(range(0, 300, 3))
    assert len(found) > 1 and max(sum(map(len, b.column("text").to_pylist())) for b in found) <= 1 << 18
