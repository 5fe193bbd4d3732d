"""Benchmark items found in documents: SimHash of item-sized windows, Hamming blocks, exact verification.

Texts are five-word shingles of lower-cased words (a shorter text is one shingle). A
window is as many shingles of a document as an item has. Its fingerprint is the
bitwise majority of its shingles' hashes, each as often as it occurs. Fingerprints are
cut into ``BLOCKS`` blocks; two that differ in at most ``RADIUS = BLOCKS - 1`` bits
agree in one block at least, so an index of the items by (item, block, value) gives
every window within the radius of its item. What it gives is verified by the exact
weighted similarity of the shingles.

Fingerprints are made where an item can be: a similarity of ``percent`` needs ``n *
percent / 100`` common shingles for an item of ``n``, in whatever order, so every run of
a document that holds this many shared shingles within ``n`` places gives all starts
whose window covers it, and no other window can reach the similarity. At a
similarity of 0.8, two fingerprints differ in 9.7 bits on average, and in more than
the radius of 15 for one window in 45; an item is lost only if that happens to all of
its windows. Tests measure the share of items found.

Column expressions only. The texts are read once to find shared shingles, and once
more for the documents that hold enough of them, from which only the stretches in
question are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.sides import broadcast_if_few
from rollbook.session import land

SHINGLE = 5
PERCENT = 80
#: Blocks of a 64-bit fingerprint, and the differing bits up to which an equal block is certain.
BLOCKS = 16
RADIUS = BLOCKS - 1
#: Starts of windows handled in one row.
SPAN = 256

_SPACE = " \\t\\n\\x0B\\f\\r"


def shingles(text: str) -> Column:
    """Hashes of the five-word shingles of a text column, in order; of a shorter text the hash of all its words; null has none."""
    words = f"split(regexp_replace(regexp_replace(lower({text}), '^[{_SPACE}]+', ''), '[{_SPACE}]+$', ''), '[{_SPACE}]+')".replace("\\", "\\\\")
    hashes = f"transform({words}, w -> xxhash64(w))"
    each = ", ".join(f"h[i + {k}]" for k in range(SHINGLE))
    rolled = f"if(size(h) >= {SHINGLE}, transform(sequence(0, size(h) - {SHINGLE}), i -> xxhash64({each})), array(xxhash64(h)))"
    # a list of one list, so that the hashes of the words are computed once
    return F.expr(f"if(rlike({text}, '[^{_SPACE}]'), transform(array({hashes}), h -> {rolled})[0], cast(array() as array<bigint>))".replace(f"'[^{_SPACE}]'", f"'[^{_SPACE}]'".replace("\\", "\\\\")))


def similarity(a: str, b: str) -> str:
    """Weighted Jaccard similarity of two arrays, as SQL text: a value counts as often as it occurs."""
    plain = f"size(array_intersect({a}, {b}))"
    counted = f"aggregate(array_distinct({a}), 0, (k, x) -> k + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))"
    common = f"if(size(array_distinct({a})) = size({a}) and size(array_distinct({b})) = size({b}), {plain}, {counted})"
    total = f"size({a}) + size({b})"
    return f"if({total} > 0, transform(array({common}), c -> double(c) / ({total} - c))[0], 0.0D)"


def fingerprint(values: str) -> str:
    """The bitwise majority of an array of hashes, as SQL text."""
    ones = f"size(filter({values}, h -> getbit(h, bit) = 1))"
    return f"aggregate(sequence(0, 63), 0L, (print, bit) -> if(2 * {ones} > size({values}), print | shiftleft(1L, bit), print))"


def window_prints() -> str:
    """(start, print) of every one of ``starts``, from the columns of a stretch, as SQL text.

    32 counters of two bits each (bit j in the low half, bit j + 32 in the high half) are counted for the first
    window; what comes in and goes out as it slides along is summed up beside it.
    """
    lane = lambda h: f"(shiftrightunsigned({h}, j) & {(1 << 32) + 1}L)"
    first = "slice(stretch, 1, greatest(least(starts[0] + n - low, size(stretch)), 0))"
    base = f"aggregate({first}, 0L, (sum, h) -> sum + {lane('h')})"

    def passed(place: str) -> str:
        step = f"array_append(sums, element_at(sums, -1) + coalesce({lane(f'get(stretch, {place} - low)')}, 0L))"
        return f"aggregate(sequence(starts[0], element_at(starts, -1)), array(0L), (sums, at) -> {step})"

    lanes = f"transform(sequence(0, 31), j -> named_struct('base', {base}, 'gone', {passed('at')}, 'come', {passed('at + n')}))"
    ones = "transform(lanes, lane -> lane.base + lane.come[start - starts[0]] - lane.gone[start - starts[0]])"
    length = "greatest(least(start + n - low, size(stretch)) - (greatest(start, 0) - low), 0)"
    bit = lambda count, place: f"if(2 * ({count}) > {length}, shiftleft(1L, {place}), 0L)"
    low, high = bit(f"ones[j] & {(1 << 32) - 1}L", "j"), bit("shiftrightunsigned(ones[j], 32)", "j + 32")
    majority = f"aggregate(sequence(0, 31), 0L, (print, j) -> print | {low} | {high})"
    each = f"named_struct('start', start, 'print', transform(array({ones}), ones -> {majority})[0])"
    return f"transform(array({lanes}), lanes -> transform(starts, start -> {each}))[0]"


def blocks(value: str) -> str:
    """The blocks of a fingerprint, as SQL text."""
    width = 64 // BLOCKS
    return f"transform(sequence(0, {BLOCKS - 1}), k -> int(shiftrightunsigned({value}, k * {width}) & {(1 << width) - 1}))"


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, similarity, start``: documents with a window at least that similar to an item.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other
    columns are ignored. One row per document and item, with the greatest similarity
    and the first word (from 0) of such a window. Windows reach over the ends of a
    document as far as they have words. Null and wordless texts match nothing; an
    item of fewer than five words matches only a document of the same words.
    Repeated rows give no further rows. The function starts jobs.
    """
    items = benchmark.where("item_id is not null").select("item_id", shingles("text").alias("item")).where("size(item) > 0")
    index = broadcast_if_few(items.select("item_id", F.size("item").alias("n"), F.explode(F.array_distinct("item")).alias("shingle")).distinct())
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    need = f"greatest(1, (n * {percent} + 99) div 100)"
    runs = f"filter(sequence(0, size(at) - {need}), i -> at[i + {need} - 1] - at[i] < n)"
    starts = f"array_distinct(flatten(transform({runs}, i -> sequence(at[i + {need} - 1] - n + 1, at[i]))))"
    windows = land(
        texts.select("doc_id", F.posexplode(shingles("text")).alias("at", "shingle"))
        .join(index, "shingle")
        .groupBy("doc_id", "item_id", "n")
        .agg(F.array_sort(F.collect_set("at")).alias("at"))
        .where(f"size(at) >= {need}")
        .select("doc_id", "item_id", "n", F.expr(starts).alias("starts"))
        .where("size(starts) > 0"),
        "windows",
    )
    met = broadcast_if_few(windows.select("doc_id").distinct())
    hit = texts.join(met, "doc_id", "left_semi").select("doc_id", shingles("text").alias("all"))
    # starts that lie together share a row, which holds the stretch of the document that their windows need
    pair = ["doc_id", "item_id", "n"]
    spans = windows.select(*pair, F.explode("starts").alias("start")).groupBy(*pair, F.floor(F.col("start") / SPAN).alias("span")).agg(F.array_sort(F.collect_set("start")).alias("starts"))
    low, high = "greatest(starts[0], 0)", "least(element_at(starts, -1) + n, size(all))"
    cut = spans.join(hit, "doc_id").select(*pair, "span", "starts", F.expr(low).alias("low"), F.expr(f"slice(all, {low} + 1, greatest({high} - {low}, 0))").alias("stretch"))
    cut = land(cut, "stretches")
    window = "slice(stretch, greatest(start, 0) - low + 1, greatest(least(start + n - low, size(stretch)) - (greatest(start, 0) - low), 0))"

    # the index of the items by block, and the windows that it gives
    held = items.withColumn("n", F.size("item")).dropDuplicates(["item_id", "item"])
    known = land(held.select("item_id", "n", "item", F.expr(fingerprint("item")).alias("item_print")), "item-prints")
    entries = broadcast_if_few(known.select("item_id", "n", "item_print", F.posexplode(F.expr(blocks("item_print"))).alias("block", "value")))
    prints = cut.select(*pair, "span", F.expr(f"inline({window_prints()})"))
    looked_up = prints.select("*", F.posexplode(F.expr(blocks("print"))).alias("block", "value")).join(entries, ["item_id", "n", "block", "value"])
    near = looked_up.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).groupBy(*pair, "span").agg(F.collect_set("start").alias("near"))

    # exact verification
    checked = cut.join(near, [*pair, "span"]).join(known.select("item_id", "n", "item"), ["item_id", "n"])
    scores = f"transform(near, start -> named_struct('similarity', transform(array({window}), w -> if(size(w) > 0, {similarity('w', 'item')}, 0.0D))[0], 'start', -start))"
    scored = checked.select("doc_id", "item_id", F.expr(f"array_max({scores})").alias("best")).where(F.col("best.similarity") * 100 >= percent)
    best = scored.groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return best.select("doc_id", "item_id", "best.similarity", F.greatest(-F.col("best.start"), F.lit(0)).alias("start"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no item; all columns and all other rows stay, those without id too."""
    leaky = land(leaks(docs, benchmark, percent).select("doc_id").distinct(), "leaky")
    return docs.join(broadcast_if_few(leaky), "doc_id", "left_anti")
