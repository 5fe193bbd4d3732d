"""Chat records of many layouts as canonical turns, and turns as marked-up text with a loss mask.

The layout of a record is recognised by a fingerprint: the hash of its nested field
paths, without types or values. A fingerprint selects a declarative mapping, an
expression over the record that gives its turns; a record of an unknown layout gets
none and is reported as such. Everything is column expressions over Spark's variant
type, so one table may hold all layouts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
# fixed values: marks of the template
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: The role whose texts are trained on.
TRAINED = "assistant"


class Mapping(NamedTuple):
    """A layout: records that show its field paths, and the turns of a record ``r`` as SQL."""

    name: str
    examples: tuple[str, ...]
    turns: str


def _list(path: str, role: str, text: str) -> str:
    return f"transform(try_variant_get(r, '$.{path}', 'array<struct<{role}:string,{text}:string>>'), t -> named_struct('role', t.{role}, 'text', t.{text}))"


def _pair(*parts: tuple[str, str]) -> str:
    turns = ", ".join(f"named_struct('role', '{role}', 'text', {text})" for role, text in parts)
    return f"array({turns})"


def _get(path: str) -> str:
    return f"try_variant_get(r, '$.{path}', 'string')"


# fixed values: names of roles in other layouts
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "prompter": "user", "model": "assistant"}

_ASK = "concat_ws('\\n\\n', " + _get("instruction") + ", nullif(" + _get("input") + ", ''))"
MAPPINGS = (
    Mapping("turns", ('{"turns":[{"role":"a","text":"b"}]}',), _list("turns", "role", "text")),
    Mapping("messages", ('{"messages":[{"role":"a","content":"b"}]}',), _list("messages", "role", "content")),
    Mapping("conversations", ('{"conversations":[{"from":"a","value":"b"}]}',), _list("conversations", "from", "value")),
    Mapping("prompt and completion", ('{"prompt":"a","completion":"b"}',), _pair(("user", _get("prompt")), ("assistant", _get("completion")))),
    Mapping("prompt and response", ('{"prompt":"a","response":"b"}',), _pair(("user", _get("prompt")), ("assistant", _get("response")))),
    Mapping("system, prompt and response", ('{"system":"s","prompt":"a","response":"b"}',), _pair(("system", _get("system")), ("user", _get("prompt")), ("assistant", _get("response")))),
    Mapping("question and answer", ('{"question":"a","answer":"b"}',), _pair(("user", _get("question")), ("assistant", _get("answer")))),
    Mapping("instruction", ('{"instruction":"a","output":"b"}', '{"instruction":"a","input":"i","output":"b"}'), _pair(("user", _ASK), ("assistant", _get("output")))),
)


def field_paths(record: Column) -> Column:
    """The nested field names of a variant, in order of name, with the shape of lists and objects; no scalar types."""
    return F.regexp_replace(F.schema_of_variant(record), r"(: |<)(?:STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DATE|TIMESTAMP(?:_NTZ)?|BINARY|VARIANT|DECIMAL\([0-9,]+\))(?=[,>]|$)", "$1_")


def fingerprint(record: Column) -> Column:
    """64-bit hash of a record's field paths; a list that is empty shows no fields of its elements."""
    return F.xxhash64(field_paths(record))


def canonical_turns(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` with ``layout`` (name of the mapping, null if no mapping fits) and ``turns``.

    ``record`` is a variant column. Role names of other layouts become user and
    assistant; a null text becomes empty and a null role ``user``. Records of an
    unknown layout and null records have no turns (null). Existing columns ``layout``
    and ``turns`` are replaced.
    """
    prints = F.create_map(*(x for m in mappings for e in m.examples for x in (fingerprint(F.parse_json(F.lit(e))), F.lit(m.name))))
    known = records.withColumn("layout", F.try_element_at(prints, fingerprint(F.col(record))))
    turns = F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        turns = F.when(F.col("layout") == m.name, F.expr(m.turns.replace("(r,", f"(`{record}`,"))).otherwise(turns)
    names = F.create_map(*(F.lit(x) for pair in ROLE_NAMES.items() for x in pair))

    def clean(turn: Column) -> Column:
        role = F.coalesce(turn["role"], F.lit("user"))
        return F.struct(F.coalesce(F.try_element_at(names, role), role).alias("role"), F.coalesce(turn["text"], F.lit("")).alias("text"))

    return known.withColumn("turns", turns).withColumn("turns", F.transform("turns", clean))


def escaped(text: Column) -> Column:
    """A text in which no control string can be: backslashes are doubled, and one is put inside every ``<|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    """A role likewise, on one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """What was escaped."""
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def unescaped_role(role: Column) -> Column:
    # an escaped line feed is a backslash and an n, after pairs of backslashes only
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def formatted(chats: DataFrame, trained: str = TRAINED) -> DataFrame:
    """``chats`` with ``formatted`` text and ``loss_spans``, of its ``turns``.

    A turn is ``<|im_start|>role``, a line feed, the escaped text, ``<|im_end|>`` and a
    line feed. ``loss_spans`` are the places (start, length, in code points) of the
    texts of the trained role, in order. No turns, or null, give the empty text and no
    span. A chat is one value and has to fit in memory.
    """
    pieces = F.transform(
        F.coalesce("turns", F.lit(None).cast(TURNS), F.expr(f"cast(array() as {TURNS})")),
        lambda t: F.struct(F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == trained).alias("loss")),
    )
    tail = f"{CLOSE}\n"
    spans = F.expr(
        f"""aggregate(`__pieces`, named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,length:int>>)),
              (a, p) -> named_struct(
                'at', a.at + length(p.head) + length(p.body) + {len(tail)},
                'spans', if(p.loss, concat(a.spans, array(named_struct('start', a.at + length(p.head), 'length', length(p.body)))), a.spans)),
              a -> a.spans)"""
    )
    text = F.array_join(F.transform("__pieces", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    return chats.withColumn("__pieces", pieces).withColumns({"formatted": text, "loss_spans": spans}).drop("__pieces")


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns`` and ``loss_texts`` as read from ``formatted`` and ``loss_spans`` alone."""
    parts = F.filter(F.split("formatted", r"<\|im_start\|>", -1), lambda p, i: i > 0)
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescaped_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescaped(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - F.lit(len(CLOSE) + 1))).alias("text"),
        ),
    )
    losses = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return chats.withColumns({"turns": turns, "loss_texts": losses})


def from_turn_rows(rows: DataFrame) -> DataFrame:
    """Records ``(conv_id, record)`` of rows ``(conv_id, turn, role, text)``, turns in order; ties by role, then text.

    Other columns are ignored. Turns are gathered per conversation, which becomes one
    text anyway.
    """
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    turns = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return gathered.select("conv_id", F.to_variant_object(F.struct(turns.alias("turns"))).alias("record"))
