"""Chat formatting with schema fingerprints.

Records of any layout (a prompt and its response, an instruction with input and output, a list of messages, one row a
turn) are recognised by a hash over their nested field paths. The hash selects a declarative mapping, which names where the
turns, their roles and their texts are. All layouts end as the same canonical turns, which one template writes.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: (role, JSON path) pairs, or a path to a list with role and text fields."""

    example: str  # a record of the layout, from which its fingerprint is taken
    fields: tuple[tuple[str, str], ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""


MAPPINGS = {
    "prompt": Mapping('{"prompt": "", "response": ""}', (("user", "$.prompt"), ("assistant", "$.response"))),
    "completion": Mapping('{"prompt": "", "completion": ""}', (("user", "$.prompt"), ("assistant", "$.completion"))),
    "question": Mapping('{"question": "", "answer": ""}', (("user", "$.question"), ("assistant", "$.answer"))),
    "instruction": Mapping('{"instruction": "", "output": ""}', (("user", "$.instruction"), ("assistant", "$.output"))),
    "instruction_input": Mapping('{"instruction": "", "input": "", "output": ""}', (("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    "messages": Mapping('{"messages": [{"role": "", "content": ""}]}', (), "$.messages", "role", "content"),
    "conversations": Mapping('{"conversations": [{"from": "", "value": ""}]}', (), "$.conversations", "from", "value"),
    "turns": Mapping('{"turns": [{"role": "", "text": ""}]}', (), "$.turns", "role", "text"),
}


def paths(schema: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type, sorted: ``messages[].role``."""
    if isinstance(schema, T.StructType):
        return sorted(p for f in schema.fields for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(schema, T.ArrayType):
        return paths(schema.elementType, at + "[]")
    return [at]


def paths_hash(names: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()


def _paths_of(mapping: Mapping) -> list[str]:
    """Nested field paths of a mapping's example."""
    def walk(value, at: str) -> list[str]:
        if isinstance(value, dict):
            return [p for k, v in value.items() for p in walk(v, f"{at}.{k}" if at else k)]
        return walk(value[0], at + "[]") if isinstance(value, list) else [at]
    return walk(json.loads(mapping.example), "")


def fingerprint(record: Column) -> Column:
    """Hash over the nested field names of a JSON record, whatever their order, values and scalar types; null if it is no JSON."""
    shape = F.schema_of_variant(F.try_parse_json(record))
    scalars = r"\b(?:STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|VOID|VARIANT|DECIMAL\([0-9]+,\s*[0-9]+\))(?=[,>]|$)"
    return F.xxhash64(F.regexp_replace(shape, scalars, "VALUE")) * F.when(shape.isNotNull(), 1)


def canonical(records: DataFrame, *, id_col: str = "id", record_col: str = "record", mappings: dict[str, Mapping] = MAPPINGS) -> DataFrame:
    """Turns of JSON records of mixed layouts: ``id_col``, ``layout`` string (null if no mapping has its fingerprint), ``turns``.

    One row per record. Unknown layouts, null and malformed records have null turns, to be looked at, not lost. Null texts are
    empty. Other columns are ignored. No shuffle; a mapping is chosen by comparing two longs. Records that are nested columns instead of
    JSON text have one layout, which is chosen by the hash over the field paths of their type.
    """
    if not isinstance(records.schema[record_col].dataType, T.StringType):
        return _canonical_columns(records, id_col, record_col, mappings)
    rows = records.select(F.col(id_col).alias("id"), F.col(record_col).cast("string").alias("record"))
    rows = rows.withColumn("print", fingerprint(F.col("record")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, m in mappings.items():
        mine = F.col("print") == fingerprint(F.lit(m.example))
        if m.turns:
            found = F.from_json(F.get_json_object("record", m.turns), f"array<struct<`{m.role}`:string,`{m.text}`:string>>")
            found = F.transform(found, _turn(m.role, m.text))
        else:
            found = F.array(*(F.struct(F.lit(role).alias("role"), F.coalesce(F.get_json_object("record", path), F.lit("")).alias("text")) for role, path in m.fields))
        layout = F.when(mine, F.lit(name)).otherwise(layout)
        turns = F.when(mine, found.cast(TURNS)).otherwise(turns)
    return rows.select(F.col("id").alias(id_col), layout.alias("layout"), turns.alias("turns"))


def _turn(role: str, text: str):
    def build(x: Column) -> Column:
        name = F.coalesce(x[role], F.lit(""))
        for other, ours in ROLES.items():
            name = F.when(F.lower(x[role]) == other, ours).otherwise(name)
        return F.struct(name.alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))
    return build


def _canonical_columns(records: DataFrame, id_col: str, record_col: str, mappings: dict[str, Mapping]) -> DataFrame:
    by_hash = {paths_hash(_paths_of(m)): name for name, m in mappings.items()}
    name = by_hash.get(paths_hash(paths(records.schema[record_col].dataType)))
    turns = F.lit(None).cast(TURNS)
    if name is not None:
        m = mappings[name]
        at = lambda path: F.col(f"{record_col}.{path.removeprefix('$.')}")
        turns = F.transform(at(m.turns), _turn(m.role, m.text)) if m.turns else \
            F.array(*(F.struct(F.lit(role).alias("role"), F.coalesce(at(path).cast("string"), F.lit("")).alias("text")) for role, path in m.fields))
    return records.select(id_col, F.lit(name).alias("layout"), turns.alias("turns"))


#: Tables that hold one row a turn, by the hash over the field paths that they use: conversation, order, and the turn's fields.
ROW_LAYOUTS = {paths_hash([conv, order, *fields]): (conv, order, fields) for conv, order, *fields in (
    ("conv_id", "turn", "role", "text"),
    ("conversation_id", "position", "role", "content"),
    ("conversation_id", "position", "from", "value"),
)}
#: What a record made of such rows calls its list of turns, by the turn's fields: the layout of a mapping.
LISTS = {"text": "turns", "content": "messages", "value": "conversations"}


def records_of(turn_rows: DataFrame) -> DataFrame:
    """Records (``conv_id``, ``record``) of a table with a row for each turn, recognised by its columns: nested columns of one known layout.

    The hash is over those of the table's field paths that any known layout uses; further columns are ignored. Rows are ordered by turn, and equal
    turns by role and text; repeated rows stay. Null roles and texts are empty. A row without a conversation id is a
    conversation of its own. A conversation is one row of the result, as its formatted text has to be; rows are collected before
    they are sorted, by hash of the conversation.
    """
    used = {name for conv, order, fields in ROW_LAYOUTS.values() for name in (conv, order, *fields)}
    layout = ROW_LAYOUTS.get(paths_hash([p for p in paths(turn_rows.schema) if p in used]))
    if layout is None:
        raise ValueError(f"no layout for columns {turn_rows.columns}")
    conv, order, (role, text) = layout
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    alone = F.when(F.col(conv).isNull(), F.monotonically_increasing_id())
    rows = turn_rows.select(F.col(conv).alias("conv_id"), alone.alias("alone"), F.struct(F.col(order).alias("_order"), plain(role), plain(text)).alias("t"))
    turns = F.transform(F.array_sort(F.collect_list("t")), lambda x: F.struct(x[role].alias(role), x[text].alias(text)))
    return rows.groupBy("conv_id", "alone").agg(F.struct(turns.alias(LISTS[text])).alias("record")).drop("alone")


def grouped(turn_rows: DataFrame) -> DataFrame:
    """Conversations (``conv_id``, ``turns``) of a table with a row for each turn: its records, mapped by their fingerprint."""
    return canonical(records_of(turn_rows), id_col="conv_id").select("conv_id", "turns")


# The template. Every control string begins with "<|", and no "<" of a role or text is left as it is.
OPEN, AFTER_ROLE, CLOSE = "<|turn|>", "<|text|>", "<|end|>"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def formatted(conversations: DataFrame, *, id_col: str = "conv_id", turns_col: str = "turns", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Text of each conversation and its loss mask: ``id_col``, ``formatted`` string, ``mask`` array of (start, end) in code points.

    The mask covers the escaped texts of turns whose role is in ``learn``, each once. Null or empty turns give an empty text.
    One row per conversation; no shuffle.
    """
    pieces = F.transform(F.coalesce(F.col(turns_col), F.array().cast(TURNS)), lambda t: F.struct(
        F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(AFTER_ROLE)).alias("head"), escaped(t["text"]).alias("body"), t["role"].isin(*learn).alias("learn")))
    frame = conversations.select(F.col(id_col).alias("id"), pieces.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    spans = "array<struct<start:int,end:int>>"

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        more = F.concat(acc["mask"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(p["learn"], more).otherwise(acc["mask"]).alias("mask"))

    mask = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("mask")), add)["mask"]
    return frame.select(F.col("id").alias(id_col), text.alias("formatted"), mask.alias("mask"))


def read_back(text: Column) -> Column:
    """Turns of a formatted text."""
    parts = F.filter(F.split(text, re.escape(OPEN), -1), lambda p: p != "")
    body = lambda p: F.split(p, re.escape(AFTER_ROLE), -1)
    return F.transform(parts, lambda p: F.struct(unescaped(body(p)[0]).alias("role"), unescaped(F.replace(body(p)[1], F.lit(CLOSE), F.lit(""))).alias("text")))


def masked_text(text: Column, mask: Column) -> Column:
    """What the mask covers, unescaped and joined."""
    return F.array_join(F.transform(mask, lambda m: unescaped(F.substring(text, m["start"] + 1, m["end"] - m["start"]))), "")
