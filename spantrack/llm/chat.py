"""Chat formatting by schema fingerprints.

A record's layout is the tree of its field names, written as Spark writes a
variant's schema with the leaves' types left out. Its fingerprint, a hash of those
nested paths, selects a declarative mapping from the layout to canonical turns
(role, text), row by row: for a table of typed columns from those that hold something
in the row, for JSON records from their fields. Layouts without a mapping give no
turns and keep their fingerprint, so that they can be counted.

The template writes each turn as ``### role``, a line break, the text and
``</turn>`` with a line break. Role names are percent-encoded. In texts a
backslash goes before every backslash, every ``#`` and every ``/`` after ``<``, so
that no text can hold a marker and every text can be read back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, END = "### ", "</turn>\n"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """From a layout to turns: either ``turns`` (array path, role field, text field) or ``fields`` (role, path) in order."""

    layout: str
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()


#: Roles of other layouts under their canonical names.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("OBJECT<messages: ARRAY<OBJECT<content: _, role: _>>>", ("messages", "role", "content")),
    Mapping("OBJECT<turns: ARRAY<OBJECT<role: _, text: _>>>", ("turns", "role", "text")),
    Mapping("OBJECT<conversations: ARRAY<OBJECT<from: _, value: _>>>", ("conversations", "from", "value")),
    Mapping("OBJECT<instruction: _, output: _>", fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("OBJECT<input: _, instruction: _, output: _>", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("OBJECT<prompt: _, response: _>", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("OBJECT<completion: _, prompt: _>", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("OBJECT<prompt: _, response: _, system: _>", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)


def fingerprint(layout: str) -> str:
    return hashlib.sha256(layout.encode()).hexdigest()[:16]


def layout_of(kind: T.DataType) -> str:
    """The layout of a column type: field names sorted, leaves as ``_``."""
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(f"{f.name}: {layout_of(f.dataType)}" for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{layout_of(kind.elementType)}>"
    return "_"


#: What mappings know: fields of a record, and of the items of its arrays.
FIELDS = sorted({path for m in MAPPINGS for _, path in m.fields})
ITEMS = {m.turns[0]: sorted(m.turns[1:]) for m in MAPPINGS if m.turns}


def _known_layout(has: Callable[[str], Column], item_has: Callable[[str, str], Column]) -> Column:
    """The layout of what mappings know, fields sorted; others are left out."""
    parts = {name: F.when(has(name), f"{name}: _") for name in FIELDS}
    for name, fields in ITEMS.items():
        inner = F.array_join(F.array_compact(F.array(*[F.when(item_has(name, f), f"{f}: _") for f in fields])), ", ")
        parts[name] = F.when(has(name), F.concat(F.lit(f"{name}: ARRAY<OBJECT<"), inner, F.lit(">>")))
    return F.concat(F.lit("OBJECT<"), F.array_join(F.array_compact(F.array(*[parts[k] for k in sorted(parts)])), ", "), F.lit(">"))


def _layout_column(record: Column) -> Column:
    """The layout of each variant: the nested paths that mappings know; null for what isn't an object."""
    at = lambda name: F.try_variant_get(record, f"$.{name}", "variant")
    inside = lambda name, field: F.schema_of_variant(at(name)).rlike(rf"^ARRAY<OBJECT<(.*, )?{field}: ")
    return F.when(F.schema_of_variant(record).startswith("OBJECT<"), _known_layout(lambda n: at(n).isNotNull(), inside))


def _role(role: Column) -> Column:
    role, known = F.coalesce(role, F.lit("")), F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    return F.coalesce(F.element_at(known, role), role)


def _turns(role_text: Column) -> Column:
    """Null roles and texts are empty."""
    return F.transform(role_text, lambda x: F.struct(_role(x["role"]).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")))


def turns_of_json(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with columns layout, fingerprint and turns, from a column of JSON texts.

    Each row's fingerprint, over the paths that mappings know, selects its mapping;
    other fields neither matter nor get lost. Null, broken or unmapped records have
    null turns; empty prompt fields (null or absent text) give no turn; repeated rows
    come out alike; an empty table gives no rows. Columns of the names layout,
    fingerprint and turns are replaced.
    """
    value = F.try_parse_json(F.col(record).cast("string"))
    layout = _layout_column(value)
    mark = F.substring(F.sha2(layout, 256), 1, 16)
    chosen = None
    for m in MAPPINGS:
        if m.turns:
            path, role, text = m.turns
            items = F.try_variant_get(value, f"$.{path}", f"array<struct<{_quoted(role)}:string,{_quoted(text)}:string>>")
            turns = _renamed(items, role, text)
        else:
            items = F.array(*[F.struct(F.lit(role).alias("role"), F.try_variant_get(value, f"$.{path}", "string").alias("text")) for role, path in m.fields])
            turns = F.filter(items, lambda x: F.length(x["text"]) > 0)
        holds = mark == fingerprint(m.layout)
        chosen = F.when(holds, turns) if chosen is None else chosen.when(holds, turns)
    return records.withColumns({"layout": layout, "fingerprint": mark, "turns": _turns(chosen)})


def _renamed(items: Column, role: str, text: str) -> Column:
    return F.transform(items, lambda x: F.struct(x[role].cast("string").alias("role"), x[text].cast("string").alias("text")))


def _quoted(name: str) -> str:
    return f"`{name}`"


def _known_field(field: T.StructField) -> T.StructField:
    """The field without those fields of its items that mappings don't know."""
    kind = field.dataType
    if field.name in ITEMS and isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        kind = T.ArrayType(T.StructType([f for f in kind.elementType.fields if f.name in ITEMS[field.name]]))
    return T.StructField(field.name, kind)


def turns_of_columns(records: DataFrame, key: str) -> DataFrame:
    """(key, fingerprint, turns) of a table among whose other columns is one of the layouts, or several of them, typed.

    Each row's fingerprint, over the paths of its fields that hold something and that
    mappings know, selects its mapping; a row that has none takes that of all such
    columns, if there is one, and has null turns else. Other columns and fields are
    not read. Raises ValueError where the columns make up no layout at all. Null turns
    stay null, null fields of a prompt give no turn; repeated rows come out alike; an
    empty table gives no rows.
    """
    fields = {f.name: _known_field(f) for f in records.schema.fields if f.name != key and f.name in (*FIELDS, *ITEMS)}
    kinds = {name: layout_of(T.StructType([f])) for name, f in fields.items()}
    usable = [m for m in MAPPINGS if (kinds.get(m.turns[0]) == m.layout if m.turns else all(kinds.get(path) == f"OBJECT<{path}: _>" for _, path in m.fields))]
    if not usable:
        raise ValueError(f"no mapping for the layout {layout_of(records.schema)}")
    read = {name for m in usable for name in ([m.turns[0]] if m.turns else [path for _, path in m.fields])}
    has = lambda name: F.col(name).isNotNull() if name in read else F.lit(False)
    item_has = lambda name, field: F.exists(name, lambda x: x[field].isNotNull()) if name in read else F.lit(False)
    own, whole = F.substring(F.sha2(_known_layout(has, item_has), 256), 1, 16), fingerprint(layout_of(T.StructType(list(fields.values()))))
    marks = [fingerprint(m.layout) for m in usable]
    mark = F.when(own.isin(marks), own).otherwise(F.lit(whole)) if whole in marks else own
    chosen = None
    for m in usable:
        if m.turns:
            path, role, text = m.turns
            turns = _renamed(F.col(path), role, text)
        else:
            items = F.array(*[F.struct(F.lit(role).alias("role"), F.col(path).cast("string").alias("text")) for role, path in m.fields])
            turns = F.filter(items, lambda x: F.length(x["text"]) > 0)
        holds = F.col("fingerprint") == fingerprint(m.layout)
        chosen = F.when(holds, turns) if chosen is None else chosen.when(holds, turns)
    others = [F.col(x) for x in sorted(read)]
    return records.select(key, mark.alias("fingerprint"), *others).select(key, "fingerprint", _turns(chosen).alias("turns"))


def turns_of_rows(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, fingerprint, turns) of a table with one row per turn: (key, turn, role, text), grouped to the turns layout.

    Turns go by number (null first), then role and text; repeated rows are turns of
    their own; a null key is a conversation; a conversation's turns meet in one row.
    """
    item = F.struct("turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    grouped = rows.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("turns"))
    return turns_of_columns(grouped.select(key, F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns")), key)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|#|(?<=<)/", r"\\$0")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``turns`` with columns formatted and loss_mask, the (start, length) in code points of each text of ``loss_roles``.

    Without turns (null or none) the text and the mask are empty; empty texts are
    turns; repeated rows come out alike; an empty table gives no rows; other columns
    pass through, those of the names formatted and loss_mask are replaced.
    """
    parts = F.transform("turns", lambda x: F.struct(F.concat(F.lit(BEGIN), F.url_encode(x["role"]), F.lit("\n")).alias("head"), escaped(x["text"]).alias("body"), x["role"].isin(*loss_roles).alias("loss")))
    frame = turns.withColumn("_parts", F.coalesce(parts, F.array().cast("array<struct<head:string,body:string,loss:boolean>>")))
    lengths = F.transform("_parts", lambda x: F.struct(F.length(x["head"]).alias("head"), F.length(x["body"]).alias("body"), x["loss"].alias("loss")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("mask"))
    step = lambda a, x: F.struct(
        (a["at"] + x["head"] + x["body"] + len(END)).alias("at"),
        F.when(x["loss"], F.concat(a["mask"], F.array(F.struct((a["at"] + x["head"]).alias("start"), x["body"].alias("length"))))).otherwise(a["mask"]).alias("mask"),
    )
    text = F.array_join(F.transform("_parts", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    return frame.withColumn("formatted", text).withColumn("loss_mask", F.aggregate(lengths, begin, step, lambda a: a["mask"])).drop("_parts")


def read_back(frame: DataFrame) -> DataFrame:
    """``frame`` with columns read_turns and read_loss, parsed from formatted and loss_mask alone.

    An empty text has no turns; null stays null; repeated rows come out alike; an
    empty table gives no rows; other columns pass through, those of the names
    read_turns and read_loss are replaced.
    """
    blocks = F.filter(F.split("formatted", END, -1), lambda x: F.length(x) > 0)
    head = lambda x: F.substring_index(x, "\n", 1)
    turn = lambda x: F.struct(
        F.url_decode(F.substring(head(x), len(BEGIN) + 1, 1 << 30)).alias("role"), unescaped(x.substr(F.length(head(x)) + 2, F.lit(1 << 30))).alias("text")
    )
    loss = F.array_join(F.transform("loss_mask", lambda s: unescaped(F.col("formatted").substr(s["start"] + 1, s["length"]))), "")
    return frame.withColumns({"read_turns": F.transform(blocks, turn), "read_loss": loss})
