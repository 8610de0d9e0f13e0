"""Chat formatting by schema fingerprints.

Records come in many layouts: lists of messages, prompt and response, instruction with an optional
input, one row per turn. The fingerprint of a record is the 64-bit hash of its nested field paths in
code-point order: ``a`` for a field, ``a.b`` for a field of an object, ``a[]`` for an array and
``a[].b`` for a field of its objects. It selects a declarative mapping, which gives the canonical
turns (role, text). Records are JSON texts (``canonical_turns``) or typed columns (``typed_turns``),
where a null field is an absent one; both take the same fingerprints and mappings.

``format_turns`` renders turns with a template that marks each one, and escapes control strings
inside texts and roles reversibly: ``%`` becomes ``%25`` and ``<|`` becomes ``%3C|`` (in roles also a
line feed ``%0A``), so no marker can arise from a text. The loss mask is the list of spans, in code
points, that assistant texts take in the output. ``read_turns`` undoes it.

Null texts and roles count as empty; turns are ordered by turn number, nulls first, ties by role and
text, and repeated rows are turns of their own. Conversations with a null id form one conversation.
An empty table gives an empty result. Extra columns are ignored. A record with an unknown layout has
null turns and keeps its fingerprint.

A VARIANT holds no string over 20 million characters and no record over 128 MiB. Rows of turns become
typed records, so texts of any length stay whole; a JSON record of over ``SURE_CHARS`` characters that
doesn't parse fails the query, a shorter one has an unknown layout.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

#: A JSON record of so many characters fits a VARIANT.
SURE_CHARS = 16_000_000
START, END = "<|im_start|>", "<|im_end|>\n"


@dataclass(frozen=True)
class Layout:
    """``paths``: the field paths. The turns are ``turns``, (role, fields) whose texts are joined by
    blank lines where not empty, or those of ``listed``: (array, role field, text field)."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    listed: tuple[str, str, str] | None = None


def _flat(name: str, *turns: tuple[str, ...]) -> Layout:
    return Layout(name, tuple(sorted(f for _, *fields in turns for f in fields)), tuple((role, tuple(fields)) for role, *fields in turns))


def _list(name: str, array: str, role: str, text: str) -> Layout:
    return Layout(name, (array, f"{array}[]", *sorted((f"{array}[].{role}", f"{array}[].{text}"))), listed=(array, role, text))


LAYOUTS = (
    _list("messages", "messages", "role", "content"),
    _list("turns", "turns", "role", "text"),
    _list("exchange", "conversations", "from", "value"),
    _flat("prompt", ("user", "prompt"), ("assistant", "response")),
    _flat("completion", ("user", "prompt"), ("assistant", "completion")),
    _flat("question", ("user", "question"), ("assistant", "answer")),
    _flat("instruction", ("user", "instruction"), ("assistant", "output")),
    _flat("instruction_input", ("user", "instruction", "input"), ("assistant", "output")),
    _flat("system_prompt", ("system", "system"), ("user", "prompt"), ("assistant", "response")),
)
#: Roles by their names in other layouts.
ROLES = {"human": "user", "gpt": "assistant"}


def path_list(record: Column) -> Column:
    """The nested field paths of a VARIANT, sorted. ``schema_of_variant`` gives its shape, whose tokens
    are read with a stack of the enclosing paths; names that aren't plain words stay in backquotes."""
    words = F.regexp_extract_all(F.schema_of_variant(record), F.lit(r"(`(?:[^`]|``)*`: |\w+: |OBJECT<|ARRAY<|>|\w+(?:\([^)]*\))?)"), F.lit(1))
    nothing = F.array().cast("array<string>")
    start = F.struct(F.lit("").alias("path"), nothing.alias("stack"), nothing.alias("out"))

    def step(state: Column, word: Column) -> Column:
        top = F.coalesce(F.get(state["stack"], F.size(state["stack"]) - 1), F.lit(""))
        name = F.left(word, F.char_length(word) - 2)
        named, opens = F.endswith(word, F.lit(": ")), word.isin("OBJECT<", "ARRAY<")
        field, items = F.when(top == "", name).otherwise(F.concat(top, F.lit("."), name)), F.concat(state["path"], F.lit("[]"))
        path = F.when(named, field).when(word == "ARRAY<", items).otherwise(state["path"])
        stack = F.when(opens, F.concat(state["stack"], F.array(state["path"])))
        stack = stack.when(word == ">", F.slice(state["stack"], 1, F.greatest(F.lit(0), F.size(state["stack"]) - 1))).otherwise(state["stack"])
        out = F.when(named | (word == "ARRAY<"), F.concat(state["out"], F.array(path))).otherwise(state["out"])
        return F.struct(path.alias("path"), stack.alias("stack"), out.alias("out"))

    return F.array_sort(F.aggregate(words, start, step)["out"])


def typed_paths(value: Column, kind: DataType, path: str = "") -> Column:
    """The same for a typed column; null fields are absent."""
    nothing = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        own = nothing
        for field in kind.fields:
            name = f"{path}.{field.name}" if path else field.name
            inner = value[field.name]
            own = F.concat(own, F.when(inner.isNotNull(), F.concat(F.array(F.lit(name)), typed_paths(inner, field.dataType, name))).otherwise(nothing))
        return own
    if isinstance(kind, ArrayType):
        items = F.transform(value, lambda x: typed_paths(x, kind.elementType, f"{path}[]"))
        return F.concat(F.array(F.lit(f"{path}[]")), F.array_distinct(F.flatten(items)))
    return nothing


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def _joined(texts: list[Column]) -> Column:
    if len(texts) == 1:
        return F.coalesce(texts[0], F.lit(""))
    return F.concat_ws("\n\n", *[F.nullif(t, F.lit("")) for t in texts])


def _renamed(role: Column) -> Column:
    out = F.coalesce(role, F.lit(""))
    for theirs, ours in ROLES.items():
        out = F.when(role == theirs, ours).otherwise(out)
    return out


def _listed_turns(items: Column, layout: Layout) -> Column:
    _, role, text = layout.listed
    named = _renamed if role == "from" else (lambda r: F.coalesce(r, F.lit("")))
    return F.transform(items, lambda x: _turn(named(x[role]), F.coalesce(x[text], F.lit(""))))


def _variant_turns(layout: Layout) -> Column:
    if layout.listed:
        array, role, text = layout.listed
        items = F.from_json(F.to_json(F.variant_get("v", f"$.{array}", "variant")), f"array<struct<`{role}`: string, `{text}`: string>>")
        return _listed_turns(items, layout)
    return F.array(*[_turn(F.lit(role), _joined([F.variant_get("v", f"$.{f}", "string") for f in fields])) for role, fields in layout.turns])


def _typed_turns(record: Column, layout: Layout) -> Column:
    if layout.listed:
        return _listed_turns(record[layout.listed[0]], layout)
    return F.array(*[_turn(F.lit(role), _joined([record[f] for f in fields])) for role, fields in layout.turns])


def _select(records: DataFrame, layouts: tuple[Layout, ...], turns_of: Callable[[Layout], Column]) -> DataFrame:
    """Add ``layout`` and ``turns`` by ``layout_fp``."""
    turns, name = F.lit(None), F.lit(None).cast("string")
    for layout in layouts:
        known = F.col("layout_fp") == fingerprint(F.array(*[F.lit(p) for p in layout.paths]))
        turns, name = F.when(known, turns_of(layout)).otherwise(turns), F.when(known, layout.name).otherwise(name)
    return records.withColumn("layout", name).withColumn("turns", turns)


def canonical_turns(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``layout_fp``, ``layout`` and ``turns`` array<struct<role, text>> to JSON records."""
    record = F.col(column)
    out = records.withColumn("v", F.when(F.char_length(record) > SURE_CHARS, F.parse_json(record)).otherwise(F.try_parse_json(record)))
    out = out.withColumn("layout_fp", fingerprint(path_list(F.col("v"))))
    return _select(out, layouts, _variant_turns).drop("v")


def typed_turns(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The same for records that are a struct column. Layouts with fields that it lacks can't occur."""
    kind, record = records.schema[column].dataType, F.col(column)
    out = records.withColumn("layout_fp", fingerprint(F.array_sort(typed_paths(record, kind))))
    usable = tuple(x for x in layouts if {p.split(".")[0].split("[")[0] for p in x.paths} <= set(kind.names))
    return _select(out, usable, lambda layout: _typed_turns(record, layout))


def _lists(rows: DataFrame) -> DataFrame:
    one = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))


def typed_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record) from rows (conv_id, turn, role, text). A conversation of a user and an assistant
    row is a record of prompt and response, any other a list of turns. A conversation is one value of
    the output, so its rows meet in one task by definition."""
    first, second = F.get("t", F.lit(0)), F.get("t", F.lit(1))
    pair = (F.size("t") == 2) & (first["role"] == "user") & (second["role"] == "assistant")
    turns = F.transform("t", lambda x: _turn(x["role"], x["text"]))
    record = F.struct(F.when(pair, first["text"]).alias("prompt"), F.when(pair, second["text"]).alias("response"), F.when(~pair, turns).alias("turns"))
    return _lists(rows).select("conv_id", record.alias("record"))


def conversation_records(rows: DataFrame) -> DataFrame:
    """The same with JSON records."""
    return typed_records(rows).withColumn("record", F.to_json("record"))


def turns_of_rows(rows: DataFrame) -> DataFrame:
    """conv_id, layout_fp, layout, turns of rows (conv_id, turn, role, text)."""
    return typed_turns(typed_records(rows)).drop("record")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def format_turns(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """From (key, turns): key, ``formatted`` and ``loss_spans`` array<struct<start, end>>. Offsets
    are running sums over the rows of a conversation, not array appends, so they stay linear."""
    rows = conversations.select(key, F.posexplode_outer("turns").alias("pos", "turn"))
    role = F.replace(escape(F.col("turn.role")), F.lit("\n"), F.lit("%0A"))
    rows = rows.select(
        key, "pos", F.col("turn.role").alias("role"), F.concat(F.lit(START), role, F.lit("\n")).alias("head"), escape(F.col("turn.text")).alias("body")
    )
    size = F.char_length("head") + F.char_length("body") + len(END)
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.char_length("head"))
    piece = F.struct(
        "pos", F.concat("head", "body", F.lit(END)).alias("piece"), "role", "start", (F.col("start") + F.char_length("body")).alias("end")
    )
    made = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), piece))).alias("p"))
    spans = F.transform(
        F.filter("p", lambda x: x["role"] == "assistant"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    )
    return made.select(key, F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns that a formatted conversation holds, unescaped: array<struct<role, text>>."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")

    def one(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        cut_head = F.substring(piece, F.char_length(role) + 2, F.char_length(piece))
        text = F.left(cut_head, F.char_length(cut_head) - len(END))
        return F.struct(
            unescape(F.replace(role, F.lit("%0A"), F.lit("\n"))).alias("role"),
            F.when(F.char_length(cut_head) > len(END), unescape(text)).otherwise("").alias("text"),
        )

    return F.transform(pieces, one)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
