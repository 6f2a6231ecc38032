"""Chat records of several layouts to one template, by a fingerprint of their nested field paths.

Everything is Column expressions: a record's layout is the set of nested field paths that hold a
value, its fingerprint is the hash of these paths, and each known fingerprint selects a declared
mapping from paths to turns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = "struct<role:string,text:string>"
# Template. Every "<" and every escape sign inside roles and texts is escaped, so that a control
# string cannot arise from them; "[" is escaped too, which keeps instruction marks of other templates apart.
OPEN, MID, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPES = [("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")]


@dataclass(frozen=True)
class Layout:
    """Field paths of a layout and how they become turns.

    ``required`` paths always hold a value, ``optional`` ones may. ``turns`` is a list of (role, path) for single
    fields, or one ("*", list path, role field, text field) for a list of messages. ``roles`` renames roles.
    """

    name: str
    required: tuple[str, ...]
    turns: tuple
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = [
    Layout("prompt", ("prompt", "response"), (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("instruction", ("instruction", "output"), (("system", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Layout("messages", ("messages[].role", "messages[].content"), (("*", "messages", "role", "content"),)),
    Layout("shared", ("conversations[].from", "conversations[].value"), (("*", "conversations", "from", "value"),), roles=(("human", "user"), ("gpt", "assistant"))),
]


def field_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Leaf paths of a schema; ``[]`` marks a list of structs."""
    out = []
    for f in schema.fields:
        kind = f.dataType
        if isinstance(kind, T.StructType):
            out += field_paths(kind, f"{prefix}{f.name}.")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out += field_paths(kind.elementType, f"{prefix}{f.name}[].")
        else:
            out.append(prefix + f.name)
    return out


def _quoted(path: str) -> str:
    return ".".join(f"`{p}`" for p in path.split("."))


def _holds(path: str) -> Column:
    """Whether a path holds a value; below a list, in any element."""
    if "[]." not in path:
        return F.col(_quoted(path)).isNotNull()
    head, tail = path.split("[].", 1)
    return F.exists(F.col(_quoted(head)), lambda x: _below(x, tail))


def _below(value: Column, path: str) -> Column:
    if "[]." in path:
        head, tail = path.split("[].", 1)
        return F.exists(value[head], lambda x: _below(x, tail))
    for part in path.split("."):
        value = value[part]
    return value.isNotNull()


def fingerprint(schema: T.StructType, ignore: tuple[str, ...] = ()) -> Column:
    """Hash of the sorted nested paths that hold a value in a row."""
    present = [F.when(F.coalesce(_holds(p), F.lit(False)), p) for p in sorted(field_paths(schema)) if p.split(".")[0].removesuffix("[]") not in ignore]
    return F.xxhash64(F.array_join(F.filter(F.array(*present), lambda p: p.isNotNull()), "\n")) if present else F.xxhash64(F.lit(""))


def _variants(layout: Layout) -> list[tuple[str, ...]]:
    out = [layout.required]
    for extra in layout.optional:
        out += [(*v, extra) for v in out]
    return out


def to_turns(records: DataFrame, layouts: list[Layout] = LAYOUTS, ignore: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """Add ``layout`` (null when the fingerprint is unknown) and ``turns``, an array of (role, text).

    Null texts in a list of messages become empty ones; null roles likewise. Columns named in ``ignore`` are no part
    of a layout. An unknown layout keeps its row with null turns, for the caller to reject or map.
    """
    schema, known = records.schema, set(field_paths(records.schema))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for layout in reversed(layouts):
        if not set(layout.required) <= known:
            continue
        marks = [F.xxhash64(F.lit("\n".join(sorted(v)))) for v in _variants(layout) if set(v) <= known]
        hit = _any_of(F.col("_fingerprint"), marks)
        name, turns = F.when(hit, F.lit(layout.name)).otherwise(name), F.when(hit, _turns(layout, known)).otherwise(turns)
    return records.withColumn("_fingerprint", fingerprint(schema, ignore)).withColumns({"layout": name, "turns": turns}).drop("_fingerprint")


def _any_of(value: Column, marks: list[Column]) -> Column:
    hit = value == marks[0]
    for m in marks[1:]:
        hit = hit | (value == m)
    return hit


def _turns(layout: Layout, known: set[str]) -> Column:
    if layout.turns[0][0] == "*":
        _, path, role, text = layout.turns[0]

        def turn(x):
            r = F.coalesce(x[role], F.lit(""))
            for old, new in layout.roles:
                r = F.when(x[role] == old, new).otherwise(r)
            return F.struct(r.alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))

        return F.transform(F.col(_quoted(path)), turn)
    turns = [F.when(F.col(_quoted(p)).isNotNull(), F.struct(F.lit(role).alias("role"), F.col(_quoted(p)).alias("text"))) for role, p in layout.turns if p in known]
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: cut at escaped escape signs, so that each piece holds only simple ones."""
    pieces = F.split(text, r"\\\\")
    plain = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")))
    return F.array_join(plain, "\\")


def format_turns(turns: Column) -> Column:
    """One text with marked turns; roles and texts can be read back exactly."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MID), escape(t["text"]), F.lit(END))), "")


def parse_turns(formatted: Column) -> Column:
    """Turns read back from a formatted text."""
    body = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    return F.transform(body, lambda p: F.struct(
        unescape(F.replace(F.substring_index(p, MID, 1), F.lit(OPEN), F.lit(""))).alias("role"),
        unescape(F.substring_index(p, MID, -1)).alias("text")))


def loss_spans(formatted: Column, roles: tuple[str, ...] = ("assistant",)) -> Column:
    """Spans (start, length) in code points, from 0, of the escaped texts that a loss covers."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    sizes = F.transform(pieces, lambda p: F.struct(
        F.length(p).cast("long").alias("n"), F.length(F.substring_index(p, MID, -1)).cast("long").alias("text"),
        unescape(F.replace(F.substring_index(p, MID, 1), F.lit(OPEN), F.lit(""))).isin(*roles).alias("loss")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return F.aggregate(sizes, start, lambda acc, s: F.struct(
        (acc["at"] + s["n"] + len(END)).alias("at"),
        F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["n"] - s["text"]).alias("start"), s["text"].alias("length"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])


def format_records(records: DataFrame, layouts: list[Layout] = LAYOUTS, ignore: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """Add ``layout``, ``turns``, ``formatted`` and ``loss_spans`` to records of any of the layouts.

    Empty records (no turns) give an empty text. Control strings inside texts are escaped and come back unchanged.
    """
    out = to_turns(records, layouts, ignore)
    out = out.withColumn("formatted", format_turns(F.col("turns")))
    return out.withColumn("loss_spans", loss_spans(F.col("formatted")))


def digest(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Figures read back from ``formatted`` and ``loss_spans`` alone."""
    back = formatted.select(key, "layout", "formatted", parse_turns(F.col("formatted")).alias("back"), F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int")))).alias("loss"))
    all_text = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        key, F.size("back").cast("long").alias("n_turns"), F.sha2(all_text.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout")


def records_of(rows: DataFrame) -> DataFrame:
    """Records of four layouts from a table of turns (conv_id, turn, role, text).

    Pairs of user and assistant become prompt records, system-user-assistant triples instruction
    records, the others lists of messages under either naming, chosen by the id. Turns are in the
    order of (turn, role, text); a conversation is the unit of work and must fit in memory.
    Other columns of the input, whatever their names, are neither read nor returned.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.array_join(F.transform("t", lambda x: x["role"]), "\n")
    pair, triple = roles == "user\nassistant", roles == "system\nuser\nassistant"
    other = ~pair & ~triple
    shared = other & (F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(2)) == 0) & ~F.exists("t", lambda x: x["role"].isin("human", "gpt"))
    text = lambda i: F.get(F.col("t"), i)["text"]
    return convs.select(
        "conv_id", F.when(pair, text(0)).alias("prompt"), F.when(pair, text(1)).alias("response"),
        F.when(triple, text(0)).alias("instruction"), F.when(triple, text(1)).alias("input"), F.when(triple, text(2)).alias("output"),
        F.when(other & ~shared, F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))).alias("messages"),
        F.when(shared, F.transform("t", lambda x: F.struct(
            F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"),
            x["text"].alias("value")))).alias("conversations"))
