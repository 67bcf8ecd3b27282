"""Chat formatting: heterogeneous records to canonical turns to one template.

The nested field paths of a record are hashed; the hash selects a declarative
mapping, which says by paths alone where the canonical turns (an array of role and
text) are. For a table the paths are those of its schema, for records in JSON those
of each record, over all elements of its arrays. Turns are then rendered by a
template whose control marks all start with `<`. Inside roles and texts the
characters `\\`, `<` and `[` are escaped (`\\\\`, `\\l`, `\\b`), so that no
control string, `</s>` or `[INST]` either, can be read from a text, and the text comes
back as it was.

Defined results: null roles and texts count as empty; rows with equal turn
numbers are ordered by role and text; repeated rows are turns of their own; rows
without a conv_id are one conversation; very long texts are formatted whole; fields
that no layout knows are left out; an empty array of messages gives no turns; a record
with the paths of two layouts goes by the one listed first; one whose paths no layout
knows, or that is no JSON, gets null turns, so that it shows; an empty table gives an
empty result. A conversation is one value of one row, so its turns have to fit a task.
"""

from __future__ import annotations

import itertools
from typing import NamedTuple

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, quoted, sums_before

TURN, TEXT, LEARN, END = "<turn>", "<text>", "<learn>", "<end>"
TURNS = "array<struct<role:string,text:string>>"


def paths_of(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type; `[]` stands for an array's elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths_of(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, f"{at}[]")
    return [at]


def schema_hash(paths) -> int:
    """Of the sorted paths; equal to Spark's xxhash64 of the same string."""
    value = xxhash.xxh64_intdigest("\n".join(sorted(paths)), 42)
    return value - (1 << 64) if value >> 63 else value


class Layout(NamedTuple):
    """A mapping to turns, as paths only. Either `messages`: an array of records with
    a role and a text (or, as `parts`, an array of records with a text); or a pair of
    what is asked, with more to it, and what is answered. `system` stands before."""

    name: str
    messages: str | None = None
    role: str | None = None
    text: str | None = None
    parts: str | None = None
    asked: str | None = None
    more: str | None = None
    answered: str | None = None
    system: str | None = None

    def may_have(self) -> tuple[list[str], list[str]]:
        """The paths of which any, but at least one, is there, and those beside."""
        if self.messages:
            inner = [self.role, self.text, *([f"{self.text}[]", f"{self.text}[].{self.parts}"] if self.parts else [])]
            return [f"{self.messages}[]", *[f"{self.messages}[].{x}" for x in inner]], [self.system] if self.system else []
        return [self.asked, self.answered], [x for x in (self.more, self.system) if x]

    def hashes(self) -> set[int]:
        """Of all sets of paths that select this layout. A pair needs both of its own;
        of messages some paths may be missing in a record (no message, no text)."""
        need, beside = self.may_have()
        few = lambda x: (c for k in range(len(x) + 1) for c in itertools.combinations(x, k))
        cores = [c for c in few(need) if c] if self.messages else [tuple(need)]
        return {schema_hash((*core, *more)) for core in cores for more in few(beside)}


#: Other names of roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS = (
    Layout("turns", messages="turns", role="role", text="text", system="system"),
    Layout("messages", messages="messages", role="role", text="content", parts="text", system="system"),
    Layout("conversations", messages="conversations", role="from", text="value", system="system"),
    Layout("request", messages="body.messages", role="role", text="content", parts="text"),
    Layout("prompt", asked="prompt", answered="completion", system="system"),
    Layout("response", asked="prompt", answered="response", system="system"),
    Layout("question", asked="question", answered="answer", more="context", system="system"),
    Layout("instruction", asked="instruction", more="input", answered="output", system="system"),
    Layout("nested", asked="data.prompt", answered="data.completion"),
)


def known_paths(layouts=LAYOUTS) -> list[str]:
    return sorted({p for x in layouts for some in x.may_have() for p in some})


def selected_by(layouts=LAYOUTS) -> dict[int, Layout]:
    """Hash of a record's known paths -> layout. A record with the paths of two
    layouts goes by the one that is listed first."""
    found: dict[int, Layout] = {}
    sets = [(x, *x.may_have()) for x in layouts]
    for x in layouts:
        for h in x.hashes():
            found.setdefault(h, x)
    for (x, need, _), (y, other, _) in itertools.combinations(sets, 2):
        both = sorted({*(need if not x.messages else need[1:3]), *(other if not y.messages else other[1:3])})
        found.setdefault(schema_hash(both), x)
    return found


class Typed:
    """Reads the fields of a struct."""

    def __init__(self, record: Column, kind: T.StructType):
        self.record, self.kind = record, kind

    def _find(self, path: str):
        at, kind = self.record, self.kind
        for name in path.split("."):
            if not isinstance(kind, T.StructType) or name not in kind.names:
                return None, None
            at, kind = at[name], kind[name].dataType
        return at, kind

    def text(self, path: str) -> Column:
        at, _ = self._find(path)
        return F.lit("") if at is None else F.coalesce(at.cast("string"), F.lit(""))

    def has(self, path: str) -> Column:
        return F.lit(self._find(path)[0] is not None)

    def each(self, path: str, body) -> Column:
        at, kind = self._find(path)
        empty = F.array().cast(TURNS)
        if not isinstance(kind, T.ArrayType):
            return empty
        return F.coalesce(F.transform(at, lambda x: body(Typed(x, kind.elementType))), empty)

    def joined(self, path: str, inner: str) -> Column:
        at, kind = self._find(path)
        return F.array_join(F.transform(at, lambda x: Typed(x, kind.elementType).text(inner)), "") if isinstance(kind, T.ArrayType) else self.text(path)


class Parsed:
    """Reads the fields of a variant, as of a record in JSON."""

    def __init__(self, record: Column):
        self.record = record

    def _get(self, path: str, kind: str) -> Column:
        return F.try_variant_get(self.record, F.lit("$." + path), kind)

    def text(self, path: str) -> Column:
        return F.coalesce(self._get(path, "string"), F.lit(""))

    def has(self, path: str) -> Column:
        return self._get(path, "variant").isNotNull()

    def each(self, path: str, body) -> Column:
        return F.coalesce(F.transform(self._get(path, "array<variant>"), lambda x: body(Parsed(x))), F.array().cast(TURNS))

    def joined(self, path: str, inner: str) -> Column:
        parts = F.transform(self._get(path, "array<variant>"), lambda x: Parsed(x).text(inner))
        return F.coalesce(F.array_join(parts, ""), self.text(path))


def _turn(role, text) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), text.alias("text"))


def mapped(x: Layout, record) -> Column:
    """The turns of a record, by a layout."""
    if x.messages:
        named = F.create_map(*[F.lit(v) for pair in ROLES.items() for v in pair])
        role = lambda m: F.coalesce(named[m.text(x.role)], m.text(x.role))
        text = lambda m: m.joined(x.text, x.parts) if x.parts else m.text(x.text)
        turns = record.each(x.messages, lambda m: _turn(role(m), text(m)))
    else:
        more = record.text(x.more) if x.more else F.lit("")
        asked = F.concat_ws("\n", record.text(x.asked), F.when(more != "", more))
        turns = F.array(_turn("user", asked), _turn("assistant", record.text(x.answered)))
    if x.system is None:
        return turns.cast(TURNS)
    first = F.when(record.text(x.system) != "", F.array(_turn("system", record.text(x.system)))).otherwise(F.array().cast(TURNS))
    return F.concat(first.cast(TURNS), turns.cast(TURNS))


#: How deep records are looked into: arrays and objects each count.
DEPTH = 5


def json_paths(record: Column, depth: int = DEPTH) -> Column:
    """The nested field paths of a variant: all keys of all elements of all arrays,
    `depth` levels deep. `[]` stands for an array's elements; an empty array is a
    path that ends so. A key with a dot or a bracket can't be taken for a path."""
    none = F.array().cast("array<string>")

    def below(v: Column, at: Column, left: int) -> Column:
        if not left:
            return F.array(at)
        fields = F.try_variant_get(v, F.lit("$"), "map<string,variant>")
        items = F.try_variant_get(v, F.lit("$"), "array<variant>")
        inside = lambda e: below(e["value"], F.concat(at, F.when(at == "", "").otherwise("."), F.regexp_replace(e["key"], r"[.\[\]]", "?")), left - 1)
        elements = F.flatten(F.transform(items, lambda x: below(x, F.concat(at, F.lit("[]")), left - 1)))
        return (
            F.when(fields.isNotNull(), F.flatten(F.transform(F.map_entries(fields), inside)))
            .when(F.size(items) > 0, elements).when(items.isNotNull(), F.array(F.concat(at, F.lit("[]")))).otherwise(F.array(at))
        )

    return F.coalesce(F.array_distinct(below(record, F.lit(""), depth)), none)


def paths_hash(paths: Column, layouts=LAYOUTS) -> Column:
    """Of the paths that some layout knows: fields beyond those change nothing."""
    known = F.array(*[F.lit(x) for x in known_paths(layouts)])
    return F.xxhash64(F.array_join(F.array_sort(F.array_intersect(paths, known)), "\n"))


def turns_of_json(record: Column, layouts=LAYOUTS) -> Column:
    """Canonical turns of a JSON record, by the layout that its hash selects."""

    def by_hash(v: Column) -> Column:
        def choose(h: Column) -> Column:
            by_layout: dict[Layout, list[int]] = {}
            for k, x in selected_by(layouts).items():
                by_layout.setdefault(x, []).append(k)
            out = F.lit(None).cast(TURNS)
            for x, hashes in by_layout.items():
                out = F.when(h.isin(hashes), mapped(x, Parsed(v))).otherwise(out)
            return out

        return let(paths_hash(json_paths(v), layouts), choose)

    return let(F.try_parse_json(record), by_hash)


def nested(df: DataFrame) -> DataFrame:
    """Rows by turn -> a record for each conversation: conv_id, turns, with all columns
    of a turn, in order. What is missing in a turn counts as empty."""
    order = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return df.groupBy("conv_id").agg(F.sort_array(F.collect_list(order)).alias("turns"))


def canonical_turns(df: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """conv_id, turns. A table is a table of records; its schema is their layout. Rows
    by turn are first nested by conversation; a column `record` holds records as JSON,
    each of a layout of its own. The hash of the known paths of the schema, or of the
    record, selects the mapping; other columns are left out."""
    if {"conv_id", "turn", "role", "text"} <= set(df.columns):
        df = nested(df.select("conv_id", "turn", "role", "text"))
    elif {"conv_id", "record"} <= set(df.columns):
        return df.select("conv_id", turns_of_json(F.col("record"), layouts).alias("turns"))
    kept = df.select(F.struct(*quoted(c for c in df.columns if c != "conv_id")).alias("r"), "conv_id")
    paths = sorted(set(paths_of(kept.schema["r"].dataType)) & set(known_paths(layouts)))
    layout = selected_by(layouts).get(schema_hash(paths))
    if layout is None:
        raise ValueError(f"no mapping for the paths {sorted(paths_of(df.schema))}")
    return kept.select("conv_id", mapped(layout, Typed(F.col("r"), kept.schema["r"].dataType)).alias("turns"))


def escape(x: Column) -> Column:
    for plain, mark in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        x = F.replace(x, F.lit(plain), F.lit(mark))
    return x


def unescape(x: Column) -> Column:
    parts = F.transform(F.split(x, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")))
    return F.array_join(parts, "\\")


def render(turn: Column) -> Column:
    """Of a turn whose role and text are escaped."""
    mark = F.when(turn["role"] == "assistant", F.lit(LEARN)).otherwise(F.lit(TEXT))
    return F.concat(F.lit(TURN), turn["role"], mark, turn["text"], F.lit(END))


def format_turns(df: DataFrame) -> DataFrame:
    """Adds `formatted`, and `loss_spans`: start (from 0) and length, in code
    points of `formatted`, of what the loss covers: each assistant text."""
    spans = "array<struct<start:bigint,length:bigint>>"

    def of_rendered(x: Column) -> Column:
        ends = len(TURN) + len(LEARN)
        assistant = F.filter(x, lambda t: t["role"] == "assistant")
        return F.transform(assistant, lambda t: F.struct((t["at"] + ends + F.length(t["role"])).alias("start"), F.length(t["text"]).alias("length"))).cast(spans)

    # Roles and texts, escaped once; a turn's place is the sum of the lengths before it.
    safe = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    df = df.withColumn("_safe", safe)
    whole = F.transform("_safe", render)
    df = df.withColumn("formatted", F.array_join(whole, ""))
    places = sums_before(F.transform(whole, F.length))
    at = F.zip_with("_safe", places, lambda t, p: F.struct(t["role"].alias("role"), t["text"].alias("text"), p.alias("at")))
    return df.withColumn("loss_spans", of_rendered(at)).drop("_safe")


def parse(formatted: Column) -> Column:
    """The turns, read back from the formatted text."""
    pieces = F.filter(F.split(formatted, TURN), lambda p: p != "")

    def turn(p: Column) -> Column:
        body = F.split(p, f"{TEXT}|{LEARN}|{END}")
        return F.struct(unescape(F.get(body, F.lit(0))).alias("role"), unescape(F.get(body, F.lit(1))).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_chat(df: DataFrame) -> DataFrame:
    """conv_id, turns, formatted, loss_spans for each record of any known layout."""
    return format_turns(canonical_turns(df))


def digests(chats: DataFrame) -> DataFrame:
    """The contract's columns, read back from `formatted` and `loss_spans`."""
    lines = F.transform(F.col("back"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = chats.select(
        "conv_id", "formatted", parse(F.col("formatted")).alias("back"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    return back.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
