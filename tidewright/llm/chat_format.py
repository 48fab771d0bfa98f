"""Chat formatting by schema fingerprints, in DataFrame functions alone.

A row's fingerprint is the SHA-256 of those of its nested field paths that hold something and that any mapping declares. It selects a declarative
mapping, which turns prompt, instruction and message layouts into canonical turns of role and text. Where fields of several layouts are there, so
that no mapping has the fingerprint, the first one takes the row whose required paths are. ``n_unmapped`` counts the paths that hold something and
are not read, but for harmless ones. ``format_turns`` writes the turns
of a conversation with a template that marks them and escapes control strings inside texts; ``parse_formatted`` reads them
back.

Null text counts as empty, null role as "". Rows of one conversation come in the order of the given columns, nulls first,
then by role and text; equal rows stay separate turns. A row without the required paths of any mapping gets ``layout`` null and no
turns, all its paths are unmapped, and its conversation is kept. Roles stay as they are unless the layout names aliases. A conversation is one value in the
end, so very long texts and conversations must fit in a task. An empty table gives an empty result. Result columns that the input has too must be
dropped or renamed by the caller: only the named input columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Turn:
    """A turn from a text field; its role is a constant or another field."""

    text: str
    role: str = ""
    role_field: str = ""


@dataclass(frozen=True)
class Mapping:
    """``required`` and ``optional`` are the field paths of the layout. ``turns`` make one turn each, in order; ``each``
    names an array of messages that makes one turn per element, with the given fields. ``roles`` are other names of roles that
    the layout uses; all else stays as it is."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[Turn, ...] = ()
    each: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    def fingerprints(self) -> list[str]:
        options = (c for k in range(len(self.optional) + 1) for c in combinations(self.optional, k))
        return [fingerprint_of((*self.required, *c)) for c in options]


#: Other names of roles, in layouts that use them.
ALIASES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
#: Fields that say nothing about the layout: a row with one of them, at any depth, is read as without it.
HARMLESS = ("name", "id", "index", "weight", "timestamp", "created_at", "metadata")
#: Layouts in common use.
MAPPINGS = (
    Mapping("turn_rows", (), ("role", "text"), (Turn("text", role_field="role"),)),
    Mapping("prompt_response", ("prompt", "response"), (), (Turn("prompt", "user"), Turn("response", "assistant"))),
    Mapping("prompt_completion", ("prompt", "completion"), (), (Turn("prompt", "user"), Turn("completion", "assistant"))),
    Mapping("question_answer", ("question", "answer"), ("system",), (Turn("system", "system"), Turn("question", "user"), Turn("answer", "assistant"))),
    Mapping("instruction", ("instruction", "output"), ("input",), (Turn("instruction", "user"), Turn("input", "user"), Turn("output", "assistant"))),
    Mapping("messages", ("messages[].role", "messages[].content"), (), each=("messages", "role", "content"), roles=ALIASES),
    Mapping("from_value", ("conversations[].from", "conversations[].value"), (), each=("conversations", "from", "value"), roles=ALIASES),
)

@dataclass(frozen=True)
class Template:
    """A turn is ``start``, its role, a newline, its text, ``end``. ``controls`` are strings no text may show; each is "<"
    or "[" and a rest without these."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")

    def rests(self) -> str:
        if any(not re.fullmatch(r"[<\[][^<\[]+", c) for c in self.controls):
            raise ValueError('a control string is "<" or "[" and a rest without these')
        return "|".join(re.escape(c[1:]) for c in self.controls)

    def escape(self, text: Column) -> Column:
        """One backslash more behind the first character of a control string, or of what looks like an escaped one."""
        return F.regexp_replace(text, rf"([<\[])(\\*)({self.rests()})", r"$1\\$2$3")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"([<\[])\\(\\*)({self.rests()})", r"$1$2$3")

    def escape_role(self, role: Column) -> Column:
        return self.escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))

    def unescape_role(self, role: Column) -> Column:
        return F.replace(F.replace(self.unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fingerprint_of(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _leaves(kind: DataType, path: str, present) -> Iterator[tuple[str, Column]]:
    """Field paths below a type, each with whether a row has it. present: a condition on the value at ``path`` -> one on the row."""
    if isinstance(kind, StructType):
        for f in kind.fields:
            yield from _leaves(f.dataType, f"{path}.{f.name}" if path else f.name, lambda test, f=f: present(lambda v: test(v[f.name])))
    elif isinstance(kind, ArrayType):
        yield from _leaves(kind.elementType, f"{path}[]", lambda test: present(lambda v: F.coalesce(F.exists(v, test), F.lit(False))))
    else:
        yield path, present(lambda v: v.isNotNull())


def field_paths(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {p: c for name in columns for p, c in _leaves(df.schema[name].dataType, name, lambda test, name=name: test(F.col(name)))}


def canonical_turns(df: DataFrame, columns: Sequence[str], mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """df with ``fingerprint``, ``layout``, ``turns`` and ``n_unmapped``. columns: those that hold the layout's fields, not ids."""
    paths = field_paths(df, columns)
    declared = {p for m in mappings for p in (*m.required, *m.optional)}
    mark = F.sha2(F.concat_ws("\n", *[F.when(paths[p], F.lit(p)) for p in sorted(paths) if p in declared]), 256)
    usable = [m for m in mappings if {*m.required, *m.optional} & paths.keys() and paths.keys() >= {*m.required}]
    named = F.lit(None).cast("string")
    for m in reversed(usable):
        there = F.lit(True)
        for p in m.required:
            there = there & paths[p]
        named = F.when(there, m.name).otherwise(named)
    for m in reversed(usable):
        named = F.when(F.col("fingerprint").isin(m.fingerprints()), m.name).otherwise(named)
    left = [F.when(paths[p] & ~F.coalesce(F.col("layout").isin([m.name for m in usable if p in (*m.required, *m.optional)]), F.lit(False)), 1).otherwise(0) for p in paths if p in declared or not _parts(p) & {*HARMLESS}]
    turns = F.array().cast(TURNS)
    for m in reversed(usable):
        turns = F.when(F.col("layout") == m.name, _turns_of(m, paths)).otherwise(turns)
    return df.withColumn("fingerprint", mark).withColumn("layout", named).withColumns({"turns": turns, "n_unmapped": sum(left, F.lit(0)).cast("long")})


def _parts(path: str) -> set[str]:
    return {*re.split(r"[.\[\]]+", path)}


def _role(name: Column, m: Mapping) -> Column:
    known = F.create_map(*[F.lit(x) for pair in m.roles for x in pair])[name] if m.roles else F.lit(None)
    return F.coalesce(known, name, F.lit(""))


def _turns_of(m: Mapping, paths: dict[str, Column]) -> Column:
    def turn(role: Column, text: Column) -> Column:
        return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))

    if m.each:
        array, role, text = m.each
        return F.transform(F.col(array), lambda e: turn(_role(e[role], m), e[text]))
    made = []
    for t in m.turns:
        there = t.text in paths and (F.lit(True) if t.role_field else F.col(t.text).isNotNull())
        if t.text in paths or t.role_field in paths:
            role = F.lit(t.role) if t.role else (_role(F.col(t.role_field), m) if t.role_field in paths else F.lit(""))
            text = F.col(t.text) if t.text in paths else F.lit("")
            made.append(F.when(there if t.text in paths else F.lit(True), turn(role, text)))
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def format_turns(df: DataFrame, id_column: str, order: Sequence[str] = (), template: Template | None = None, trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation from rows with ``turns``: ``formatted``, its number of ``turns``, and ``loss_spans``, the
    start and length in code points of the texts of trained roles. order: columns by which rows of one conversation follow."""
    t = template or Template()
    keys = [f"__order{k}" for k in range(len(order))]
    named = df.select(F.col(id_column).alias("__id"), *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)], "turns")
    one = named.select("__id", *keys, F.posexplode_outer("turns").alias("place", "turn"))
    role, text = F.col("turn.role"), F.col("turn.text")
    head = F.concat(F.lit(t.start), t.escape_role(role), F.lit("\n"))
    parts = one.select("__id", *keys, "place", role.alias("role"), text.alias("text"), head.alias("head"), t.escape(text).alias("body"))
    shown = parts.withColumn("piece", F.concat("head", "body", F.lit(t.end)))
    # Rows that tie on the given columns come by role and text; turns of one row keep their places.
    last = ["role", "text", "place"] if order else ["place", "role", "text"]
    ordered = Window.partitionBy("__id").orderBy(*[F.col(c).asc_nulls_first() for c in keys + last])
    before = F.coalesce(F.sum(F.length("piece")).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = shown.withColumns({"seq": F.row_number().over(ordered), "at": before})
    span = F.when(F.col("role").isin(*trained), F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    rows = placed.groupBy("__id").agg(F.sort_array(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("seq", "piece", span.alias("span"))))).alias("rows"))
    return rows.select(
        F.col("__id").alias(id_column),
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.size("rows").cast("long").alias("n_turns"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parse_formatted(formatted: Column, template: Template | None = None) -> Column:
    """The turns that a formatted conversation holds."""
    t = template or Template()
    pieces = F.split(formatted, re.escape(t.start))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(t.end))
        return F.struct(t.unescape_role(role).alias("role"), t.unescape(text).alias("text"))

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def trained_text(formatted: Column, loss_spans: Column, template: Template | None = None) -> Column:
    """The unescaped text under the loss mask."""
    t = template or Template()
    return F.array_join(F.transform(loss_spans, lambda s: t.unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
