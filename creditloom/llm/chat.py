"""Chat records of any known layout as canonical turns, and turns as text with a loss mask.

A record's fingerprint is a hash of its nested field paths that hold a value and that
some declared layout names. The fingerprint selects the layout, and the layout says, as
data, where roles and texts lie. Records are JSON texts or rows of typed columns.

The formatted text of a conversation is a run of turns, each
``<turn>`` role ``<text>`` text ``</turn>`` and a line break. Inside roles and texts a
backslash is doubled, and a control string gets one behind its first character, so that
no control string is left and taking one backslash off each pair undoes both.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

TURNS = "array<struct<role:string,text:string>>"


# layouts


@dataclass(frozen=True)
class Each:
    """A turn for each element of a list; the first of ``texts`` that has a value is its text."""

    items: str
    role: str
    texts: tuple[str, ...]
    roles: dict[str, str] = field(default_factory=dict, hash=False)
    before: str | None = None  # the path of a system text


@dataclass(frozen=True)
class Fixed:
    """A turn for each (role, paths); the values of the paths are joined by an empty line."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Row:
    """A row is one turn of a conversation; rows of a conversation are ordered by ``order``."""

    order: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """A set of field paths and how they become turns. Any of the optional paths may be missing."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: Each | Fixed | Row

    def variants(self) -> Iterator[frozenset[str]]:
        some = chain.from_iterable(combinations(self.optional, k) for k in range(len(self.optional) + 1))
        return (frozenset(self.required) | set(s) for s in some)


# --- fixed values: field names and roles of common public layouts ---
SHAREGPT_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant"}
LAYOUTS = (
    Layout("turn_rows", (), ("conv_id", "turn", "role", "text"), Row("turn", "role", "text")),
    Layout("messages", ("messages[]",), ("messages[].role", "messages[].content", "messages[].content[].text"),
           Each("messages", "role", ("content", "content[].text"))),
    Layout("sharegpt", ("conversations[]",), ("conversations[].from", "conversations[].value", "system"),
           Each("conversations", "from", ("value",), SHAREGPT_ROLES, "system")),
    Layout("instruction", ("instruction",), ("input", "output", "system"),
           Fixed((("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))))),
    Layout("prompt", ("prompt",), ("completion", "system"),
           Fixed((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))))),
    Layout("prompt_response", ("prompt", "response"), ("system",),
           Fixed((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))))),
    Layout("question", ("question",), ("context", "answer"),
           Fixed((("user", ("context", "question")), ("assistant", ("answer",))))),
)
# --- end of fixed values ---


def fingerprint(paths) -> str:
    """The hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def table_of(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    """The layout of each fingerprint; two layouts that share one raise."""
    out: dict[str, Layout] = {}
    for layout in layouts:
        for paths in layout.variants():
            if out.setdefault(fingerprint(paths), layout) is not layout:
                raise ValueError(f"{layout.name} and {out[fingerprint(paths)].name} share the paths {sorted(paths)}")
    return out


@dataclass(frozen=True)
class Value:
    """A value in a record, typed or variant, and ways to go on from it. None stands for no such field."""

    column: Column
    kind: DataType
    fields: dict[str, str] | None = None  # a whole row's columns by their exact names

    def child(self, name: str) -> Value | None:
        if isinstance(self.kind, VariantType):
            quoted = name.replace("\\", "\\\\").replace("'", "\\'")
            return Value(F.try_variant_get(self.column, f"$['{quoted}']", "variant"), VariantType())
        if not isinstance(self.kind, StructType) or name not in self.kind.names:
            return None
        column = F.col(self.fields[name]) if self.fields else self.column.getField(name)
        return Value(column, self.kind[name].dataType)

    def items(self) -> Value | None:
        if isinstance(self.kind, VariantType):
            return Value(F.try_variant_get(self.column, "$", "array<variant>"), ArrayType(VariantType()))
        return self if isinstance(self.kind, ArrayType) else None

    def scalar(self) -> Column | None:
        """The value as text, null unless it is a single one."""
        if isinstance(self.kind, VariantType):
            single = ~F.schema_of_variant(self.column).rlike("^(ARRAY|OBJECT|VOID)")
            return F.when(single, F.try_variant_get(self.column, "$", "string"))
        return None if isinstance(self.kind, (ArrayType, MapType, StructType)) else self.column.cast("string")


def _steps(path: str) -> list[tuple[str, bool]]:
    return [(s.removesuffix("[]"), s.endswith("[]")) for s in path.split(".")]


def present(value: Value, steps: list[tuple[str, bool]]) -> Column | None:
    """Does the path hold a value? A list does, also an empty one. None: it never can."""
    (name, many), *rest = steps
    child = value.child(name)
    if child and many:
        child = child.items()
    if child is None:
        return None
    if many:
        if not rest:
            return child.column.isNotNull()
        inner = lambda x: present(Value(x, child.kind.elementType), rest)
        if inner(F.lit(None)) is None:
            return None
        return F.coalesce(F.exists(child.column, lambda x: F.coalesce(inner(x), F.lit(False))), F.lit(False))
    if rest:
        return present(child, rest)
    single = child.scalar()
    return None if single is None else single.isNotNull()


def text_at(value: Value, path: str) -> Column | None:
    """The text at a path; elements of a list are put end to end."""
    (name, many), *rest = _steps(path)
    child = value.child(name)
    if child and many:
        child = child.items()
    if child is None:
        return None
    if not many:
        return text_at(child, ".".join(p + "[]" * m for p, m in rest)) if rest else child.scalar()
    below = ".".join(p + "[]" * m for p, m in rest)
    inner = lambda x: text_at(Value(x, child.kind.elementType), below) if rest else Value(x, child.kind.elementType).scalar()
    if inner(F.lit(None)) is None:
        return None
    joined = F.array_join(F.transform(child.column, lambda x: inner(x)), "")
    return F.when(F.exists(child.column, lambda x: inner(x).isNotNull()), joined)


def _first(columns: list[Column | None]) -> Column:
    some = [c for c in columns if c is not None]
    return F.coalesce(*some, F.lit(None).cast("string")) if some else F.lit(None).cast("string")


def _turns(value: Value, how: Each | Fixed | Row) -> Column:
    turn = lambda role, text: F.struct(role.cast("string").alias("role"), text.cast("string").alias("text"))
    if isinstance(how, Row):
        return F.array(turn(_first([text_at(value, how.role)]), _first([text_at(value, how.text)])))
    if isinstance(how, Fixed):
        made = []
        for role, paths in how.turns:
            texts = [c for c in (text_at(value, p) for p in paths) if c is not None]
            if texts:
                whole = F.array_join(F.filter(F.array(*texts), lambda t: F.length(t) > 0), "\n\n")
                made.append(F.when(F.coalesce(*texts).isNotNull(), turn(F.lit(role), whole)))
        return F.array_compact(F.array(*made)) if made else F.lit(None).cast(TURNS)
    child = value.child(how.items)
    child = child.items() if child else None
    if child is None:
        return F.lit(None).cast(TURNS)

    def one(x: Column) -> Column:
        element = Value(x, child.kind.elementType)
        role = _first([text_at(element, how.role)])
        for said, meant in how.roles.items():
            role = F.when(role == said, meant).otherwise(role)
        return turn(role, _first([text_at(element, p) for p in how.texts]))

    listed = F.transform(child.column, one)
    before = text_at(value, how.before) if how.before else None
    if before is None:
        return listed
    return F.concat(F.when(before.isNotNull(), F.array(turn(F.lit("system"), before))).otherwise(F.array().cast(TURNS)), listed)


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS, json: str | None = None, key: str = "conv_id") -> DataFrame:
    """conv_id, place, layout, fingerprint and turns (role, text) of every record.

    ``json`` names a column of JSON texts; without it the columns themselves are the record,
    of which those named in no layout are ignored. conv_id is the record's field ``key``.
    layout and turns are null for records that no layout fits, JSON that cannot be parsed
    among them. A null or missing role or text stays null; an empty list has no turns.
    place orders the rows of conversations that lie row by row, and is null for others.
    """
    if json is None:
        # positional names: columns may differ in case only
        plain = [f"_c{k}" for k in range(len(records.columns))]
        row = Value(F.lit(None), records.schema, dict(zip(records.columns, plain, strict=True)))
        records, usable = records.toDF(*plain), [x for x in layouts if not isinstance(x.turns, Row) or set(x.optional) <= set(row.kind.names)]
    else:
        records = records.select(F.try_parse_json(F.col(json)).alias("_record"))
        row, usable = Value(F.col("_record"), VariantType()), [x for x in layouts if not isinstance(x.turns, Row)]
    names = table_of(tuple(usable))
    paths = sorted({p for x in usable for p in (*x.required, *x.optional)})
    held = [(p, present(row, _steps(p))) for p in paths]
    listed = F.array_join(F.array_sort(F.array_compact(F.array(*[F.when(c, p) for p, c in held if c is not None], F.lit(None).cast("string")))), "\n")
    mark = F.substring(F.sha2(listed, 256), 1, 16)
    marked = records.withColumn("_mark", mark)
    layout, turns, place = F.lit(None).cast("string"), F.lit(None).cast(TURNS), F.lit(None).cast("long")
    for each in usable:
        here = F.col("_mark").isin([f for f, x in names.items() if x is each])
        layout = F.when(here, F.lit(each.name)).otherwise(layout)
        turns = F.when(here, _turns(row, each.turns)).otherwise(turns)
        if isinstance(each.turns, Row):
            place = F.when(here, row.child(each.turns.order).column.cast("long")).otherwise(place)
    found = row.child(key)
    conv = F.lit(None).cast("string") if found is None else found.scalar() if json else found.column
    return marked.select(conv.alias("conv_id"), place.alias("place"), layout.alias("layout"), F.col("_mark").alias("fingerprint"), turns.alias("turns"))


def layout_counts(records: DataFrame, json: str) -> DataFrame:
    """How many JSON records have each nested structure, and one of them: for declaring new layouts."""
    shape = F.schema_of_variant(F.try_parse_json(F.col(json)))
    return records.groupBy(shape.alias("structure")).agg(F.count("*").alias("records"), F.min(json).alias("example"))


# the template


@dataclass(frozen=True)
class Template:
    """Control strings around a turn; each begins with a character that is nowhere else in them."""

    begin: str = "<turn>"
    middle: str = "<text>"
    end: str = "</turn>"
    assistant: str = "assistant"

    def __post_init__(self) -> None:
        marks = (self.begin, self.middle, self.end)
        if any(len(m) < 2 or "\\" in m or m[0] in "".join(x[1:] for x in marks) for m in marks) or len(set(marks)) < 3:
            raise ValueError("a control string needs two characters, no backslash, and a first character of its own")

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for mark in (self.begin, self.middle, self.end):
            text = text.replace(mark, f"{mark[0]}\\{mark[1:]}")
        return text

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def write(self, role: str, text: str) -> tuple[str, int]:
        """The turn, and where its text begins."""
        head = f"{self.begin}{self.escape(role)}{self.middle}"
        return f"{head}{self.escape(text)}{self.end}\n", len(head)

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """Roles and texts of the turns of a formatted text."""
        out, at = [], 0
        while at < len(formatted):
            middle = formatted.find(self.middle, at)
            end = formatted.find(self.end, at)
            if not formatted.startswith(self.begin, at) or not at < middle < end:
                raise ValueError(f"no turn at character {at}")
            out.append((self.unescape(formatted[at + len(self.begin) : middle]), self.unescape(formatted[middle + len(self.middle) : end])))
            at = end + len(self.end) + 1
        return out


FORMATTED = StructType([
    StructField("chat", LongType()), StructField("part", IntegerType()), StructField("last", BooleanType()), StructField("layout", StringType()), StructField("n_turns", LongType()),
    StructField("text", StringType()), StructField("loss", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
])
BATCH_CHARS = 2_000_000


def _formatted(rows: DataFrame, template: Template, part_chars: int, by_rows: bool) -> DataFrame:
    """Formats rows in their order; of rows by turn, those of a conversation lie together."""
    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *FORMATTED])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, held, open_row, kind = [], 0, None, None
        number = 2 * (TaskContext.get().partitionId() << 32) + by_rows

        def frame() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True))
            loss = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            types = [kind, pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.string(), loss]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)

        def close(last: bool) -> None:
            nonlocal held
            row = open_row
            ready.append((row["conv"], row["chat"], row["part"], last, row["layout"], row["n"], "".join(row["pieces"]), row["loss"]))
            held += row["chars"]
            row.update(part=row["part"] + 1, n=0, pieces=[], loss=[], chars=0)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            convs, layouts, turns = (batch.column(c).to_pylist() for c in ("conv_id", "layout", "turns"))
            for conv, layout, said in zip(convs, layouts, turns, strict=True):
                if open_row is None or not by_rows or conv != open_row["conv"]:
                    if open_row is not None:
                        close(True)
                        number += 2
                    open_row = {"conv": conv, "chat": number, "part": 0, "layout": layout, "n": 0, "pieces": [], "loss": [], "chars": 0}
                for turn in said or []:
                    role, text = turn["role"] or "", turn["text"] or ""
                    if open_row["chars"] >= part_chars:
                        close(False)
                    piece, at = template.write(role, text)
                    if role == template.assistant:
                        open_row["loss"].append({"start": open_row["chars"] + at, "end": open_row["chars"] + len(piece) - len(template.end) - 1})
                    open_row["pieces"].append(piece)
                    open_row["n"] += 1
                    open_row["chars"] += len(piece)
                if held >= BATCH_CHARS or len(ready) >= 1000:
                    yield frame()
                    ready, held = [], 0
        if open_row is not None:
            close(True)
        if ready:
            yield frame()

    return rows.select("conv_id", "layout", "turns").mapInArrow(work, schema)


def format_chats(canonical: DataFrame, template: Template = Template(), part_chars: int = 1_000_000) -> DataFrame:
    """conv_id, chat, part, last, layout, n_turns, text and loss spans of every conversation.

    chat numbers the conversations, whose ids need not differ. loss holds the spans (code points of text, end exclusive) of assistant turns' texts. A
    conversation is one row, or several parts in order: a part that has ``part_chars``
    characters is closed before the next turn. Rows by turn with the same conv_id (null
    too) are one conversation, ordered by place, role and text, nulls first; repeated rows
    are repeated turns. Other records are a conversation each. A null role or text is
    formatted as an empty one; a record without a layout or turns has an empty text. An
    empty table gives an empty result.
    """
    by_rows = F.coalesce(F.col("layout") == "turn_rows", F.lit(False))
    ordered = canonical.filter(by_rows).withColumn("_role", F.col("turns")[0]["role"]).withColumn("_text", F.col("turns")[0]["text"])
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "place", "_role", "_text")
    return _formatted(ordered, template, part_chars, True).unionByName(_formatted(canonical.filter(~by_rows), template, part_chars, False))


def read_turns(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """The turns of formatted texts: conv_id, chat, part, place in the part, role and text."""
    schema = StructType([
        StructField("conv_id", formatted.schema["conv_id"].dataType), StructField("chat", LongType()), StructField("part", IntegerType()), StructField("place", IntegerType()),
        StructField("role", StringType()), StructField("text", StringType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                turns = template.read(batch.column("text")[k].as_py())
                n = len(turns)
                take = pa.array([k] * n, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column("conv_id").take(take), batch.column("chat").take(take), batch.column("part").take(take), pa.array(range(n), pa.int32()),
                    pa.array([r for r, _ in turns], pa.string()), pa.array([t for _, t in turns], pa.string()),
                ], schema.names)

    return formatted.select("conv_id", "chat", "part", "text").mapInArrow(work, schema)


def chat_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted texts hold, read back: a row per conversation.

    conv_id, n_turns, turns_sha256 (of role, line break, text, line break per turn),
    loss_chars and loss_sha256 (of the unescaped text under the loss mask), formatted_chars.
    Parts of a conversation are digested in order in one stream of bounded memory, since a
    digest of the whole cannot be put together from digests of parts; conversations of
    one part are not shuffled.
    """
    schema = StructType([
        StructField("conv_id", formatted.schema["conv_id"].dataType), StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, chars, masked, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "last", "text", "loss"))
            for conv, last, text, spans in zip(*columns, strict=True):
                for role, said in template.read(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in spans:
                    under = template.unescape(text[span["start"] : span["end"]])
                    loss.update(under.encode())
                    masked += len(under)
                chars += len(text)
                if last:
                    done.append((conv, n, turns.hexdigest(), masked, loss.hexdigest(), chars))
                    n, chars, masked, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            if done:
                kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], schema.names)

    single = F.col("last") & (F.col("part") == 0)
    needed = formatted.select("conv_id", "chat", "part", "last", "text", "loss")
    parted = needed.filter(~single).repartition("chat").sortWithinPartitions("chat", "part")
    return needed.filter(single).mapInArrow(work, schema).unionByName(parted.mapInArrow(work, schema))
