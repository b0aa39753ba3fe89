"""Conversations to training text, with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor flattens them, in order, into text
with numbered placeholders, and records for each attachment its reference and the number of tokens that its
placeholder stands for. The template marks turns with control strings; where a text holds such a string, or
the escape sign, it is escaped, so the formatted text can be read back to exactly the same turns.

    <s>[ROLE]name[/ROLE]text</s>        user turns: <s>[INST] text [/INST]</s>
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import named
from lakewarden.session import stage

# The control strings of the template.
OPEN, CLOSE = "<s>", "</s>"
INST, END_INST = "[INST]", "[/INST]"
ROLE, END_ROLE = "[ROLE]", "[/ROLE]"
_ESCAPED = re.compile(r"\\|<(?=/?s>|(?:image|audio|document):)|\[(?=/?(?:INST|ROLE)\])")
_ESCAPE = re.compile(r"\\(.)", re.S)
# An escaped character is passed over whole, so an escaped end mark does not end the name.
_NAMED = re.compile(r"((?:\\.|[^\\])*?)\[/ROLE\]", re.S)

PARTS = ("array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>")


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


@dataclass
class PartVisitor:
    """Flattens parts; ``attachments`` lists what their placeholders stand for, numbered from ``first``."""

    patch: int = 14
    audio_rate: float = 12.5
    page_tokens: int = 768
    first: int = 0
    attachments: list[dict] = field(default_factory=list)

    def message(self, parts: Iterable[dict]) -> str:
        return "".join(self.visit(p) for p in parts if p is not None)

    def visit(self, part: dict) -> str:
        kind = part.get("type") or "text"
        visitor = getattr(self, f"visit_{kind}", None)
        if visitor is None:
            raise ValueError(f"unknown content part {kind!r}")
        return visitor(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict) -> str:
        wide, high = (max(1, math.ceil((part.get(side) or 0) / self.patch)) for side in ("width", "height"))
        return self._attach("image", part, wide * high)

    def visit_audio(self, part: dict) -> str:
        return self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.audio_rate)))

    def visit_document(self, part: dict) -> str:
        return self._attach("document", part, self.page_tokens * max(1, part.get("pages") or 0))

    def _attach(self, kind: str, part: dict, tokens: int) -> str:
        number = self.first + len(self.attachments)
        self.attachments.append({"number": number, "kind": kind, "ref": part.get("ref"), "tokens": tokens})
        return f"<{kind}:{number}>"


def format_turn(role: str | None, body: str) -> tuple[str, int, int]:
    """The turn's text, and where its loss begins and ends in it: the body of assistant turns."""
    if role == "user":
        return f"{OPEN}{INST} {body} {END_INST}{CLOSE}", 0, 0
    head = f"{OPEN}{ROLE}{escape(role or '')}{END_ROLE}"
    loss = len(body) if role == "assistant" else 0
    return f"{head}{body}{CLOSE}", len(head) if loss else 0, (len(head) + loss) if loss else 0


def parse_turn(text: str) -> tuple[str, str]:
    """Role and unescaped body of a formatted turn; placeholders stay as they are."""
    inner = text[len(OPEN):-len(CLOSE)]
    if inner.startswith(INST):
        return "user", unescape(inner[len(INST) + 1:-len(END_INST) - 1])
    name = _NAMED.match(inner, len(ROLE))
    return unescape(name[1]), unescape(inner[name.end():])


_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()),
    ("loss_end", pa.int64()), ("attachments", pa.list_(pa.struct([
        ("number", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])))])
SEGMENTS = ("conv_id long, position long, formatted string, loss_start long, loss_end long, "
            "attachments array<struct<number:long,kind:string,ref:string,tokens:long>>")
_FIRST = object()
# Characters of a text by which turns of one number and role are dealt out; their order is by the whole text.
DEALT_CHARS = 64


def text_parts(text: Column) -> Column:
    """A text as the one part of a message, typed as in ``PARTS``."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (
        ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *nothing))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row of a sorted partition, the turns and the attachments of its conversation before it in that partition."""
    now, turns, known = _FIRST, 0, 0
    for batch in batches:
        places, before = [], []
        for conv, own in zip(batch.column("conv_id").to_pylist(), batch.column("own").to_pylist()):
            if now is _FIRST or conv != now:
                now, turns, known = conv, 0, 0
            places.append(turns)
            before.append(known)
            turns, known = turns + 1, known + own
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64()), pa.array(before, pa.int64())],
                                         names=[*batch.schema.names, "place", "known"])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            visitor = PartVisitor(first=row["known"])
            text, start, end = format_turn(row["role"], visitor.message(row["parts"] or []))
            out.append({"conv_id": row["conv_id"], "position": row["position"], "formatted": text, "loss_start": start,
                        "loss_end": end, "attachments": visitor.attachments})
        yield pa.RecordBatch.from_pylist(out, _SEGMENT)


def format_conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", parts_col: str | None = None) -> DataFrame:
    """One row per turn: (conv_id, position, formatted, loss_start, loss_end, attachments).

    The formatted conversation is its turns joined by position; the loss mask covers [loss_start, loss_end) of
    each. With ``parts_col`` (an array as in ``PARTS``) that column is read, else ``text_col`` is one text part.
    Turns are taken by number, NULL first; equal numbers by role and text, so repeated rows are turns of
    their own. A NULL text is empty, a NULL role an empty name, rows without a conversation id form one
    conversation, a NULL part is nothing, an empty table gives no rows, other columns are not read. Ids are
    whole numbers; an empty type is that of a text.

    Turns are dealt out in ranges of their order, so a conversation with very many turns is formatted by many tasks.
    Rows are numbered within their range; only the first conversation of a range can have begun in an earlier
    one, so what came before is at most one row per range and is broadcast.
    """
    parts = named(df, parts_col) if parts_col else text_parts(F.coalesce(named(df, text_col), F.lit("")))
    rows = df.select(named(df, id_col).cast("bigint").alias("conv_id"), named(df, turn_col).alias("turn"),
                     named(df, role_col).alias("role"), parts.alias("parts"))
    said = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    keys = [F.col("conv_id"), F.col("turn"), F.col("role")]
    dealt = rows.repartitionByRange(*keys, F.left(said, F.lit(DEALT_CHARS))).sortWithinPartitions(*keys, said, F.xxhash64("parts"))
    own = F.coalesce(F.size(F.filter("parts", lambda p: (p["type"] != "text") & (p["type"] != ""))), F.lit(0))
    kind = rows.schema["parts"].dataType.simpleString()
    turns = stage(dealt.select(F.spark_partition_id().alias("range"), "conv_id", "role", "parts", F.greatest(own, F.lit(0)).cast("bigint").alias("own")).mapInArrow(
        _numbered, f"range int, conv_id long, role string, parts {kind}, own long, place long, known long"), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begun = turns.groupBy("range", "conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("own")).select(
        F.col("range").alias("_range"), F.col("conv_id").alias("_conv"), F.sum("n").over(earlier).alias("_turns"),
        F.sum("own").over(earlier).alias("_known")).filter("_turns > 0")
    placed = turns.join(F.broadcast(begun), (F.col("range") == F.col("_range")) & F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return placed.select(
        "conv_id", "role", "parts", (F.col("place") + F.coalesce("_turns", F.lit(0))).alias("position"),
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("known")).mapInArrow(_format, SEGMENTS)


def written(segments: DataFrame) -> DataFrame:
    """The formatted turns as a Parquet table in the shared folder, read from there."""
    return stage(segments, "conversations")


@dataclass
class _Digest:
    conv_id: int | None
    turns: int = 0
    loss_chars: int = 0
    formatted_chars: int = 0
    attachments: int = 0
    attachment_tokens: int = 0
    all_turns: "hashlib._Hash" = field(default_factory=hashlib.sha256)
    loss: "hashlib._Hash" = field(default_factory=hashlib.sha256)

    def add(self, formatted: str, start: int, end: int, tokens: list[int]) -> None:
        role, body = parse_turn(formatted)
        self.turns += 1
        self.all_turns.update(f"{role}\n{body}\n".encode())
        learnt = unescape(formatted[start:end])
        self.loss.update(learnt.encode())
        self.loss_chars += len(learnt)
        self.formatted_chars += len(formatted)
        self.attachments += len(tokens)
        self.attachment_tokens += sum(tokens)

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all_turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(),
                "formatted_chars": self.formatted_chars, "n_attachments": self.attachments,
                "attachment_tokens": self.attachment_tokens}


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                     ("n_attachments", pa.int64()), ("attachment_tokens", pa.int64())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Digest | None = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Digest(row["conv_id"])
            now.add(row["formatted"], row["loss_start"], row["loss_end"], row["tokens"])
        yield pa.RecordBatch.from_pylist(out, _DIGEST)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], _DIGEST)


def read_back(segments: DataFrame) -> DataFrame:
    """What the formatted turns hold, per conversation: turns, digests of turns and of the loss text, attachments.

    A digest is sequential, so the turns of one conversation are read by one task, in order and as a stream.
    """
    dealt = segments.select("conv_id", "position", "formatted", "loss_start", "loss_end", F.transform(
        "attachments", lambda a: a["tokens"]).alias("tokens")).repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return dealt.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                     "formatted_chars long, n_attachments long, attachment_tokens long")
