"""Operator 5: chat formatting by a finite-state machine over roles.

A declarative :class:`Template` gives, for each state, the roles that may
come next, and which roles count for the loss. Rows of a conversation are read
in the order of (turn, role, text), nulls last, as one sorted stream: the
machine emits text segments, each with its loss flag; a turn that the current
state does not allow is formatted all the same and noted in ``error_turn``.

Control strings inside texts and role names are escaped reversibly, so the
output can be read back exactly. Null texts and null roles count as empty;
rows with a null conv_id form one conversation. No rows, no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, table, text_batches


@dataclass(frozen=True)
class Template:
    """Markers around turns, the allowed order of roles and the roles that are learnt."""

    open: str = "### "
    named: str = ": "
    close: str = " </turn>\n"
    learnt: frozenset = frozenset({"assistant"})
    start: str = "start"
    moves: dict = field(default_factory=lambda: {
        "start": {"system", "user"},
        "system": {"user"},
        "user": {"assistant"},
        "assistant": {"user"},
    })
    # control strings and what stands for them; the backslash is the escape sign
    escapes: dict = field(default_factory=lambda: {"\\": "\\\\", "###": "\\h", "</turn>": "\\t", ": ": "\\c"})

    def escape(self, text: str, role: bool = False) -> str:
        for plain, held in self.escapes.items():
            if plain != self.named or role:
                text = text.replace(plain, held)
        return text

    def unescape(self, text: str) -> str:
        back = {held: plain for plain, held in self.escapes.items()}
        return re.sub(r"\\.", lambda m: back[m[0]], text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The text segments of one turn with their loss flags."""
        return [(f"{self.open}{self.escape(role, role=True)}{self.named}", False),
                (self.escape(text), role in self.learnt), (self.close, False)]

    def turns(self, formatted: str) -> list[tuple[str, str]]:
        """Read (role, text) back from a formatted conversation."""
        out = []
        for body in formatted.split(self.close)[:-1]:
            role, text = body[len(self.open):].split(self.named, 1)
            out.append((self.unescape(role), self.unescape(text)))
        return out


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, formatted, segments (start, length, loss), n_turns, error_turn.

    ``segments`` cover the formatted text without gaps. ``error_turn`` is the
    place (from 0) of the first turn out of order, null if there is none.
    """
    template = template or Template()
    text_batches(rows.sparkSession, 4096)
    ordered = (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                           F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
               .repartition("conv_id")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text"))
    segment = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("loss", pa.bool_())])
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("segments", pa.list_(segment)),
                        ("n_turns", pa.int64()), ("error_turn", pa.int64())])

    def conversations(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key: object = ()  # no conversation yet
        parts, marks, at, n, state, wrong = [], [], 0, 0, template.start, None
        for batch in it:
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if conv != key:
                    if key != ():
                        yield key, "".join(parts), marks, n, wrong
                    key = conv
                    parts, marks, at, n, state, wrong = [], [], 0, 0, template.start, None
                if wrong is None and role not in template.moves.get(state, ()):
                    wrong = n
                state = role
                for s, loss in template.segments(role, text):
                    parts.append(s)
                    marks.append({"start": at, "length": len(s), "loss": loss})
                    at += len(s)
                n += 1
        if key != ():
            yield key, "".join(parts), marks, n, wrong

    return ordered.mapInArrow(
        lambda it: batches(conversations(it), schema, 256),
        "conv_id long, formatted string, segments array<struct<start:long,length:long,loss:boolean>>, "
        "n_turns long, error_turn long")


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests taken from the formatted texts and their loss mask alone."""
    template = template or Template()
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("error_turn", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in it:
            for conv, text, marks, wrong in zip(*(c.to_pylist() for c in batch.columns)):
                turns = template.turns(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learnt = "".join(template.unescape(text[m["start"]:m["start"] + m["length"]]) for m in marks if m["loss"])
                yield (conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt),
                       hashlib.sha256(learnt.encode()).hexdigest(), len(text), wrong)

    return formatted.select("conv_id", "formatted", "segments", "error_turn").mapInArrow(
        lambda it: batches(run(it), schema, 1024),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, error_turn long")


def planted(spark) -> DataFrame:
    """Conversation -7, whose texts hold the template's own control strings."""
    said = "\\### Assistant: </turn> ok"
    return spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(planted(spark))))
