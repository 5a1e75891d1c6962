"""Chat formatting: conversations rebuilt from an event log, rendered with a loss mask, and read back.

A log row has a conversation, a sequence number, a kind, a role, a text and a target turn. Kinds: ``message`` begins
a turn; ``delta`` appends to the newest turn; ``edit`` replaces the text of turn ``target``; ``regenerate`` drops
turn ``target`` and all after it and begins it anew.

Rendered, a turn is ``<turn ROLE>TEXT</turn>`` and a newline. Inside role and text a backslash stands before each
backslash, ``<`` and ``>``, so control strings of a text can't be taken for those of the template, and taking the
backslashes out gives the text back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("message", "delta", "edit", "regenerate")
RENDERED = "conv_id bigint, formatted string, loss_starts array<int>, loss_ends array<int>"
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
          "formatted_chars bigint")
_SPECIAL, _ESCAPED = re.compile(r"[\\<>]"), re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


class Conversation:
    """Turns folded from events: role and pieces of text."""

    def __init__(self) -> None:
        self.turns: list[tuple[str, list[str]]] = []

    def fold(self, kind: str, role: str, text: str, target: int | None) -> None:
        """Apply one event. One that names a turn which isn't there, or an unknown kind, changes nothing."""
        there = target is not None and 0 <= target < len(self.turns)
        if kind == "message":
            self.turns.append((role, [text]))
        elif kind == "delta":
            if self.turns:
                self.turns[-1][1].append(text)
        elif kind == "edit" and there:
            self.turns[target] = (self.turns[target][0], [text])
        elif kind == "regenerate" and there:
            role = role or self.turns[target][0]
            del self.turns[target:]
            self.turns.append((role, [text]))

    def render(self, learn: str) -> tuple[str, list[int], list[int]]:
        """The formatted text and the character spans of the texts of role ``learn``."""
        out, starts, ends, at = [], [], [], 0
        for role, pieces in self.turns:
            head, body = f"<turn {escape(role)}>", escape("".join(pieces))
            if role == learn:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            out += [head, body, "</turn>\n"]
            at += len(head) + len(body) + 8
        return "".join(out), starts, ends


def format_conversations(log: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_starts, loss_ends`` (spans in characters).

    ``log`` has ``conv_id, seq, kind, role, text, target``; more columns are ignored. A task sorts its conversations
    by sequence (Spark spills what doesn't fit) and folds them as they stream by, so it holds the text of one
    conversation, which is one row of the result anyhow. Events with one sequence number are taken in the order of
    kind, role and text; a repeated row is a further event. A null text or role is empty, a null sequence number
    comes first, and rows without conversation form one conversation with a null id.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    ordered = (
        log.select(F.col("conv_id").cast("bigint"), F.col("seq").cast("bigint"), "kind", "role", "text",
                   F.col("target").cast("int"), rank.alias("rank"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "rank", "role", "text", "target")
        .select("conv_id", "kind", "role", "text", "target")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, done, size = None, None, [], 0
        for batch in batches:
            for conv, kind, role, text, target in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or conv != key:
                    if now is not None:
                        done.append((key, *now.render(learn)))
                        size += len(done[-1][1])
                    key, now = conv, Conversation()
                    if size > 4 << 20:
                        yield _rows(done)
                        done, size = [], 0
                now.fold(kind or "", role or "", text or "", target)
        if now is not None:
            done.append((key, *now.render(learn)))
            yield _rows(done)

    return ordered.mapInArrow(task, RENDERED)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), kinds)],
                                      ["conv_id", "formatted", "loss_starts", "loss_ends"])


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; raises when it isn't one."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def digest(rendered: DataFrame) -> DataFrame:
    """Hashes of turns and of the text under the loss mask, both read back from the formatted text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, formatted, starts, ends in zip(*[c.to_pylist() for c in batch.columns]):
                turns = read_back(formatted)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescape(formatted[a:b]) for a, b in zip(starts, ends))
                out.append((conv, len(turns), sha256(said.encode()).hexdigest(), len(loss),
                            sha256(loss.encode()).hexdigest(), len(formatted)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                names = [part.split()[0] for part in DIGEST.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)

    return rendered.mapInArrow(task, DIGEST)
