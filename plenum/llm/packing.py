"""Packing of token ids into rows of one length: best fit decreasing, as matrices ready for training.

Documents longer than a row are split into full rows and a rest; rests and short documents are segments. Segments,
longest first, go to the row with the least room that still holds them; a segment tree over room finds it. A row is
written as its ids, the cumulative lengths of its segments and the position of each segment's first id in its
document, so every document can be put together again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm import bpe
from plenum.llm.text import parse_schema, with_struct

ROW = 2048
#: Characters of text, or ids, that one pack group aims at.
GROUP = 4_000_000
#: Longest text, in characters, that is given to the tokenizer library.
LIBRARY_TEXT = 100_000
PACKED = ("pack_group bigint, row bigint, ids binary, cu_seqlens array<int>, position_starts array<bigint>, "
          "doc_ids array<bigint>, n_tokens bigint")


class Rooms:
    """Open rows by room, 0 to ``size``: a segment tree whose nodes count the rows in a range of room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Room and number of a row with the smallest room of at least ``least``, which is taken out."""
        node = self.leaves + least
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1  # up until there is something to the right
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, row


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows as lists of segment numbers; ``lengths`` are 1 to ``size``. Equal lengths in the order given."""
    rooms, rows = Rooms(size), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            found = size, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(i)
        rooms.add(room - lengths[i], row)
    return rows


@lru_cache(maxsize=1)
def _library(lines: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_ids(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` (binary) of a rank vocabulary, made by the tokenizer library inside the tasks; null as the empty text.

    The library overflows its stack on very long runs of white space, so texts of more than ``LIBRARY_TEXT`` characters
    are encoded by :mod:`plenum.llm.bpe`, which gives the same ids.
    """
    with open(path, "rb") as file:
        lines = docs.sparkSession.sparkContext.broadcast(file.read())  # as large as a vocabulary

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        encode = _library(lines.value, pattern).encode_ordinary

        def ids(value: str) -> bytes:
            if len(value) > LIBRARY_TEXT:
                return bpe.vocabulary(path, lines.value, pattern).encode(value)
            return np.array(encode(value), "<u4").tobytes()

        return {"ids": pa.array([ids(t.as_py() or "") for t in texts], pa.binary())}

    some = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return with_struct(some, ["text"], "tokens", parse_schema("ids binary"), work).select("doc_id", "tokens.ids")


def pack(
    tokens: DataFrame, key: str = "doc_id", ids: str = "ids", size: int = ROW, group: int = GROUP, groups: int | None = None,
) -> DataFrame:
    """Rows of at most ``size`` ids made of all documents of ``tokens`` (a key and an array or binary of ids).

    ``ids`` are 32-bit little-endian numbers when binary. Documents are dealt by a hash of key and ids to groups of
    about ``group`` ids, so null and repeated keys are spread like others, and packed one by one. A group that
    holds more, as copies with one key make it, is packed in pieces: a task holds twice ``group`` ids and one document
    at most, and its rows are sorted by key and ids, so a task that runs again makes the same rows. ``groups`` sets
    their number, which otherwise takes a pass to count the ids. Only a piece's last rows may be partly full. Null and empty documents have no
    ids and appear in no row; a null key is kept as null; other columns are ignored.
    """
    packed = dict(tokens.dtypes)[ids] == "binary"
    some = tokens.select(F.col(key).cast("bigint").alias("doc_id"), F.col(ids).alias("ids")).filter(F.col("ids").isNotNull())
    some = some if packed else some.withColumn("ids", pack_ids("ids"))
    if groups is None:
        groups = -(-int(some.agg(F.sum(F.octet_length("ids") / 4)).first()[0] or 0) // group)
    return pack_groups(some, max(1, groups), size, 2 * group)


def pack_ids(column: str):
    """An array of ids as a binary of 32-bit little-endian numbers."""
    @F.arrow_udf("binary")
    def to_bytes(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else np.array(x, "<u4").tobytes() for x in lists.to_pylist()], pa.binary())
    return to_bytes(F.col(column))


def pack_groups(some: DataFrame, groups: int, size: int, held: int) -> DataFrame:
    """Pack ``doc_id, ids`` in so many groups, ``held`` ids at a time; ``ids`` are binary."""
    dealt = some.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(groups)))

    def rows_of(number: int, first: int, docs: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
        # segments: document, first id, length; full rows are segments of their own
        segments = [(d, at, min(size, len(b) // 4 - at)) for d, (_, b) in enumerate(docs) for at in range(0, len(b) // 4, size)]
        columns: list[list] = [[] for _ in range(7)]
        for row, members in enumerate(best_fit([s[2] for s in segments], size)):
            parts = [segments[i] for i in members]
            values = (number, first + row, b"".join(docs[d][1][4 * at : 4 * (at + n)] for d, at, n in parts),
                      np.cumsum([0, *[n for _, _, n in parts]]).tolist(), [at for _, at, _ in parts],
                      [docs[d][0] for d, _, _ in parts], sum(n for _, _, n in parts))
            for column, value in zip(columns, values):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
        names = [part.split()[0] for part in PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, ids, first = None, [], 0, 0
        for batch in batches:
            for number, doc, content in zip(*[c.to_pylist() for c in batch.columns]):
                if docs and (number != now or ids >= held):
                    rows = rows_of(now, first, docs)
                    yield rows
                    docs, ids, first = [], 0, first + rows.num_rows
                if number != now:
                    now, first = number, 0
                docs.append((doc, content))
                ids += len(content) // 4
        if docs:
            yield rows_of(now, first, docs)

    ordered = dealt.repartition(groups, "pack_group").sortWithinPartitions("pack_group", "doc_id", "ids")
    return ordered.select("pack_group", "doc_id", "ids").mapInArrow(task, PACKED)


def unpack(packed: DataFrame) -> DataFrame:
    """``doc_id, position, ids``: the segments of packed rows again, one row each."""
    part = F.posexplode(F.arrays_zip("doc_ids", "position_starts", F.slice(F.col("cu_seqlens"), 2, F.size("doc_ids")).alias("ends"),
                                     F.slice(F.col("cu_seqlens"), 1, F.size("doc_ids")).alias("begins")))
    rows = packed.select("ids", part.alias("i", "p"))
    begin, end = F.col("p.begins") * 4, F.col("p.ends") * 4
    return rows.select(F.col("p.doc_ids").alias("doc_id"), F.col("p.position_starts").alias("position"),
                       F.substr("ids", begin + 1, end - begin).alias("ids"))


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows: ids as one binary per row, with cumulative lengths and position resets beside it."""
    packed.write.mode("overwrite").parquet(path)
