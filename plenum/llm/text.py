"""Words of many texts at once: byte classes, word spans and 64-bit hashes as numpy arrays.

All functions work on one block: the bytes of some whole texts and the offsets at which each text begins. A block
holds at most ``BLOCK`` bytes, or one longer text, so a task needs memory for a block whatever its partition holds.
Lower-casing touches A-Z only. Hashes depend on the bytes alone, never on the process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BLOCK = 1 << 20
#: Rows whose results a task holds at once.
ROWS = 500
#: Rows that Spark hands to a task's Python process in one batch, inside :func:`small_batches`.
BATCH_ROWS = 1_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
# runs of 0-9, A-Z, a-z and every byte of a character beyond ASCII
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_STEP = 0x9E3779B97F4A7C15  # odd, 5 modulo 8: its powers repeat only after 2^62 places
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


RAW_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_STEP))
_fold = np.arange(256)
_fold[65:91] += 32
FOLDED_BYTES = RAW_BYTES[_fold]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return table(_STEP), table(pow(_STEP, -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, ``n`` of each at least."""
    return _powers(max(BLOCK, 1 << (n - 1).bit_length()) if n > 1 else BLOCK)


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash: what :func:`span_hashes` takes differences of."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hashes(run: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values in each span; equal spans have equal hashes wherever they stand."""
    return mix((run[ends] - run[starts]) * powers(len(run))[1][starts])


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes in class ``inside``, and the number of words before each text."""
    held = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = held[:-1]
    starts = np.flatnonzero(held & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = held[1:]
    ends = np.flatnonzero(held & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(first: np.ndarray) -> np.ndarray:
    """Text number of each word, from the number of words before each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, also across texts; the last ones are missing."""
    n = len(words) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        total += words[k : k + n] * _U((_STEP * (2 * k + 1) * (k + 3) | 1) & (2**64 - 1))
    return mix(total)


def flat(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """A list array whose i-th list is ``values[offsets[i]:offsets[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def count_in(data: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Bytes of class ``chosen`` in each text."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(chosen[data], out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_struct(
    df: DataFrame,
    columns: list[str],
    name: str,
    fields: T.StructType,
    work: Callable[..., dict[str, pa.Array]],
) -> DataFrame:
    """``df`` plus a struct column ``name`` that ``work`` makes of whole Arrow columns; no row moves."""
    arrow = [pa.field(f.name, _arrow(f.dataType)) for f in fields]
    places = [df.columns.index(c) for c in columns]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, max(whole.num_rows, 1), ROWS)):
            made = work(*[batch.column(i) for i in places])
            parts = [pa.array(made[f.name], f.type) if not isinstance(made[f.name], pa.Array) else made[f.name].cast(f.type)
                     for f in arrow]
            struct = pa.StructArray.from_arrays(parts, fields=arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, name])
        give_back()

    return df.mapInArrow(task, T.StructType([*df.schema.fields, T.StructField(name, fields)]))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's


def give_back() -> None:
    """Returns what is freed to the system at the end of a task; the process goes on with other tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Jobs started inside pass texts to Python in batches of at most ``rows`` rows.

    Both the executor and its Python processes hold a batch of whole texts, outside of the heap. No result depends on
    it. The session's own setting stays if it is smaller, and comes back at the end.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches_from_now(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """:func:`small_batches` without an end, for frames that are returned: whoever asked for one runs it later."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
              "boolean": pa.bool_(), "binary": pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind])
    return simple[kind.simpleString()]


def parse_schema(text: str) -> T.StructType:
    """Schema from DDL text without a session."""
    names = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(),
             "boolean": T.BooleanType(), "binary": T.BinaryType()}

    def kind(word: str) -> T.DataType:
        if word.startswith("array<"):
            return T.ArrayType(kind(word[6:-1]))
        return names[word]

    return T.StructType([T.StructField(*(lambda n, k: (n, kind(k)))(*part.split())) for part in text.split(",")])
