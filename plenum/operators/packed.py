"""Edges packed into few bytes, so that a task can hold a large component and many tasks can be sent the same one."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Edges of one packed row, about.
CHUNK_EDGES = 1_000_000
# So few different weights are put in order before the ends.
FEW_WEIGHTS = 32
# Unsigned whole numbers by their size in bytes: 1, 2, 4, 8.
KINDS = (np.uint8, np.uint16, np.uint32, np.uint64)


def squeeze(x: np.ndarray) -> bytes:
    """Whole numbers of 64 bits as bytes: their differences, the same byte of all of them together, compressed."""
    steps = np.diff(x, prepend=x[:1] * 0)
    steps = ((steps << 1) ^ (steps >> 63)).view(np.uint64)
    kind = next(k for k in KINDS if not len(x) or steps.max() <= np.iinfo(k).max)
    planes = np.ascontiguousarray(steps.astype(kind).view(np.uint8).reshape(len(x), np.dtype(kind).itemsize).T)
    return len(x).to_bytes(8, "little") + bytes([planes.shape[0]]) + zlib.compress(planes.tobytes(), 1)


def expand(data: bytes) -> np.ndarray:
    """The numbers that :func:`squeeze` was given."""
    n, size = int.from_bytes(data[:8], "little"), data[8]
    planes = np.frombuffer(zlib.decompress(data[9:]), np.uint8).reshape(size, n)
    steps = np.ascontiguousarray(planes.T).view(KINDS[size.bit_length() - 1]).reshape(n).astype(np.uint64)
    return np.cumsum((steps >> np.uint64(1)).view(np.int64) ^ -(steps & np.uint64(1)).view(np.int64))


def pack(rows: pd.DataFrame) -> bytes:
    """Edges ``u, v, w``, whole numbers, as bytes; their order is lost."""
    ends = rows[["u", "v"]].to_numpy(np.int64)
    w = rows["w"].to_numpy(np.int64)
    ids, place = np.unique(ends, return_inverse=True)
    u, v = place.reshape(ends.shape).T
    keys = (v, u, w) if len(np.unique(w)) <= FEW_WEIGHTS else (w, v, u)
    order = np.lexsort(keys)
    parts = [squeeze(x) for x in (ids, w[order], u[order], v[order])]
    return b"".join([*(len(x).to_bytes(8, "little") for x in parts), *parts])


def _pieces(data: bytes) -> list[bytes]:
    """Of packed edges: the vertices in order, the weights, the places of both ends among the vertices."""
    found, at = [], 32
    for i in range(4):
        size = int.from_bytes(data[8 * i:8 * i + 8], "little")
        found.append(data[at:at + size])
        at += size
    return found


def owners(starts: np.ndarray, a: int, b: int) -> np.ndarray:
    """The vertices of the edges from ``a`` to ``b``, where those of vertex i lie from ``starts[i]`` to ``starts[i + 1]``."""
    first, last = int(np.searchsorted(starts, a, "right")) - 1, int(np.searchsorted(starts, b, "left"))
    return np.repeat(np.arange(first, last), np.diff(np.clip(starts[first:last + 1], a, b)))


class Packed:
    """Packed rows as one network: ``ids`` of its vertices in order, its different ``weights``, and ``many`` edges."""

    def __init__(self, rows: Iterable[bytes]):
        self.rows, self.many = list(rows), 0
        self.ids = self.weights = np.array([], np.int64)
        for row in self.rows:
            ids, w, _, _ = _pieces(row)
            w = expand(w)
            self.ids, self.weights = np.union1d(self.ids, expand(ids)), np.union1d(self.weights, w)
            self.many += len(w)

    def edges(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of both ends among ``ids``, and that of the weight among ``weights``, of each packed row in turn."""
        for row in self.rows:
            ids, w, u, v = map(expand, _pieces(row))
            place = np.searchsorted(self.ids, ids)
            yield place[u], place[v], np.searchsorted(self.weights, w)

    def both_ways(self, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``starts, ends, codes``: the edges of vertex i, at both of its ends, lie from ``starts[i]`` to
        ``starts[i + 1]`` in the order of weight and other end. Self-loops are left out; ``place`` renumbers vertices.

        One number holds an edge while edges are put in order, if it can.
        """
        n, size, at = len(self.ids), 2 * self.many, 0
        end_bits, code_bits = max(1, (n - 1).bit_length()), (len(self.weights) - 1).bit_length()
        degree = np.zeros(n, np.int64)
        fits = 2 * end_bits + code_bits < 63
        keys = np.empty(size if fits else (3, size), np.int64)
        for u, v, code in self.edges():
            if place is not None:
                u, v = place[u], place[v]
            if len(step := np.flatnonzero(u != v)) < len(u):
                u, v, code = u[step], v[step], code[step]
            for one, two in ((u, v), (v, u)):
                degree += np.bincount(one, minlength=n)
                if fits:
                    keys[at:at + len(one)] = ((one << code_bits | code) << end_bits) | two
                else:
                    keys[:, at:at + len(one)] = two, code, one
                at += len(one)
        starts = np.append(0, np.cumsum(degree))
        if not fits:
            order = np.lexsort(keys[:, :at])
            return starts, keys[0][order], keys[1][order]
        keys = keys[:at]
        keys.sort()
        codes = np.empty(at, np.min_scalar_type(max(1, len(self.weights))))
        for a in range(0, at, CHUNK_EDGES):
            some = keys[a:a + CHUNK_EDGES]
            codes[a:a + CHUNK_EDGES] = some >> end_bits & (1 << code_bits) - 1
            some &= (1 << end_bits) - 1
        return starts, keys, codes


def chunk(edges: Column) -> Column:
    """Number of the packed row that an edge ``u, v`` of a part of so many ``edges`` goes to: with most others at ``u``.

    Those of a vertex with very many are spread over as many rows as bound what one holds.
    """
    spread = F.pmod(F.xxhash64("v"), F.ceil(edges / (4 * CHUNK_EDGES)))
    return F.pmod(F.xxhash64("u", spread), F.ceil(edges / CHUNK_EDGES)).cast("int")


def packed(rows: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """``edges``, a packed row for each value of ``keys`` and ``chunk``, from rows of these with edges ``u, v, w``."""
    by = [*keys, "chunk"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by) + ", edges binary"

    def made(some: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({**{c: some[c].iloc[:1] for c in by}, "edges": [pack(some)]})

    return rows.select(*by, "u", "v", "w").repartition(max(1, min(tasks, 20_000)), *by).groupBy(*by).applyInPandas(made, schema)
