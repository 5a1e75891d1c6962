"""Fill-in-the-middle: texts cut at token boundaries that a learned rank index finds.

The index of a text maps the rank of a boundary to its place. Straight segments are fitted to all boundaries with an
error of at most ``ERROR``; each boundary keeps one signed byte, by how much the segment misses it. A cut is then
predicted from its rank and corrected exactly, so the places themselves need not be kept.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm.text import blocks, fresh, parse_schema, with_struct

#: Largest distance of a boundary from its segment; it fits one signed byte.
ERROR = 127
#: Bytes of one text whose boundaries are held at once; a longer text is indexed piece by piece.
PIECE = 1 << 22

# Fixed marks of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

MADE = parse_schema(
    "n bigint,form string,output string,prefix_chars bigint,middle_chars bigint,segments bigint")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_FIRST = np.ones(256, bool)  # bytes that begin a character
_FIRST[0x80:0xC0] = False


def token_starts(data: np.ndarray, begins: np.ndarray, in_word: bool = False) -> np.ndarray:
    """Places where a token begins: a run of A-Z and a-z, or any other character.

    ``begins`` are places where a text begins; ``in_word`` tells whether a letter stands before the first byte.
    """
    letter = _LETTER[data]
    before = np.empty(len(data), bool)
    before[:1] = in_word
    before[1:] = letter[:-1]
    before[begins[begins < len(data)]] = False
    return np.flatnonzero(np.where(letter, ~before, _FIRST[data]))


def fit(places: np.ndarray, cuts: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments over ``places``, whose parts between ``cuts`` are sorted: first rank, base and slope of each segment,
    and what each place lies off its segment.

    A segment joins the first and the last place it covers. One that misses a place by more than ``error`` is halved,
    all of one round at once; a segment of two places misses none.
    """
    kept, open_low, open_high = [], cuts[:-1], cuts[1:]
    open_high, open_low = open_high[open_high > open_low], open_low[open_high > open_low]
    off = np.zeros(len(places), np.int8)
    while len(open_low):
        size = open_high - open_low
        base = places[open_low]
        slope = (places[open_high - 1] - base) / np.maximum(size - 1, 1)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        at = np.repeat(open_low, size) + within
        miss = places[at] - predict(np.repeat(base, size), np.repeat(slope, size), within)
        fits = np.maximum.reduceat(np.abs(miss), first) <= error
        kept.append((open_low[fits], base[fits], slope[fits]))
        held = np.repeat(fits, size)
        off[at[held]] = miss[held]
        low, high = open_low[~fits], open_high[~fits]
        middle = (low + high) // 2
        open_low, open_high = np.concatenate([low, middle]), np.concatenate([middle, high])
    if not kept:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), off
    start, base, slope = (np.concatenate(x) for x in zip(*kept))
    order = np.argsort(start)
    return start[order], base[order], slope[order], off


def predict(base, slope, steps):
    """Place that a segment gives for a rank ``steps`` after its first; fitting and lookup must round alike."""
    return base + np.floor(slope * steps + 0.5).astype(np.int64)


class RankIndex:
    """Boundaries of one text by rank: boundary k lies before token k, boundary n at the end of the text."""

    def __init__(self, start: np.ndarray, base: np.ndarray, slope: np.ndarray, off: np.ndarray):
        self.start, self.base, self.slope, self.off = start.tolist(), base, slope, off

    @property
    def n(self) -> int:
        return len(self.off) - 1

    def place(self, rank: int) -> int:
        """Byte offset of boundary ``rank``: the segment's prediction, corrected by the stored residual."""
        i = bisect_right(self.start, rank) - 1
        return int(predict(self.base[i], self.slope[i], rank - self.start[i])) + int(self.off[rank])


def index_text(data: np.ndarray, piece: int = PIECE) -> RankIndex:
    """Index of one text, its bytes read ``piece`` at a time."""
    parts, count = [], 0
    for at in range(0, max(len(data), 1), piece):
        part = data[at : at + piece]
        begins = np.zeros(1 if at == 0 else 0, np.int64)
        places = token_starts(part, begins, at > 0 and bool(_LETTER[data[at - 1]])) + at
        if at + piece >= len(data):
            places = np.append(places, len(data))
        start, base, slope, off = fit(places, np.array([0, len(places)]))
        parts.append((start + count, base, slope, off))
        count += len(places)
    return RankIndex(*(np.concatenate(x) for x in zip(*parts)))


def index_texts(data: np.ndarray, offsets: np.ndarray) -> Iterator[RankIndex]:
    """Indexes of the texts of one block, fitted together."""
    if len(offsets) == 2 and len(data) > PIECE:
        yield index_text(data)
        return
    starts = token_starts(data, offsets[:-1])
    first = np.searchsorted(starts, offsets)  # tokens before each text
    n = np.diff(first)
    cuts = first + np.arange(len(offsets))  # each text has one boundary more than tokens
    places = np.empty(len(starts) + len(n), np.int64)
    ends = cuts[1:] - 1
    inner = np.ones(len(places), bool)
    inner[ends] = False
    places[inner] = starts
    places[ends] = offsets[1:]
    places -= np.repeat(offsets[:-1], n + 1)
    start, base, slope, off = fit(places, cuts)
    segment = np.searchsorted(start, cuts)
    for i in range(len(n)):
        a, b = segment[i], segment[i + 1]
        yield RankIndex(start[a:b] - cuts[i], base[a:b], slope[a:b], off[cuts[i] : cuts[i + 1]])


def draws(key: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 that depend on the seed and the key only; a null key counts as no digits."""
    digits = sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digits[i : i + 8], 16) for i in range(0, 32, 8))


def assemble(data: bytes, index: RankIndex, low: int, high: int, form: str) -> tuple[bytes, bytes, bytes]:
    """(output, prefix, middle) of a text cut at the boundaries ``low`` and ``high``."""
    a, b = index.place(low), index.place(high)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = MARKS
    if form == "psm":
        return b"".join((p, prefix, s, suffix, m, middle)), prefix, middle
    return b"".join((s, suffix, p, prefix, m, middle)), prefix, middle


def restored(output: Column, form: Column) -> Column:
    """The text that was cut. No text that is cut holds a mark, so the first of each kind is the one put in."""
    halves = F.split(output, MIDDLE, 2)
    outer, middle = F.element_at(halves, 1), F.try_element_at(halves, F.lit(2))
    psm = F.split(F.substring(outer, len(PREFIX) + 1, 1 << 30), SUFFIX, 2)
    spm = F.split(F.substring(outer, len(SUFFIX) + 1, 1 << 30), PREFIX, 2)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(F.element_at(psm, 1), middle, F.try_element_at(psm, F.lit(2))))
        .otherwise(F.concat(F.try_element_at(spm, F.lit(2)), middle, F.element_at(spm, 1)))
    )


def _characters(text: bytes) -> int:
    return int(np.count_nonzero(_FIRST[np.frombuffer(text, np.uint8)]))


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90, spm_percent: int = 20,
    name: str = "fim",
) -> DataFrame:
    """``docs`` plus a struct ``name`` (or a free name like it): ``n`` tokens, ``form``, ``output``, code points of
    ``prefix_chars`` and ``middle_chars`` (null if plain), and the number of ``segments`` of the text's index.

    Tokens are runs of A-Z and a-z and single other characters. ``percent`` of the texts are cut at two boundaries
    drawn from a hash of seed and key, ``spm_percent`` of these with the suffix first. Empty texts and texts that hold
    a mark stay plain. A null text counts as empty, a null key as one without digits. Equal rows get equal results;
    rows that share a key are drawn alike, each for its own number of tokens. Other columns pass through.

    Rows stay where they are. A text longer than ``PIECE`` is indexed piece by piece, so beyond the text itself a task
    holds one byte per boundary.
    """

    def work(texts: pa.Array, keys: pa.Array) -> dict[str, pa.Array]:
        made: dict[str, list] = {f.name: [] for f in MADE}
        ids = keys.to_pylist()
        for low, high, data, offsets in blocks(texts):
            spots = offsets.tolist()
            for i, index in enumerate(index_texts(data, offsets)):
                content = data[spots[i] : spots[i + 1]].tobytes()
                n = index.n
                h1, h2, h3, h4 = draws(ids[low + i], seed)
                form, output, before, middle = "plain", content, None, None
                if content and h3 % 100 < percent and not any(m in content for m in MARKS):
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    cut = sorted((h1 % (n + 1), h2 % (n + 1)))
                    output, first, second = assemble(content, index, *cut, form)
                    before, middle = _characters(first), _characters(second)
                row = (n, form, output.decode(), before, middle, len(index.start))
                for values, value in zip(made.values(), row):
                    values.append(value)
        return {f.name: pa.array(made[f.name], pa.string() if f.name in ("form", "output") else pa.int64()) for f in MADE}

    return with_struct(docs, [text, key], fresh(docs, name), MADE, work)


def digest(made: DataFrame, name: str = "fim", key: str = "doc_id") -> DataFrame:
    """Per row of :func:`transform`'s result its numbers, and the hashes of the output and of the text restored from it."""
    part = made[name]
    return made.select(
        made[key].cast("bigint").alias("doc_id"), part["n"].alias("n"), part["form"].alias("form"),
        part["prefix_chars"].alias("prefix_chars"), part["middle_chars"].alias("middle_chars"),
        F.sha2(part["output"], 256).alias("output_sha256"),
        F.sha2(restored(part["output"], part["form"]), 256).alias("restored_sha256"),
    )
