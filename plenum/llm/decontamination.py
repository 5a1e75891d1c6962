"""Benchmark decontamination with suffix arrays over shards of the training texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.text import (
    FOLDED_BYTES, LETTERS, blocks, flat, fresh, owners, parse_schema, running, span_hashes, with_struct, word_spans,
)

WINDOW = 10
#: Bytes of test text that one block of test suffixes may hold in a task.
TEST_BLOCK = 8 << 20

FIELDS = parse_schema("n_words bigint,hit_starts array<int>,hit_lengths array<int>,items array<string>,"
                      "match_items array<string>,match_starts array<int>,match_lengths array<int>")


@dataclass
class TestSuffixes:
    """The suffixes of a block of test items: every window, with the items it occurs in."""

    vocabulary: np.ndarray  # sorted word hashes; word i has id i + 1
    windows: np.ndarray  # one row of word ids for each different window, 0 beyond its end
    lengths: np.ndarray
    uses: np.ndarray  # (window, item, place in its text, text), by window
    first_use: np.ndarray
    items: list[str]


def words_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, word hashes, words before each text) block by block."""
    for low, high, data, offsets in blocks(texts):
        starts, ends, first = word_spans(data, offsets, LETTERS)
        yield low, high, span_hashes(running(FOLDED_BYTES[data]), starts, ends), first


def test_suffixes(items: list[str], texts: pa.Array, window: int) -> TestSuffixes | None:
    """All suffixes of the items cut to ``window`` words, or None when no item has a word."""
    rows, uses, lengths = [], [], []
    names = list(dict.fromkeys(items))  # several texts of one id are one item
    number = {name: k for k, name in enumerate(names)}
    for low, _, hashes, first in words_of(texts):
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            size = min(window, b - a)
            if size:
                places = np.arange(b - a - size + 1)
                grid = np.zeros((len(places), window), np.uint64)
                grid[:, :size] = hashes[a + places[:, None] + np.arange(size)]
                rows.append(grid)
                lengths.append(np.full(len(places), size))
                uses.append(np.stack([np.full(len(places), number[items[low + i]]), places, np.full(len(places), low + i)], axis=1))
    if not rows:
        return None
    grid, sizes, used = np.concatenate(rows), np.concatenate(lengths), np.concatenate(uses)
    held = np.arange(window) < sizes[:, None]
    vocabulary = np.unique(grid[held])
    ids = np.where(held, np.searchsorted(vocabulary, grid) + 1, 0).astype(np.int32)
    windows, which = np.unique(ids, axis=0, return_inverse=True)
    which = which.reshape(-1)
    order = np.argsort(which, kind="stable")
    first_use = np.searchsorted(which[order], np.arange(len(windows) + 1))
    uses_by_window = np.column_stack([which, used])[order]
    return TestSuffixes(vocabulary, windows, (windows > 0).sum(axis=1), uses_by_window, first_use, names)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``ids`` in the order of their suffixes' first ``depth`` ids, by prefix doubling; 0 ends a suffix."""
    ranks, known = ids.astype(np.int64), 1
    while known < depth:
        then = np.zeros_like(ranks)
        then[:-known] = ranks[known:]
        then[ranks == 0] = 0
        both = ranks * (int(ranks.max()) + 1) + then
        both[ids == 0] = 0
        values, ranks = np.unique(both, return_inverse=True)
        ranks = ranks.reshape(-1) + (values[0] != 0)
        known *= 2
    order = np.argsort(ranks, kind="stable")
    return order[ids[order] > 0]


def search(ids: np.ndarray, places: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """For every test window the range of the suffix array that begins with it: two binary searches at once."""
    width = tests.windows.shape[1]
    padded = np.concatenate([ids, np.zeros(width, ids.dtype)])
    held = np.arange(width) < tests.lengths[:, None]

    def bound(past_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(tests.windows), np.int64), np.full(len(tests.windows), len(places), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            found = padded[places[np.minimum(middle, len(places) - 1)][:, None] + np.arange(width)]
            differs = (found != tests.windows) & held
            at = differs.argmax(axis=1)
            row = np.arange(len(at))
            less = differs[row, at] & (found[row, at] < tests.windows[row, at])
            if past_equal:
                less |= ~differs[row, at]
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low

    return bound(False), bound(True)


def occurrences(hashes: np.ndarray, first: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """(window, word place) of every occurrence of a test window in one shard.

    Only stretches of words that all occur in some test, and that are long enough for the shortest window, can hold
    one; the suffix array is built over those stretches.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    known = tests.vocabulary[at] == hashes
    edge = np.zeros(len(hashes) + 1, bool)
    edge[first] = True
    before = np.concatenate([[False], known[:-1]])
    starts = np.flatnonzero(known & (~before | edge[:-1]))
    after = np.concatenate([known[1:], [False]])
    ends = np.flatnonzero(known & (~after | edge[1:])) + 1
    long_enough = ends - starts >= tests.lengths.min()
    starts, ends = starts[long_enough], ends[long_enough]
    if not len(starts):
        return none
    sizes = ends - starts + 1  # each stretch ends with a 0
    begin = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(begin - starts, sizes)
    last = begin + sizes - 1
    place[last] = 0
    ids = at[place].astype(np.int32) + 1
    ids[last] = 0
    order = suffix_array(ids, tests.windows.shape[1])
    low, high = search(ids, order, tests)
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return window, place[order[np.repeat(low, count) + inside]]


def mark(texts: pa.Array, tests: TestSuffixes) -> dict[str, pa.Array]:
    """Per text: its words, the stretches hit, the items met and the longest verbatim matches with their places."""
    made: dict[str, list] = {f.name: [] for f in FIELDS}
    for _, _, hashes, first in words_of(texts):
        n = len(first) - 1
        window, place = occurrences(hashes, first, tests)
        step = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(step, place, 1)
        np.add.at(step, place + tests.lengths[window], -1)
        hit = np.cumsum(step[:-1]) > 0
        edge = np.zeros(len(hashes) + 1, bool)
        edge[first] = True
        begins = np.flatnonzero(hit & (~np.concatenate([[False], hit[:-1]]) | edge[:-1]))[:]
        ends = np.flatnonzero(hit & (~np.concatenate([hit[1:], [False]]) | edge[1:])) + 1
        cut = np.searchsorted(begins, first)

        # every use of each window met: (item, place in item, place in shard)
        uses = tests.first_use[window + 1] - tests.first_use[window]
        use = np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses) + np.repeat(tests.first_use[window], uses)
        item, in_item, source = tests.uses[use, 1], tests.uses[use, 2], tests.uses[use, 3]
        at, size = np.repeat(place, uses), np.repeat(tests.lengths[window], uses)
        doc = np.searchsorted(first, at, "right") - 1
        pairs = np.unique(np.column_stack([doc, item]), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
        named = np.array([tests.items[i] for i in pairs[:, 1]], dtype=object)
        order = sorted(range(len(named)), key=lambda i: (pairs[i, 0], named[i]))
        item_cut = np.searchsorted(pairs[:, 0], np.arange(n + 1))

        # windows that follow one another in text and item are one longer match
        shift = at - in_item
        order2 = np.lexsort((at, shift, source, item, doc))
        doc2, item2, shift2, at2, size2 = doc[order2], item[order2], shift[order2], at[order2], size[order2]
        source2 = source[order2]
        new = np.ones(len(at2), bool)
        new[1:] = (doc2[1:] != doc2[:-1]) | (source2[1:] != source2[:-1]) | (shift2[1:] != shift2[:-1]) | (at2[1:] != at2[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(at2)]]) - 1 if len(head) else head
        match_cut = np.searchsorted(doc2[head], np.arange(n + 1))

        made["n_words"].append(pa.array(np.diff(first)))
        made["hit_starts"].append(flat(pa.array(begins - first[np.searchsorted(first, begins, "right") - 1], pa.int32()), cut))
        made["hit_lengths"].append(flat(pa.array(ends - begins, pa.int32()), cut))
        made["items"].append(flat(pa.array(named[order].tolist(), pa.string()), item_cut))
        made["match_items"].append(flat(pa.array([tests.items[i] for i in item2[head]], pa.string()), match_cut))
        made["match_starts"].append(flat(pa.array(at2[head] - first[doc2[head]], pa.int32()), match_cut))
        made["match_lengths"].append(flat(pa.array(at2[tail] - at2[head] + size2[tail], pa.int32()), match_cut))
    return {k: pa.concat_arrays(v) if v else pa.array([], _kind(k)) for k, v in made.items()}


def _kind(name: str) -> pa.DataType:
    return pa.int64() if name == "n_words" else pa.list_(pa.string() if name.endswith("items") else pa.int32())


def test_blocks(benchmark: DataFrame, item: str, text: str, window: int, limit: int = TEST_BLOCK) -> Iterator[TestSuffixes]:
    """The test items in blocks of about ``limit`` bytes; the driver holds one block while it is prepared."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).filter(
        F.col("item").isNotNull() & F.col("text").isNotNull()).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // limit) or 1
    for part in range(parts):
        block = rows.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).toArrow()
        tests = test_suffixes(block["item"].to_pylist(), block["text"].combine_chunks(), window)
        if tests is not None:
            yield tests


def find_matches(
    docs: DataFrame, benchmark: DataFrame, name: str, text: str = "text", item: str = "item_id",
    test_text: str = "text", window: int = WINDOW, test_block: int = TEST_BLOCK,
) -> DataFrame:
    """``docs`` plus a struct ``name`` with every verbatim match of at least ``window`` test words.

    A shard is a block of whole texts; each task sorts the suffixes of its shards and looks up every test suffix by
    binary search, so texts are never shuffled. An item of fewer words, but not none, matches as a whole. The struct
    holds ``n_words``, the stretches of words hit (``hit_starts``, ``hit_lengths``), the ``items`` met (sorted text)
    and the longest matches with their places (``match_items``, ``match_starts``, ``match_lengths``, one entry per
    item and stretch). A null or empty text has no words and no match; null items and null test texts match
    nothing; items that repeat an id count once. Repeated rows each get the same result; other columns pass through.

    The test set is read in blocks of ``test_block`` bytes, each one more pass in the same task over the text: that
    bounds the memory of a task, not the number of passes, so a test set should be small beside the texts.
    """
    found, parts = docs, []
    for tests in test_blocks(benchmark, item, test_text, window, test_block):
        shared = docs.sparkSession.sparkContext.broadcast(tests)  # at most test_block bytes of text
        parts.append(fresh(found, "_matches"))
        found = with_struct(found, [text], parts[-1], FIELDS, lambda texts, b=shared: mark(texts, b.value))
    if not parts:
        nothing = test_suffixes_none()
        parts.append(fresh(found, "_matches"))
        found = with_struct(found, [text], parts[-1], FIELDS, lambda texts, t=nothing: mark(texts, t))
    if len(parts) == 1:
        return found.withColumnRenamed(parts[0], name)
    joined = {f.name: F.concat(*[F.col(f"{p}.{f.name}") for p in parts]) for f in FIELDS if f.name != "n_words"}
    joined["items"] = F.array_sort(F.array_distinct(joined["items"]))
    struct = F.struct(F.col(f"{parts[0]}.n_words").alias("n_words"), *[v.alias(k) for k, v in joined.items()])
    return found.withColumn(name, struct).drop(*parts)


def test_suffixes_none() -> TestSuffixes:
    """What an empty benchmark gives: one window that no text can hold."""
    empty = np.zeros((0, 4), np.int64)
    return TestSuffixes(np.array([0], np.uint64), np.ones((1, 1), np.int32), np.array([1 << 40]), empty,
                        np.zeros(2, np.int64), [])


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Per row of ``docs``: words, words hit, items met, and whether it is contaminated at all."""
    found = find_matches(docs.select(key, options.get("text", "text")), benchmark, "_found", **options)
    # stretches of several test blocks may overlap, so hit words are counted once
    stretch = F.arrays_zip("_found.hit_starts", "_found.hit_lengths")
    ends = F.aggregate(
        F.array_sort(stretch), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["hit_starts"] + s["hit_lengths"] - F.greatest(a["upto"], s["hit_starts"]))).alias("n"),
            F.greatest(a["upto"], s["hit_starts"] + s["hit_lengths"]).cast("bigint").alias("upto")),
        lambda a: a["n"])
    return found.select(
        key, F.col("_found.n_words").alias("n_words"), ends.alias("n_hit"),
        F.size("_found.items").cast("bigint").alias("n_items"), F.col("_found.items").alias("items"),
        F.coalesce(F.array_max("_found.match_lengths"), F.lit(0)).cast("bigint").alias("longest_match"),
        (F.size("_found.hit_starts") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no test window occurs."""
    name = fresh(docs, "_contamination")
    found = find_matches(docs, benchmark, name, **options)
    return found.filter(F.size(F.col(f"{name}.hit_starts")) == 0).drop(name)
