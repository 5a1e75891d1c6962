"""Quality rules: base counts of each text, and lines that too many documents of one host share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm.text import (
    FOLDED_BYTES, NOT_SPACE, RAW_BYTES, blocks, count_in, flat, fresh, gram_hashes, mix, owners, parse_schema, running,
    span_hashes, with_struct, word_spans,
)
from plenum.session import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line is boilerplate of its host when more than this share of the host's different documents hold it, ...
LINE_PERCENT = 8
#: ... and at least so many.
LINE_DOCS = 10
#: A document is depleted when less than this share of its words is left without such lines.
LEFT_PERCENT = 30

COUNTS = "n_words bigint,word_chars bigint,n_symbols bigint,n_dup_lines bigint,n_repeat_words bigint"
FEATURES = parse_schema(f"{COUNTS},text_key bigint,line_keys array<bigint>,line_words array<int>")
CLEANED = parse_schema(f"{COUNTS},left_words bigint,left_text string")

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CHARACTER_STARTS = np.ones(256, bool)
CHARACTER_STARTS[0x80:0xC0] = False
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


def repeated(groups: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (group, key): whether it occurs twice or more, and whether this is not its first occurrence."""
    order = np.lexsort((keys, groups))
    same = (keys[order][1:] == keys[order][:-1]) & (groups[order][1:] == groups[order][:-1])
    later, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, later


class Block:
    """Counts and lines of the texts of one block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        starts, ends, first = word_spans(data, offsets, NOT_SPACE)
        raw_run = running(RAW_BYTES[data])
        words, doc = span_hashes(raw_run, starts, ends), owners(first)
        self.counts = {"n_words": np.diff(first),
                       "word_chars": count_in(data, offsets, CHARACTER_STARTS & NOT_SPACE),
                       "n_symbols": count_in(data, offsets, SYMBOLS)}

        grams = gram_hashes(words, 3)
        whole = doc[: len(grams)] == doc[2:] if len(grams) else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        twice, _ = repeated(doc[at], grams[at])
        marked = np.zeros(len(words), bool)
        for k in range(3):
            marked[at[twice] + k] = True
        self.counts["n_repeat_words"] = np.bincount(doc[marked], minlength=n)

        # lines: from a text's start or a newline to the next; only those with a word count
        newline = np.flatnonzero(data == 10)
        line_starts = np.unique(np.concatenate([offsets[:-1], newline + 1]))
        line_starts = line_starts[line_starts <= len(data)]
        line_doc = np.searchsorted(offsets[1:], line_starts, "right")
        keep = (line_doc < n)
        line_starts, line_doc = line_starts[keep], line_doc[keep]
        nearest = np.minimum(np.searchsorted(newline, line_starts), max(len(newline) - 1, 0))
        stop = newline[nearest] if len(newline) else np.full(len(line_starts), len(data))
        stop = np.where(stop < line_starts, len(data), stop)
        line_ends = np.minimum(stop, offsets[line_doc + 1])
        word_low, word_high = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
        held = (word_high > word_low) & (line_ends > line_starts)
        line_starts, line_ends, line_doc = line_starts[held], line_ends[held], line_doc[held]
        word_low, word_high = word_low[held], word_high[held]
        _, again = repeated(line_doc, span_hashes(raw_run, line_starts, line_ends))
        self.counts["n_dup_lines"] = np.bincount(line_doc[again], minlength=n)
        folded = span_hashes(running(FOLDED_BYTES[data]), starts, ends)
        self.line_keys = span_hashes(running(folded), word_low, word_high).view(np.int64)
        self.line_words, self.line_starts, self.line_ends, self.line_doc = word_high - word_low, line_starts, line_ends, line_doc
        self.line_cut = np.searchsorted(line_doc, np.arange(n + 1))
        self.text_keys = span_hashes(raw_run, offsets[:-1], offsets[1:])


def features(texts: pa.Array) -> dict[str, pa.Array]:
    """Base counts, a key of the whole text, and key and words of each line with a word."""
    made: dict[str, list] = {f.name: [] for f in FEATURES}
    for _, _, data, offsets in blocks(texts):
        block = Block(data, offsets)
        for name, values in block.counts.items():
            made[name].append(pa.array(values, pa.int64()))
        made["text_key"].append(pa.array(block.text_keys.view(np.int64)))
        made["line_keys"].append(flat(pa.array(block.line_keys), block.line_cut))
        made["line_words"].append(flat(pa.array(block.line_words, pa.int32()), block.line_cut))
    kinds = {"line_keys": pa.list_(pa.int64()), "line_words": pa.list_(pa.int32())}
    return {k: pa.concat_arrays(v) if v else pa.array([], kinds.get(k, pa.int64())) for k, v in made.items()}


def cleaned(texts: pa.Array, frequent: pa.Array) -> dict[str, pa.Array]:
    """Base counts, and each text without the lines whose keys are in its list ``frequent``."""
    made: dict[str, list] = {f.name: [] for f in CLEANED}
    for low, high, data, offsets in blocks(texts):
        block = Block(data, offsets)
        for name, values in block.counts.items():
            made[name].append(pa.array(values, pa.int64()))
        limits = frequent.slice(low, high - low)
        sizes = limits.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        keys, owner = limits.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(np.arange(high - low), sizes)
        salt = mix(np.arange(high - low).astype(np.uint64) + np.uint64(1))
        gone = np.isin(block.line_keys.view(np.uint64) ^ salt[block.line_doc], keys ^ salt[owner])
        lost = np.bincount(block.line_doc[gone], weights=block.line_words[gone], minlength=high - low).astype(np.int64)
        made["left_words"].append(pa.array(block.counts["n_words"] - lost))
        # a line goes with the newline after it
        stay = np.ones(len(data) + 1, np.int8)
        np.add.at(stay, block.line_starts[gone], -1)
        ends = np.minimum(block.line_ends[gone] + 1, offsets[block.line_doc[gone] + 1])
        np.add.at(stay, ends, 1)
        level = np.cumsum(stay - 1)[: len(data)] == 0
        kept = np.zeros(len(data) + 1, np.int64)
        np.cumsum(level, out=kept[1:])
        left = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), high - low, [None, pa.py_buffer(kept[offsets]), pa.py_buffer(data[level].tobytes())])
        made["left_text"].append(left.cast(pa.binary()).cast(pa.string()))
    return {k: pa.concat_arrays(v) if v else pa.array([], pa.string() if k == "left_text" else pa.int64()) for k, v in made.items()}


def frequent_lines(counted: DataFrame, host: str, percent: int, least: int) -> DataFrame:
    """Per host the keys of its boilerplate lines, a stored table.

    Documents are counted once per different text, so that the copies of one document, which a later stage removes,
    don't turn its own lines into boilerplate. (host, line, text) rows are made different before the shuffle and
    again after it, then counted with map-side sums: a host or line with any share of the rows stays spread. A host
    of d documents with m lines each has at most 100 m / ``percent`` such lines (m d / ``least`` when it is small),
    which bounds the list that a row of this table holds.
    """
    sizes = counted.select(host, "text_key").distinct().groupBy(host).agg(F.count(F.lit(1)).alias("docs"))
    lines = counted.select(host, "text_key", F.explode(F.array_distinct("line_keys")).alias("line"))
    met = lines.distinct().groupBy(host, "line").agg(F.count(F.lit(1)).alias("met"))
    often = met.filter(F.col("met") >= least).join(sizes, host).filter(F.col("met") * 100 > F.col("docs") * percent)
    return materialize(often.groupBy(host).agg(F.collect_list("line").alias("frequent")), "frequent-lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def line_features(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """One stored row per row of ``docs``: key, host, counts and lines, without the text."""
    some = docs.select(F.col(key).alias("key"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       F.col(text).alias("text"))
    wide = with_struct(some, ["text"], "f", FEATURES, features)
    return materialize(wide.select("key", "host", "f.*"), "line-features")


def judge_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
    percent: int = LINE_PERCENT, least: int = LINE_DOCS, left_percent: int = LEFT_PERCENT,
) -> DataFrame:
    """Per row of ``docs``: base counts, words left without boilerplate lines, and both verdicts.

    A line is compared by its words, A-Z in lower case. A document is depleted when boilerplate lines take more than
    ``100 - left_percent`` percent of its words. A null text has no words and fails the base rules; a null host is
    the host ''. Repeated rows count once among the documents and each get the verdict.
    """
    stored = line_features(docs, key, text, host)
    often = frequent_lines(stored, "host", percent, least)
    lost = F.aggregate(
        F.arrays_zip("line_keys", "line_words"), F.lit(0).cast("bigint"),
        lambda total, line: total + F.when(F.array_contains("frequent", line["line_keys"]), line["line_words"]).otherwise(0))
    left = F.when(F.col("frequent").isNull(), F.col("n_words")).otherwise(F.col("n_words") - lost)
    # one row per host on the right: broadcast by Spark while small, else a join whose large keys it splits
    judged = stored.join(often, "host", "left").withColumn("left_words", left).withColumn("base_failed", base_failed())
    depleted = F.col("left_words") * 100 < F.col("n_words") * left_percent
    return judged.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"), "left_words")


def keep_good(
    docs: DataFrame, text: str = "text", host: str = "source", length: str | None = "n_chars",
    percent: int = LINE_PERCENT, least: int = LINE_DOCS, left_percent: int = LEFT_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, their boilerplate lines taken out of ``text``.

    ``length``, if the rows have that column, is set to the new number of characters. Rules as in
    :func:`judge_lines`.
    """
    some = docs.select(F.lit(0).alias("key"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       F.col(text).alias("text"))
    stored = materialize(with_struct(some, ["text"], "f", FEATURES, features).select("host", "f.text_key", "f.line_keys"), "lines")
    host_key, lines, name = fresh(docs, "_host"), fresh(docs, "_frequent"), fresh(docs, "_cleaned")
    often = frequent_lines(stored, "host", percent, least).toDF(host_key, lines)
    wide = docs.withColumn(host_key, F.coalesce(F.col(host).cast("string"), F.lit(""))).join(often, host_key, "left")
    done = with_struct(wide, [text, lines], name, CLEANED, cleaned)
    n_words = F.col(f"{name}.n_words")
    good = (
        (n_words >= MIN_WORDS)
        & (F.col(f"{name}.n_repeat_words") * 100 <= n_words * MAX_REPEAT_PERCENT)
        & (F.col(f"{name}.left_words") * 100 >= n_words * left_percent)
    )
    new = F.col(f"{name}.left_text")
    columns = [new.alias(c) if c == text else
               F.length(new).cast(docs.schema[c].dataType).alias(c) if c == length else F.col(f"`{c}`") for c in docs.columns]
    return done.filter(good).select(*columns)
