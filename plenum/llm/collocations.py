"""Phrase collocations per language, grown from prefixes best first, with bounds that cut off what can't be among the best.

A phrase of two to five words scores ``floor(factor * a * n / (l * r))`` at its weakest cut, where ``a`` counts the
phrase, ``l`` and ``r`` its parts and ``n`` all words. Since ``r >= a``, no phrase that grows from a prefix scores more
than ``factor * n / l`` of that prefix, and the tightest of these bounds comes from its first word. So phrases are
grown from the rarest first words on. When a language has its best phrases, a first word whose bound lies below the
last of them is never grown; one whose bound equals it still is, because of ties.

A round reads the texts three times: pairs of words, longer phrases whose first pair is frequent, and then the parts
and neighbours of what has been found. Words and phrases are counted as what they are, text by text; sets of them
reach the tasks as bit sieves of bounded size, which let some more be counted but never change a count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plenum.llm.text import RAW_BYTES, blocks, gram_hashes, mix, running, span_hashes, word_spans
from plenum.session import discard, materialize

SHORTEST, LONGEST = 2, 5
#: Bytes of text whose phrases are counted at once.
BLOCK = 1 << 22
#: Bits per member of a sieve, and bits of the largest one: 32 MB for every task, whatever the corpus.
BITS_EACH, MOST_BITS = 16, 1 << 28
PROBES = 4
#: Parts of all occurrences of frequent words that the first words of the first rounds may hold; a language that has its
#: best phrases takes what its bound asks for instead.
SHARES = (0.125, 0.5)
#: Languages still being searched are looked up by every task up to this many; more are not told apart.
FEW_LANGUAGES = 10_000
NO_LANGUAGE = "und"

# Fixed characters: those between words, and those that also end a piece.
GAPS, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_WORD = np.ones(256, bool)
_WORD[list(GAPS + BREAKS)] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

_U = np.uint64
COUNTED = "lang string, phrase string, f bigint"
CENSUS = "lang string, phrase string, f bigint, before string, after string"


@dataclass
class Words:
    """Words of one block: numbers into a dictionary of different words, the piece of each, and its language."""

    ids: np.ndarray
    book: pa.StringArray
    piece: np.ndarray
    lang: np.ndarray
    hashes: np.ndarray

    def same_piece(self, size: int) -> np.ndarray:
        """Places where ``size`` words of one piece begin."""
        last = len(self.ids) - size + 1
        return np.flatnonzero(self.piece[: max(last, 0)] == self.piece[size - 1 :])

    def phrases(self, at: np.ndarray, size: int) -> np.ndarray:
        """Number of the phrase at each place; equal numbers are equal words of one language, without hashing."""
        number = self.lang[at]
        for k in range(size):
            number = np.unique(number * len(self.book) + self.ids[at + k], return_inverse=True)[1]
        return number

    def text(self, at: np.ndarray, size: int) -> pa.StringArray:
        parts = [self.book.take(pa.array(self.ids[at + k])) for k in range(size)]
        return pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]


def split_long(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A block of one text longer than ``limit`` in parts that end between pieces, which no phrase crosses; others whole.

    Only a single piece can still be longer than ``limit``.
    """
    if len(offsets) != 2 or len(data) <= limit:
        yield data, offsets
        return
    ends = np.flatnonzero(_BREAK[data]) + 1
    low = 0
    while low < len(data):
        place = np.searchsorted(ends, low + limit, "right") - 1
        high = int(ends[place]) if place >= 0 and ends[place] > low else 0
        if not high:
            place = np.searchsorted(ends, low, "right")
            high = int(ends[place]) if place < len(ends) else len(data)
        yield data[low:high], np.array([0, high - low])
        low = high


def words_of(data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, lang_hashes: np.ndarray) -> Words:
    """Words of one block; ``lang`` is the number of each text's language."""
    data = _FOLD[data]
    starts, ends, first = word_spans(data, offsets, _WORD)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sizes = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=sizes[1:])
    held = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(data[_WORD[data]])]).dictionary_encode()
    ids = held.indices.to_numpy().astype(np.int64)
    piece = np.cumsum(_BREAK[data])[starts] + owner if len(starts) else owner
    book = held.dictionary
    _, places, content = book.buffers()
    cuts = np.frombuffer(places, np.int32)[: len(book) + 1].astype(np.int64) if len(book) else np.zeros(1, np.int64)
    run = running(RAW_BYTES[np.frombuffer(content, np.uint8)[: cuts[-1]]]) if len(book) else np.zeros(1, np.uint64)
    own = span_hashes(run, cuts[:-1], cuts[1:])
    langs = lang[owner]
    return Words(ids, book.cast(pa.string()), piece, langs, mix(own[ids] ^ lang_hashes[langs]) if len(ids) else own)


def read_words(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[Words, list[str]]]:
    """Words of the texts of a batch ``lang, text``, block by block, and the names of the languages."""
    named = batch.column(0).fill_null(NO_LANGUAGE).dictionary_encode()
    names = named.dictionary.to_pylist()
    seeds = np.array([int.from_bytes(blake2b(n.encode(), digest_size=8).digest(), "little") for n in names], np.uint64)
    numbers = named.indices.to_numpy().astype(np.int64)
    for low, high, data, offsets in blocks(batch.column(1), limit):
        for part, cuts in split_long(data, offsets, limit):
            yield words_of(part, cuts, numbers[low:high], seeds), names


class Sieve:
    """A set of words or phrases as bits: says yes to every member, and seldom to anything else."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.mask = _U(len(bits) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in probes(hashes, self.mask):
            found &= (self.bits[place >> _U(6)] >> (place & _U(63))) & _U(1) > 0
        return found


def probes(hashes: np.ndarray, mask: np.uint64) -> Iterator[np.ndarray]:
    step = mix(hashes) | _U(1)
    for i in range(PROBES):
        yield (hashes + _U(i) * step) & mask


def sieve_of(members: DataFrame, most_bits: int = MOST_BITS) -> bytes:
    """Bits of a :class:`Sieve` for the rows ``lang, phrase``: set by the tasks, joined by word of 64 bits."""
    count = members.count()
    size = min(most_bits, 1 << max(12, (count * BITS_EACH - 1).bit_length()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = _U(size - 1)
        for batch in batches:
            for words, _ in read_words(batch, BLOCK):
                # each row is one piece of as many words as its phrase has
                first = np.flatnonzero(np.diff(words.piece, prepend=-1))
                length = np.diff(np.append(first, len(words.piece)))
                made = []
                for n in np.unique(length).tolist():
                    hashes = gram_hashes(words.hashes, n)[first[length == n]]
                    made += [place for place in probes(hashes, mask)]
                place = np.unique(np.concatenate(made)) if made else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((place >> _U(6)).astype(np.int64)), pa.array((_U(1) << (place & _U(63))).view(np.int64))],
                    ["word", "bits"])

    made = members.select("lang", "phrase").mapInArrow(task, "word bigint, bits bigint")
    rows = made.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # as many as the sieve has words of 64 bits at most
    bits = np.zeros(size >> 6, np.int64)
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return bits.tobytes()


def counted(docs: DataFrame, schema: str, work: Callable[[Words, list[str]], Iterator[list[pa.Array]]], limit: int) -> DataFrame:
    """Rows that ``work`` makes of each block of words of ``docs`` (``lang, text``)."""
    names = [field.split()[0] for field in schema.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, languages in read_words(batch, limit):
                for columns in work(words, languages):
                    yield pa.RecordBatch.from_arrays(columns, names)
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(task, schema)


def tally(words: Words, languages: list[str], at: np.ndarray, size: int) -> list[pa.Array]:
    """``lang, phrase, f`` of the phrases of ``size`` words at the given places."""
    _, some, many = np.unique(words.phrases(at, size), return_index=True, return_counts=True)
    where = at[some]
    return [pa.array(languages, pa.string()).take(pa.array(words.lang[where])), words.text(where, size), pa.array(many, pa.int64())]


def _total(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def word_counts(docs: DataFrame, least: int, limit: int = BLOCK) -> DataFrame:
    """``lang, phrase, f`` of the words met ``least`` times, and a row with a null phrase for all words of a language."""

    def work(words: Words, languages: list[str]) -> Iterator[list[pa.Array]]:
        yield tally(words, languages, np.arange(len(words.ids)), 1)
        found, many = np.unique(words.lang, return_counts=True)
        yield [pa.array(languages, pa.string()).take(pa.array(found)), pa.nulls(len(found), pa.string()), pa.array(many, pa.int64())]

    return materialize(_total(counted(docs, COUNTED, work, limit)).filter((F.col("f") >= least) | F.col("phrase").isNull()), "words")


def pair_counts(docs: DataFrame, first: bytes, frequent: bytes, least: int, limit: int = BLOCK) -> DataFrame:
    """Pairs met ``least`` times, of a word of the sieve ``first`` and one of ``frequent``."""
    sent = docs.sparkSession.sparkContext.broadcast((first, frequent))

    def work(words: Words, languages: list[str]) -> Iterator[list[pa.Array]]:
        begins, goes_on = (Sieve(np.frombuffer(b, np.uint64)).holds(gram_hashes(words.hashes, 1)) for b in sent.value)
        at = words.same_piece(2)
        yield tally(words, languages, at[begins[at] & goes_on[at + 1]], 2)

    return materialize(_total(counted(docs, COUNTED, work, limit)).filter(F.col("f") >= least), "pairs")


def longer_counts(docs: DataFrame, pairs: bytes, frequent: bytes, least: int, limit: int = BLOCK) -> DataFrame:
    """Phrases of three to ``LONGEST`` words met ``least`` times whose first pair is in the sieve ``pairs``."""
    sent = docs.sparkSession.sparkContext.broadcast((pairs, frequent))

    def work(words: Words, languages: list[str]) -> Iterator[list[pa.Array]]:
        begins, goes_on = (Sieve(np.frombuffer(b, np.uint64)) for b in sent.value)
        common = goes_on.holds(gram_hashes(words.hashes, 1))
        at = words.same_piece(3)
        at = at[common[at + 2]]
        at = at[begins.holds(gram_hashes(words.hashes, 2)[at])]
        for size in range(3, LONGEST + 1):
            yield tally(words, languages, at, size)
            at = at[at + size < len(words.ids)]
            at = at[(words.piece[at + size] == words.piece[at]) & common[at + size]]

    return materialize(_total(counted(docs, COUNTED, work, limit)).filter(F.col("f") >= least), "longer")


def census(docs: DataFrame, wanted: DataFrame, limit: int = BLOCK) -> DataFrame:
    """``lang, phrase, f, held`` of the phrases ``wanted`` (``lang, phrase``, each once).

    ``held``: all its occurrences have the same word before them in their piece, or all the same word after them. Then
    the phrase with that word added occurs as often.
    """
    sent = docs.sparkSession.sparkContext.broadcast(sieve_of(wanted))

    def work(words: Words, languages: list[str]) -> Iterator[list[pa.Array]]:
        sieve = Sieve(np.frombuffer(sent.value, np.uint64))
        n = len(words.ids)
        joined = np.zeros(n + 1, bool)  # whether a word and the one before it share a piece
        joined[1:n] = words.piece[1:] == words.piece[:-1]
        for size in range(SHORTEST, LONGEST + 1):
            at = words.same_piece(size)
            at = at[sieve.holds(gram_hashes(words.hashes, size)[at])]
            if not len(at):
                continue
            number = words.phrases(at, size)
            order = np.argsort(number, kind="stable")
            cut = np.flatnonzero(np.diff(number[order], prepend=-1))
            where = at[order][cut]
            sides = []
            for there, neighbour in ((joined[at], at - 1), (joined[at + size], at + size)):
                word = np.where(there, words.ids[np.clip(neighbour, 0, n - 1)], -1)[order]
                low, high = np.minimum.reduceat(word, cut), np.maximum.reduceat(word, cut)
                sides.append(words.book.take(pa.array(low, mask=(low != high) | (low < 0))))
            many = np.diff(np.append(cut, len(at)))
            yield [pa.array(languages, pa.string()).take(pa.array(words.lang[where])), words.text(where, size),
                   pa.array(many, pa.int64()), *sides]

    def one(side: str) -> Column:
        return (F.count(side) == F.count(F.lit(1))) & (F.min(side) == F.max(side))

    rows = counted(docs, CENSUS, work, limit).groupBy("lang", "phrase").agg(
        F.sum("f").alias("f"), (one("before") | one("after")).alias("held"))
    return materialize(rows.join(wanted, ["lang", "phrase"], "left_semi"), "census")


def per_language(rows: DataFrame, some: DataFrame, how: str = "inner") -> DataFrame:
    """Join what holds one row per language; up to ``FEW_LANGUAGES`` of them go to every task, so no language is gathered."""
    return rows.join(F.broadcast(some) if some.count() <= FEW_LANGUAGES else some, "lang", how)


def _part(first: Column, size: Column | int) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame, factor: int) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` at each phrase's weakest cut; of equal ones that after the fewest words.

    The products are DECIMAL(38, 0), exact up to 10^38.
    """
    words = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    left = cuts.withColumn("left", _part(F.lit(1), F.col("k"))).withColumn(
        "right", _part(F.col("k") + 1, F.size("words") - F.col("k"))).drop("words")
    for side, name in (("left", "l"), ("right", "r")):
        left = left.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    above = (big["a"] * big["n"] * F.lit(factor).cast("decimal(9,0)")).cast("decimal(38,0)")
    below = (big["l"] * big["r"]).cast("decimal(38,0)")
    rows = per_language(left, totals).withColumn("above", above).withColumn("below", below).withColumn("score", F.expr("above div below"))
    weakest = F.min(F.struct("score", "k", "l", "r"))
    return rows.groupBy("lang", "phrase", "a", "n").agg(weakest.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def grow(
    docs: DataFrame, words: DataFrame, totals: DataFrame, batch: DataFrame, frequent: bytes, least: int, factor: int, limit: int,
) -> DataFrame:
    """All scored phrases, not inside a longer one met as often, whose first word is in ``batch``; a stored table."""
    pairs = pair_counts(docs, sieve_of(batch), frequent, least, limit)
    longer = longer_counts(docs, sieve_of(pairs), frequent, least, limit)
    starts = batch.select("lang", F.col("phrase").alias("first"))
    found = pairs.unionByName(longer).withColumn("first", F.substring_index("phrase", " ", 1))
    found = materialize(found.join(starts, ["lang", "first"], "left_semi").drop("first"), "phrases")
    discard(pairs, longer)
    split = found.select("lang", F.split("phrase", " ").alias("words"))
    parts = split.select("lang", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"), "words").select(
        "lang", _part(F.col("k"), F.size("words")).alias("phrase"))
    wanted = materialize(parts.distinct(), "parts")
    seen = census(docs, wanted, limit)
    counts = words.unionByName(seen.select("lang", "phrase", "f"))
    longest = F.size(F.split("phrase", " ")) == LONGEST
    free = seen.filter(~F.col("held") | longest).select("lang", "phrase")
    kept = scored(found, counts, totals, factor).join(free, ["lang", "phrase"], "left_semi")
    kept = materialize(kept, "collocations")
    discard(found, wanted, seen)
    return kept


def _next(words: DataFrame, totals: DataFrame, done: DataFrame, found: DataFrame | None, turn: int, top: int, factor: int) -> DataFrame:
    """``lang, done, upto``: the largest count of a first word that each language has grown, and that it grows next.

    A language with ``top`` phrases grows all whose bound reaches the score of the last of them, the others a part of
    the occurrences of their words, by powers of two, or in the end all.
    """
    band = F.floor(F.log2(F.col("f").cast("double"))).cast("int")
    sizes = words.groupBy("lang", band.alias("band")).agg(F.sum("f").alias("rows"), F.max("f").alias("most"))
    whole = Window.partitionBy("lang")  # some sixty rows at most
    share = F.lit(SHARES[turn]) if turn < len(SHARES) else F.lit(1.0)
    reached = F.sum("rows").over(whole.orderBy("band")) >= share * F.sum("rows").over(whole)
    upto = sizes.withColumn("reached", reached).groupBy("lang").agg(
        F.min(F.when(F.col("reached"), F.col("most"))).alias("part"), F.max("most").alias("all"))
    upto = upto.withColumn("upto", F.coalesce("part", "all")).select("lang", "upto")
    if found is not None:
        order = Window.partitionBy("lang").orderBy(F.col("score").desc())
        last = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).groupBy("lang").agg(
            F.count(F.lit(1)).alias("held"), F.min("score").alias("last"))
        limit = F.expr(f"(cast(n AS decimal(18,0)) * {factor}) div cast(last AS decimal(18,0))")
        upto = upto.join(last.join(totals, "lang"), "lang", "left").select(
            "lang", F.when((F.col("held") >= top) & (F.col("last") > 0), limit).otherwise(F.col("upto")).alias("upto"))
    before = F.coalesce("before", F.lit(0))
    return materialize(upto.join(done, "lang", "left").select(
        "lang", before.alias("done"), F.greatest("upto", before).alias("upto")), "bounds")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000, factor: int = 1000,
    limit: int = BLOCK,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best ``top`` phrases of two to five words.

    Words are what stands between spaces, tabs and the signs that end a piece, with A-Z lower-cased; a phrase lies in
    one piece of one text. Candidates occur ``least`` times; one inside a longer one that occurs as often is left out.
    Order: score, then ``a``, both falling, then the phrase by its bytes. A null language is ``und``, a null text has
    no words; repeated rows count each time; other columns are not looked at; an empty table gives an empty one. A
    text longer than ``limit`` bytes is counted in parts that end between pieces.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    counts = word_counts(rows, least, limit)
    totals = materialize(counts.filter("phrase IS NULL").select("lang", F.col("f").alias("n")), "totals")
    words = counts.filter("phrase IS NOT NULL")
    frequent = sieve_of(words)
    done = spark.createDataFrame([], "lang string, before bigint")
    rounds: list[DataFrame] = []
    turn = 0
    while True:
        found = reduce(DataFrame.unionByName, rounds) if rounds else None
        upto = _next(words, totals, done, found, turn, top, factor)
        batch = per_language(words, upto).filter(
            (F.col("f") <= F.col("upto")) & (F.col("f") > F.col("done"))).select("lang", "phrase", "f")
        batch = materialize(batch, "first-words")
        if batch.isEmpty():
            turn += 1
            if turn > len(SHARES):
                break
            continue
        searched = batch.select("lang").distinct()
        some = per_language(rows, searched, "left_semi") if searched.count() <= FEW_LANGUAGES else rows
        rounds.append(grow(some, words, totals, batch, frequent, least, factor, limit))
        discard(batch)
        done, turn = upto.select("lang", F.col("upto").alias("before")), turn + 1
    if not rounds:
        found = spark.createDataFrame([], "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
