"""Byte-level BPE: ranks of a public vocabulary, merged through a hierarchical-bitmap queue of ranks."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from plenum.llm.text import fresh, give_back, parse_schema, with_struct

#: Different pieces and words that a worker remembers (some 160 bytes each); when half of them are new, it forgets the
#: half that it has not met since.
REMEMBERED = 400_000
SHORT = 64
#: Characters of texts that are cut together, and bytes of their new words in one queue (some 60 bytes each at the peak).
TOGETHER, QUEUED = 4_000_000, 1_000_000
#: Words of at least so many bytes are merged many places at once, while a rank has some ``OFTEN`` places. So many parts
#: are then merged one by one in one queue (some 150 bytes each at the peak).
MANY, OFTEN, FEW = 5_000, 16, 100_000
#: Rows whose ids a task holds at once.
ROWS = 2_000

# Unicode White_Space, which is what \s means in the public pattern.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Every piece is whole matches of the public pattern: those begin at white space or don't hold any.
PIECES = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# A pattern with these parts matches a run of letters, and one of marks after it, as a whole; so no search is needed for
# a piece that is such a word.
PLAIN = r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
WORD = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)")

ENCODED = parse_schema("ids array<int>,n_tokens bigint")
PACKED = parse_schema("ids binary,n_tokens bigint")
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Ranks by bytes; encodes pieces of text and decodes ids."""

    def __init__(self, lines: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}
        self.nothing = max(self.ranks.values()) + 1  # no id
        self.tokens = np.full(self.nothing, None)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = np.array([self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)
        get = self.ranks.get  # rank of what two ids make together, by both ids
        self.joined = {
            a << 32 | b: rank for token, rank in self.ranks.items() for k in range(1, len(token))
            if (a := get(token[:k])) is not None and (b := get(token[k:])) is not None
        }
        pairs = np.fromiter(self.joined, np.int64, len(self.joined))
        ranks = np.fromiter(self.joined.values(), np.int32, len(self.joined))
        # per id, what may come next to it and the rank of both together
        self.nexts = self._by(pairs >> 32, pairs & 0xFFFFFFFF, ranks)
        self.lasts = self._by(pairs & 0xFFFFFFFF, pairs >> 32, ranks)
        self.matches = regex.compile(pattern)
        self.cuts, self.plain = PIECES, WORD.fullmatch if PLAIN in pattern else None
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _by(self, one: np.ndarray, other: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(one, kind="stable")
        return other[order].astype(np.int32), ranks[order], np.searchsorted(one[order], np.arange(self.nothing + 1))

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else np.frombuffer(self.merge_all([piece])[0], "<u4").tolist()

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of the matches ``words``, none of them empty, as 32-bit little-endian numbers.

        Words don't touch, so one queue merges all of them, each in its own order: lowest rank first, and of one rank
        the leftmost place. As long as ranks are found at many places at once, :meth:`_merge_many` takes a place of
        every word together; :meth:`_merge_few` takes what is left one by one.
        """
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(word) for word in words])
        ids, ranks = self.first[data], np.full(len(data), -1, np.int32)
        ranks[:-1] = self.pairs[data[:-1].astype(np.int32) << 8 | data[1:]]
        ranks[ends - 1] = -1
        if len(data) >= MANY:
            ids, ranks, ends = self._merge_many(ids, ranks, ends)
        made, low = [], 0
        while low < len(ends):
            begin = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, begin + FEW, "right")))
            end = int(ends[high - 1])
            made += self._merge_few(ids[begin:end], ranks[begin:end], ends[low:high] - begin)
            low = high
        return made

    def _merge_many(self, ids: np.ndarray, now: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The parts left (ids, ranks at which they merge with the next, where words end) when ranks have few places.

        The queue is that of :meth:`_merge_few`, with arrays of places in its buckets. The leftmost place of each word
        is merged; the word's other places go back to the bucket, behind any lower rank that this gave the word.
        """
        n = len(ids)
        word = np.zeros(n, np.int32)
        word[ends[:-1]] = 1
        word = np.cumsum(word, dtype=np.int32)
        # place n is beyond the ends of all words, as is place -1
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[ends - 1], before[ends[:-1]] = n, n
        ids, now = np.append(ids, self.nothing).astype(np.int32), np.append(now, -1).astype(np.int32)
        buckets, top, blocks, usual = {}, 0, {}, 2.0 * OFTEN
        table, nexts, lasts = np.full(self.nothing + 1, -1, np.int32), self.nexts, self.lasts

        def push(found: np.ndarray, places: np.ndarray) -> None:
            nonlocal top
            some = np.flatnonzero(found >= 0)
            if not len(some):
                return
            some = some[np.argsort(found[some], kind="stable")]
            found, places = found[some], places[some]
            cut = np.flatnonzero(found[1:] != found[:-1]) + 1
            begin = [0, *cut.tolist()]
            for rank, x, y in zip(found[begin].tolist(), begin, [*begin[1:], len(found)]):
                if rank in buckets:
                    buckets[rank].append(places[x:y])
                else:
                    buckets[rank] = [places[x:y]]
                    blocks[rank >> 8] = blocks.get(rank >> 8, 0) | 1 << (rank & 255)
                    top |= 1 << (rank >> 8)

        push(now[:n], np.arange(n, dtype=np.int32))
        while top and usual >= OFTEN:
            block = (top & -top).bit_length() - 1
            bits = blocks[block]
            rank = block << 8 | (bits & -bits).bit_length() - 1
            blocks[block] = bits = bits & bits - 1
            if not bits:
                top &= top - 1
            held = buckets.pop(rank)
            i = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            i = i[now[i] == rank]
            usual += (len(i) - usual) / 16
            if not len(i):
                continue
            owner = word[i]
            leftmost = np.append(True, owner[1:] != owner[:-1])
            if not leftmost.all():
                push(np.full(len(i) - np.count_nonzero(leftmost), rank), i[~leftmost])
                i = i[leftmost]
            gone, left = after[i], before[i]
            right = after[gone]
            ids[i], ids[gone], now[gone], after[i], before[right] = rank, -1, -1, right, i
            for others, at, near in ((nexts, i, right), (lasts, left, left)):
                a, b = others[2][rank : rank + 2].tolist()
                table[others[0][a:b]] = others[1][a:b]
                now[at] = found = table[ids[near]]
                table[others[0][a:b]] = -1
                push(found, at)
        left = np.flatnonzero(ids[:n] >= 0)
        return ids[left], now[left], np.searchsorted(left, ends)

    def _merge_few(self, parts: np.ndarray, ranks: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Ids of words given by their parts, the ranks at which those merge with the next, and where words end.

        Places are parts, linked to the next and the previous part of the same word that is left; ``now`` has
        the rank at which the part at a place merges with the next, -1 for never. ``buckets`` holds, per rank, the places
        where it was found. Which buckets there are is kept in bits on two levels: ``blocks`` has one bit per rank, 256
        ranks a block, and ``top`` one bit per block; the next rank is the first set bit of the first block. Within a
        bucket the leftmost place comes first; if a merge gives a lower rank, the rest of the bucket waits. An entry
        whose place has another rank by now is stale and skipped.
        """
        n, get = len(parts), self.joined.get
        links = np.arange(1, n + 1)
        links[ends - 1] = n
        after = links.tolist()
        links = np.arange(-1, n - 1)
        links[ends[:-1]] = -1
        before = links.tolist()
        ids, now = parts.tolist(), ranks.tolist()
        places = np.argsort(ranks, kind="stable")
        places = places[np.searchsorted(ranks[places], 0):]
        found, begin = np.unique(ranks[places], return_index=True)
        places, begin = places.tolist(), [*begin.tolist(), len(places)]
        buckets = {rank: places[x:y] for rank, x, y in zip(found.tolist(), begin, begin[1:])}
        top, blocks = 0, {}
        for rank in buckets:
            blocks[rank >> 8] = blocks.get(rank >> 8, 0) | 1 << (rank & 255)
            top |= 1 << (rank >> 8)
        while top:
            block = (top & -top).bit_length() - 1
            bits = blocks[block]
            rank = block << 8 | (bits & -bits).bit_length() - 1
            blocks[block] = bits = bits & bits - 1
            if not bits:
                top &= top - 1
            places = buckets.pop(rank)
            places.sort()
            for at, i in enumerate(places):
                if now[i] != rank:
                    continue
                gone = after[i]
                right, left = after[gone], before[i]
                ids[i], now[gone], after[i], ids[gone] = rank, -1, right, -1
                lower, found = False, -1
                if right < n:
                    before[right] = i
                    found = get(rank << 32 | ids[right], -1)
                now[i] = found
                if found >= 0:
                    lower = found < rank
                    if found in buckets:
                        buckets[found].append(i)
                    else:
                        buckets[found] = [i]
                        block = found >> 8
                        blocks[block] = blocks.get(block, 0) | 1 << (found & 255)
                        top |= 1 << block
                if left >= 0:
                    now[left] = found = get(ids[left] << 32 | rank, -1)
                    if found >= 0:
                        lower = lower or found < rank
                        if found in buckets:
                            buckets[found].append(left)
                        else:
                            buckets[found] = [left]
                            block = found >> 8
                            blocks[block] = blocks.get(block, 0) | 1 << (found & 255)
                            top |= 1 << block
                if lower and at + 1 < len(places):
                    buckets[rank] = places[at + 1:]
                    block = rank >> 8
                    blocks[block] = blocks.get(block, 0) | 1 << (rank & 255)
                    top |= 1 << block
                    break
        made = np.array(ids, np.int64)
        left = made >= 0
        cuts = (4 * np.cumsum(left)[ends - 1]).tolist()
        packed = made[left].astype("<u4").tobytes()
        return [packed[x:y] for x, y in zip([0, *cuts], cuts)]

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces of text and of the matches in them, by text; short ones are remembered."""
        split, words, known, merged = {}, {}, {}, []
        get, old, rank_of, plain, all_matches = self.memory.get, self.older.get, self.ranks.get, self.plain, self.matches.findall
        for text in pieces:
            if (ids := old(text)) is not None:
                known[text] = ids
                continue
            if plain is None or (found := plain(text)) is None:
                matches = all_matches(text)
            else:
                matches = found.groups() if found[2] else (text,)
            if len(matches) != 1 or matches[0] != text:
                split[text] = matches
            for match in matches:
                if match not in words and match not in known:
                    ids = get(match) or old(match)
                    if ids is not None:
                        known[match] = ids
                    elif (rank := rank_of(piece := match.encode())) is not None:
                        known[match] = pack("<I", rank)
                    else:
                        words[match] = piece
        some, size = [], 0
        for word in words.values():
            some.append(word)
            size += len(word)
            if size >= QUEUED:
                merged += self.merge_all(some)
                some, size = [], 0
        known.update(zip(words, merged + (self.merge_all(some) if some else [])))
        for text, matches in split.items():
            known[text] = b"".join([known[match] for match in matches])
        self.memory.update((text, ids) for text, ids in known.items() if len(text) <= SHORT)
        if 2 * len(self.memory) > REMEMBERED:
            self.memory, self.older = {}, self.memory
        return known

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, packed; what is between matches of the pattern, if anything, has none.

        Texts of some ``TOGETHER`` characters are cut before their new words are merged.
        """
        made, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= TOGETHER:
                made += self._encoded(some)
                some, size = [], 0
        return made + self._encoded(some)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        get, cut, met, new = self.memory.get, self.cuts.findall, [], {}
        for text in texts:
            pieces = cut(text)
            ids = list(map(get, pieces))
            if None in ids:
                lacking = [p for p, i in zip(pieces, ids) if i is None]
                new.update(dict.fromkeys(lacking))
                met.append((ids, lacking))
            else:
                met.append((b"".join(ids), None))
        known = self.learn(list(new)) if new else {}
        for at, (ids, lacking) in enumerate(met):
            if lacking is not None:
                found = map(known.__getitem__, lacking)
                ids = b"".join([next(found) if i is None else i for i in ids])
            met[at] = ids
        return met

    def forget(self) -> None:
        """Gives back the memory of words met; the vocabulary stays."""
        self.memory, self.older = {}, {}
        give_back()

    def encode(self, text: str) -> bytes:
        """Ids of one whole text, packed."""
        return self.encode_all([text])[0]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(packed, "<u4")].tolist())


_loaded: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(name: str, lines: bytes, pattern: str) -> Vocabulary:
    """The vocabulary, built once per worker process."""
    key = (name, pattern)
    if key not in _loaded:
        _loaded[key] = Vocabulary(lines, pattern)
    return _loaded[key]


def _shared(docs: DataFrame, path: str):
    """The rank file, read by the driver and sent to the workers; its size is that of a vocabulary."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "tokens", packed: bool = False) -> DataFrame:
    """``docs`` plus a struct ``name`` of ``ids`` (an array, or if ``packed`` 32-bit numbers in a binary) and ``n_tokens``.

    The text is cut at white space into pieces of whole matches of ``pattern``, which holds for patterns whose
    matches hold no white space but at their start; pieces met before are looked up, others go through the rank
    queue. Texts stay where they are. A null text is encoded as the empty one: no ids. Special tokens are ordinary
    text. Repeated rows and other columns pass through.
    """
    lines = _shared(docs, path)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        book = vocabulary(path, lines.value, pattern)
        made = book.encode_all([t.as_py() or "" for t in texts])
        sizes = np.array([len(p) // 4 for p in made], np.int64)
        if packed:
            return {"ids": pa.array(made, pa.binary()), "n_tokens": pa.array(sizes)}
        ids = pa.array(np.frombuffer(b"".join(made), "<u4").astype(np.int32))
        cut = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), ids), "n_tokens": pa.array(sizes)}

    return with_struct(docs, [text], fresh(docs, name), PACKED if packed else ENCODED, work)


def round_trip(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens``, the hash of the ids and that of the bytes the ids decode to.

    ``with_ids`` adds the ids as an array. Nulls and repeated rows as in :func:`encode`.
    """
    lines = _shared(docs, path)
    names = [part.split()[0] for part in DIGEST.split(", ")] + ["ids"] * with_ids

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = vocabulary(path, lines.value, pattern)
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, max(whole.num_rows, 1), ROWS)):
            sizes, hashes, decoded, made = [], [], [], []
            for packed in book.encode_all([value.as_py() or "" for value in batch.column(1)]):
                sizes.append(len(packed) // 4)
                hashes.append(sha256(packed).hexdigest())
                decoded.append(sha256(book.decode(packed)).hexdigest())
                if with_ids:
                    made.append(np.frombuffer(packed, "<i4"))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(pa.array(made, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)
        book.forget()  # the process goes on with other tasks

    some = docs.select(docs[key].cast("bigint").alias("doc_id"), text)
    return some.mapInArrow(task, DIGEST + ", ids array<int>" * with_ids)
