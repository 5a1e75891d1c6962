"""N-gram Jaccard join: tiles of documents of similar size, bitmap signatures, exact intersection of sorted arrays.

Two documents link when their sets of word 5-grams have a Jaccard similarity of at least ``percent`` / 100. Comparing
all documents of similar size would grow with the square of the corpus, so the tiles are built inside groups of
documents that can link at all: in any fixed order of the shingles, two linked documents share one of the first
``n - ceil(0.8 n) + 1`` of each (the prefix filter). Shingles that many documents share come last in the order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.components import components
from plenum.llm.text import (
    FOLDED_BYTES, NOT_SPACE, blocks, flat, gram_hashes, mix, parse_schema, running, small_batches, span_hashes,
    with_struct, word_spans,
)
from plenum.session import discard, materialize

SHINGLE, PERCENT = 5, 80
#: Shingles put last in the order; only the cost depends on them. 8 bytes each are sent to every task.
COMMON = 100_000
#: Shingles of neighbouring documents that are counted at once to find those.
SEEN = 600_000
#: A tile holds at most about so many documents, and so many shingles.
TILE_DOCS, TILE_SHINGLES = 2_000, 2_000_000
#: Bits of signatures, and shingles searched in one set, that a tile works on at once.
TILE_BITS, TILE_SEARCH = 1 << 20, 1 << 18
#: Documents that share a prefix shingle are compared by their bitmaps where they are at most so many; more are taken
#: for one group of candidates, which the exact step then divides.
COMPARED = 1_000
#: Lists of documents to look at up to this many rows are sent to every task, longer ones are joined.
SMALL_LIST = 50_000

SETS = parse_schema("n bigint,k1 bigint,k2 bigint,prefix array<bigint>,bits binary")
ARRAYS = parse_schema("n bigint,k1 bigint,k2 bigint,shingles array<bigint>")


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(all sets one after the other, each sorted; where each begins), block by block."""
    for _, _, data, offsets in blocks(texts):
        starts, ends, first = word_spans(data, offsets, NOT_SPACE)
        words = span_hashes(running(FOLDED_BYTES[data]), starts, ends)
        grams = gram_hashes(words, size)
        whole = span_hashes(running(words), first[:-1], first[1:])
        sets = []
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if b - a >= size:
                sets.append(np.unique(grams[a : b - size + 1]))
            else:
                sets.append(whole[i : i + 1] if b > a else whole[:0])
        yield np.concatenate(sets), np.cumsum([0, *map(len, sets)])


def set_keys(values: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set; equal sets have equal keys."""
    out = []
    for salt in (0x6A09E667F3BCC909, 0x3C6EF372FE94F82B):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ np.uint64(salt)), out=total[1:])
        out.append(mix(total[cut[1:]] - total[cut[:-1]]).view(np.int64))
    return out[0], out[1]


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (n * percent + 99) // 100 + 1, 0)


def common_shingles(docs: DataFrame, text: str, size: int, most: int) -> np.ndarray:
    """Shingles that several neighbouring documents share, the most frequent ``most`` of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for values, _ in shingle_sets(batch.column(0), size):
                held.append(values)
                count += len(values)
                if count >= SEEN:
                    yield often(held)
                    held, count = [], 0
        if held:
            yield often(held)

    def often(held: list[np.ndarray]) -> pa.RecordBatch:
        found, met = np.unique(np.concatenate(held), return_counts=True)
        some = met >= 3
        return pa.RecordBatch.from_arrays([pa.array(found[some].view(np.int64)), pa.array(met[some], pa.int64())], ["token", "met"])

    met = docs.select(text).mapInArrow(task, "token bigint, met bigint").groupBy("token").agg(F.sum("met").alias("met"))
    top = met.filter("met >= 8").orderBy(F.desc("met"), "token").limit(most)
    return np.sort(np.array([r.token for r in top.select("token").collect()], np.int64).view(np.uint64))


def sets_of(docs: DataFrame, key: str, text: str, common: np.ndarray, size: int, percent: int) -> DataFrame:
    """``doc_id, n, k1, k2, prefix, bits`` per row of ``docs``, a stored table."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        made: dict[str, list] = {f.name: [] for f in SETS}
        for values, cut in shingle_sets(texts, size):
            n = np.diff(cut)
            k1, k2 = set_keys(values, cut)
            late = np.isin(values, shared.value)
            # stable: rare before common within each set, each in the order of their hashes
            doc = np.repeat(np.arange(len(n)), n)
            order = np.argsort(doc * 2 + late, kind="stable")
            take = prefix_length(n, percent)
            within = np.arange(len(values)) - np.repeat(cut[:-1], n)
            prefix = values[order][within < np.repeat(take, n)]
            made["n"].append(pa.array(n, pa.int64()))
            made["k1"].append(pa.array(k1))
            made["k2"].append(pa.array(k2))
            made["bits"].append(pa.array(list(map(signature, (values[a:b] for a, b in zip(cut[:-1], cut[1:])))), pa.binary()))
            made["prefix"].append(flat(pa.array(prefix.view(np.int64)), np.concatenate([[0], np.cumsum(take)])))
        kinds = {"prefix": pa.list_(pa.int64()), "bits": pa.binary()}
        return {k: pa.concat_arrays(v) if v else pa.array([], kinds.get(k, pa.int64())) for k, v in made.items()}

    some = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return materialize(with_struct(some, ["text"], "s", SETS, work).select("doc_id", "s.*"), "shingle-sets")


def signature(values: np.ndarray) -> bytes:
    """Hashed bitmap of a set, with about a bit per shingle: bit b tells whether an odd number of them falls on b."""
    bits = min(8192, max(256, 1 << int(len(values)).bit_length()))
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(n: int, x: bytes, m: int, y: bytes, percent: int) -> bool:
    """Whether sets of ``n`` and ``m`` shingles with these bitmaps can link.

    Folding halves onto each other makes the longer bitmap as long as the other. Bits that differ come from shingles
    in only one of the sets, so their number bounds the overlap from above.
    """
    if min(n, m) * 100 < max(n, m) * percent:
        return False
    a, b = int.from_bytes(x), int.from_bytes(y)
    long, short = 8 * len(x), 8 * len(y)
    if long < short:
        a, b, long, short = b, a, short, long
    while long > short:
        long //= 2
        a = a >> long ^ a & (1 << long) - 1
    bound = (n + m - (a ^ b).bit_count()) // 2
    return bound * 100 >= (n + m - bound) * percent


def bitmap_links(rows: list[tuple[int, int, bytes]], percent: int) -> Iterator[tuple[int, int]]:
    """Links, as few as possible, that connect the documents (id, size, bitmap) of one shingle which may link."""
    group = list(range(len(rows)))
    for i, (rep, n, x) in enumerate(rows):
        for k in range(i):
            if group[k] != group[i] and may_link(n, x, rows[k][1], rows[k][2], percent):
                yield rep, rows[k][0]
                old, new = max(group[i], group[k]), min(group[i], group[k])
                group = [new if g == old else g for g in group]


def classes_of(sets: DataFrame) -> DataFrame:
    """Classes of equal sets, a stored table: ``rep``, a number of the class, ``first``, its smallest document, its
    ``weight`` in rows, and what the set is."""
    held = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("weight"),
        F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    return materialize(held.withColumn("rep", F.monotonically_increasing_id()), "classes")


def candidate_groups(classes: DataFrame, percent: int, compared: int) -> DataFrame:
    """``id, component``: classes of equal sets, by number, in groups outside of which none can link.

    Classes meet where they share a prefix shingle. The first shingle that two linked sets share also bounds their
    overlap by what follows it in either set; where just two classes meet, sizes and places alone rule most out
    before any bitmap is looked at.
    """
    # size and place in one number: what is compared first is the size
    tokens = classes.select("rep", "n", F.posexplode("prefix").alias("place", "token")).select(
        "rep", "token", (F.shiftleft("n", 31) + F.col("place")).alias("at"))
    met = tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("met"), F.min("at").alias("a"), F.max("at").alias("b"), F.min("rep").alias("least"))
    n, m = F.shiftright("a", 31), F.shiftright("b", 31)
    place = F.lit((1 << 31) - 1)
    rest = F.least(n - F.col("a").bitwiseAND(place), m - F.col("b").bitwiseAND(place))
    two_fit = (n * 100 >= m * percent) & (rest * (100 + percent) >= (n + m) * percent)
    shared = met.filter((F.col("met") > 2) | ((F.col("met") == 2) & two_fit)).select("token", "met", "least")
    rows = materialize(tokens.join(shared, "token").select("token", "rep", "met", "least"), "shared-shingles")
    stars = rows.filter((F.col("met") > compared) & (F.col("rep") != F.col("least"))).select(F.col("rep").alias("a"), F.col("least").alias("b"))
    bitmaps = classes.select("rep", "n", "bits")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, found = None, [], []
        for batch in batches:
            for token, rep, size, bits in zip(*[c.to_pylist() for c in batch.columns]):
                if token != now:
                    found += bitmap_links(group, percent)
                    now, group = token, []
                group.append((rep, size, bits))
            yield links(found)
            found = []
        found += bitmap_links(group, percent)
        yield links(found)

    def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*set(found)) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    few = rows.filter(F.col("met") <= compared).join(bitmaps, "rep").select("token", "rep", "n", "bits")
    near = few.repartition("token").sortWithinPartitions("token", "rep").mapInArrow(task, "a bigint, b bigint")
    found = components(near.unionByName(stars), "a", "b")
    discard(rows)
    return found


def tiles_of(members: DataFrame, percent: int, tile_docs: int, tile_shingles: int) -> DataFrame:
    """``rep, first, k1, k2, weight, tiles``: the tiles each class goes to.

    A group that fits is one tile. A larger one is cut by size into bands so wide that a class links only into its
    own and the next band; a tile has one band and the next. A band that is still too large is cut into blocks by a
    hash, and there is a tile for each pair of blocks.
    """
    ratio = 100.0 / percent
    # sizes up to 1.25 times as large are at most one band away; the margin covers rounding of the logarithm
    band = F.floor(F.log(F.col("n") * 1.0) / F.log(F.lit(ratio)) + 1e-9).cast("int")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total"))
    placed = members.join(sizes, "component").withColumn(
        "whole", (F.col("docs") <= tile_docs) & (F.col("total") <= tile_shingles))
    homes = placed.withColumn("band", F.explode(F.when(F.col("whole"), F.array(F.lit(-1))).otherwise(F.array(band, band - 1))))
    homes = homes.withColumn("upper", ~F.col("whole") & (F.col("band") < band))
    loads = homes.groupBy("component", "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / tile_docs), F.ceil(F.sum("n") / tile_shingles)).cast("int").alias("parts"))
    cut = homes.join(loads, ["component", "band"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tile = F.xxhash64("component", "band", F.least("part", "other"), F.greatest("part", "other"))
    return (
        cut.withColumn("other", other)
        .select("rep", "first", "k1", "k2", "weight", F.struct(
            tile.alias("tile"), "upper", "part", (F.col("part") == F.col("other")).alias("own")).alias("t"))
        .groupBy("rep", "first", "k1", "k2", "weight").agg(F.collect_list("t").alias("tiles"))
    )


def signatures(values: np.ndarray, doc: np.ndarray, n_docs: int, bits: int) -> np.ndarray:
    """Hashed bitmaps: bit b tells whether an odd number of the set's shingles falls on b. ``doc`` is sorted."""
    made, step = [], max(1, TILE_BITS // bits)
    for low in range(0, n_docs, step):
        high = min(n_docs, low + step)
        a, b = np.searchsorted(doc, (low, high))
        place = (doc[a:b] - low) * bits + (values[a:b] & np.uint64(bits - 1)).astype(np.int64)
        odd = (np.bincount(place, minlength=(high - low) * bits) & 1).astype(np.uint8)
        made.append(np.packbits(odd.reshape(high - low, bits), axis=1).view(np.uint64))
    return np.concatenate(made)


def overlaps(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Shingles that ``one`` shares with each of ``others``, all sorted, searched some sets at a time."""
    found, held, count = [], [], 0

    def search() -> None:
        picked = np.concatenate(held)
        at = np.minimum(np.searchsorted(one, picked), len(one) - 1)
        begin = np.cumsum([0, *map(len, held[:-1])])
        found.append(np.add.reduceat((one[at] == picked).astype(np.int64), begin))

    for values in others:
        held.append(values)
        count += len(values)
        if count >= TILE_SEARCH:
            search()
            held, count = [], 0
    if held:
        search()
    return np.concatenate(found)


def tile_links(reps: np.ndarray, weights: np.ndarray, sets: list[np.ndarray], upper: np.ndarray, part: np.ndarray,
               own: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, smallest linked-to document of the tile, links) for the documents of a tile that link.

    Bits that differ between two signatures come from shingles in only one of the sets, so their number bounds the
    overlap from above; only pairs whose bound allows a link are intersected. Pairs of two upper documents, and of
    one block in a tile of two, belong to another tile.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    reps, weights, sizes, upper, part, own = (x[order] for x in (reps, weights, sizes, upper, part, own))
    sets = [sets[i] for i in order]
    n = len(sets)
    values, doc = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    cut = np.concatenate([[0], np.cumsum(sizes)])
    bits = int(min(4096, max(256, 1 << int(2 * sizes.max()).bit_length())))
    bitmaps = signatures(values, doc, n, bits)
    limit = np.searchsorted(sizes, sizes * 100 // percent, "right")
    label, links = np.arange(n), np.zeros(n, np.int64)
    for i in range(n - 1):
        j = np.arange(i + 1, limit[i])
        if not len(j):
            continue
        j = j[~(upper[j] & upper[i]) & ((part[j] != part[i]) | own[i])]
        total = sizes[i] + sizes[j]
        bound = (total - np.bitwise_count(bitmaps[j] ^ bitmaps[i]).sum(axis=1)) // 2
        may = bound * 100 >= (total - bound) * percent
        j, total = j[may], total[may]
        if not len(j):
            continue
        overlap = overlaps(sets[i], [sets[k] for k in j.tolist()])
        j = j[overlap * 100 >= (total - overlap) * percent]
        if len(j):
            links[i] += weights[j].sum()
            links[j] += weights[i]
            old = np.unique(np.append(label[j], label[i]))
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
    linked = links > 0
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, label, reps)
    return reps[linked], least[label[linked]], links[linked]


def verified_links(docs: DataFrame, key: str, text: str, tiles: DataFrame, size: int, percent: int) -> DataFrame:
    """``rep, least, links`` by number of class: what the tiles find. A task holds one tile at a time."""

    def arrays(texts: pa.Array) -> dict[str, pa.Array]:
        made: dict[str, list] = {f.name: [] for f in ARRAYS}
        for values, cut in shingle_sets(texts, size):
            k1, k2 = set_keys(values, cut)
            for name, value in (("n", pa.array(np.diff(cut), pa.int64())), ("k1", pa.array(k1)), ("k2", pa.array(k2)),
                                ("shingles", flat(pa.array(values.view(np.int64)), cut))):
                made[name].append(value)
        return {k: pa.concat_arrays(v) if v else pa.array([], pa.list_(pa.int64()) if k == "shingles" else pa.int64())
                for k, v in made.items()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, {}

        def finish() -> pa.RecordBatch:
            cols = [np.array(c) for c in zip(*[r[:5] for r in rows.values()])]
            found = tile_links(cols[0], cols[1], [r[5] for r in rows.values()], *cols[2:], percent)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["rep", "least", "links"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            lists = batch.column(6)
            cut, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (tile, rep, weight, upper, part, own) in enumerate(zip(*columns)):
                if tile != now:
                    if len(rows) > 1:
                        yield finish()
                    now, rows = tile, {}
                rows.setdefault(rep, (rep, weight, upper, part, own, values[cut[i] : cut[i + 1]].copy()))  # not the batch
        if len(rows) > 1:
            yield finish()

    some = docs.select(F.col(key).cast("bigint").alias("first"), F.col(text).alias("text")).filter("first IS NOT NULL")
    few = tiles.withColumnsRenamed({"k1": "c1", "k2": "c2"})
    wanted = some.join(F.broadcast(few) if few.count() <= SMALL_LIST else few, "first")
    made = with_struct(wanted, ["text"], "a", ARRAYS, arrays).filter("a.k1 = c1 AND a.k2 = c2")
    dealt = made.select("rep", "weight", F.explode("tiles").alias("t"), F.col("a.shingles").alias("shingles")).select(
        "t.tile", "rep", "weight", "t.upper", "t.part", "t.own", "shingles")
    return dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(task, "rep bigint, least bigint, links bigint")


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT,
    tile_docs: int = TILE_DOCS, tile_shingles: int = TILE_SHINGLES, common: int = COMMON, compared: int = COMPARED,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, n_links``.

    Words are runs of non-spaces, A-Z in lower case; a text of fewer than ``size`` words is one shingle. Equal sets
    form a class and are compared once; ``n_links`` counts all linked rows, those of the same class included. A null
    or empty text has no shingles, links with nothing and is its own component. Rows that repeat a ``doc_id`` are one
    document, which links by each of its texts; a null ``doc_id`` takes no part and has a null component and
    number of links. The join is exact up to equal 64-bit hashes.
    """
    with small_batches(docs.sparkSession):
        sets = sets_of(docs, key, text, common_shingles(docs, text, size, common), size, percent)
        classes, narrow = classes_of(sets), materialize(sets.select("doc_id", "n", "k1", "k2"), "set-keys")
        discard(sets)
        groups = candidate_groups(classes, percent, compared)
        members = classes.select("rep", "first", "k1", "k2", "n", "weight").join(groups.withColumnRenamed("id", "rep"), "rep")
        members = materialize(members, "candidates")
        tiles = materialize(tiles_of(members, percent, tile_docs, tile_shingles), "tiles")
        found = materialize(verified_links(docs, key, text, tiles, size, percent), "links")
        discard(members, tiles)
    # a document of several texts joins their classes
    several = materialize(narrow.filter("doc_id IS NOT NULL").distinct().groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("doc_id"), "several-texts")
    repeated = not several.isEmpty()
    links = found.select("rep", "least")
    if repeated:
        held = narrow.join(several, "doc_id").join(classes.select("k1", "k2", "n", "rep"), ["k1", "k2", "n"]).select("doc_id", "rep").distinct()
        least = held.groupBy("doc_id").agg(F.min("rep").alias("least"))
        links = links.unionByName(held.join(least, "doc_id").select("rep", "least").filter("rep <> least"))
    linked = materialize(components(links, "rep", "least").toDF("rep", "component"), "linked")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    some = classes.select("rep", "first", "k1", "k2", "n", "weight")
    smallest = some.join(linked, "rep").groupBy("component").agg(F.min("first").alias("smallest"))
    named = some.join(linked.join(smallest, "component"), "rep", "left").join(counts, "rep", "left").select(
        "k1", "k2", "n", F.coalesce("smallest", "first").alias("component"), "weight", "links")
    none = F.lit(0).cast("bigint")
    links = F.when(F.col("n") > 0, F.coalesce("links", none) + F.col("weight") - 1).otherwise(none)
    placed = narrow.join(named, ["k1", "k2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), links).alias("n_links"))
    if not repeated:
        return placed
    # a row without words goes with the other texts of its document
    whole = placed.join(several, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("of_all"))
    return placed.join(whole, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("of_all", "component_id").alias("component_id"), "n_links")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all columns kept.

    Of rows that repeat that id the one with the smallest hash of its text stays; rows without id stay.
    """
    found = jaccard_components(docs, key, text, **options)
    gone = materialize(found.filter("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct(), "near-copies")
    left = docs.join(gone, key, "left_anti")
    ids = left.filter(F.col(key).isNotNull())
    if ids.groupBy(key).count().filter("count > 1").isEmpty():
        return left.select(*docs.columns)
    whole = F.struct(F.xxhash64(text).alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once = ids.groupBy(key).agg(F.min_by(whole["row"], whole["h"]).alias("row")).select("row.*")
    return once.unionByName(left.filter(F.col(key).isNull()).select(*docs.columns))
