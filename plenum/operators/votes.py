"""From roll-call ballots to a weighted network of members who vote alike."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plenum.functions.quantiles import histogram_quantiles
from plenum.session import materialize
from plenum.skew import HOT_FLOOR, hot_keys, salted_join, small_list, tile_of

# Members per tile: one task step pairs at most TILE x TILE members of a group.
TILE = 1024
# A group of at least DENSE_FROM members that holds more than 1/DENSE_SHARE of all members is dense.
DENSE_FROM = 64
DENSE_SHARE = 8
WORD_BITS = 64
WORDS_PER_BIN = 16
BIN_FILL = 0.94  # bins are filled by hash: room for uneven filling
# Pairs that one task makes in a self-join.
PAIRS_PER_TASK = 20_000_000
# Up to so many different votes are compared by their place in the sorted list of votes.
KNOWN_VOTES = 1_000
# Rows that one task reduces to ballots, about (some 250 bytes each at the peak).
BALLOT_ROWS = 1_000_000


def ballots_from(rows: DataFrame, voting: str, member: str, vote: str) -> DataFrame:
    """One ballot per voting and member; of repeated rows the largest vote counts. Rows without either are no ballots.

    Votes are few, so they are compared as numbers, by which rows are summed up by hash; the largest text would need two
    sorts of all rows. Hardly any rows are repeated, so sums before rows move would hold nearly all rows of a task; rows
    are counted with the votes and dealt to as many tasks as bound what one holds. The frame is marked, so that its
    rows aren't reduced once more.
    """
    named = rows.select(F.col(voting).alias("voting"), F.col(member).alias("member"), F.col(vote).alias("vote")).filter(
        F.col("voting").isNotNull() & F.col("member").isNotNull())
    found = named.groupBy("vote").agg(F.count(F.lit(1)).alias("n")).limit(KNOWN_VOTES + 2).collect()
    many = len(found) > KNOWN_VOTES + 1  # NULL is one of them, or not
    tasks = -(-(named.count() if many else sum(r.n for r in found)) // BALLOT_ROWS)
    if tasks > 1:
        named = named.repartition(max(tasks, named.sparkSession.sparkContext.defaultParallelism), "voting", "member")
    votes = [r.vote for r in found if r.vote is not None]
    if not votes or len(votes) > KNOWN_VOTES or not isinstance(votes[0], str):
        reduced = named.groupBy("voting", "member").agg(F.max("vote").alias("vote"))
    else:
        known = F.array(*[F.lit(v) for v in sorted(votes, key=str.encode)])
        coded = named.select("voting", "member", F.when(F.col("vote").isNotNull(), F.array_position(known, F.col("vote"))).alias("code"))
        reduced = coded.groupBy("voting", "member").agg(F.max("code").alias("code")).select(
            "voting", "member", F.when(F.col("code") > 0, F.element_at(known, F.col("code").cast("int"))).alias("vote"))
    reduced.one_each = True
    return reduced


def _tally(ballots: DataFrame, min_minority: int | None) -> DataFrame:
    """Ballots per voting and vote, with a flag for votings that are relevant; a stored table."""
    tally = ballots.groupBy("voting", "vote").agg(F.count(F.lit(1)).alias("n"))
    if min_minority is None:
        return materialize(tally.withColumn("relevant", F.lit(True)), "tally")
    split = tally.groupBy("voting").agg(
        (F.sum("n") - F.max("n") >= min_minority).alias("relevant")
    )
    return materialize(tally.join(split, "voting").select("voting", "vote", "n", "relevant"), "tally")


def relevant_votings(ballots: DataFrame, min_minority: int = 1, floor: int = HOT_FLOOR) -> DataFrame:
    """Ballots of votings in which at least ``min_minority`` ballots differ from the most common vote."""
    votings = (
        ballots.groupBy("voting", "vote").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("voting").agg(F.sum("n").alias("_rows"), F.max("n").alias("_top"))
    )
    votings = materialize(
        votings.select("voting", "_rows", (F.col("_rows") - F.col("_top") >= min_minority).alias("relevant")),
        "votings",
    )
    return salted_join(
        ballots, votings.filter("relevant").select("voting"), ["voting"], "left_semi",
        sizes=votings, spread=["member"], floor=floor,
    ).select("voting", "member", "vote")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.when(a < b, a).otherwise(b).alias("src"), F.when(a < b, b).otherwise(a).alias("dst")]


def _dealt(rows: DataFrame, keys: list[str], pairs: int) -> DataFrame:
    """Rows dealt by ``keys`` to as many tasks as their ``pairs`` need, where the usual number would be too few."""
    tasks = -(-pairs // PAIRS_PER_TASK)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *keys) if tasks > usual else rows


def _light_pairs(ballots: DataFrame, groups: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Pairs inside groups of at most one tile.

    Ballots of hot groups, which other lanes handle, are dropped before the shuffle. One shuffle of ballots by
    voting and vote then serves both sides of the self-join.
    """
    keys = ["voting", "vote"]
    if hot is not None:
        ballots = ballots.join(small_list(hot), keys, "left_anti")
    ballots = _dealt(ballots, keys, int(groups.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0))
    a = ballots.join(groups.select(*keys), keys, "left_semi").withColumnRenamed("member", "src")
    b = ballots.withColumnRenamed("member", "dst")
    one = F.lit(1).cast("bigint").alias("weight")
    return a.join(b, keys).filter("src < dst").select("src", "dst", one)


def _tile_pairs(cells: DataFrame, keys: list[str], tiles: Column, words: list[str]) -> DataFrame:
    """Pairs inside large groups, one pair of member tiles at a time.

    ``cells`` has one row per group and member. A member of tile i is sent to the tile pairs (i, j) with j >= i as
    left side and (j, i) with j <= i as right side; every pair of members then meets in exactly one tile pair, and
    the tile pairs of one group are spread over the cluster. A pair weighs the bits its ``words`` share, or 1
    without words.
    """
    cells = cells.withColumn("_tiles", tiles).withColumn("_tile", tile_of(F.col("member"), F.col("_tiles")))
    a = cells.select(
        *keys, F.col("_tile").alias("_i"), F.col("member").alias("a"), *[F.col(w).alias(f"a_{w}") for w in words],
        F.explode(F.sequence("_tile", F.col("_tiles") - 1)).alias("_j"),
    )
    b = cells.select(
        *keys, F.col("_tile").alias("_j"), F.col("member").alias("b"), *[F.col(w).alias(f"b_{w}") for w in words],
        F.explode(F.sequence(F.lit(0), "_tile")).alias("_i"),
    )
    shared = [F.bit_count(F.col(f"a_{w}").bitwiseAND(F.col(f"b_{w}"))) for w in words]
    weight = reduce(Column.__add__, shared) if words else F.lit(1)
    return (
        a.join(b, [*keys, "_i", "_j"])
        .filter((F.col("_i") < F.col("_j")) | (F.col("a") < F.col("b")))
        .select(*_pair(F.col("a"), F.col("b")), weight.cast("bigint").alias("weight"))
        .filter("weight > 0")
    )


def _tiled_pairs(ballots: DataFrame, groups: DataFrame, tally: DataFrame, tile: int, floor: int) -> DataFrame:
    """Pairs inside groups of more than one tile that are a small part of all members."""
    cells = salted_join(
        ballots, groups.select("voting", "vote", "n"), ["voting", "vote"],
        sizes=tally, rows="n", spread=["member"], floor=floor,
    )
    return _tile_pairs(cells, ["voting", "vote"], F.ceil(F.col("n") / tile).cast("int"), [])


def _dense_pairs(
    ballots: DataFrame, groups: DataFrame, tally: DataFrame, n_groups: int, n_members: int, tile: int, floor: int
) -> DataFrame:
    """Pairs inside groups that hold a large part of all members, about a thousand groups at a time.

    Groups are numbered inside hashed bins, so no task orders them all. A bin and member make one row with a bit per
    group, in a fixed number of words; the few groups beyond the last word go to a further ``block`` of the bin.
    """
    bits = WORD_BITS * WORDS_PER_BIN
    bins = max(1, math.ceil(n_groups / (bits * BIN_FILL)))
    place = F.row_number().over(Window.partitionBy("bin").orderBy("voting", "vote")) - 1
    numbered = (
        groups.withColumn("bin", F.pmod(F.xxhash64("voting", "vote"), F.lit(bins)).cast("int"))
        .withColumn("place", place)
        .select(
            "voting", "vote", "bin",
            F.floor(F.col("place") / bits).cast("int").alias("block"),
            F.floor(F.col("place") % bits / WORD_BITS).cast("int").alias("word"),
            (F.col("place") % WORD_BITS).cast("int").alias("bit"),
        )
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    words = [f"w{i}" for i in range(WORDS_PER_BIN)]
    packed = (
        salted_join(
            ballots, numbered, ["voting", "vote"], sizes=tally, rows="n", spread=["member"], floor=floor
        )
        .groupBy("bin", "block", "member")
        .agg(*[F.bit_or(F.when(F.col("word") == i, bit).otherwise(0)).alias(w) for i, w in enumerate(words)])
    )
    return _tile_pairs(packed, ["bin", "block"], F.lit(max(1, math.ceil(n_members / tile))), words)


def agreement_edges(
    ballots: DataFrame,
    min_minority: int | None = None,
    min_weight: int | None = None,
    tile: int = TILE,
    dense_from: int = DENSE_FROM,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Pairs of members with the number of votings in which both cast the same vote.

    ``min_minority`` applies the rule of :func:`relevant_votings` to the vote counts that are needed anyway. The
    counts are written once, and their sizes decide which of three exact ways the groups of equal votes take:

    * light groups, at most one tile: a self-join on one shuffle;
    * tiled groups: cut into member tiles, so that one huge roll call is many bounded pair steps;
    * dense groups, with a large share of all members: about a thousand groups are packed as bits of one row per
      member, and a pair is weighed by the bits it shares, so a pair is met once instead of a thousand times.

    All ways see the same ballots: one per voting and member, as :func:`ballots_from` reduces them, stored here
    because each way reads them. Pair counts are summed on the map side before the one shuffle by pair. With
    ``min_weight`` only pairs of at least that weight are given, and members with fewer ballots, who can't reach it,
    are left out before any pair is made.
    """
    floor = max(floor, tile)
    if not getattr(ballots, "one_each", False):
        ballots = ballots_from(ballots, "voting", "member", "vote")
    ballots = materialize(ballots, "ballots")
    if min_weight is not None:
        tally = _tally(ballots, min_minority)
        counted = salted_join(ballots, tally.filter("relevant").select("voting").distinct(), ["voting"], "left_semi",
                              spread=["member"], floor=floor)
        able = counted.groupBy("member").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_weight).select("member")
        # the rule of relevance has been applied to all ballots, so it isn't applied to those that are left
        left = salted_join(counted, able, ["member"], "left_semi", spread=["voting"], floor=floor)
        ballots, min_minority = materialize(left.select("voting", "member", "vote"), "able-ballots"), None
    keys, n = ["voting", "vote"], F.col("n")
    tally = _tally(ballots, min_minority)
    groups = tally.filter((n > 1) & F.col("vote").isNotNull() & F.col("relevant"))
    hot = hot_keys(tally, keys, "n", floor)

    largest = groups.agg(F.max(n)).first()[0] or 0
    lanes = []
    dense = F.lit(False)
    if largest >= dense_from:
        n_members = ballots.agg(F.approx_count_distinct("member")).first()[0]
        dense = (n >= dense_from) & (n * DENSE_SHARE > n_members)
        n_dense = groups.filter(dense).count()
        if n_dense:
            lanes.append(_dense_pairs(ballots, groups.filter(dense), tally, n_dense, n_members, tile, floor))
    if largest > tile:
        lanes.append(_tiled_pairs(ballots, groups.filter(~dense & (n > tile)), tally, tile, floor))
    lanes.append(_light_pairs(ballots, groups.filter(~dense & (n <= tile)), hot))
    pairs = reduce(DataFrame.unionByName, lanes)
    edges = pairs.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    return edges if min_weight is None else edges.filter(F.col("weight") >= min_weight)


def durable_edges(edges: DataFrame, min_weight: int | None = None, quantile: float = 0.75) -> DataFrame:
    """Edges whose weight reaches ``min_weight``, or else the given quantile of all weights.

    The quantile comes from one scan that counts the edges of each weight; the filter is another, so pass a stored
    table. No weight at all gives no edge.
    """
    if min_weight is None:
        min_weight = histogram_quantiles(edges, "weight", [quantile])[0]
    if min_weight is None:
        return edges.limit(0)
    return edges.filter(F.col("weight") >= min_weight)


def label_vertices(members: DataFrame, parties: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Members with the ideology of their party; an unknown party gives NULL."""
    return salted_join(members, parties, ["partido"], "left", floor=floor).select(
        F.col("id").cast("bigint").alias("id"), "nome", "partido", "ideologia"
    )
