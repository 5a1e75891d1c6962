"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.session import materialize

# A key is hot when it holds more than HOT_ROWS rows, or more than 1/HOT_SHARE of all rows if that is less; each of its
# pieces has at most so many. Hot keys are total / HOT_ROWS at most, or HOT_SHARE.
HOT_ROWS = 5_000_000
HOT_SHARE = 1024
# Below this many rows a key is never worth splitting.
HOT_FLOOR = 100_000
# A list of hot keys up to this many rows is broadcast, a longer one is joined by shuffle.
BROADCAST_KEYS = 100_000


def hot_keys(sizes: DataFrame, keys: list[str], rows: str, floor: int = HOT_FLOOR) -> DataFrame | None:
    """Hot keys with the number of ``_pieces`` to split each into, or None when no key is hot.

    Two numbers, the sum and the largest of the group sizes, decide whether there is anything to do.
    """
    total, largest = sizes.agg(F.sum(rows), F.max(rows)).first()
    target = max(floor, min(HOT_ROWS, int(total) // HOT_SHARE)) if total else 0
    if not total or largest <= target:
        return None
    pieces = F.ceil(F.col(rows) / max(target, 1)).cast("int")
    return materialize(sizes.filter(F.col(rows) > target).select(*keys, pieces.alias("_pieces")), "hot-keys")


def small_list(hot: DataFrame) -> DataFrame:
    """The list of hot keys, marked for broadcast if it is short."""
    return F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    sizes: DataFrame | None = None,
    rows: str = "_rows",
    spread: list[str] | None = None,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Join a long ``left`` with a short ``right`` on ``keys``; hot keys of ``left``, if any, are split.

    Rows of a hot key go to several partitions by a hash of ``spread`` (all columns of ``left`` by default), and
    the matching rows of ``right`` are repeated once per piece. ``sizes`` holds the number of rows per key when
    the caller already has it; otherwise a count over the key columns finds it. The hash is a function of the row
    alone, so a recomputed task sends its rows to the same place.
    """
    if sizes is None:
        sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows))
    return split_join(left, right, keys, hot_keys(sizes, keys, rows, floor), how, spread)


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    hot: DataFrame | None,
    how: str = "inner",
    spread: list[str] | None = None,
) -> DataFrame:
    """:func:`salted_join` with the hot keys already known; a plain join when there are none."""
    if hot is None:
        return left.join(right, keys, how)
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    listed = small_list(hot)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    split = F.when(no_key, HOT_SHARE).otherwise(pieces)  # rows without a key match nothing and go anywhere
    salted = (
        left.join(listed, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*(spread or left.columns)), split).cast("int"))
        .drop("_pieces")
    )
    repeated = (
        right.join(listed, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces")
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def tile_of(column: Column, tiles: Column) -> Column:
    """Tile number of a value when its group is cut into ``tiles`` parts."""
    return F.pmod(F.xxhash64(column), tiles).cast("int")
