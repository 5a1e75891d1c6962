"""Exact quantiles whose only single-task step orders a bounded number of values."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plenum.session import discard, materialize

ACCURACY = 10_000
# Distinct values that one task orders at the end, whatever the input.
BOUND = 200_000


def _brackets(values: DataFrame, size: int, probabilities: list[float], bound: int) -> list[tuple]:
    """For each quantile two values that enclose its ranks, with few enough rows strictly between them.

    A round sketches what lies between the present ends and counts what lies around the new ones. Either both ranks
    are inside the new bracket and it is taken, or the margin is doubled. An end that moves lies strictly inside the
    old bracket, so rows between get fewer with each bracket; the driver reads a few numbers per quantile and round.
    """
    value = F.col("value")
    share = max(1, bound // len(probabilities))
    ranks = [(math.floor(p * (size - 1)), math.ceil(p * (size - 1))) for p in probabilities]
    found = [(None, None, 0, size)] * len(probabilities)  # low, high, rows up to low, rows strictly between
    margins = [2.0] * len(probabilities)
    wide = list(range(len(probabilities)))
    while wide:
        sketches = []
        for i in wide:
            low, high, upto, between = found[i]
            margin = margins[i] * (1 / ACCURACY + 1 / between)
            ends = [(ranks[i][0] - upto) / between - margin, (ranks[i][1] - upto) / between + margin]
            held = value if low is None else F.when((F.lit(low) < value) & (value < F.lit(high)), value)
            sketches.append(F.percentile_approx(held, [min(1.0, max(0.0, e)) for e in ends], ACCURACY))
        tried = []
        for i, (low, high) in zip(wide, values.agg(*sketches).first()):
            old_low, old_high, upto, between = found[i]
            tried.append((old_low if ranks[i][0] < upto else low, old_high if ranks[i][1] >= upto + between else high))
        counted = values.agg(*[
            F.count_if(c) for low, high in tried
            for c in (value < F.lit(low), value <= F.lit(low), value < F.lit(high), value <= F.lit(high))
        ]).first()
        for n, (i, (low, high)) in enumerate(zip(wide, tried)):
            before_low, upto_low, before_high, upto_high = counted[4 * n : 4 * n + 4]
            if before_low <= ranks[i][0] and ranks[i][1] < upto_high:
                found[i] = low, high, upto_low, max(0, before_high - upto_low)
                margins[i] = 2.0
            else:
                margins[i] *= 2
        wide = [i for i in wide if found[i][3] > share]
    return [(low, high) for low, high, _, _ in found]


def exact_quantiles(
    df: DataFrame, column: str, probabilities: list[float], names: list[str], bound: int = BOUND
) -> DataFrame:
    """One row of linearly interpolated quantiles of the non-null values of ``column``.

    The built-in exact percentile keeps every distinct value in one task. Here, beyond ``bound`` rows, sketches
    first narrow a bracket around each quantile until all of them hold at most about ``bound`` values. A last pass
    keeps single values only inside the brackets and one count for each gap between them, so one task orders at most
    about ``bound`` values whatever the size of the data.
    """
    values = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
    size = values.count()
    value = F.col("value")
    if size <= bound:
        kept = values.select("value", F.lit(False).alias("gap"))
    else:
        brackets = _brackets(values, size, probabilities, bound)
        inside = reduce(lambda a, b: a | b, [value.between(F.lit(low), F.lit(high)) for low, high in brackets])
        # highest bracket end below the value; null sorts first and stands for "below every bracket"
        below = F.array_max(F.array(*[F.when(F.lit(high) < value, F.lit(high)) for _, high in brackets]))
        kept = values.select(F.when(inside, value).otherwise(below).alias("value"), (~inside).alias("gap"))
    counted = kept.groupBy("value", "gap").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(0))
    order = whole.orderBy(F.col("value").asc_nulls_first(), "gap")
    ranked = (
        counted.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("start", F.col("upto") - F.col("n"))
    )

    picks = []
    for i, p in enumerate(probabilities):
        place = F.lit(p) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            held = ~F.col("gap") & (F.col("start") <= rank) & (rank < F.col("upto"))
            picks.append(F.max(F.when(held, value)).alias(f"_{side}{i}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_part{i}"))
    found = ranked.agg(*picks)

    def quantile(i: int, name: str):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return (low + (high - low) * F.col(f"_part{i}")).cast("double").alias(name)

    return found.select(*[quantile(i, name) for i, name in enumerate(names)])


def histogram_quantiles(df: DataFrame, column: str, probabilities: list[float], bound: int = BOUND) -> list[float | None]:
    """Linearly interpolated quantiles of the non-null values of ``column``, from one scan of ``df``.

    That scan counts the rows of each different value, with map-side sums. The counts are then cut into ranges of
    about ``bound`` values; one number per range tells which of them hold the ranks asked for, and only those are put
    in order, a task for each. Without any value the quantiles are None.
    """
    value, n = F.col("value"), F.col("n")
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    stored = materialize(counts, "value-counts")
    distinct, total = stored.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not distinct:
        return [None] * len(probabilities)
    ranges = -(-distinct // bound)
    placed = stored.withColumn("part", F.lit(0))
    if ranges > 1:
        placed = materialize(stored.repartitionByRange(ranges, "value").withColumn("part", F.spark_partition_id()), "value-ranges")
    places = [p * (total - 1) for p in probabilities]
    wanted = sorted({rank for place in places for rank in (math.floor(place), math.ceil(place))})
    offsets, before = {}, 0
    for part, rows in sorted(map(tuple, placed.groupBy("part").agg(F.sum("n")).collect())):  # one row per range
        if any(before <= rank < before + rows for rank in wanted):
            offsets[part] = before
        before += rows
    some = placed.filter(F.col("part").isin(list(offsets)))
    begin = F.coalesce(*[F.when(F.col("part") == part, F.lit(offset)) for part, offset in offsets.items()])
    upto = begin + F.sum("n").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    held = some.withColumn("upto", upto).select("value", "upto", (F.col("upto") - n).alias("start"))
    found = held.agg(*[F.max(F.when((F.col("start") <= r) & (F.lit(r) < F.col("upto")), value)) for r in wanted]).first()
    at = {rank: float(v) for rank, v in zip(wanted, found)}
    discard(stored, placed)
    return [at[math.floor(x)] + (at[math.ceil(x)] - at[math.floor(x)]) * (x - math.floor(x)) for x in places]
