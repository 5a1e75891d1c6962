"""Distributions and shares of vertex attributes, and chart-ready points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.functions.text import capitalised, percent_text, words
from plenum.session import materialize
from plenum.skew import HOT_FLOOR, salted_join

JITTER = 0.09  # fixed half width of the strip


def attribute_distribution(vertices: DataFrame, field: str) -> DataFrame:
    """Vertices per value of a field; vertices without it are one NULL group."""
    return vertices.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def cross_share(vertices: DataFrame, field1: str, field2: str, floor: int = HOT_FLOOR) -> DataFrame:
    """For each value of ``field1``, count and percentage of each value of ``field2``.

    Totals come from the stored counts, not from the vertices. A value with very many values of ``field2`` is split in
    their join; in a struct, a NULL is a key like others.
    """
    counted = vertices.groupBy(field1, field2).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counted, "cross-counts").withColumn("_of", F.struct(field1))
    totals = counts.groupBy("_of").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("_rows"))
    return (
        salted_join(counts, totals.drop("_rows"), ["_of"], sizes=totals, spread=[field2], floor=floor)
        .select(field1, field2, "n", "total", (F.col("n") / F.col("total") * 100).alias("pct"))
    )


def dominant_category(vertices: DataFrame, field1: str, field2: str) -> DataFrame:
    """For each value of ``field1`` the most frequent value of ``field2``; ties go to the smallest, NULL last.

    The winner is a struct minimum, merged on the map side, so no group is sorted or gathered.
    """
    counts = vertices.groupBy(field1, field2).agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct((-F.col("n")).alias("minus_n"), F.col(field2).isNull().alias("missing"), F.col(field2))
    return (
        counts.groupBy(field1)
        .agg(F.min(rank).alias("best"), F.sum("n").alias("total"))
        .select(field1, F.col("best")[field2].alias(field2), (-F.col("best.minus_n")).alias("n"), "total")
        .withColumn("pct", F.col("n") / F.col("total") * 100)
    )


def _shares(vertices: DataFrame, field: str) -> DataFrame:
    counts = attribute_distribution(vertices, field)
    total = vertices.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100)


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def category_shares(vertices: DataFrame, field: str) -> DataFrame:
    """Count and percentage per value among vertices that have attributes, with the donut label.

    Of vertices from :func:`plenum.operators.attributes.with_fields` those count that have this very field.
    """
    present = vertices.filter("has_attrs") if "has_attrs" in vertices.columns else vertices
    label = F.concat(
        capitalised(F.lit(field)), F.lit(" "), _shown(F.col("value")), F.lit(" ("), F.col("n").cast("string"),
        F.lit(" ocorrências - "), percent_text(F.col("pct"), 1), F.lit(")"),
    )
    return _shares(present, field).withColumn("label", label)


def group_shares(vertices: DataFrame, color: str) -> DataFrame:
    """Count and percentage of all vertices per colour group, with the legend label."""
    label = F.concat(
        F.lit("Comunidade "), _shown(F.col("value")), F.lit(": "), F.col("n").cast("string"), F.lit(" ("),
        percent_text(F.col("pct"), 2), F.lit(")"),
    )
    return _shares(vertices, color).withColumn("label", label)


def strip_points(df: DataFrame, value: str, color: str, seed: int = 0) -> DataFrame:
    """One point per vertex: jittered x, value y, its logarithm where it has one, and the colour group.

    The jitter is a hash of id and seed, so it does not change when a task is run again.
    """
    unit = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    y = F.col(value).cast("double")
    return df.select(
        "id", ((unit * 2 - 1) * JITTER).alias("x"), y.alias("y"),
        F.when(y > 0, F.log10(y)).alias("log_y"), F.col(color).alias("color"),
    )


def strip_chart(df: DataFrame, value: str, color: str, seed: int = 0) -> DataFrame:
    """:func:`strip_points` with the titles of both axes: the field's and the group's name in words."""
    return strip_points(df, value, color, seed).withColumns(
        {"y_title": words(F.lit(value)), "color_title": words(F.lit(color))})
