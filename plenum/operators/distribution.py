"""Quartiles, outlier fences and labels of a numeric column, and the numbers behind a box plot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.functions.quantiles import exact_quantiles

# Fixed values of the report: quartile labels in order, and low outlier, high outlier, neither.
QUARTILES = ["1", "2", "3", "4"]
LOW, HIGH, NEITHER = "SI", "SS", "N"
WHISKER = 1.5


def quartiles(df: DataFrame, column: str) -> DataFrame:
    """First, second and third quartile by linear interpolation, one row ``q1, q2, q3``."""
    return exact_quantiles(df, column, [0.25, 0.5, 0.75], ["q1", "q2", "q3"])


def iqr_fences(df: DataFrame, column: str) -> DataFrame:
    """Quartiles with the limits beyond which a value is an outlier."""
    spread = F.col("q3") - F.col("q1")
    return quartiles(df, column).select(
        "*",
        (F.col("q1") - WHISKER * spread).alias("fence_lo"),
        (F.col("q3") + WHISKER * spread).alias("fence_hi"),
    )


def quartile_label(df: DataFrame, column: str, limits=None, name: str = "Quartil") -> DataFrame:
    """Add the quartile of each value, right-closed; equal quartiles give the lowest matching label.

    ``limits`` is a row of :func:`quartiles` or :func:`iqr_fences` when the caller already has it. The three
    numbers become constants of the projection.
    """
    q = limits or quartiles(df, column).first()
    x = F.col(column)
    label = F.when(x <= F.lit(q["q1"]), QUARTILES[0])
    label = label.when(x <= F.lit(q["q2"]), QUARTILES[1]).when(x <= F.lit(q["q3"]), QUARTILES[2])
    return df.withColumn(name, label.when(x > F.lit(q["q3"]), QUARTILES[3]))


def outlier_label(df: DataFrame, column: str, limits=None, name: str = "Outlier") -> DataFrame:
    """Add the outlier label: strictly below the lower fence, strictly above the upper one, or neither."""
    q = limits or iqr_fences(df, column).first()
    x = F.col(column)
    label = F.when(x < F.lit(q["fence_lo"]), LOW).when(x > F.lit(q["fence_hi"]), HIGH).otherwise(NEITHER)
    return df.withColumn(name, label)


def quartile_counts(labelled: DataFrame, label: str = "Quartil") -> DataFrame:
    """Rows per quartile in order, empty quartiles included."""
    counts = labelled.agg(*[F.count_if(F.col(label) == q).alias(q) for q in QUARTILES])
    rows = F.array(*[F.struct(F.lit(q).alias(label), F.col(f"`{q}`").alias("n")) for q in QUARTILES])
    return counts.select(F.inline(rows)).orderBy(label)


def outlier_counts(labelled: DataFrame, label: str = "Outlier") -> DataFrame:
    """Number of high and low outliers, one row."""
    return labelled.agg(
        F.count_if(F.col(label) == HIGH).alias("superiores"), F.count_if(F.col(label) == LOW).alias("inferiores")
    )


def boxplot_stats(df: DataFrame, column: str) -> DataFrame:
    """Box and whiskers, one row; a whisker ends at the furthest value inside the fence, or at the box."""
    q = iqr_fences(df, column).first()
    x = F.col(column).cast("double")
    q1, q3 = F.lit(q["q1"]).cast("double"), F.lit(q["q3"]).cast("double")
    lo, hi = F.min(F.when(x >= F.lit(q["fence_lo"]), x)), F.max(F.when(x <= F.lit(q["fence_hi"]), x))
    return df.agg(F.count(column).alias("n"), lo.alias("_lo"), hi.alias("_hi")).select(
        "n", q1.alias("q1"), F.lit(q["q2"]).cast("double").alias("median"), q3.alias("q3"),
        F.least(F.col("_lo"), q1).alias("whisker_lo"), F.greatest(F.col("_hi"), q3).alias("whisker_hi"),
    )
