"""Density, strength, modularity and the bridging coefficient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.functions.text import safe_ratio
from plenum.operators.graph import both_ends, induced_edges, label_ends, symmetric_edges
from plenum.session import materialize
from plenum.skew import HOT_FLOOR, salted_join


def _density(weight: Column, n: Column) -> Column:
    n = n.cast("double")
    return safe_ratio(weight, n * (n - 1) / 2)


def weighted_density(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Sum of weights over the number of possible edges, one row; 0 for fewer than two vertices."""
    weight = edges.agg(F.coalesce(F.sum("weight"), F.lit(0))).scalar()
    return (
        vertices.agg(F.count(F.lit(1)).alias("n_nodes"))
        .withColumn("total_weight", weight)
        .withColumn("density", _density(F.col("total_weight"), F.col("n_nodes")))
    )


def weighted_density_by(vertices: DataFrame, edges: DataFrame, label: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Weighted density inside each group; a group without inner edges gives 0, vertices without label none."""
    inner = (
        induced_edges(edges, vertices, label, floor).groupBy(label).agg(F.sum("weight").alias("total_weight"))
    )
    return (
        vertices.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n_nodes"))
        .join(inner, label, "left")
        .withColumn("total_weight", F.coalesce("total_weight", F.lit(0)))
        .withColumn("density", _density(F.col("total_weight"), F.col("n_nodes")))
    )


def strength(edges: DataFrame) -> DataFrame:
    """Sum of edge weights at each vertex, a self-loop once, and the number of neighbours."""
    return (
        symmetric_edges(edges)
        .groupBy(F.col("src").alias("id"))
        .agg(F.sum("weight").alias("strength"), F.count(F.lit(1)).alias("degree"))
    )


def modularity(
    edges: DataFrame, membership: DataFrame, label: str, resolution: float = 1.0, floor: int = HOT_FLOOR
) -> DataFrame:
    """Modularity of a partition, one row; vertices with a NULL label form one group.

    Each edge gives one row per end with its inner weight and its share of the group's strength, so one grouped
    sum yields both; a self-loop counts twice in strength.
    """
    w = F.col("weight").cast("double")
    same = F.col("src_label").eqNullSafe(F.col("dst_label"))
    ends = label_ends(edges, membership, label, floor).select(
        both_ends(
            F.struct(F.col("src_label").alias("label"), F.when(same, w).otherwise(0.0).alias("inner"), w.alias("k")),
            F.struct(F.col("dst_label").alias("label"), F.lit(0.0).alias("inner"), w.alias("k")),
        )
    )
    groups = ends.groupBy("label").agg(F.sum("inner").alias("inner"), F.sum("k").alias("k"))
    # Q = sum(inner)/m - resolution * sum(k^2)/(2m)^2 with 2m = sum(k)
    k2, twice_m = F.sum(F.col("k") * F.col("k")), F.sum("k")
    q = F.sum("inner") * 2 / twice_m - F.lit(resolution) * k2 / (twice_m * twice_m)
    return groups.agg(F.count(F.lit(1)).alias("n_groups"), q.alias("modularity"))


def bridging_coefficient(edges: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Sum over the neighbours of a vertex of one over the neighbour's strength; only positive strengths count.

    Strength is summed once per vertex and written, then looked up per neighbour.
    """
    node = materialize(strength(edges), "strength")
    neighbours = symmetric_edges(edges).select(F.col("src").alias("id"), F.col("dst").alias("other"))
    lookup = node.select(F.col("id").alias("other"), "strength")
    sizes = node.select(F.col("id").alias("other"), F.col("degree").alias("_rows"))
    share = F.when(F.col("strength") > 0, 1 / F.col("strength").cast("double")).otherwise(0.0)
    return (
        salted_join(neighbours, lookup, ["other"], sizes=sizes, floor=floor)
        .groupBy("id")
        .agg(F.sum(share).alias("coef_ponte"))
    )
