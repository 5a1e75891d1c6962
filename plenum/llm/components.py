"""Connected components of a graph of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.session import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component`` for every end of a link; the component is its smallest id.

    Alternates two star steps until the links are one star per component: each vertex first hands its larger, then
    its smaller neighbours to the smallest one it knows. The links of a step are at most as many as those before it;
    the driver sees a count and a checksum per round. A vertex with very many links is the short side of a join whose
    large keys Spark splits, and minima are taken before rows move.
    """
    now = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    told = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smallest.select("u", F.col("m").alias("v")))
        now = materialize(small.filter("u <> v").distinct(), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if told == tuple(state):
            break
        told = tuple(state)
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
