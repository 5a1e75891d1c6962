"""The network as a pair of tables: vertices by ``id`` and edges by ``src``, ``dst``, ``weight``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.operators.near_paths import named, stars
from plenum.session import discard, materialize
from plenum.skew import HOT_FLOOR, salted_join

# Links between vertices from which one task may find the components.
FEW_LINKS = 4_000_000


def canonical_edges(edges: DataFrame, order_col: str | None = None) -> DataFrame:
    """One undirected edge per pair, smaller end first.

    Of repeated or reversed rows the last by ``order_col`` counts, or without an order the largest weight.
    """
    ends = [F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")]
    held = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if not order_col:
        return held.groupBy(*ends).agg(F.max("weight").alias("weight"))
    # the largest weight per place in the order, then the last place: both are summed up by hash, a struct would be sorted
    placed = held.groupBy(*ends, F.col(order_col).alias("_order")).agg(F.max("weight").alias("weight"))
    last = F.coalesce(F.max_by("weight", "_order"), F.max(F.when(F.col("_order").isNull(), F.col("weight"))))
    return placed.groupBy("src", "dst").agg(last.alias("weight"))


def symmetric_edges(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, a self-loop once, in one pass over the edges."""
    there = F.struct(F.col("src"), F.col("dst"), F.col("weight"))
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("weight"))
    both = F.when(F.col("src") == F.col("dst"), F.array(there)).otherwise(F.array(there, back))
    return edges.select(F.inline(both))


def vertex_ids(edges: DataFrame) -> DataFrame:
    """Vertices of the network: every end point of an edge, once."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def components(edges: DataFrame, a: str = "src", b: str = "dst", few: int = FEW_LINKS) -> DataFrame:
    """``id, component`` of every end of an edge, a stored table; the component is its smallest vertex.

    Each task leaves at most an edge per vertex, and if few are left one task names them all. Else each round links every
    vertex to the smallest it knows, chains of such links are halved until they are stars, and the edges left are those
    between stars, named by their centres: there are ever fewer, and none in the end.
    """
    linked = edges.select(F.least(a, b).cast("bigint").alias("u"), F.greatest(a, b).cast("bigint").alias("v"))
    ends = materialize(linked.mapInPandas(stars, "u bigint, v bigint"), "stars")
    if ends.count() <= few:
        alone = materialize(ends.repartition(1).mapInPandas(named, "id bigint, component bigint"), "components")
        discard(ends)
        return alone
    both = ends.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    places, left = None, None
    while True:
        found = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("root"))
        roots = materialize(found, "roots")
        while True:
            up = roots.select(F.col("u").alias("root"), F.col("root").alias("top"))
            jumped = materialize(roots.join(up, "root").select("u", F.col("top").alias("root"), (F.col("top") < F.col("root")).alias("up")), "roots")
            discard(roots)
            roots = jumped
            if roots.filter("up").isEmpty():
                break
        if places is None:
            grown = roots.select(F.col("u").alias("id"), F.col("root").alias("component"))
        else:
            grown = places.join(roots.select(F.col("u").alias("component"), "root"), "component", "left").select(
                "id", F.coalesce("root", "component").alias("component"))
        grown = materialize(grown, "components")
        one, two = (roots.select(F.col("u").alias(end), F.col("root").alias(f"{end}_root")) for end in ("u", "v"))
        across = both.filter("u < v").join(one, "u").join(two, "v").filter("u_root <> v_root").select(
            F.inline(F.array(F.struct(F.col("u_root").alias("u"), F.col("v_root").alias("v")),
                             F.struct(F.col("v_root").alias("u"), F.col("u_root").alias("v"))))).distinct()
        after = materialize(across, "links")
        discard(places, left, roots)
        places, left, both = grown, after, after
        if after.isEmpty():
            discard(after, ends)
            return places


def attach_attributes(ids: DataFrame, attributes: DataFrame, order_col: str | None = None) -> DataFrame:
    """Network vertices with their attributes; ``has_attrs`` tells a missing row from NULL attributes.

    Keys are compared as BIGINT. Of repeated rows the last by ``order_col`` counts, or else the one with the
    smallest attributes; a struct minimum picks it on the map side, so a repeated key is never gathered.
    """
    names = [c for c in attributes.columns if c != "id" and c != order_col]
    row = F.struct(*names)
    chosen = F.max(F.struct(F.col(order_col), row.alias("row")))["row"] if order_col else F.min(row)
    unique = (
        attributes.groupBy(F.col("id").cast("bigint").alias("id"))
        .agg(chosen.alias("row"))
        .select("id", "row.*", F.lit(True).alias("has_attrs"))
    )
    return (
        ids.select(F.col("id").cast("bigint").alias("id"))
        .join(unique, "id", "left")
        .withColumn("has_attrs", F.coalesce("has_attrs", F.lit(False)))
    )


def graph_size(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of vertices and edges, one row."""
    count = F.count(F.lit(1))
    return vertices.agg(count.alias("n_nodes")).withColumn("n_edges", edges.agg(count).scalar())


def label_ends(edges: DataFrame, membership: DataFrame, label: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Edges with the label of both ends as ``src_label`` and ``dst_label``; NULL when an end has none."""
    labelled = edges
    for end in ("src", "dst"):
        lookup = membership.select(F.col("id").alias(end), F.col(label).alias(f"{end}_label"))
        # sizes from the stored edges, not from the join before
        sizes = edges.groupBy(end).agg(F.count(F.lit(1)).alias("_rows"))
        labelled = salted_join(labelled, lookup, [end], "left", sizes=sizes, spread=["src", "dst"], floor=floor)
    return labelled


def induced_edges(edges: DataFrame, membership: DataFrame, label: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Edges with both ends in the same group, with that group as ``label``."""
    return (
        label_ends(edges, membership, label, floor)
        .filter("src_label = dst_label")
        .select("src", "dst", "weight", F.col("src_label").alias(label))
    )


def both_ends(*fields: Column) -> Column:
    """Generator of one row per end point; each field is a struct of the columns for that end."""
    return F.inline(F.array(*fields))
