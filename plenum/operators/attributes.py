"""Vertex attributes as maps, so that a vertex without a field and one whose field is NULL differ field by field."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.operators.graph import attach_attributes


def _map_of(names: list[str]) -> Column:
    """Every column as text under its name, a NULL one as a key without value."""
    pairs = [part for c in names for part in (F.lit(c), F.col(f"`{c.replace('`', '``')}`").cast("string"))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def _overwritten(old: Column, new: Column) -> Column:
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)


def attach_maps(ids: DataFrame, sources: list[DataFrame], order_col: str | None = None) -> DataFrame:
    """``id, attrs`` of every network vertex: the fields that the ``sources`` give it, as MAP<STRING, STRING>.

    A source has ``id`` and fields; it gives each of its vertices all its fields, NULL ones too, and others none. A
    field that several sources give has the value of the last of them, even if that is NULL. Rows of vertices outside
    the network are ignored, and of repeated rows one counts, as in :func:`attach_attributes`. Vertices in no source
    have an empty map. All joins are on ``id``, so the vertices are shuffled once.
    """
    empty = F.create_map().cast("map<string,string>")

    def attached(found: DataFrame, source: DataFrame) -> DataFrame:
        names = [c for c in source.columns if c not in ("id", order_col)]
        given = attach_attributes(ids, source.select("id", _map_of(names).alias("_entries"), *([order_col] if order_col else []))
                                  .withColumn("_entries", F.array_sort(F.map_entries("_entries"))), order_col)
        new = given.select("id", F.coalesce(F.map_from_entries("_entries"), empty).alias("_new"))
        return found.join(new, "id").select("id", _overwritten(F.col("attrs"), F.col("_new")).alias("attrs"))

    start = ids.select(F.col("id").cast("bigint").alias("id"), empty.alias("attrs"))
    return reduce(attached, sources, start)


def with_fields(vertices: DataFrame, fields: dict[str, str], present: str | None = None) -> DataFrame:
    """``id`` and the ``fields`` of the given types as columns; NULL where a vertex has no such field or a NULL one.

    ``has_attrs`` tells whether the vertex has the field ``present`` (by default the first), so the shares of those
    who have it come from :func:`plenum.operators.profile.category_shares`.
    """
    return vertices.select(
        "id", *[F.col("attrs")[name].cast(kind).alias(name) for name, kind in fields.items()],
        F.map_contains_key("attrs", present or next(iter(fields))).alias("has_attrs"))


def field_presence(vertices: DataFrame, fields: list[str]) -> DataFrame:
    """``field, n_valued, n_null, n_lacking``: vertices with a value, with NULL and without the field; one pass."""
    def counts(i: int, name: str) -> list[Column]:
        has, value = F.map_contains_key("attrs", name), F.col("attrs")[name]
        return [F.count_if(value.isNotNull()).alias(f"v{i}"), F.count_if(has & value.isNull()).alias(f"n{i}"),
                F.count_if(~has).alias(f"l{i}")]

    told = [c for i, name in enumerate(fields) for c in counts(i, name)]
    rows = [F.struct(F.lit(name).alias("field"), F.col(f"v{i}").alias("n_valued"), F.col(f"n{i}").alias("n_null"),
                     F.col(f"l{i}").alias("n_lacking")) for i, name in enumerate(fields)]
    return vertices.agg(*told).select(F.inline(F.array(*rows)))
