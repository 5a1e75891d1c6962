"""Vertex, edge and graph exchange files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements of one XML file, about 60 MB: a file is read by one task, and few megabytes of Parquet become very many of XML.
FILE_ROWS = 250_000


def write_vertices(vertices: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Write the vertex report; the key column is named ID."""
    named = vertices.withColumnRenamed("id", "ID") if "id" in vertices.columns else vertices
    named.write.mode("overwrite").format(fmt).options(**options).save(path)


def edge_report(edges: DataFrame) -> DataFrame:
    """Edges with the report's column names: weight, Origem, Destino, then any other column."""
    others = [c for c in edges.columns if c not in ("src", "dst", "weight")]
    return edges.select("weight", F.col("src").alias("Origem"), F.col("dst").alias("Destino"), *others)


def write_edges(edges: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Write :func:`edge_report`."""
    edge_report(edges).write.mode("overwrite").format(fmt).options(**options).save(path)


def _attvalues(names: list[str]):
    """Attribute values in the nesting of GEXF, by attribute number; a NULL attribute is left out."""
    values = [
        F.struct(F.lit(str(i)).alias("_for"), F.col(f"`{name}`").cast("string").alias("_value"))
        for i, name in enumerate(names)
    ]
    present = F.filter(F.array(*values), lambda v: v["_value"].isNotNull())
    return F.struct(present.alias("attvalue")).alias("attvalues")


# Fixed type names of the exchange format.
XML_TYPES = {"bigint": "long", "int": "integer", "smallint": "integer", "tinyint": "integer", "double": "double",
             "float": "float", "boolean": "boolean"}


def export_graph_xml(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Write the network as GEXF-shaped XML with Spark's XML writer.

    Below ``path``: ``nodes`` and ``edges`` with one element per row, and ``attributes`` with the number, name and
    type of each vertex and edge attribute. Every executor writes its own files, of at most ``FILE_ROWS`` elements;
    there is no single envelope.
    """
    spark = vertices.sparkSession
    names = [c for c in vertices.columns if c not in ("id", "has_attrs")]
    ends = edges.withColumns({"Origem": F.col("src"), "Destino": F.col("dst")})
    edge_names = [c for c in ends.columns if c not in ("src", "dst", "weight")]
    id_text, pair = F.col("id").cast("string"), F.concat_ws("-", "src", "dst")

    nodes = vertices.select(id_text.alias("_id"), id_text.alias("_label"), _attvalues(names))
    links = ends.select(
        pair.alias("_id"), F.col("src").cast("string").alias("_source"), F.col("dst").cast("string").alias("_target"),
        F.col("weight").alias("_weight"), _attvalues(edge_names),
    )
    declared = [
        (owner, str(i), name, XML_TYPES.get(frame.schema[name].dataType.simpleString(), "string"))
        for owner, frame, columns in (("node", vertices, names), ("edge", ends, edge_names))
        for i, name in enumerate(columns)
    ]
    attributes = spark.createDataFrame(declared, "_class string, _id string, _title string, _type string")
    for rows, root, tag in ((nodes, "nodes", "node"), (links, "edges", "edge"), (attributes, "attributes", "attribute")):
        rows.write.mode("overwrite").format("xml").option("rootTag", root).option("rowTag", tag).option(
            "maxRecordsPerFile", FILE_ROWS).save(f"{path}/{root}")


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    """``class, id, attribute, type, value``: every attribute value of an exported network under its declared name."""
    declared = spark.read.format("xml").option("rowTag", "attribute").schema(
        "_class string, _id string, _title string, _type string").load(f"{path}/attributes")
    frames = []
    for kind, root, tag in (("node", "nodes", "node"), ("edge", "edges", "edge")):
        rows = spark.read.format("xml").option("rowTag", tag).schema(
            "_id string, attvalues struct<attvalue: array<struct<_for: string, _value: string>>>").load(f"{path}/{root}")
        frames.append(rows.select(F.lit(kind).alias("class"), F.col("_id").alias("id"), F.inline("attvalues.attvalue")))
    names = declared.select(F.col("_class").alias("class"), F.col("_id").alias("_for"), F.col("_title").alias("attribute"),
                            F.col("_type").alias("type"))
    # one row per attribute of the schema, so Spark sends it to all tasks
    return frames[0].unionByName(frames[1]).join(names, ["class", "_for"]).select(
        "class", "id", "attribute", "type", F.col("_value").alias("value"))


def read_graph_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Vertices ``id, label`` and edges ``src, dst, weight`` of an exported network."""
    def rows(root: str, tag: str, schema: str) -> DataFrame:
        return spark.read.format("xml").option("rowTag", tag).schema(schema).load(f"{path}/{root}")

    nodes = rows("nodes", "node", "_id string, _label string")
    links = rows("edges", "edge", "_source string, _target string, _weight double")
    return (
        nodes.select(F.col("_id").cast("bigint").alias("id"), F.col("_label").alias("label")),
        links.select(
            F.col("_source").cast("bigint").alias("src"), F.col("_target").cast("bigint").alias("dst"),
            F.col("_weight").alias("weight"),
        ),
    )
