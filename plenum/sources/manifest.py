"""The manifest of source files, and which table each file becomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plenum.functions.text import last_segment, stem
from plenum.skew import HOT_FLOOR, salted_join

# Fixed column names of the manifest, in file order.
MANIFEST_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("url", "nome_banco_dados", "descricao")]
)
# Fixed rule for input workbooks: this ending, and not one of the network files written by the last run.
SUFFIX = ".xlsx"
OWN_OUTPUT = "REDE"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest CSV, all text, spaces kept."""
    return spark.read.csv(path, header=True, schema=MANIFEST_SCHEMA)


def manifest_files(manifest: DataFrame, url: str = "url") -> DataFrame:
    """Add ``filename``, the part of the URL after its last slash."""
    return manifest.withColumn("filename", last_segment(F.col(url)))


def resolve_table_names(
    files: DataFrame,
    manifest: DataFrame,
    suffix: str = SUFFIX,
    own_output: str = OWN_OUTPUT,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Files to load with their table: the manifest entry, or else the file stem.

    ``files`` has a ``filename``; ``manifest`` has ``filename`` and ``nome_banco_dados``. Of repeated manifest
    entries the largest name counts. ``in_manifest`` shows which rule gave the name.
    """
    wanted = files.filter(F.col("filename").endswith(suffix) & ~F.col("filename").contains(own_output))
    entries = manifest.groupBy("filename").agg(F.max("nome_banco_dados").alias("_table"))
    return (
        salted_join(wanted, entries, ["filename"], "left", floor=floor)
        .withColumn("in_manifest", F.col("_table").isNotNull())
        .withColumn("table_name", F.coalesce("_table", stem(F.col("filename"))))
        .drop("_table")
    )
