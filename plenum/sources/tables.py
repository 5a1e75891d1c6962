"""Raw tables, all text with measured widths, and the network tables read back from the catalogue."""

from __future__ import annotations

import re
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_database(spark: SparkSession, name: str) -> None:
    """Create the database unless it exists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to string."""
    return df.select(*[_quoted(c).cast("string").alias(c) for c in df.columns])


def varchar_widths(df: DataFrame) -> DataFrame:
    """Longest text per column, at least 1, as ``column, width``; NULL has no width. One pass."""
    widths = [
        F.greatest(F.lit(1), F.coalesce(F.max(F.length(_quoted(c).cast("string"))), F.lit(1))).alias(f"w{i}")
        for i, c in enumerate(df.columns)
    ]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"w{i}").alias("width")) for i, c in enumerate(df.columns)]
    return df.agg(*widths).select(F.inline(F.array(*rows)))


def _location(spark: SparkSession, table: str) -> str | None:
    """Where the files of a table lie, if there is such a table."""
    if not spark.catalog.tableExists(table.replace("`", "")):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return told["data_type"] if told else None


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def load_table(
    source: DataFrame, table: str, location: str | None = None, measured: bool = True
) -> DataFrame:
    """Store ``source`` as text in ``table``, replacing it, and return the stored table.

    One pass over the source writes the rows beside what is there, and counts them and measures each column on the
    way; only then does the name go to the new files. A load that fails leaves the old table as it was. ``measured``
    declares each column as VARCHAR of its measured width. The stored frame has the count as ``rows_source``. Without
    ``location`` the files lie in the folder of the database.
    """
    spark = source.sparkSession
    if location is None:
        names = table.replace("`", "").split(".")
        database = names[0] if len(names) > 1 else spark.catalog.currentDatabase()
        location = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{names[-1]}"
    mark = uuid4().hex
    staged, fresh = f"{location.rstrip('/')}-{mark}", f"{table[:-1]}__{mark}`" if table.endswith("`") else f"{table}__{mark}"
    seen = Observation()
    widths = [F.max(F.length(_quoted(c))).alias(f"w{i}") for i, c in enumerate(source.columns)]
    try:
        as_text(source).observe(seen, F.count(F.lit(1)).alias("rows"), *widths).write.parquet(staged)
    except Exception:
        _remove(spark, staged)
        raise
    told = seen.get
    kinds = [f"VARCHAR({max(1, told[f'w{i}'] or 1)})" if measured else "STRING" for i in range(len(source.columns))]
    quoted = ["`" + c.replace("`", "``") + "` " + kind for c, kind in zip(source.columns, kinds)]
    place = staged.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {fresh} ({', '.join(quoted)}) USING parquet LOCATION '{place}'")
    old = _location(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if old is not None and re.search(r"-[0-9a-f]{32}$", old.rstrip("/")):
        _remove(spark, old)  # files of an earlier load
    stored = spark.table(table)
    stored.rows_source = told["rows"]
    return stored


def read_files(spark: SparkSession, paths: list[str], fmt: str = "csv", **options: str) -> DataFrame:
    """All files of one table with one reader, in one scan.

    Headers of CSV files are compared with the first file's while they are read. Of self-describing files the columns
    of all count, and all must be those of the first file; a column that one of them lacks is null there.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        return reader.option("enforceSchema", "false").load(paths)
    rows = (reader.option("mergeSchema", "true") if fmt in ("parquet", "orc") else reader).load(paths)
    if len(paths) > 1 and set(rows.columns) != set(reader.load(paths[0]).columns):
        raise ValueError(f"other columns than in {paths[0]}")
    return rows


def rows_per_file(source: DataFrame) -> DataFrame:
    """``file, rows`` of the files that a frame of :func:`read_files` reads, in one grouped count."""
    return source.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def load_tables(
    spark: SparkSession,
    resolved: DataFrame,
    folder: str,
    fmt: str = "csv",
    database: str = "default",
    location: str | None = None,
    **options: str,
) -> list[tuple[str, DataFrame, DataFrame]]:
    """Load the resolved files below ``folder``, all files of one table together; ``name, stored, source`` of each table.

    Files of one table must have the same columns; they are read by one reader. The list of files is read by the
    driver, which hands it to the reader; the rows of the files are not.
    """
    create_database(spark, database)
    loaded = []
    named = F.min("in_manifest") if "in_manifest" in resolved.columns else F.lit(None).cast("boolean")
    tables = resolved.groupBy("table_name").agg(F.array_sort(F.collect_set("filename")).alias("files"), named.alias("in_manifest"))
    for row in tables.orderBy("table_name").toLocalIterator():
        source = read_files(spark, [f"{folder.rstrip('/')}/{name}" for name in row["files"]], fmt, **options)
        place = f"{location.rstrip('/')}/{row['table_name']}" if location else None
        try:
            stored = load_table(source, f"`{database}`.`{row['table_name']}`", place)
        except Exception as error:
            if "CSV header" in str(error):
                raise ValueError(f"a file of {row['table_name']} has other columns than {row['files'][0]}") from error
            raise
        stored.in_manifest = row["in_manifest"]
        loaded.append((row["table_name"], stored, source))
    return loaded


def load_audit(loaded: list[tuple[str, DataFrame, DataFrame]], naming: bool = False) -> DataFrame:
    """Rows in each stored table against rows in its source, as counted while they were written.

    ``naming`` adds ``in_manifest``: whether the manifest gave the table its name, or else the file.
    """
    def line(name: str, stored: DataFrame, source: DataFrame) -> DataFrame:
        known = getattr(stored, "rows_source", None)
        rows = source.agg(F.count(F.lit(1))).scalar() if known is None else F.lit(known).cast("bigint")
        return stored.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
            F.lit(name).alias("table"), "rows_loaded", rows.alias("rows_source"),
            F.lit(getattr(stored, "in_manifest", None)).cast("boolean").alias("in_manifest"))

    counts = reduce(DataFrame.unionByName, [line(*entry) for entry in loaded])
    names = ["in_manifest"] if naming else []
    return counts.select("table", "rows_loaded", "rows_source", (F.col("rows_loaded") == F.col("rows_source")).alias("ok"), *names)


def read_edges(spark: SparkSession, table: str) -> DataFrame:
    """Edge table with columns SOURCE, TARGET, WEIGHT as ``src, dst, weight``.

    Whole and decimal weights stay as they are; other numbers and text become decimals, and a weight that isn't
    exactly one raises an error.
    """
    rows = spark.table(table)
    weight, kind = F.col("WEIGHT"), rows.select("WEIGHT").schema[0].dataType
    if isinstance(kind, T.IntegralType):
        weight = weight.cast("bigint")
    elif not isinstance(kind, T.DecimalType):
        exact = weight.try_cast("decimal(38,9)")
        same = exact.cast("double") == weight.cast("double")
        weight = F.when(weight.isNull() | same, exact).otherwise(
            F.raise_error(F.lit("weight is no decimal")).cast("decimal(38,9)"))
    keys = [F.col(c).cast("bigint").alias(name) for c, name in (("SOURCE", "src"), ("TARGET", "dst"))]
    return rows.select(*keys, weight.alias("weight"))


def read_vertices(spark: SparkSession, table: str) -> DataFrame:
    """Vertex table: column ID as ``id``, all other columns as attributes."""
    rows = spark.table(table)
    others = [_quoted(c) for c in rows.columns if c.upper() != "ID"]
    return rows.select(F.col("ID").cast("bigint").alias("id"), *others)
