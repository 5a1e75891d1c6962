"""Sharding by extendible hashing: a directory of hash prefixes in which only oversized buckets split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plenum.llm.text import fresh
from plenum.session import discard, materialize

LIMIT = 32 << 20
#: Bits that one pass over the rows decides at most.
STRIDE = 8
BITS = 64


def prefix(h: Column, bits: int) -> Column:
    """The first ``bits`` bits of a hash, as a number."""
    return F.shiftrightunsigned(h, BITS - bits) if bits else F.lit(0).cast("bigint")


def assign_shards(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, row: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``key, n_bytes, shard, depth, shard_bytes``, and ``row`` if it names a unique number of rows.

    A shard is the bucket of all rows whose hash begins with its bits; ``shard`` spells them as text and ``depth``
    is their number. From the empty prefix on, a bucket with more than ``limit`` bytes of text splits on the next
    bit, the others stay. A pass sums bytes for the next 8 bits of rows that are still in oversized buckets, finds
    their buckets, and hands on the rest; the sums are grouped with map-side combination, so large keys do no harm.
    The first 32 bits are a hash of the key, then come 32 of a stored row number, so that rows of one key can be
    told apart; only a single text larger than ``limit`` stays oversized, alone. A null text has 0 bytes, a null
    key is a key; an empty table has no shards.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    stored = materialize(docs.select(
        F.col(key).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), number.alias("row")), "shard-rows")
    low = F.shiftrightunsigned(F.xxhash64("row"), 32)
    high = F.shiftleft(F.shiftrightunsigned(F.xxhash64("id"), 32), 32)
    pending = stored.select("id", "n_bytes", "row", high.bitwiseOR(low).alias("h"))
    done, start = [], 0
    while start < BITS:
        end = min(BITS, start + STRIDE)
        cells = pending.groupBy(prefix(F.col("h"), end).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        for bits in range(start, end + 1):
            inside = Window.partitionBy(F.shiftright("cell", end - bits))
            cells = cells.withColumn(f"bytes_{bits}", F.sum("bytes").over(inside)).withColumn(f"rows_{bits}", F.sum("rows").over(inside))
        # the shortest prefix that fits; a bucket of one row can't be split
        pick = reduce(lambda other, b: F.when((F.col(f"bytes_{b}") <= limit) | (F.col(f"rows_{b}") == 1),
                                              F.struct(F.lit(b).alias("depth"), F.col(f"bytes_{b}").alias("shard_bytes"))).otherwise(other),
                      range(end, start - 1, -1), F.lit(None).cast("struct<depth:int,shard_bytes:bigint>"))
        if end == BITS:
            pick = F.coalesce(pick, F.struct(F.lit(end).alias("depth"), F.col(f"bytes_{end}").alias("shard_bytes")))
        directory = materialize(cells.select("cell", pick.alias("s")), "directory")
        met = pending.withColumn("cell", prefix(F.col("h"), end)).join(directory, "cell")
        name = F.substr(F.lpad(F.bin("cell"), end, "0"), F.lit(1), F.col("s.depth")) if end else F.lit("")
        done.append(met.filter("s IS NOT NULL").select(
            F.col("id").alias(key), "n_bytes", name.alias("shard"), F.col("s.depth").alias("depth"),
            F.col("s.shard_bytes").alias("shard_bytes"), *([F.col("row").alias(row)] if row else [])))
        if directory.filter("s IS NULL").isEmpty():
            break
        pending = materialize(met.filter("s IS NULL").select("id", "n_bytes", "row", "h"), "shard-rest")
        start = end
    return reduce(DataFrame.unionByName, done)


def directory_of(shards: DataFrame) -> DataFrame:
    """``shard, depth, shard_bytes, rows`` per shard."""
    return shards.groupBy("shard", "depth", "shard_bytes").agg(F.count(F.lit(1)).alias("rows"))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Write the rows of ``docs`` below ``path``, one folder per shard, and return the directory of the shards.

    A folder is named ``shard=b`` and the shard's bits (another free name if ``docs`` has a column ``shard``). Rows are
    numbered and stored first and find their shard by number, so null and repeated keys and equal rows all come back once.
    """
    row, folder = fresh(docs, "_row"), fresh(docs, "shard")
    stored = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "shard-docs")
    shards = materialize(assign_shards(stored, key, text, limit, row), "shards")
    placed = stored.join(shards.select(row, F.concat(F.lit("b"), "shard").alias("_bits")), row)
    # a shard is no larger than the limit, or one row
    placed.select(*docs.columns, F.col("_bits").alias(folder)).repartition(folder).write.mode("overwrite").partitionBy(folder).parquet(path)
    discard(stored)
    return directory_of(shards)
