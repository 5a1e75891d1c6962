"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and runs of punctuation, A-Z in lower case, and their pairs within a text fall into ``buckets`` hash buckets.
Two bag-of-n-grams models, of target texts and of all texts, give each text the logarithm of the ratio of its
likelihoods. The k texts with the largest sum of this number and Gumbel noise are a sample without replacement, in
proportion to the ratios.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.functions.numbering import number_rows
from plenum.llm.text import FOLDED_BYTES, LETTERS, SPACE, blocks, gram_hashes, owners, parse_schema, running, span_hashes, with_struct
from plenum.session import materialize

BUCKETS = 10_000
#: Labelled target documents the target model is fitted on, at most: those with the smallest hashes of their ids.
TARGET_DOCS = 20_000
SEED = 20
SCORED = parse_schema("n_grams bigint,log_ratio double")

KIND = np.where(SPACE, 0, np.where(LETTERS, 1, 2))
KIND[ord("_")] = 1


def n_grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word or run of punctuation and of every pair of neighbours within a text."""
    kind = KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    cut = change | edge
    starts = np.flatnonzero(cut[:-1] & (kind > 0))
    ends = np.flatnonzero(cut[1:] & (kind > 0)) + 1
    first = np.searchsorted(starts, offsets)
    words, doc = span_hashes(running(FOLDED_BYTES[data]), starts, ends), owners(first)
    pairs = gram_hashes(words, 2)
    inner = doc[: len(pairs)] == doc[1:] if len(pairs) else np.zeros(0, bool)
    hashes = np.concatenate([words, pairs[inner]])
    return np.concatenate([doc, doc[: len(pairs)][inner]]), (hashes % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, key: str, text: str, targets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket in target texts and in all texts; a task sends two numbers per bucket."""
    chosen = docs.sparkSession.sparkContext.broadcast(targets)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            ids, texts = batch.column(0).fill_null(-1).to_numpy(), batch.column(1)
            wanted = np.isin(ids, chosen.value) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for low, high, data, offsets in blocks(texts):
                doc, bucket = n_grams(data, offsets, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[wanted[low:high][doc]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(target), pa.array(raw)], ["bucket", "target", "raw"])

    some = docs.select(F.col(key).cast("bigint"), F.col(text))
    sums = some.mapInArrow(task, "bucket bigint, target bigint, raw bigint").groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw")).collect()
    target, raw = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for row in sums:
        target[row.bucket], raw[row.bucket] = row.target, row.raw
    return target, raw


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(p_target / p_raw) per bucket, one n-gram added to each bucket of both models."""
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def score(docs: DataFrame, text: str, weights: np.ndarray, name: str) -> DataFrame:
    """``docs`` plus a struct ``name``: n-grams of the text and the sum of their ``weights``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        sizes, sums = [], []
        for low, high, data, offsets in blocks(texts):
            doc, bucket = n_grams(data, offsets, len(shared.value))
            sizes.append(np.bincount(doc, minlength=high - low))
            sums.append(np.bincount(doc, weights=shared.value[bucket], minlength=high - low))
        none = np.zeros(0)
        return {"n_grams": pa.array(np.concatenate([none, *sizes]).astype(np.int64)), "log_ratio": pa.array(np.concatenate([none, *sums]))}

    return with_struct(docs, [text], name, SCORED, work)


def target_ids(docs: DataFrame, labels: DataFrame, key: str, most: int) -> tuple[np.ndarray, int, int]:
    """Ids of at most ``most`` labelled target documents; labelled documents of good quality, and all labelled."""
    present = docs.select(F.col(key).alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    known = materialize(labels.select("doc_id", "quality", "toxic").filter("quality IS NOT NULL").distinct().join(
        present, "doc_id", "left_semi"), "labelled")
    good, total = known.agg(F.count_if(F.col("quality") == 1), F.count(F.lit(1))).first()
    top = known.filter("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return np.sort(np.array([r.doc_id for r in top.collect()], np.int64)), good, total


def sample_size(rows: int, good: int, total: int) -> int:
    """How many documents to sample: the share of good ones among the labelled, three standard errors up."""
    if not total:
        return rows
    share = good / total
    return min(rows, int(np.ceil(rows * min(1.0, share + 3 * (share * (1 - share) / total) ** 0.5))))


def resample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", k: int | None = None,
    buckets: int = BUCKETS, target_docs: int = TARGET_DOCS, seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: ``key, n_grams, log_ratio, sample_key, kept``; exactly ``k`` rows are kept.

    The target is a bounded sample of the labelled documents of quality 1 that aren't toxic; the raw model counts
    every text. Without ``k`` as many documents are kept as the labels of the documents at hand call good. The noise
    is a function of ``seed`` and the id, so a task that runs again gives the same rows; equal keys are taken in the
    order of their ids. Texts without n-grams (null, empty) have the ratio 1. Without any target document all
    ratios are 1, and all rows are kept if there are no labels. Repeated rows are scored and ranked one by one.
    """
    scored = scored_rows(docs, labels, key, text, buckets, target_docs, seed)
    rows, k_found = scored[1], scored[2]
    ranked = number_rows(scored[0], [F.desc("sample_key"), F.asc_nulls_last("id"), F.asc("n_grams")], "place")
    return ranked.select(F.col("id").alias(key), "n_grams", "log_ratio", "sample_key",
                         (F.col("place") < (k_found if k is None else min(k, rows))).alias("kept"))


def scored_rows(docs, labels, key, text, buckets, target_docs, seed) -> tuple[DataFrame, int, int]:
    """Stored ``id, n_grams, log_ratio, sample_key`` per row, the number of rows, and how many to keep."""
    targets, good, total = target_ids(docs, labels, key, target_docs)
    weights = log_ratios(*bucket_counts(docs, key, text, targets, buckets)) if len(targets) else np.zeros(buckets)
    some = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    # 53 bits in (0, 1)
    uniform = (F.shiftrightunsigned(F.xxhash64(F.coalesce("id", F.lit(-1)), F.lit(seed)), 11) + 0.5) / F.lit(float(1 << 53))
    scored = score(some, "text", weights, "s").select("id", "s.*").withColumn(
        "sample_key", F.col("log_ratio") - F.log(-F.log(uniform)))
    stored = materialize(scored, "scores")
    rows = stored.count()
    return stored, rows, sample_size(rows, good, total)


def keep_sampled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are sampled, with all their columns; a row goes if its id has no kept row.

    Rows without an id stay.
    """
    found = resample(docs.filter(F.col(key).isNotNull()), labels, key, text, **options)
    by_id = found.groupBy(key).agg(F.max("kept").alias("kept"))
    gone = materialize(by_id.filter(~F.col("kept")).select(key), "not-sampled")
    return docs.join(gone, key, "left_anti").select(*docs.columns)
