"""The corpus pipeline: raw documents to token ids in five stages, each one operator of ``plenum.llm``.

A stage takes (spark, docs, sf_dir) and works on all rows the stage before has kept. All but the last return the
columns of ``documents``; what they reject is gone, and lines that the first removes are gone from the texts. Empty
tables give empty ones, and further columns, whatever their names, pass through all stages but the last.

What a stage returns runs later, when it is stored, so each stage sets the session to small batches of texts for good:
executors and their Python processes hold a batch of whole texts each, outside of the heap.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plenum.llm import bpe, decontamination, jaccard, line_quality, quality_model
from plenum.llm.text import small_batches_from_now
from plenum.session import materialize

VOCABULARY = "byte_bpe_50k.tiktoken"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches_from_now(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are depleted by boilerplate lines; takes out those lines.

    A null or empty text has no words, fails and goes. A null source is one host of its own. Repeated rows count once
    when lines are counted and are each judged; equal counts get equal verdicts. Long texts are judged whole.
    """
    return line_quality.keep_good(docs)


@in_small_batches
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the importance sample towards the documents labelled good.

    Rows without an id stay. A null or empty text has the ratio 1. Equal sample keys go by id; of rows that repeat an id
    all stay if one is sampled. Without labels all rows stay.
    """
    return quality_model.keep_sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of documents linked by a Jaccard similarity of 0.8.

    Rows without an id stay, and a null or empty text links with nothing. Rows that repeat an id are one document, which
    links by each of its texts; if it stays, the row with the smallest hash of its text does. Whole texts are compared.
    """
    return jaccard.keep_first(docs)


@in_small_batches
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which ten consecutive words of a test item occur.

    An item of fewer words, but not none, is looked for as a whole. Null and empty texts, of documents or items, match
    nothing; every row is judged by its own text, whatever its id, and to its end.
    """
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the hashes of the ids and of the bytes they decode to.

    A null text has no ids, like an empty one; a row of any id, null or repeated, gives a row.
    """
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: The classifier's hashes and noise and the merges of the vocabulary can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is stored and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
