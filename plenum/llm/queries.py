"""The operators as named queries over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.llm import (
    bpe, chat, collocations, decontamination, fill_in_middle, html_text, jaccard, licenses, line_quality, packing,
    quality_model, sharding, url_rules,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Small enough that the test tables fill many shards, and buckets split several times.
SHARD_BYTES = 64 << 10
RULES = [  # host, path, verdict
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated", "longest_match")


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(h + p, h, p, v) for h, p, v in RULES], "rule string, host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge_lines(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    log = rows.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text",
                      F.lit(None).cast("int").alias("target"))
    return chat.digest(chat.format_conversations(log))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tokens = packing.token_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return packing.pack(tokens, groups=size // packing.GROUP + 1)


def op8_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), limit=SHARD_BYTES)


def op9_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"), name="main").select("page_id", "url", "main.*")


def llm_queries() -> dict[str, Query]:
    made = [op1_suffix_array_decontamination, op2_importance_resampling, op3_ngram_jaccard_join, op4_url_rules,
            op5_line_frequency, op6_chat_format, op7_best_fit_packing, op8_extendible_shards, op9_license_dice, op10_byte_bpe,
            op11_fill_in_middle, op12_phrase_collocations, op13_html_main_text]
    return {f.__name__: f for f in made}
