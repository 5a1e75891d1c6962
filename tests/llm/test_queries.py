"""Named queries against their SQL twins, and the pipeline against a brute-force version of its stages."""

import math
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from compare import difference, duck
from plenum.llm import bpe, packing, quality_model, sharding, text
from plenum.llm.oracle import llm_oracles
from plenum.llm.queries import llm_queries
from tests.llm.test_group_operators import brute_jaccard
from tests.llm.test_word_operators import brute_contamination, brute_lines

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_its_twin(spark, name):
    found = llm_queries()[name](spark, FOLDER).toPandas()
    assert difference(found, duck(FOLDER).execute(llm_oracles()[name]).df()) == ""


def test_packed_rows_hold_every_id(spark):
    packed = llm_queries()["op7_best_fit_packing"](spark, FOLDER)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        book = bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)
    parts = packing.unpack(packed).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for doc in texts:
        ids = b"".join(bytes(r.ids) for r in sorted((r for r in parts if r.doc_id == doc), key=lambda r: r.position))
        assert book.decode(ids).decode() == texts[doc]
    filled = packed.agg(F.sum("n_tokens"), F.max("n_tokens"), F.count(F.lit(1))).first()
    least = -(-filled[0] // packing.ROW)
    assert filled[1] <= packing.ROW
    assert filled[2] <= 11 / 9 * least + 1  # the proven bound of the method, here against the fewest rows thinkable


def test_library_and_own_encoding_agree(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    texts = [None, "", "a b\n\n  c", " " * 250_000 + "x", "\n" * 200_000, "héllo 你好 " * 20_000, "word 12 it's " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: bytes(r.ids) for r in packing.token_ids(docs, path, pattern).collect()}
    with open(path, "rb") as file:
        book = bpe.Vocabulary(file.read(), pattern)
    assert got == {i: book.encode(t or "") for i, t in enumerate(texts)}


def brute_shards(sizes, limit):
    """Shards of rows (hash bits, bytes): the shortest prefixes whose rows fit, or are one."""
    found, open_ = {}, [("", sizes)]
    while open_:
        name, rows = open_.pop()
        if sum(n for _, n in rows) <= limit or len(rows) == 1:
            found.update(dict.fromkeys((h for h, _ in rows), name))
        else:
            for bit in "01":
                part = [r for r in rows if r[0][len(name)] == bit]
                open_ += [(name + bit, part)] * bool(part)
    return found


def test_shards_fit(spark):
    """All documents, in the shards that splitting bit by bit gives; the hash is looked up in the longest names met."""
    from plenum.llm.queries import SHARD_BYTES

    shards = llm_queries()["op8_extendible_shards"](spark, FOLDER)
    rows = shards.withColumn("h", F.lpad(F.bin(F.shiftrightunsigned(F.xxhash64("doc_id"), 32)), 32, "0")).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 200
    want = brute_shards([(r.h, r.n_bytes) for r in rows], SHARD_BYTES)
    assert {r.h: r.shard for r in rows} == want and len(set(want.values())) > 4
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.n_bytes
    assert all(r.shard_bytes == loads[r.shard] and r.depth == len(r.shard) for r in rows)
    assert all(n <= SHARD_BYTES or sum(r.shard == s for r in rows) == 1 for s, n in loads.items())


def test_written_shards_hold_every_row_once(spark, tmp_path):
    rows = [(None, "a" * 50), (None, "a" * 50), (1, "b" * 60), (1, "c" * 70), (2, None), (2, ""), (3, "d" * 500), *[(9, "same")] * 40]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("shard", F.lit("mine"))
    listed = sharding.write_shards(docs, str(tmp_path / "s"), limit=150).collect()
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.columns == ["doc_id", "text", "shard", "shard_"]
    assert sorted(map(tuple, back.select("doc_id", "text").collect()), key=repr) == sorted(rows, key=repr)
    loads = {r.shard_: (r.n, r.size) for r in back.groupBy("shard_").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size")).collect()}
    assert loads == {f"b{r.shard}": (r.rows, r.shard_bytes) for r in listed}
    assert all(n == 1 or size <= 150 for n, size in loads.values()) and len(loads) > 3


def test_resampling_holds_out(spark):
    """Labelled junk is rejected and labelled good text kept."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = llm_queries()["op2_importance_resampling"](spark, folder).join(labels, "doc_id")
    share = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.98 and share[0] < 0.5


def spark_hash(value, seed):
    return xxhash.xxh64(struct.pack("<q" if seed == 42 else "<i", value), seed=seed).intdigest()


def brute_sample(docs, labels):
    """Ids that importance resampling keeps: both models, the noise and the number to keep, in plain Python."""
    def grams(text):
        data = (text or "").encode()
        return quality_model.n_grams(np.frombuffer(data, np.uint8), np.array([0, len(data)]), quality_model.BUCKETS)[1].tolist()

    ids = {i for i, _ in docs}
    known = {(i, q, t) for i, q, t in labels if i in ids and q is not None}
    good = sum(q == 1 for _, q, _ in known)
    target = {i for i, q, t in known if q == 1 and not t}
    assert len(target) <= quality_model.TARGET_DOCS
    counts = {i: Counter(grams(t)) for i, t in docs}
    raw, chosen = Counter(), Counter()
    for i, c in counts.items():
        raw.update(c)
        if i in target:
            chosen.update(c)
    n, m, size = sum(chosen.values()), sum(raw.values()), quality_model.BUCKETS
    ratio = {b: math.log((chosen[b] + 1) / (n + size)) - math.log((raw[b] + 1) / (m + size)) for b in raw}
    keys = []
    for i, c in counts.items():
        uniform = ((spark_hash(quality_model.SEED, spark_hash(i, 42)) >> 11) + 0.5) / 2**53
        keys.append((-(sum(k * ratio[b] for b, k in c.items()) - math.log(-math.log(uniform))), i))
    share = good / len(known)
    k = min(len(docs), math.ceil(len(docs) * min(1.0, share + 3 * math.sqrt(share * (1 - share) / len(known)))))
    return {i for _, i in sorted(keys)[:k]}


def test_resampling_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()]
    got = llm_queries()["op2_importance_resampling"](spark, FOLDER).filter("kept").collect()
    want = brute_sample(docs, labels)
    assert {r.doc_id for r in got} == want and 0 < len(want) < len(docs)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    wide = docs.withColumn("kept", F.lit(1)).withColumn("rep", F.lit("a"))  # more columns, clashing names
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, wide, FOLDER)
        before, after = wide.collect(), {r.doc_id: r for r in made.collect()}
        rows = [(r.doc_id, r.text) for r in before]
        if name == "quality_rules":
            judged = brute_lines([(r.doc_id, r.text, r.source) for r in before], 8, 10, 30)
            assert set(after) == {j[0] for j in judged if j[7]}
        elif name == "quality_classifier":
            labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()]
            assert set(after) == brute_sample(rows, labels) and len(after) >= 0.8 * len(before)
        elif name == "near_duplicates":
            assert set(after) == {r[0] for r in brute_jaccard(rows) if r[0] == r[2]}
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            hit = brute_contamination([t for _, t in rows], items, 10)
            assert set(after) == {i for (i, _), h in zip(rows, hit) if not h[1]}
        else:
            assert set(after) == {i for i, _ in rows}
            with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
                book = bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)
            for i, t in rows:
                assert book.decode(np.array(after[i].ids, "<u4").tobytes()).decode() == t
            break
        assert made.columns == wide.columns
        wide = made
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()) == sorted(after)


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


def test_what_stages_return_runs_in_small_batches(spark):
    """Batches were small only inside ``run``, and a stage's frame runs after the stage has returned."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(name, "10000")
            docs = stage(spark, docs, FOLDER).limit(20)
            assert spark.conf.get(name) == str(text.BATCH_ROWS)
            assert docs.count() > 0
        spark.conf.set(name, "7")
        corpus_pipeline.byte_bpe(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
        assert spark.conf.get(name) == "7"
    finally:
        spark.conf.set(name, before)


def test_words_are_forgotten_at_the_end_of_a_task():
    """Processes kept the words of the last encoding while other stages ran."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        book = bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)
    ids = book.encode("xqzzkv jjwqk")
    assert book.memory
    book.forget()
    assert not book.memory and not book.older and book.encode("xqzzkv jjwqk") == ids
