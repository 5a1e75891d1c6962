"""Decontamination, importance resampling, line rules and byte BPE against brute force, with edge cases."""

import base64
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plenum.llm import bpe, decontamination, line_quality, quality_model, text

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, _rows int"
LONG = "word " * 40_000 + "end"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with nulls, an empty, a very long and a repeated text, and columns whose names clash."""
    rows = [(1, "The quick brown fox. " * 20), (2, None), (3, ""), (4, LONG), (5, "ÀÉ 漢字 ok\tx"), (5, "ÀÉ 漢字 ok\tx"),
            (None, "some words without an id"), (6, "\n\n \n"), (7, "a b c d e f g h i j k l m n o p")]
    return spark.createDataFrame([(i, t, None, None, None, True, 7) for i, t in rows], DOCS)


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))


# ---- words and blocks ---------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t漢.#9 ", max_size=30)), max_size=12), st.integers(1, 40))
def test_word_spans_and_hashes_follow_the_pattern(texts, limit):
    for low, high, data, offsets in text.blocks(pa.array(texts, pa.string()), limit):
        starts, ends, first = text.word_spans(data, offsets, text.LETTERS)
        hashes = text.span_hashes(text.running(text.FOLDED_BYTES[data]), starts, ends)
        expected = [words(t) for t in texts[low:high]]
        assert np.diff(first).tolist() == [len(w) for w in expected]
        flat = [w for ws in expected for w in ws]
        assert len(set(flat)) == len(set(hashes.tolist()))
        assert len({*zip(flat, hashes.tolist())}) == len(set(flat))


# ---- decontamination ----------------------------------------------------------------------------------------


def brute_contamination(texts, items, window):
    tests = defaultdict(set)
    for item, t in items:
        w = words(t)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            tests[tuple(w[i : i + window])].add(str(item))
    out = []
    for t in texts:
        w, hit, met = words(t), set(), set()
        for n in {len(x) for x in tests}:
            for i in range(len(w) - n + 1):
                found = tests.get(tuple(w[i : i + n]))
                if found:
                    met |= found
                    hit.update(range(i, i + n))
        out.append((len(w), len(hit), sorted(met)))
    return out


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("abcX"), max_size=30).map(" ".join), max_size=6),
    st.lists(st.lists(st.sampled_from("abc"), max_size=9).map(" ".join), min_size=1, max_size=5),
    st.integers(1, 5),
)
def test_matches_equal_brute_force(texts, items, window):
    tests = decontamination.test_suffixes([str(i) for i in range(len(items))], pa.array(items), window)
    if tests is None:
        return
    found = {k: v.to_pylist() for k, v in decontamination.mark(pa.array(texts, pa.string()), tests).items()}
    for i, (n, hit, met) in enumerate(brute_contamination(texts, list(enumerate(items)), window)):
        assert (found["n_words"][i], sum(found["hit_lengths"][i]), found["items"][i]) == (n, hit, met)
        for item, at, size in zip(found["match_items"][i], found["match_starts"][i], found["match_lengths"][i]):
            said = words(texts[i])[at : at + size]
            assert " ".join(said) in " ".join(words(items[int(item)]))
        assert bool(met) == bool(found["match_items"][i])


@pytest.mark.parametrize("test_block", [1 << 20, 60])
def test_contamination_of_edge_cases(spark, docs, test_block):
    items = [(1, "b c d e f g h i j k l"), (2, "quick brown FOX the quick brown fox the quick brown"), (3, None), (None, "word word"), (4, ""),
             (5, "ok"), (10, "漢字 OK")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, n_words int")
    got = decontamination.contamination(docs, bench, test_block=test_block).collect()
    rows = docs.select("doc_id", "text").collect()
    expected = brute_contamination([r.text for r in rows], [i for i in items if None not in i], 10)
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got], key=key) == sorted(
        [(r.doc_id, n, h, len(m), m, h > 0) for r, (n, h, m) in zip(rows, expected)], key=key)
    left = decontamination.remove_contaminated(docs, bench, test_block=test_block)
    assert left.schema == docs.schema
    assert left.count() == sum(h == 0 for _, h, _ in expected)
    assert decontamination.remove_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert decontamination.contamination(docs.limit(0), bench).count() == 0


# ---- line rules ---------------------------------------------------------------------------------------------


def brute_lines(rows, percent, least, left_percent):
    space = r"[^\x20\x09-\x0D]+"
    norm = lambda line: tuple(re.findall(space, fold(line)))
    met, hosts = defaultdict(set), defaultdict(set)
    for _, t, host in rows:
        hosts[host or ""].add(t or "")
        for line in (t or "").split("\n"):
            met[host or "", norm(line)].add(t)
    out = []
    for i, t, host in rows:
        t, host = t or "", host or ""
        w, lines = re.findall(space, t), [x for x in t.split("\n") if norm(x)]
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
        often = [x for x in lines if len(met[host, norm(x)]) >= least and 100 * len(met[host, norm(x)]) > percent * len(hosts[host])]
        left = len(w) - sum(len(norm(x)) for x in often)
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again),
                    failed, not failed and 100 * left >= left_percent * len(w), left))
    return out


def test_line_rules_equal_brute_force(spark, docs):
    site = "Menu About Contact # | us\n"
    rows = [(100 + i, site * (1 + i % 3) + " ".join(f"w{i}x{k}" for k in range(30 + i)) + "\n menu  ABOUT contact # | US", f"h{i % 2}")
            for i in range(40)]
    banner = " ".join(f"b{k}" for k in range(70))
    rows += [(200 + i, f"{banner}\none{i} own line", "h0") for i in range(15)] + [(300, rows[0][1], None)] * 2
    more = spark.createDataFrame([(i, t, None, h, len(t), False, 1) for i, t, h in rows], DOCS).unionByName(docs)
    plain = [(r.doc_id, r.text, r.source) for r in more.collect()]
    key = lambda x: str(x)
    got = sorted([tuple(r) for r in line_quality.judge_lines(more, percent=30, least=5).collect()], key=key)
    expected = sorted(brute_lines(plain, 30, 5, 30), key=key)
    assert got == expected
    assert any(not r[6] and not r[7] for r in got) and any(r[7] for r in got)
    kept = line_quality.keep_good(more, percent=30, least=5)
    assert kept.schema.names == more.schema.names
    stay = kept.collect()
    assert sorted((str(r.doc_id) for r in stay)) == sorted(str(r[0]) for r in expected if r[7])
    assert all("menu" not in r.text.lower() and r.n_chars == len(r.text) for r in stay if r.doc_id and 100 <= r.doc_id < 200)
    assert line_quality.judge_lines(more.limit(0)).count() == 0
    assert line_quality.keep_good(more.limit(0)).count() == 0


# ---- importance resampling ----------------------------------------------------------------------------------


def brute_scores(rows, targets, buckets):
    def grams(t):
        tokens = re.findall(r"[0-9a-z_\x80-\U0010FFFF]+|[^0-9a-z_\x80-\U0010FFFF\x20\x09-\x0D]+", fold(t))
        return tokens + [a + " " + b for a, b in zip(tokens, tokens[1:])]

    return {i: len(grams(t)) for i, t in rows}


def test_resampling_keeps_good_documents(spark):
    rows, labels = [], []
    for i in range(300):
        good = i % 4 > 0
        body = " ".join(f"sane{(i * k) % 50}" for k in range(60))
        rows.append((i, body if good else re.sub(r"(\w) ", r"\1*** ", body)))
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels + [(9999, 1, 0), (None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality_model.resample(docs, known).collect()}
    assert len(got) == 300
    assert all(got[i].kept for i in range(300) if i % 4)  # every good one
    assert sum(r.kept for r in got.values()) < 300
    assert {i: r.n_grams for i, r in got.items()} == brute_scores(rows, None, 0)
    chosen = quality_model.resample(docs, known, k=17)
    top = sorted(got.values(), key=lambda r: (-r.sample_key, r.doc_id))[:17]
    assert sorted(r.doc_id for r in chosen.filter("kept").collect()) == sorted(r.doc_id for r in top)


def test_ratios_equal_counts_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a a"), (3, "c")], "doc_id bigint, text string")
    buckets = 1 << 20
    target, raw = quality_model.bucket_counts(docs, "doc_id", "text", np.array([1, 3]), buckets)
    assert (target.sum(), raw.sum()) == (4, 7)
    weights = quality_model.log_ratios(target, raw)
    found = {r.doc_id: r.s.log_ratio for r in quality_model.score(docs, "text", weights, "s").collect()}
    ratio = lambda t, r: np.log((t + 1) / (4 + buckets)) - np.log((r + 1) / (7 + buckets))
    assert found[1] == pytest.approx(ratio(1, 3) + 2 * ratio(1, 1))
    assert found[2] == pytest.approx(2 * ratio(1, 3) + ratio(0, 1))


def test_resampling_edge_cases(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = quality_model.resample(docs, labels)
    assert got.count() == docs.count()
    assert {r.log_ratio for r in got.filter("doc_id IN (2, 3, 6)").collect()} == {0.0}
    none = quality_model.resample(docs, labels.limit(0)).collect()
    assert all(r.kept and r.log_ratio == 0 for r in none)
    assert quality_model.resample(docs.limit(0), labels).count() == 0
    kept = quality_model.keep_sampled(docs, labels)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id IS NULL").count() == 1


# ---- byte BPE -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def book():
    with open(VOCABULARY, "rb") as file:
        return bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.one_of(
    st.text(alphabet=" \n\t\r\x0b\x1c\x85\xa0　​aab'strmldvelé1２Ⅷ—🙂́ſ<|>", max_size=40), st.text(max_size=40)))
def test_ids_equal_the_library(book, library, t):
    packed = book.encode(t)
    assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(t)
    assert book.decode(packed) == t.encode()


def test_very_long_match(book, library):
    for t in ("ab" * 30_000, "a" * 50_001, "the" * 10_000, " " * 10_000 + "x"):
        assert np.frombuffer(book.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_leftmost_first_and_stale_entries(book):
    assert b"".join(book.tokens[i] for i in book.merge(b"aaaaaaaaa")) == b"aaaaaaaaa"
    assert book.merge(b"zzqqzzqq") == [i for part in ("zz", "qq", "zz", "qq") for i in book.merge(part.encode())]


def test_new_words_of_many_texts_share_a_queue(library, monkeypatch):
    """Each new word had a queue of its own; whatever is cut or merged together, and forgotten, the ids are the library's."""
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choice("aabcdehilnorst éñ1") for _ in range(rng.randrange(1, 24))) for _ in range(30)) for _ in range(60)]
    texts += ["", "aaaa" * 40, "abababab " * 9, texts[3]]
    expected = [library.encode_ordinary(t) for t in texts]
    for together, queued, remembered in ((10**6, 10**6, 400_000), (300, 40, 50), (1, 1, 0)):
        for name, value in (("TOGETHER", together), ("QUEUED", queued), ("REMEMBERED", remembered)):
            monkeypatch.setattr(bpe, name, value)
        with open(VOCABULARY, "rb") as file:
            book = bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)
        queues, merge_all = [], book.merge_all
        monkeypatch.setattr(book, "merge_all", lambda words: queues.append(len(words)) or merge_all(words))
        assert [np.frombuffer(ids, "<u4").tolist() for ids in book.encode_all(texts)] == expected
        assert together < 10**6 or len(queues) == 1 < queues[0]


@pytest.mark.parametrize("often, few", [(0, 1), (16, 50), (10**9, 100_000)])
def test_places_of_many_words_are_merged_together(book, library, monkeypatch, often, few):
    """A place at a time went through the queue; the order within a word stays the library's, runs and lower ranks included."""
    rng = random.Random(3)
    words = [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    words += ["".join(rng.choice("aabcdehilnorstéñ1") for _ in range(rng.randrange(1, 90))).encode() for _ in range(400)]
    words += [part * k for part in (b"a", b"ab", b"the", b" ", b"=") for k in range(1, 60)]
    words = [w for w in words if w not in book.ranks]
    for name, value in (("MANY", 1), ("OFTEN", often), ("FEW", few)):
        monkeypatch.setattr(bpe, name, value)
    left, merge_few = [], book._merge_few
    monkeypatch.setattr(book, "_merge_few", lambda parts, ranks, ends: left.append(int((ranks >= 0).sum())) or merge_few(parts, ranks, ends))
    got = [np.frombuffer(ids, "<u4").tolist() for ids in book.merge_all(words)]
    assert got == [library._encode_single_piece(w) for w in words]
    assert (sum(left) == 0) == (often == 0)


def test_words_met_again_and_again_stay_remembered(monkeypatch):
    """All words were forgotten when too many were remembered, and those of nearly every text merged anew."""
    monkeypatch.setattr(bpe, "REMEMBERED", 200)
    with open(VOCABULARY, "rb") as file:
        book = bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)
    merged, merge_all = [], book.merge_all
    monkeypatch.setattr(book, "merge_all", lambda words: merged.extend(words) or merge_all(words))
    usual = [f" qzx{a}{b}kv" for a in "abcd" for b in "efgh"]
    for k in range(40):
        rare = "".join(f" wq{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j)}xj" for j in range(20))
        book.encode("".join(usual) + rare)
        assert len(book.memory) + len(book.older) <= 200 + 2 * 36
    assert merged.count(usual[0].encode()) == 1
    assert len(merged) == len(usual) + 40 * 20


def test_plain_words_are_matches(book, library):
    for t in ("it's we'll don't. 's,x", " Über ñandú, ça; \u00d7\u00f7 a\u00d7b \u01bb\u024f\u0250.", "e\u0301t, a.b a..b a,'s a!? \u00aa\u00ba.", "x1, 1x. A\u2167;"):
        assert np.frombuffer(book.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_round_trip_of_edge_cases(docs, library):
    got = bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN, with_ids=True).collect()
    expected = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        expected.append((r.doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         sha256((r.text or "").encode()).hexdigest(), ids))
    key = lambda x: str(x[:3])
    assert sorted([tuple(r) for r in got], key=key) == sorted(expected, key=key)
    for packed in (False, True):
        wide = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, name="kept", packed=packed)
        assert wide.columns == [*docs.columns, "kept_"]
        assert wide.agg(F.sum("kept_.n_tokens")).first()[0] == sum(len(e[4]) for e in expected)
    assert bpe.round_trip(docs.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("block", [100, 8 << 20])
def test_items_that_repeat_an_id_count_once(spark, block):
    a, b = (" ".join(f"{x}{k}" for k in range(14)) for x in "pq")
    docs = spark.createDataFrame([(1, f"see {a} and {b} there"), (2, b), (3, "none of it")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, a), (1, a), (2, a), (1, b), (3, "other words"), (None, a), (4, None)], "item_id bigint, text string")
    got = {r.doc_id: (r.n_items, list(r["items"]), r.longest_match, r.n_hit)
           for r in decontamination.contamination(docs, items, test_block=block).collect()}
    assert got == {1: (2, ["1", "2"], 14, 28), 2: (1, ["1"], 14, 14), 3: (0, [], 0, 0)}
