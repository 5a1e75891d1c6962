"""Jaccard join, URL rules, chat, packing, sharding and licences against brute force, with edge cases."""

import re
from collections import defaultdict
from random import Random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plenum.llm import chat, components, jaccard, licenses, packing, sharding, url_rules

key = str


def roots(pairs, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("links", [
    [], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 100), (7, 7)],
    [(i, (i * 7 + 3) % 90) for i in range(90)],
])
def test_components(spark, links):
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    ids = {i for p in links for i in p if p[0] != p[1]}
    assert got == roots([p for p in links if p[0] != p[1]], ids)


# ---- Jaccard join -------------------------------------------------------------------------------------------


def brute_jaccard(rows, percent=80):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    pairs, degree = [], [0] * len(sets)
    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            if x and y and i is not None and j is not None and 100 * len(x & y) >= percent * len(x | y):
                pairs.append((i, j))
                degree[a] += 1
                degree[b] += 1
    root = roots(pairs, {i for i, _ in sets if i is not None})
    return sorted([(i, len(x), root.get(i), degree[a] if i is not None else None) for a, (i, x) in enumerate(sets)], key=key)


def near_copies():
    base = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(base[:60] + [f"x{i}"] + base[61:])) for i in range(30)]
    rows += [(100 + i, " ".join(base[i * 6 :])) for i in range(12)]  # a chain of shorter and shorter texts
    rows += [(200, rows[3][1].upper()), (201, rows[3][1] + "\n"), (202, "a b c"), (203, "A  b c"), (204, "a b"), (205, None), (206, ""),
             (207, " \n"), (208, "one " * 5000), (209, "one " * 6000), (None, rows[0][1]), (None, None)]
    shared = " ".join(f"p{k}" for k in range(55))
    return rows + [(300 + i, f"{shared} " + " ".join(f"u{i}v{k}" for k in range(10 + i))) for i in range(25)]


def test_jaccard_join_keeps_links_of_repeated_ids(spark):
    """A document of several texts links by each of them, and joins what they link with."""
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(5, a), (5, b), (6, a + " tail"), (7, b + " tail"), (8, None), (8, a), (3, b + " end"), (9, "alone"), (9, "alone"), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, jaccard.jaccard_components(docs).collect()), key=key)
    assert got == brute_jaccard(rows)
    assert {r[0]: r[2] for r in got} == {**dict.fromkeys((3, 5, 6, 7, 8), 3), 9: 9, 10: 10}
    assert sorted(r.doc_id for r in jaccard.keep_first(docs).collect()) == [3, 9, 10]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9), st.integers(0, 3)), max_size=14))
def test_jaccard_join_of_any_repeated_ids(spark, drawn):
    base = [f"w{k}" for k in range(30)]
    rows = [(i, " ".join(base[cut : cut + 20] + ["x"] * (tail > 1) + [f"t{tail}"])) for i, cut, tail in drawn]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, jaccard.jaccard_components(docs).collect()), key=key) == brute_jaccard(rows)


@pytest.mark.parametrize("options", [{}, {"tile_docs": 4, "common": 0}, {"tile_docs": 9, "tile_shingles": 700, "compared": 3}])
def test_jaccard_join_equals_brute_force(spark, options):
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, n bigint, component bigint").repartition(3)
    got = jaccard.jaccard_components(docs, **options)
    assert sorted([tuple(r) for r in got.collect()], key=key) == brute_jaccard(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=2, max_size=14), st.integers(1, 3), st.randoms())
def test_tiles_find_every_pair_once(sets, parts, rnd):
    values = [np.unique(np.array([v * 0x9E3779B97F4A7C15 % 2**64 for v in s], np.uint64)) for s in sets]
    part = np.array([rnd.randrange(parts) for _ in sets])
    total = np.zeros(len(sets), np.int64)
    for a in range(parts):
        for b in range(a, parts):
            at = [i for i in range(len(sets)) if part[i] in (a, b)]
            if len(at) > 1:
                reps, _, links = jaccard.tile_links(np.array(at), np.ones(len(at), np.int64), [values[i] for i in at],
                                                    np.zeros(len(at), bool), part[at], np.full(len(at), a == b), 80)
                total[reps] += links
    expected = [sum(100 * len(x & y) >= 80 * len(x | y) for j, y in enumerate(sets) if j != i) for i, x in enumerate(sets)]
    assert total.tolist() == expected


def test_keep_first(spark):
    rows = near_copies() + [(1, near_copies()[1][1]), (202, "a b c")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, rep string")
    left = jaccard.keep_first(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    expected = {r[0] for r in brute_jaccard(near_copies()) if r[0] == r[2] and r[0] is not None}
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 2
    assert jaccard.keep_first(docs.limit(0)).count() == 0


# ---- URL rules ----------------------------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("ample.net", "/", "allow"), ("example.net", "/en/x", "block")]
URLS = [None, "", "no scheme.net/", "http://example.net/en/1", "http://EXAMPLE.net", "https://b.a.example.net/q?x=http://n.net/", "x://net/",
        "http://xample.net/", "http://example.com/de/1#a", "http://www.example.com/fr/", "http://a-b.org/fr/x", "http://example.net/en/xy?p",
        "http:///path", "http://.net/", "http://net./x", "ftp://é.org/fr/", "http://example.net:80/en/"]


def brute_rules(url):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host, path = ("", "") if rest is None else re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


@pytest.mark.parametrize("rows_per_sweep", [1_000_000, 1])
def test_rules_equal_brute_force(spark, rows_per_sweep):
    rows = [(i, u, "z") for i, u in enumerate(URLS * 12)] + [(None, URLS[3], "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    rules = spark.createDataFrame([(h + p, h, p, v) for h, p, v in RULES] * 2 + [(None, None, None, None)],
                                  "rule string, host string, path string, verdict string")
    for inline in (url_rules.INLINE, 1, 0):
        got = url_rules.judge_urls(pages, rules, rows_per_sweep=rows_per_sweep, inline=inline)
        assert sorted([tuple(r) for r in got.collect()], key=key) == sorted([(i, *brute_rules(u)) for i, u, _ in rows], key=key)
        assert "Python" not in got._jdf.queryExecution().toString()
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    free = url_rules.judge_urls(pages, rules.limit(0)).collect()
    assert len(free) == len(rows) and {(r.rule, r.verdict) for r in free} == {(None, "allow")}


def test_rule_events_do_not_grow_with_the_rules_around_them(spark):
    told = [(f"com/{i}/", "com", f"/{i}/", "block") for i in range(500)] + [(f"h{i}.com", f"h{i}.com", "", "allow") for i in range(500)]
    told += [("com/7/7", "com", "/7/7", "allow")]
    rules = spark.createDataFrame(told, "rule string, host string, path string, verdict string")
    size = url_rules.rule_events(rules).agg(F.count(F.lit(1)), F.sum(F.size("stack"))).first()
    assert size[0] == 1002 and size[1] <= 2000
    assert url_rules.path_events(rules.filter("host = 'com'")).count() == 2 * 501 + 1
    urls = [(0, "http://h3.com/7/"), (1, "http://x.com/7/"), (2, "http://x.com/7/7/a"), (3, "http://com/8/a"), (4, "http://h3.com/none"),
            (5, "http://x.com/none"), (6, "http://com/499/"), (7, "http://xcom/7/"), (2, "http://x.com/7/7/a")]
    got = url_rules.judge_urls(spark.createDataFrame(urls, "page_id int, url string"), rules)
    assert sorted((r.page_id, r.rule, r.verdict) for r in got.fillna("-").collect()) == [
        (0, "h3.com", "allow"), (1, "com/7/", "block"), (2, "com/7/7", "allow"), (2, "com/7/7", "allow"), (3, "com/8/", "block"),
        (4, "h3.com", "allow"), (5, "-", "allow"), (6, "com/499/", "block"), (7, "-", "allow")]


# ---- chat ---------------------------------------------------------------------------------------------------

LOG = "conv_id bigint, seq bigint, kind string, role string, text string, target int, turn string"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ua<>\\ \n", max_size=5), st.text(alphabet="</turn>\\ \n#é", max_size=30)), max_size=6))
def test_template_is_reversible(turns):
    talk = chat.Conversation()
    for role, said in turns:
        talk.fold("message", role, said, None)
    formatted, starts, ends = talk.render("a")
    assert chat.read_back(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in zip(starts, ends)] == [t for r, t in turns if r == "a"]


def test_events_are_folded_in_sequence(spark):
    log = [(1, 2, "delta", None, "lo", None), (1, 0, "message", "user", "hi", None), (1, 1, "message", "assistant", "hel", None),
           (1, 3, "edit", None, "hey", 0), (1, 4, "regenerate", None, "new", 1), (1, 5, "delta", None, "!", None),
           (2, None, "message", None, None, None), (2, 1, "delta", "x", "</turn>\n", None), (2, 1, "delta", "x", "</turn>\n", None),
           (3, 0, "delta", "user", "nothing to add to", None), (None, 0, "message", "assistant", "lost", None),
           (4, 0, "edit", "a", "b", 9), (4, 1, "what", "a", "b", None), (4, 2, "message", "assistant", "x" * 200_000, None)]
    frame = spark.createDataFrame([(*r, "t") for r in log], LOG).repartition(3)
    rendered = chat.format_conversations(frame)
    got = {r.conv_id: chat.read_back(r.formatted) for r in rendered.collect()}
    assert got == {1: [("user", "hey"), ("assistant", "new!")], 2: [("", "</turn>\n</turn>\n")], 3: [], None: [("assistant", "lost")],
                   4: [("assistant", "x" * 200_000)]}
    digests = {r.conv_id: r for r in chat.digest(rendered).collect()}
    assert digests[1].loss_chars == 4 and digests[3].n_turns == 0 and digests[4].loss_chars == 200_000
    assert chat.digest(chat.format_conversations(frame.limit(0))).count() == 0


# ---- packing ------------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_best_fit_equals_the_plain_search(lengths):
    rows, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [r for r in range(len(rows)) if room[r] >= lengths[i]]
        least = min((room[r] for r in fit), default=None)
        if least is None:
            rows.append([])
            room.append(16)
            least = 16
            r = len(rows) - 1
        else:
            r = next(r for r in fit if room[r] == least)
        rows[r].append(i)
        room[r] -= lengths[i]
    got = packing.best_fit(lengths, 16)
    assert sorted(i for r in got for i in r) == list(range(len(lengths)))
    shape = lambda rs: sorted(sum(lengths[i] for i in r) for r in rs)
    assert all(sum(lengths[i] for i in r) <= 16 for r in got)
    assert shape(got) == shape(rows)  # of rows with equal room either may be taken


@pytest.mark.parametrize("groups", [None, 1, 5])
def test_packing_is_lossless(spark, groups):
    docs = [(i, list(range(i * 3))) for i in range(40)] + [(50, list(range(1000))), (51, None), (52, []), (None, [7, 8]), (53, [1]), (53, [1])]
    tokens = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, ids array<int>, row int")
    packed = packing.pack(tokens, size=64, group=500, groups=groups)
    rows = packed.collect()
    for r in rows:
        assert r.cu_seqlens[-1] == r.n_tokens <= 64 and len(r.ids) == 4 * r.n_tokens
        assert len(r.doc_ids) == len(r.position_starts) == len(r.cu_seqlens) - 1
    back = defaultdict(list)
    for r in packing.unpack(packed).collect():
        back[r.doc_id].append((r.position, np.frombuffer(r.ids, "<u4").tolist()))
    expected = defaultdict(list)
    for i, t in docs:
        expected[i] += t or []
    assert {i: [x for _, part in sorted(p) for x in part] for i, p in back.items()} == {i: t for i, t in expected.items() if t}
    assert packing.pack(tokens.limit(0)).count() == 0


def test_packing_spreads_null_ids_and_packs_copies_in_pieces(spark):
    docs = [(None, [i, i + 1]) for i in range(600)] + [(1, [5] * 10)] * 300
    tokens = spark.createDataFrame(docs, "doc_id bigint, ids array<int>")
    rows = packing.pack(tokens, size=64, group=200).collect()
    assert len({(r.pack_group, r.row) for r in rows}) == len(rows)
    held = defaultdict(int)
    for r in rows:
        if None in r.doc_ids:
            held[r.pack_group] += sum(d is None for d in r.doc_ids)
    assert len(held) > 10 and max(held.values()) < 100  # of 21 groups and 600 documents
    segments = [(d, tuple(np.frombuffer(r.ids, "<u4")[a:b].tolist())) for r in rows
                for d, a, b in zip(r.doc_ids, r.cu_seqlens, r.cu_seqlens[1:])]
    assert sorted(segments, key=str) == sorted([(d, tuple(t)) for d, t in docs], key=str)


# ---- sharding -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [10_000, 300, 40])
def test_shards_split_only_where_they_must(spark, limit):
    rows = [(i, "x" * (i % 37)) for i in range(400)] + [(7, "same key, many rows")] * 60 + [(None, "no key"), (900, None), (901, "y" * 500)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, shard string")
    got = sharding.assign_shards(docs, limit=limit).collect()
    assert len(got) == len(rows)
    load, names = defaultdict(int), defaultdict(int)
    for r in got:
        load[r.shard] += r.n_bytes
        names[r.shard] += 1
        assert len(r.shard) == r.depth
    assert all(load[s] <= limit or names[s] == 1 for s in load)
    assert all({load[r.shard]} == {r.shard_bytes} for r in got)
    for s in load:  # no shard lies in another, and each parent was too large
        assert not any(o != s and o.startswith(s) for o in load)
        assert not s or sum(b for o, b in load.items() if o.startswith(s[:-1])) > limit
    assert sharding.assign_shards(docs.limit(0)).count() == 0
    assert sharding.directory_of(sharding.assign_shards(docs, limit=limit)).count() == len(load)


# ---- licences -----------------------------------------------------------------------------------------------


def brute_license(text):
    def grams(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        return {f"{a} {b}" for a, b in zip(w, w[1:])}

    def count(t):
        return len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))

    text = text or ""
    lines = [(u, n) for u in text.split("\n") if (n := count(u))]
    runs = set()
    for i in range(len(lines)):
        for w in {count(t) for _, t in licenses.NOTICES}:
            k = 0
            while i + k < len(lines) and sum(n for _, n in lines[i:i + k + 1]) < w:
                k += 1
            runs |= {(i, i + k), (i, min(i + k + 1, len(lines)))}
    runs = [" ".join(u for u, _ in lines[i:j]) for i, j in runs if 1 < j - i < len(lines)]
    units = text.split("\n") + ([text] if "\n" in text else []) + runs
    found, hits = [], 0
    for u in units:
        g = grams(u)
        scores = [(2 * len(g & set(n)) / (len(g) + len(n)), name) for name, t in licenses.NOTICES if (n := licenses.notice_bigrams(t))]
        scores = [s for s in scores if s[0] >= 0.8]
        found += scores
        hits += bool(scores)
    best = max((s[0] for s in found), default=None)
    return (min((n for d, n in found if d == best), default=None), best and round(best, 6), ",".join(sorted({n for _, n in found})), hits)


def test_licenses_equal_brute_force(spark):
    texts = [t for _, t in licenses.NOTICES] + [
        "prose\nlicensed UNDER the  apache license version 2.0\nmore", "Released under the MIT License. Released under the MIT License.",
        licenses.NOTICES[4][1].replace(", ", ",\n"), "MIT", "", None, "é è\n\n", "under the license " * 30_000,
        "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "Licensed under the Apache License, Version 3.0."]
    rows = [(i, t, "q") for i, t in enumerate(texts)] + [(None, texts[0], "q"), (0, texts[0], "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, license string")
    got = licenses.scan_licenses(docs)
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted([(i, *brute_license(t)) for i, t, _ in rows], key=key)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert "Python" not in got._jdf.queryExecution().toString()


def wrapped(notice, width, prefix):
    words = notice.split(" ")
    return "\n".join(prefix + " ".join(words[i:i + width]) for i in range(0, len(words), width))


@pytest.mark.parametrize("width, prefix", [(10, "# "), (7, " * "), (3, "// "), (1, ""), (12, "dnl ")])
def test_wrapped_notices_inside_files_are_found(spark, width, prefix):
    top, tail = "#!/bin/sh\n# Copyright 2020 somebody\n#\n", "\n#\nset -e\necho done\nexit 0\n"
    rows = [(i, top + wrapped(t, width, prefix) + tail) for i, (_, t) in enumerate(licenses.NOTICES)]
    got = {r[0]: tuple(r)[1:] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: brute_license(t) for i, t in rows}
    if prefix != "dnl ":
        assert [got[i][0] for i, _ in rows] == [name for name, _ in licenses.NOTICES]


def test_anchors_are_in_all_that_can_match():
    random = Random(5)
    for percent in (50, 80, 100):
        for _, notice in licenses.NOTICES:
            grams = licenses.notice_bigrams(notice)
            anchors = licenses.anchors_of([licenses.notice_bigrams(t) for _, t in licenses.NOTICES], percent)
            for _ in range(50):
                held = random.sample(grams, -(-percent * len(grams) // (200 - percent)))
                assert any(a == g or a in g.split(" ") for g in held for a in anchors)


def test_long_text_of_short_lines_is_scanned(spark):
    text = "license\n" * 4_000 + wrapped(licenses.NOTICES[5][1], 2, "") + "\nend" * 4_000
    got = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert got["licenses"] == licenses.NOTICES[5][0]
