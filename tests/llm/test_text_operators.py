"""Fill-in-middle, phrase collocations and main text of pages against plain versions and edge cases."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from plenum.llm import collocations, fill_in_middle, html_text
from plenum.llm.html_text import main_text

# ---- fill-in-middle ---------------------------------------------------------------------------------------------


def brute_fim(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digits = sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, output = "plain", text
    if text and not any(m in text for m in ("<P>", "<S>", "<M>")) and h3 % 100 < 90:
        form = "spm" if h4 % 100 < 20 else "psm"
        output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    sizes = (None, None) if form == "plain" else (len(prefix), len(middle))
    return key, n, form, *sizes, *[sha256(t.encode()).hexdigest() for t in (output, text)]


def texts_to_cut():
    rng = random.Random(5)
    made = [None, "", "a", "é", "日本 x", "with <P> mark", "<S>", "<", "<P <S M>", "\n\n", "word " * 3000, "a" * 9000 + "é ," * 500]
    return made + ["".join(rng.choice("abcDé.\n日< P>") for _ in range(rng.randint(0, 200))) for _ in range(150)]


def test_fim_equals_brute_force(spark):
    rows = [*enumerate(texts_to_cut()), (3, "other text of a repeated key"), (3, "other text of a repeated key"), (None, "no key")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("FIM", F.lit("clash"))
    made = fill_in_middle.transform(docs)
    assert made.columns == ["doc_id", "text", "FIM", "fim_"]
    got = sorted(map(tuple, fill_in_middle.digest(made, "fim_").collect()), key=repr)
    assert got == sorted((brute_fim(*row) for row in rows), key=repr)
    forms = Counter(row[2] for row in got)
    assert all(forms[f] for f in ("plain", "psm", "spm"))
    assert fill_in_middle.digest(fill_in_middle.transform(docs.drop("FIM").limit(0))).count() == 0


@pytest.mark.parametrize("piece", [5, 64, 1 << 22])
def test_index_finds_every_boundary(piece):
    for text in texts_to_cut():
        ends = np.cumsum([0, *(len(u.encode()) for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", text or ""))]).tolist()
        index = fill_in_middle.index_text(np.frombuffer((text or "").encode(), np.uint8), piece)
        assert [index.place(k) for k in range(index.n + 1)] == ends


def test_segments_are_bounded_and_few():
    rng = np.random.default_rng(1)
    places = np.cumsum(rng.integers(1, 9, 300_000))
    cuts = np.array([0, 100_000, 100_001, 300_000])
    start, base, slope, off = fill_in_middle.fit(places, cuts, 50)
    assert np.abs(off).max() <= 50 and set(cuts[:-1]) <= set(start.tolist())
    assert len(start) < 3000  # some hundred boundaries each, where one pair of numbers per boundary would be 300,000
    owner = np.searchsorted(start, np.arange(len(places)), "right") - 1
    assert (fill_in_middle.predict(base[owner], slope[owner], np.arange(len(places)) - start[owner]) + off == places).all()


# ---- phrase collocations ----------------------------------------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    key = lang, tuple(words[i : i + size])
                    counts[key] = counts.get(key, 0) + 1
    often = {k: f for k, f in counts.items() if f >= least}
    inside = {(lang, p[i : i + m]) for (lang, p), f in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
              if often.get((lang, p[i : i + m])) == f}
    found = {}
    for (lang, p), a in often.items():
        if len(p) < 2 or (lang, p) in inside:
            continue
        score, _, left, right = min(
            (1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]])
            for k in range(1, len(p)))
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -score)
                  for lang, best in found.items() for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1))


def phrases_corpus():
    rng = random.Random(11)
    words = ["the", "of", "The", "a", *[f"w{i}" for i in range(60)], "é", "日本", "x y", "(", "a"]
    rows = [(None, None), ("en", None), ("en", ""), ("en", " \t.,;"), ("de", "solo")]
    for lang, size in (("en", 260), ("de", 60), (None, 25), ("und", 25)):
        fixed = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 7))) for _ in range(15)]
        for _ in range(size):
            parts = [rng.choice(fixed) if rng.random() < 0.6 else rng.choice(words) for _ in range(rng.randint(1, 25))]
            rows.append((lang, "".join(p + rng.choice([" ", "  ", "\t", " ", ". ", "\n"]) for p in parts)))
    copies = "some Rare copied passage a a a a a a, of many words; that ends here"
    return rows + [("en", copies)] * 40 + [("fr", "un deux trois quatre cinq six")] * 12


@pytest.mark.parametrize("least, top, limit", [(10, 2000, 1 << 22), (10, 12, 1 << 22), (6, 5, 64), (10, 12, 300)])
def test_collocations_equal_brute_force(spark, least, top, limit):
    rows = phrases_corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit("clash")).withColumn("f", F.lit(1))
    got = sorted(map(tuple, collocations.collocations(docs, least=least, top=top, limit=limit).collect()))
    assert got == brute_collocations(rows, least, top)


def test_collocations_leave_hopeless_prefixes_ungrown(spark, monkeypatch):
    """A settled language grows no first word whose bound is below the last of its best phrases."""
    grown, grow = [], collocations.grow

    def watched(docs, words, totals, batch, *rest):
        grown.extend(map(tuple, batch.collect()))
        return grow(docs, words, totals, batch, *rest)

    monkeypatch.setattr(collocations, "grow", watched)
    rows = phrases_corpus()
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, least=6, top=5).collect()
    last = {r.lang: (r.score, r.n) for r in got if r.rank == 5}
    assert len({(lang, w) for lang, w, _ in grown}) == len(grown)
    counts = Counter(w for _, w, _ in grown)
    assert "the" not in {w for lang, w, f in grown if lang == "en"} and counts
    score, n = last["en"]
    words = Counter(w for lang, t in rows if lang == "en" for w in re.findall(r"[^\x20\x09.,;:!?\x0a-\x0d]+", (t or "").lower()))
    assert {w for w, f in words.items() if f >= 6 and 1000 * n // f >= score} <= {w for lang, w, _ in grown if lang == "en"}


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    made = collocations.collocations(docs)
    assert made.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and made.count() == 0
    one = spark.createDataFrame([("en", "a b " * 3)], "lang string, text string")
    assert collocations.collocations(one).count() == 0


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "p q", 3_000_000_007)], "lang string, phrase string, f bigint")
    counts = spark.createDataFrame([("en", "p", 4_000_000_009), ("en", "q", 5_000_000_023)], "lang string, phrase string, f bigint")
    totals = spark.createDataFrame([("en", 90_000_000_001_234)], "lang string, n bigint")
    row = collocations.scored(phrases, counts, totals, 1000).first()
    assert row.score == 1000 * 3_000_000_007 * 90_000_000_001_234 // (4_000_000_009 * 5_000_000_023)


# ---- main text of pages -----------------------------------------------------------------------------------------

LONG = "A sentence of the article, with commas, goes on for a while. " * 4
PAGES = [
    # plain article between everything that is none
    (f"<html><head><title>t</title><style>p{{}}</style><script>var a='</p><p>{LONG}</p>';</script></head><body><nav><a href=x>menu</a>"
     f"</nav><header><h1>Site</h1></header><div class='ad'>Buy, now, please, {LONG}</div><article><h1>Head &amp; line</h1><p>{LONG}<p>b"
     f"<br>c&nbsp;d<ul><li>one<li>two</ul></article><aside>{LONG}</aside><footer>&copy;</footer></body></html>",
     f"Head & line\n{LONG.strip()}\nb c d\none\ntwo"),
    # no article element: the best container, its headline and what reads alike beside it
    (f"<body class='has-sidebar'><div id=page><h2>Title</h2><div class=x><p>{LONG}</p><p>{LONG}</p></div><div class=y><p>{LONG}</p></div>"
     f"<div class=sidebar><p>{LONG}</p></div><ul><li><a href=1>link one</a><li><a href=2>link two</a></ul></div>",
     "\n".join(["Title", *[LONG.strip()] * 3])),
    # comments, notices and forms inside the article; its header holds the headline
    (f"<article class='post with-comments'><header><h1>T</h1><p>by me</p></header><p>{LONG}</p><section><p>short</p></section>"
     f"<div class='cookie-notice'>{LONG}</div><form><label>name</label></form><div id='comments'><article>{LONG}</article></div></article>",
     f"T\n{LONG.strip()}\nshort"),
    # a page layout whose class speaks of a sidebar
    (f"<div class='layout sidebar'><main><p>{LONG}</p></main><div>{LONG}</div></div>", LONG.strip()),
    ("<p>cut off <b>here</b> <a hre", "cut off here"),
    ("a &lt;b&gt; &amp;lt; 1 < 2 &#233; &unknown; &amp", "a <b> &lt; 1 < 2 é &unknown; &"),
    ("<!-- never closed <p>x</p>", ""), ("<nav>only menus</nav>", ""), ("", ""), (None, ""), ("   ", ""),
    ("<table><tr><td>a, b<td>c</table>", "a, b\nc"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>yes, this one</p>", "yes, this one"),
    ("<script>never closed <p>x", ""), ("</div></p><p>x</i></b></span>y</p>", "xy"),
    ('<p title="a > b">quoted</p><p title="open>rest', "quoted\nrest"),  # a quote that is never closed ends with its tag
]


@pytest.mark.parametrize("i", range(len(PAGES)))
def test_main_text(i):
    assert main_text(PAGES[i][0]) == PAGES[i][1]


def test_link_density_rules_out_lists_of_links():
    links = "".join(f"<li><a href={i}>A linked headline, with a comma, of some length {i}</a></li>" for i in range(60))
    assert main_text(f"<div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div>") == f"{LONG.strip()}\n{LONG.strip()}"


def test_pages_as_a_table(spark):
    deep = "<div>" * 3000 + "<p>deep, down</p>"
    many = "<article>" + "<p>one, two</p>" * 50_000 + "</article>"
    html = [h for h, _ in PAGES] + [deep, many, many]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id bigint, html string").withColumn("extracted", F.lit(1))
    made = html_text.extract_main_text(pages)
    assert made.columns == ["page_id", "html", "extracted", "extracted_"]
    got = {r.page_id: (r.text, r.n_chars) for r in made.select("page_id", "extracted_.*").collect()}
    want = [t for _, t in PAGES] + ["deep, down", *["\n".join(["one, two"] * 50_000)] * 2]
    assert got == {i: (t, len(t)) for i, t in enumerate(want)}
    assert html_text.extract_main_text(pages.limit(0)).count() == 0
