"""Licence scans: normalised texts, lines and runs of lines against licence notices by the Dice coefficient of word bigrams.

Only DataFrame functions: the notices are a constant array, so a scan is one projection without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm.url_rules import LOWER, UPPER

PERCENT = 80

# SPDX identifiers and customary notices.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without '
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
]
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z are in lower case: whatever isn't 0-9, a-z or beyond ASCII
LONG_WORD = 6
BREAKS_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def notice_words(text: str) -> list[str]:
    """Words of a notice, in order."""
    return [w for w in re.split(BREAKS, re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def notice_bigrams(text: str) -> list[str]:
    """Different word bigrams of a notice."""
    words = notice_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors_of(notices: list[list[str]], percent: int = PERCENT) -> list[str]:
    """Words and bigrams of which every text that reaches ``percent`` with one of ``notices`` (their bigrams) holds one.

    Such a text holds at least ``percent / (200 - percent)`` of the notice's bigrams. So words of ``LONG_WORD`` letters
    and more are taken, the longest first, until fewer bigrams than that are without one; short words would be in most
    texts, so if need be the longest of these bigrams are taken themselves.
    """
    taken: set[str] = set()
    for grams in notices:
        need, free = -(-percent * len(grams) // (200 - percent)), {tuple(g.split(" ")) for g in grams}
        for word in sorted({w for g in free for w in g if len(w) >= LONG_WORD}, key=lambda w: (w not in taken, -len(w), w)):
            if len(free) < need:
                break
            free = {g for g in free if word not in g}
            taken.add(word)
        spare = sorted(free, key=lambda g: (-len(g[0]) - len(g[1]), g))
        taken.update(" ".join(g) for g in spare[: max(0, len(free) - need + 1)])
    return sorted(taken)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _any_of(words: list[str], text: Column) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(w)) for w in words])


def _may_match(anchors: list[str], low: Column) -> Column:
    """Whether a text in lower case, not yet normalised, has one of ``anchors``; it may also say so of one that hasn't."""
    pairs = [a.replace(" ", BREAKS) for a in anchors if " " in a]
    found = [_any_of(words, low)] if (words := [a for a in anchors if " " not in a]) else []
    return reduce(Column.__or__, found + ([F.rlike(low, F.lit("|".join(pairs)))] if pairs else []))


def bigrams(spaced: Column) -> Column:
    """Different word bigrams of words with one space between; none of fewer than two words."""
    return _let(F.split(spaced, " "), lambda words: F.array_distinct(F.filter(F.transform(
        # the words beside themselves moved by one; the last has no partner and gives a null
        F.arrays_zip(words.alias("a"), F.slice(words, 2, 1 << 30).alias("b")),
        lambda p: F.when(p["b"].isNotNull(), F.concat(p["a"], F.lit(" "), p["b"]))), lambda g: g.isNotNull())))


def _run_lengths(sizes: Column, lengths: list[int]) -> Column:
    """How many of the first lines, with ``sizes`` words each, are compared as a run.

    Of each notice length: the most lines that have fewer words, and a line more if there is one.
    """
    full = max(lengths)
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"), F.array().cast("array<int>").alias("picks"))

    def grown(acc: Column, n: Column) -> Column:
        words, lines = acc["words"] + n, acc["lines"] + 1
        crossed = reduce(Column.__or__, [(acc["words"] < w) & (words >= w) for w in lengths])
        picks = F.when(crossed, F.concat(acc["picks"], F.array(acc["lines"], lines))).otherwise(acc["picks"])
        return F.when(acc["words"] >= full, acc).otherwise(
            F.struct(words.alias("words"), lines.alias("lines"), picks.alias("picks")))

    return F.array_distinct(F.aggregate(sizes, start, grown, lambda acc: F.when(
        acc["words"] < full, F.concat(acc["picks"], F.array(acc["lines"]))).otherwise(acc["picks"])))


def compared_units(low: Column, lengths: list[int], anchors: list[str]) -> Column:
    """The text, its lines and runs of its lines, normalised, from a text in lower case; only those with an anchor."""
    full = max(lengths)
    words = sorted({max(a.split(" "), key=len) for a in anchors})  # one of them is on a line of each such run

    def of_lines(lines: Column) -> Column:
        worded = F.filter(lines, lambda line: line != "")
        whole = F.when(F.size(lines) > 1, F.array(F.array_join(worded, " "))).otherwise(F.array().cast("array<string>"))
        return F.concat(whole, worded, _let(worded, runs))

    def runs(lines: Column) -> Column:
        sizes = F.transform(lines, lambda line: F.size(F.split(line, " ")))
        marks = F.transform(lines, lambda line: _any_of(words, line))
        return _let(sizes, lambda sizes: _let(marks, lambda marks: F.flatten(F.transform(
            F.filter(F.when(F.size(lines) > 2, F.sequence(F.lit(1), F.size(lines) - 1)).otherwise(F.array().cast("array<int>")),
                     lambda i: F.array_contains(F.slice(marks, i, F.lit(full)), True)),
            lambda i: F.transform(
                F.filter(_run_lengths(F.slice(sizes, i, F.lit(full)), lengths), lambda k: (k > 1) & (k < F.size(lines))),
                lambda k: F.array_join(F.slice(lines, i, k), " "))))))

    spaced = F.regexp_replace(low, BREAKS_IN_LINE, " ")
    lines = F.transform(F.split(spaced, "\n"), lambda line: F.trim(line))
    return F.filter(_let(lines, of_lines), lambda unit: _any_of(anchors, unit))


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", notices: list[tuple[str, str]] = NOTICES, percent: int = PERCENT,
) -> DataFrame:
    """Per row of ``docs``: ``key, license, dice, licenses, n_matches``.

    Compared are the whole text, each of its lines, and runs of consecutive lines, as notices are wrapped. Lines
    without words don't count in runs. From each line on, and for the number of words of each notice, these are the
    longest run with fewer words and the run with a line more; runs of one line or of all are no runs. So a
    text of n lines has at most 2 n runs per notice, whatever its lines hold.

    A text without any of :func:`anchors_of` can match nothing and is only searched for them. With sizes a and b the
    coefficient is at most 2 min(a, b) / (a + b), so a notice outside of the size bounds is left out before any bigrams
    are intersected. ``licenses`` are the different identifiers, sorted, of all that reach ``percent`` (over 0);
    ``license`` is the one with the highest coefficient, the smaller identifier among equals; ``n_matches`` counts the
    texts, lines and runs that reach it. Null, empty and one-word texts match nothing. Repeated rows each get their
    result.
    """
    known = [(name, grams, len(notice_words(notice))) for name, notice in notices if (grams := notice_bigrams(notice))]
    anchors = anchors_of([g for _, g, _ in known], percent)
    lengths = sorted({n for _, _, n in known})
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(g)).alias("size"), F.array(*map(F.lit, g)).alias("grams"))
                      for name, g, _ in known])
    least = min(len(g) for _, g, _ in known) * percent / (200 - percent)
    most = max(len(g) for _, g, _ in known) * (200 - percent) / percent

    def fits(g: Column, t: Column) -> Column:
        both = F.size(g) + t["size"]
        return F.least(F.size(g), t["size"]) * 200 >= both * percent

    def dice(g: Column, t: Column) -> Column:
        return F.struct((F.size(F.array_intersect(g, t["grams"])) * 2.0 / (F.size(g) + t["size"])).alias("dice"), t["name"].alias("name"))

    def matches(low: Column) -> Column:
        sized = F.filter(F.transform(compared_units(low, lengths, anchors), bigrams),
                         lambda g: (F.size(g) >= least) & (F.size(g) <= most))
        scored = F.transform(sized, lambda g: F.filter(
            F.transform(F.filter(table, lambda t: fits(g, t)), lambda t: dice(g, t)), lambda s: s["dice"] * 100 >= percent))
        return F.when(_may_match(anchors, low), F.filter(scored, lambda s: F.size(s) > 0))

    found = docs.select(F.col(key), F.coalesce(_let(F.translate(text, UPPER, LOWER), matches), F.array()).alias("found"))
    every = F.flatten("found")
    best = F.array_max(F.transform(every, lambda s: s["dice"]))
    return found.select(
        key,
        F.array_min(F.transform(F.filter(every, lambda s: s["dice"] == best), lambda s: s["name"])).alias("license"),
        F.round(best, 6).alias("dice"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(every, lambda s: s["name"]))), ",").alias("licenses"),
        F.size("found").cast("bigint").alias("n_matches"))
