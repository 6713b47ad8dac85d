"""License scans by patience alignment.

Words are lower-cased runs of letters and digits.  A template is aligned to a
stretch of text by patience: words that are unique to both, and occur in both,
are anchors; the longest increasing subsequence of their positions is kept;
the gaps between kept anchors are aligned the same way, and equal words right
before and after an anchor extend it.  Coverage is the share of the template's
words that are matched.

A whole text is searched in stretches of twice the template's length, so an
occurrence need not be unique in its document.  Only stretches that hold
enough words of the template to reach ``min_coverage`` are aligned; every
other stretch cannot reach it, so nothing is missed.

Null text has no words.  A template without words is never found.  Ties in
coverage go to the longer template, then to the first name.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_COVERAGE = 0.8

# Notices that licences prescribe, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, "
                    "are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
           "without fee is hereby granted",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
           "and associated documentation files, to deal in the Software without restriction",
    "MIT (by name)": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

_WORD = re.compile(r"[^\W_]+")


def words_in(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    tops_at: list[int] = []
    before = [-1] * len(values)
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile:
            before[k] = tops_at[pile - 1]
        if pile == len(tops):
            tops.append(v)
            tops_at.append(k)
        else:
            tops[pile], tops_at[pile] = v, k
    out, k = [], tops_at[-1] if tops_at else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched ``(i, j)``, increasing in both, of a patience alignment of ``a`` and ``b``."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        lo, hi, lo2, hi2 = gaps.pop()
        # equal ends need no anchor
        while lo < hi and lo2 < hi2 and a[lo] == b[lo2]:
            found.append((lo, lo2))
            lo, lo2 = lo + 1, lo2 + 1
        while lo < hi and lo2 < hi2 and a[hi - 1] == b[hi2 - 1]:
            hi, hi2 = hi - 1, hi2 - 1
            found.append((hi, hi2))
        if lo == hi or lo2 == hi2:
            continue
        once, once2 = Counter(a[lo:hi]), Counter(b[lo2:hi2])
        place2 = {w: j for j, w in enumerate(b[lo2:hi2], lo2)}
        pairs = [(i, place2[w]) for i, w in enumerate(a[lo:hi], lo) if once[w] == 1 and once2[w] == 1]
        anchors = [pairs[k] for k in longest_increasing([j for _, j in pairs])]
        if not anchors:
            continue
        found += anchors
        ends = [(lo - 1, lo2 - 1), *anchors, (hi, hi2)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(found)


def scan(words: list[str], templates: dict[str, list[str]], vocabulary: dict[str, tuple[str, ...]],
         min_coverage: float = MIN_COVERAGE) -> list[tuple]:
    """``(name, coverage, matched words, first word, end word)`` of each template found, at its best place."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        if w in vocabulary:
            for name in vocabulary[w]:
                places.setdefault(name, []).append(i)
    out = []
    for name, at in places.items():
        template = templates[name]
        need, reach, best, done = max(1, -int(-min_coverage * len(template) // 1)), 2 * len(template), None, -1
        for k in range(len(at) - need + 1):
            if at[k + need - 1] - at[k] >= reach or at[k] <= done:
                continue
            matched = patience(words[at[k]:at[k] + reach], template)
            # a stretch that covers the template wholly also covers later starts inside it
            if len(matched) == len(template):
                done = at[k] + matched[-1][0]
            if len(matched) >= need and (best is None or len(matched) > len(best[1])):
                best = (at[k], matched)
        if best:
            start, matched = best
            out.append((name, len(matched) / len(template), len(matched),
                        start + matched[0][0], start + matched[-1][0] + 1))
    return sorted(out, key=lambda r: (-r[1], -len(templates[r[0]]), r[0]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, license, coverage, found``, one row per input row.

    ``license`` and ``coverage`` are the best template's (null, 0 where none
    reaches ``min_coverage``); ``found`` has all, best first, with the words
    they span (``first``, ``end``: positions, end exclusive).
    """
    own = {name: words_in(text) for name, text in (templates or TEMPLATES).items()}
    own = {name: words for name, words in own.items() if words}
    vocabulary = {w: tuple(n for n, words in own.items() if w in words) for words in own.values() for w in words}
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int64()),
                               ("first", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in batches:
            found = [scan(words_in(t), own, vocabulary, min_coverage) for t in b.column(1).to_pylist()]
            rows = [[dict(zip(("license", "coverage", "matched", "first", "end"), f)) for f in fs] for fs in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fs[0][0] if fs else None for fs in found], pa.string()),
                 pa.array([fs[0][1] if fs else 0.0 for fs in found], pa.float64()), pa.array(rows, kind)],
                names=["doc_id", "license", "coverage", "found"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, license string, coverage double, "
             "found array<struct<license: string, coverage: double, matched: long, first: long, end: long>>")
