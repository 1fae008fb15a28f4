"""License scans by Patience alignment of texts with license templates.

Words that occur once in both texts are anchors; the longest increasing subsequence of
their places is the spine of the alignment, and the gaps between its anchors are aligned
the same way, after equal words at both ends are matched. Coverage is the share of a
template's words that the alignment matches.

A template is found where a stretch of the text holds enough of its words, so the
alignment runs on stretches of about its length, wherever in the whole text they lie. If
no stretch reaches the coverage, as where other words lie between a template's parts, the
whole text is aligned; a text that lacks the words can't reach it and is not aligned.

A text may hold several licenses: all are returned, the best first; where occurrences
share half of the words, the one of the better coverage, then of the longer template, then the first by name
wins. Notices of a few words are sentences that prose may resemble, so they count only as
one piece (a word more than their own at most) and not after a negation.

Defined cases: null and empty texts have no license; repeated rows are scanned row by row;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from folioforge.llm.common import id_and_bytes

#: Least coverage of a template, and words of a stretch beyond the template's own, as a share.
COVERAGE, SLACK = 0.8, 0.5
#: Templates of fewer words are notices; words that negate one within the three words before it.
NOTICE, NEGATIONS = 20, frozenset([b"not", b"never", b"no", b"isn", b"aren", b"wasn", b"nor"])

#: Widely used notices, by SPDX-like name.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "AGPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return _WORD.findall((text or b"").lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence that increases in both places; pairs ascend in the first (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back[i] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[at], piles[at] = b, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places (in a, in b), ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = _increasing([(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place])
        out += anchors
        if anchors:
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(ends, ends[1:])]
    return sorted(out)


class Scanner:
    """Finds the templates in word lists."""

    def __init__(self, templates: dict[str, str] | None = None, coverage: float = COVERAGE, slack: float = SLACK) -> None:
        self.coverage, self.slack = coverage, slack
        self.templates = [(name, w, Counter(w), frozenset(w)) for name, t in sorted((templates or TEMPLATES).items()) if (w := words(t.encode()))]

    def _stretches(self, doc: list[bytes], template: tuple) -> Iterator[tuple[int, int]]:
        """Stretches that hold enough of the template's words, merged where they overlap."""
        _, w, _, known = template
        span = len(w) + int(self.slack * len(w)) + 2
        need = self.coverage * len(w)
        at = [i for i, x in enumerate(doc) if x in known]
        start, last = None, None
        lo = 0
        for hi, i in enumerate(at):
            while at[lo] <= i - span:
                lo += 1
            if hi - lo + 1 >= need:
                if last is not None and at[lo] <= last:
                    last = i
                else:
                    if start is not None:
                        yield start, last + 1
                    start, last = at[lo], i
        if start is not None:
            yield start, last + 1

    def find(self, doc: list[bytes]) -> list[tuple]:
        """(coverage, template length, name, start, end, matched, places) of each license, the best first."""
        own = set(doc)
        found = []
        for name, w, count, known in self.templates:
            if sum(count[x] for x in known & own) < self.coverage * len(w):
                continue
            passed = [x for start, end in self._stretches(doc, (name, w, count, known)) for a, b in self._cut(start, end, len(w)) if (x := self._match(doc, a, b, name, w))]
            if not passed and (x := self._match(doc, 0, len(doc), name, w)):
                passed = [x]
            found += passed
        kept, taken = [], set()
        for x in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[3])):
            if 2 * len(taken.intersection(x[6])) < x[5]:
                kept.append(x)
                taken.update(x[6])
        return kept

    def _match(self, doc: list[bytes], a: int, b: int, name: str, w: list[bytes]) -> tuple | None:
        """What find() returns, of one piece and one template, if it reaches the coverage."""
        pairs = align(doc[a:b], w)
        share = len(pairs) / len(w)
        if share < self.coverage:
            return None
        start, end = a + pairs[0][0], a + pairs[-1][0] + 1
        if len(w) < NOTICE and (end - start > len(w) + 1 or NEGATIONS.intersection(doc[max(0, start - 3) : end])):
            return None
        return share, len(w), name, start, end, len(pairs), [a + i for i, _ in pairs]

    def _cut(self, start: int, end: int, n: int) -> Iterator[tuple[int, int]]:
        """Pieces of a long stretch that overlap so that any occurrence lies within one."""
        size = 2 * (n + int(self.slack * n) + 2)
        while end - start > size:
            yield start, start + size
            start += size // 2
        yield start, end


_LICENSES = "array<struct<license:string,coverage:double,start_word:bigint,end_word:bigint>>"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Per document: doc_id, n_words; license (null: none), coverage, matched and the word range of its best license;
    licenses: all of them, the best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                doc = words(text.as_py())
                found = scanner.find(doc)
                b = found[0] if found else None
                rows.append((len(doc), *((b[2], b[0], b[5], b[3], b[4]) if b else (None, 0.0, 0, None, None)), [{"license": x[2], "coverage": x[0], "start_word": x[3], "end_word": x[4]} for x in found]))
            each = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]))
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), each]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["doc_id", "n_words", "license", "coverage", "matched", "start_word", "end_word", "licenses"])

    return id_and_bytes(docs).mapInArrow(run, f"doc_id long, n_words long, license string, coverage double, matched long, start_word long, end_word long, licenses {_LICENSES}")
