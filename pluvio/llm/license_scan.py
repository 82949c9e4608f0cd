"""License notices in documents by patience alignment against templates.

For a template and a document the words that occur exactly once in both are
anchors; the longest increasing subsequence of their positions is matched, and
the gaps between matched anchors are aligned the same way, with equal words at a
gap's ends matched first. A gap without anchors is matched word by word in
order. Coverage is the share of the template's words that end up matched inside
one stretch of the document not much longer than the template. Words that tell a
template from its rivals (numbers, and words that a similar template lacks) must
be matched, and where templates match the same words the one that explains most
of them wins.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")

#: Opening words of common notices, each matched by its wording.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
           "and associated documentation files (the \"Software\"), to deal in the Software without "
           "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
           "distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-1.1-notice": "Licensed under the Apache License, Version 1.1.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                  "except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the "
               "GNU General Public License as published by the Free Software Foundation; either version 2 of "
               "the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU Lesser General Public License as published by the Free Software Foundation; either "
                "version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
                "of the License, or (at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the "
               "GNU General Public License as published by the Free Software Foundation, either version 3 of "
               "the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
           "fee is hereby granted, provided that the above copyright notice and this permission notice "
           "appear in all copies.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def plain_words(text: str | None) -> list[str]:
    """Words in lower case without marks at their edges (a word of marks stays)."""
    return [_EDGE.sub("", w).lower() or w for w in _WORD.findall(text or "")]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence with increasing second part, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        p = bisect_left(tops, b)
        if p == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[p], piles[p] = b, i
        back.append(piles[p - 1] if p else -1)
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(template: list[str], words: list[str]) -> list[tuple[int, int]]:
    """Matched (template position, word position) pairs, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(words))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == words[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == words[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once: dict[str, int] = {}
        for i in range(a, b):
            once[template[i]] = -1 if template[i] in once else i
        there: dict[str, int] = {}
        for j in range(c, d):
            w = words[j]
            if w in once:
                there[w] = -1 if w in there else j
        anchors = _increasing(sorted((i, there[w]) for w, i in once.items() if i >= 0 and there.get(w, -1) >= 0))
        if anchors:
            out.extend(anchors)
            ends = [(a - 1, c - 1), *anchors, (b, d)]
            todo.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:]) if i + 1 < k and j + 1 < m)
        elif there:
            j = c
            for i in range(a, b):
                k = j
                while template[i] in there and k < d and words[k] != template[i]:
                    k += 1
                if template[i] in there and k < d:
                    out.append((i, k))
                    j = k + 1
    return sorted(out)


def _closest(template: list[str], words: list[str], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The alignment in the shortest piece that ends where ``pairs`` end and holds the
    same words as often, if it matches as many: an alignment over two copies then
    lies in the second one."""
    missing = Counter(template[i] for i, _ in pairs)
    left, end = len(pairs), pairs[-1][1] + 1
    for x in range(end - 1, pairs[0][1] - 1, -1):
        if missing[words[x]] > 0:
            missing[words[x]] -= 1
            left -= 1
            if not left:
                near = align(template, words[x:end])
                return [(i, x + j) for i, j in near] if len(near) >= len(pairs) else pairs
    return pairs


class Scanner:
    """Finds the best stretch for every template in a document.

    The document is first cut into stretches: runs of words where the next word
    of the template comes within ``reach`` words, so a notice that stands twice
    in a document is aligned twice. A stretch takes part if it holds
    ``min_coverage`` of the template's distinct words. Two templates are rivals if
    one's words match ``rivalry`` of the other's; the words of a template that a
    rival leaves unmatched, and all its words with digits, are telling: a stretch
    without one of them is another license. Of stretches that share words the one
    with most matched words counts, then the better covered, then the first name.
    """

    def __init__(self, templates: dict[str, str], min_coverage: float = 0.85, reach: int = 8,
                 rivalry: float = 0.7):
        self.templates = {name: plain_words(t) for name, t in templates.items()}
        if not all(self.templates.values()):
            raise ValueError("a template has no words")
        self.min_coverage, self.reach = min_coverage, reach
        # the rarest-looking word is not known here, so a template is looked at
        # only if enough of its distinct words are in the document at all
        self.vocabulary = {name: frozenset(t) for name, t in self.templates.items()}
        self.every = frozenset().union(*self.vocabulary.values())
        self.telling = {}
        for name, template in self.templates.items():
            told = {i for i, w in enumerate(template) if any(c.isdigit() for c in w)}
            for rival in self.templates.values():
                same = {i for i, _ in align(template, rival)}
                if len(same) >= rivalry * len(template):
                    told.update(i for i in range(len(template)) if i not in same)
            self.telling[name] = frozenset(told)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """``(template, coverage, matched words, first word, last word)`` of the
        best stretch of each template that reaches ``min_coverage``, holds its
        telling words and is no part of what a better template explains."""
        words = plain_words(text)
        at: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.every:
                at.setdefault(w, []).append(i)
        hits = []
        for name, template in self.templates.items():
            need = self.min_coverage * len(self.vocabulary[name])
            if sum(w in at for w in self.vocabulary[name]) < need:
                continue
            places = sorted(i for w in self.vocabulary[name] for i in at.get(w, ()))
            todo = list(self._stretches(places, len(template)))
            while todo:
                lo, hi = todo.pop()
                own = words[lo:hi]
                if len(self.vocabulary[name].intersection(own)) < need:
                    continue
                pairs = align(template, own)
                if len(pairs) < self.min_coverage * len(template):
                    continue
                pairs = _closest(template, own, pairs)
                if self.telling[name] <= {i for i, _ in pairs}:
                    hits.append((len(pairs), len(pairs) / len(template), name, [lo + j for _, j in pairs]))
                todo += [(lo, lo + pairs[0][1]), (lo + pairs[-1][1] + 1, hi)]
        hits.sort(key=lambda h: (-h[0], -h[1], h[2], h[3][0]))
        taken: set[int] = set()
        best: dict[str, tuple] = {}
        for n, coverage, name, own in hits:
            if 2 * sum(j in taken for j in own) > n:
                continue
            taken.update(own)
            row = (name, coverage, n, own[0], own[-1])
            if name not in best or (coverage, -own[0]) > (best[name][1], -best[name][3]):
                best[name] = row
        return [best[name] for name in self.templates if name in best]

    def _stretches(self, places: list[int], length: int) -> Iterator[tuple[int, int]]:
        """Runs of template words with gaps of at most ``reach``; a run much longer
        than the template is looked at in overlapping windows of twice its length."""
        start = 0
        for k in range(1, len(places) + 1):
            if k == len(places) or places[k] - places[k - 1] > self.reach:
                lo, hi = places[start], places[k - 1] + 1
                if hi - lo <= 2 * length + self.reach:
                    yield lo, hi
                else:
                    for x in range(lo, hi, max(1, length)):
                        yield x, min(hi, x + 2 * length + self.reach)
                start = k


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None,
                 min_coverage: float = 0.85) -> DataFrame:
    """``(doc_id, license, coverage, n_matched, first_word, last_word)``: one row
    per document and template whose best stretch covers ``min_coverage`` of the
    template with its telling words, unless another template explains the same
    words better. Whole texts are read; null and empty texts give no row; null and
    repeated ``doc_id`` rows are scanned each; other columns are ignored; an
    empty table gives an empty result. Of equally covered stretches the first
    counts. The templates travel with the task; they are a parameter and do not
    grow with the documents."""
    scanner = Scanner(templates or TEMPLATES, min_coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(doc_id, *hit) for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for hit in scanner.scan(text)]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.float64(),
                                                       pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "license", "coverage", "n_matched", "first_word", "last_word"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, license string, coverage double, n_matched long, first_word long, last_word long")
