"""License scans by patience alignment of texts and license templates.

Words are runs of ASCII letters, digits and bytes beyond ASCII, in lower case. A text that holds
enough of a template's words is searched around every occurrence of the template's rarest word in
it, so that repeated licenses are each found and a long text costs no more than its places. In such a window,
words that occur once in both sides are anchors; the longest run of anchors in the same order on
both sides is kept, and the gaps between them are aligned in the same way, down to common beginnings
and ends. Coverage is the share of a template's words that are aligned.

Defined cases: a null or empty text has no license; of several templates the one with the largest
coverage is named first, ties by name. Every input row gives one row.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.spans import ALNUM, Run, runs
from plazaflow.llm.tables import with_text

MIN_COVERAGE = 0.8
# Words of a text that a window holds for each word of the template, on either side.
REACH = 2

# Well-known license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        ' software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction"
    ),
}


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by piles."""
    tops, ends, before = [], [], []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            ends.append(i)
        else:
            tops[pile], ends[pile] = value, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def aligned(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned places (text, template), ascending on both sides."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        counts, others = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(text[a:b], a) if counts[w] == 1}
        anchors = [(place[w], i) for i, w in enumerate(template[c:d], c) if others[w] == 1 and w in place]
        anchors = [anchors[i] for i in longest_increasing([x for x, _ in anchors])]
        if not anchors:
            continue
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])]
    return sorted(out)


@dataclass(frozen=True)
class _Index:
    names: list[str]
    templates: list[list[int]]  # as places in the vocabulary
    vocabulary: np.ndarray  # sorted word hashes
    member: np.ndarray  # by word and template, how often it holds the word


def _index(templates: dict[str, str]) -> _Index:
    names = sorted(templates)
    parts = list(runs(pa.array([templates[x] for x in names]), ALNUM))
    hashes = [p.hash[p.bounds[i] : p.bounds[i + 1]] for p in parts for i in range(p.n)]
    vocabulary = np.unique(np.concatenate(hashes))
    places = [np.searchsorted(vocabulary, x) for x in hashes]
    member = np.zeros((len(vocabulary), len(names)), dtype=np.float32)
    for i, x in enumerate(places):
        np.add.at(member[:, i], x, 1)
    return _Index(names, [x.tolist() for x in places], vocabulary, member)


def needed(length: int, min_coverage: float) -> int:
    """So many of a template's words must be aligned; the share is read as the decimal it is written as."""
    return ceil(Fraction(str(min_coverage)) * length)


def _found(run: Run, index: _Index, min_coverage: float) -> list[list[dict]]:
    at = np.minimum(np.searchsorted(index.vocabulary, run.hash), len(index.vocabulary) - 1)
    known = index.vocabulary[at] == run.hash
    words = np.where(known, at, -1)
    doc = np.repeat(np.arange(run.n), np.diff(run.bounds))
    present = np.zeros((run.n, len(index.vocabulary)), dtype=np.float32)
    present[doc[known], at[known]] = 1
    enough = present @ index.member >= np.array([needed(len(x), min_coverage) for x in index.templates])
    out: list[list[dict]] = [[] for _ in range(run.n)]
    for i, t in zip(*np.nonzero(enough)):
        own = words[run.bounds[i] : run.bounds[i + 1]]
        out[i] += _occurrences(own, index.names[t], index.templates[t], min_coverage)
    for x in out:
        x.sort(key=lambda y: (-y["coverage"], y["license"], y["first"]))
    return out


def _occurrences(words: np.ndarray, name: str, template: list[int], min_coverage: float) -> list[dict]:
    counts = {w: int((words == w).sum()) for w in dict.fromkeys(template)}
    rarest = sorted((w for w in counts if counts[w]), key=lambda w: (counts[w], template.index(w)))
    # So many words may be missing; one of the rarest others is in every occurrence.
    need = needed(len(template), min_coverage)
    seeds, reach, found, done = rarest[: len(template) - need + 1], REACH * len(template), [], -1
    for place in np.flatnonzero(np.isin(words, seeds)).tolist():
        if place <= done:
            continue
        low, high = max(done + 1, place - reach), min(len(words), place + reach)
        # Of repeated occurrences, the window ends before the seed comes again.
        again = np.flatnonzero(words[place + 1 : high] == words[place])
        if len(again):
            high = place + 1 + int(again[0])
        pairs = aligned(words[low:high].tolist(), template)
        coverage = len(pairs) / len(template)
        if len(pairs) >= need:
            first, last = low + pairs[0][0], low + pairs[-1][0]
            found.append({"license": name, "coverage": coverage, "first": first, "last": last})
            done = last
    return found


def scanned(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    column: str = "licenses",
    text_col: str = "text",
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """All columns of `docs` and an array `column` of the licenses found: name, coverage, and the
    places of their first and last aligned word; largest coverage first."""
    docs = docs.drop(column)
    kept, (given, text) = docs.columns, with_text(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(_index(templates or TEMPLATES))
    kind = pa.list_(
        pa.struct(
            [("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("last", pa.int64())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            rows = [x for part in runs(texts, ALNUM) for x in _found(part, shared.value, min_coverage)]
            yield batch.select(kept).append_column(column, pa.array(rows, kind))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    struct = "array<struct<license:string,coverage:double,first:bigint,last:bigint>>"
    return given.mapInArrow(run, f"{schema}, `{column}` {struct}")
