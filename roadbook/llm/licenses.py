"""License scans by patience alignment.

A template and a region of a text are aligned on words that occur once in both: the longest
increasing subsequence of their positions gives anchors, and the gaps between anchors are aligned
the same way. A region covers a template if at least ``COVER`` of the template's words are aligned,
among them its telling phrases (``TELLING``: name and version), each without another word inside.

Which texts and regions are looked at follows from bounds that lose nothing: a text, or a stretch of
``ROOM`` times a template's length, must hold at least ``COVER`` of the template's words at all.

Templates go to all tasks; together they may have ``MOST_TEMPLATE_WORDS`` words at most.

Defined results: a null or empty text has no license; each stretch that covers a template is
reported, the first one first, and no word is used twice for one template. Repeated rows are
reported each. Words are compared with A-Z lower-cased and without punctuation marks at their ends.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadbook.llm.decontam import keys_of, word_keys
from roadbook.llm.words import ids_and_texts, word_slices

COVER, ROOM, MOST_TEMPLATE_WORDS = 0.8, 2, 100_000

# Notices as their licenses word them; several wordings of one are parted by a new line.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.\n"
    "This work is licensed under the GNU General Public License, version 3.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    "this software and associated documentation files",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met",
}
# What tells a license from others that are worded alike; a word in brackets may be missing.
TELLING = {
    "Apache-2.0": ["Apache License [Version] 2.0"],
    "MIT": ["MIT License"],
    "GPL-3.0": ["GNU General Public License", "version 3", "version 3.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0"],
    "MIT-grant": ["person obtaining", "this software and associated documentation files"],
    "BSD-conditions": ["source and binary forms", "permitted provided"],
}


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[i] = ends[pile - 1] if pile else -1
        tops[pile : pile + 1], ends[pile : pile + 1] = [value], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (in a, in b), both ascending."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        # Equal ends are aligned at once; words that repeat there have no anchor.
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        shared = [(i, at_b[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at_b]
        anchors = [shared[k] for k in increasing([j for _, j in shared])]
        pairs += anchors
        if anchors:
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [
                (i + 1, k, j + 1, m)
                for (i, j), (k, m) in zip(edges, edges[1:])
                if i + 1 < k and j + 1 < m
            ]
    return sorted(pairs)


class Template:
    def __init__(self, name: str, text: str, telling: Iterable[str] = ()):
        self.name, self.keys = name, keys_of(text)
        self.words = self.keys.tolist()
        self.counts = Counter(self.words)
        # Where each telling phrase that this wording has begins, and which of its words must be there.
        self.telling: list[tuple[int, list[bool]]] = []
        for phrase in telling:
            words = keys_of(phrase).tolist()
            must = [not word.startswith("[") for word in phrase.split()]
            for at in range(len(self.words) - len(words) + 1):
                if self.words[at : at + len(words)] == words:
                    self.telling.append((at, must))

    def told(self, pairs: list[tuple[int, int]]) -> bool:
        """Whether an alignment (in the text, in the template) has the telling phrases."""
        place = {j: i for i, j in pairs}
        for at, must in self.telling:
            if any(needed and at + k not in place for k, needed in enumerate(must)):
                return False
            there = [place[at + k] for k in range(len(must)) if at + k in place]
            if there[-1] - there[0] != len(there) - 1:
                return False
        return True


def stretches(words: list[int], template: Template, cover: float = COVER):
    """(first word, words, coverage) of each stretch of a text that covers the template."""
    size = len(template.words)
    room = ROOM * size
    hits = [i for i, w in enumerate(words) if w in template.counts]
    # Of the template's words, how many the room from the current hit on holds; it slides along.
    held: Counter = Counter()
    both = behind = until = 0
    out, at = [], 0
    while at < len(hits):
        begin = hits[at]
        while until < len(hits) and hits[until] < begin + room:
            word = words[hits[until]]
            held[word] += 1
            both += held[word] <= template.counts[word]
            until += 1
        while behind < at:
            word = words[hits[behind]]
            both -= held[word] <= template.counts[word]
            held[word] -= 1
            behind += 1
        at += 1
        if both < cover * size:
            continue
        region = words[begin : begin + room]
        pairs = patience(region, template.words)
        if len(pairs) >= cover * size and template.told(pairs):
            first, last = begin + pairs[0][0], begin + pairs[-1][0]
            out.append((first, last - first + 1, len(pairs) / size))
            at = bisect_left(hits, last + 1)
    return out


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    cover: float = COVER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, license, first_word, n_words, coverage: one row for each stretch, in one pass.

    Given templates are taken as they are: one wording each, without telling phrases.
    """
    if templates:
        given = [Template(*item) for item in sorted(templates.items())]
    else:
        given = [
            Template(name, wording, TELLING[name])
            for name, text in sorted(TEMPLATES.items())
            for wording in text.split("\n")
        ]
    given = [t for t in given if t.words]
    if sum(len(t.words) for t in given) > MOST_TEMPLATE_WORDS:
        raise ValueError("too many template words for one pass; give templates in parts")
    vocabulary = np.unique(np.concatenate([t.keys for t in given] or [np.zeros(0, np.uint64)]))
    # How much of each template a word makes up.
    shares = np.zeros((len(vocabulary), len(given)), np.float32)
    for n, template in enumerate(given):
        np.add.at(shares[:, n], np.searchsorted(vocabulary, template.keys), 1 / len(template.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(1)):
                ids = batch.column(0).slice(i, j - i).to_pylist()
                keys, rows = word_keys(words), []
                at = np.minimum(np.searchsorted(vocabulary, keys), max(len(vocabulary) - 1, 0))
                known = np.flatnonzero(vocabulary[at] == keys) if len(vocabulary) else at[:0]
                present = np.zeros((j - i, len(vocabulary)), np.float32)
                present[words.text_of()[known], at[known]] = 1
                for text, n in zip(*np.nonzero(present @ shares >= cover - 1e-4)):
                    own = keys[words.first[text] : words.first[text + 1]].tolist()
                    rows += [
                        (ids[text], given[n].name, *found)
                        for found in stretches(own, given[n], cover)
                    ]
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "license", "first_word", "n_words", "coverage"],
                )

    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, license string, first_word long, n_words long, coverage double"
    )
