"""Licence notices, found by a suffix automaton of licence tokens."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.automaton import Alphabet, SuffixAutomaton, known_runs
from tallywire.llm.shared import Shared
from tallywire.llm.text import (
    NOT_PLAIN, in_slabs, list_column, lower_ascii, text_bytes, word_hashes, word_ranges,
)

# Phrases every place of which counts, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Wordings of licence notices and their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may "
                   "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
]
# A match of fewer words is no link of a chain; a chain may skip this many words of the
# text or the template between links, and must cover this part of the template.
LEAST_MATCH = 3
MOST_GAP = 6
LEAST_COVERAGE = 0.8

_FOUND = ("struct<n_words: bigint, places: array<struct<first: bigint, label: string>>, "
          "spans: array<struct<first: bigint, end: bigint, label: string, coverage: double>>>")


class LicenseMatcher:
    """Phrases and templates in one automaton.

    At each word of a text the automaton's state stands for the longest match that ends
    there. Phrases end at states known beforehand. Where a match of some length can't go
    on it becomes a link; links that follow one another in the text and in a template,
    with small gaps, are chained, and a chain that covers enough of the template is a span.
    """

    def __init__(self, phrases: Mapping[str, str], templates: Sequence[tuple[str, str]],
                 least_match: int, most_gap: int, least_coverage: float):
        texts = [*phrases, *(text for _, text in templates)]
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        data = lower_ascii(data)
        starts, ends, rows = word_ranges(data, offsets, NOT_PLAIN)
        hashes = word_hashes(data, starts, ends)
        self.alphabet = Alphabet(hashes)
        ids = self.alphabet.ids(hashes).tolist()
        words = [ids[rows[i]:rows[i + 1]] for i in range(len(texts))]
        self.automaton = auto = SuffixAutomaton(words)
        self.least_match, self.most_gap = least_match, most_gap
        self.least_coverage = least_coverage
        n = len(phrases)
        self.labels = [label for label, _ in templates]
        self.sizes = [len(w) for w in words[n:]]
        self.least = min([least_match, *(len(w) for w in words[:n])])
        self.phrases: dict[int, set] = defaultdict(set)
        # Per state, where in the templates it ends.
        self.places: dict[int, set] = defaultdict(set)
        for number, word_ids in enumerate(words):
            state = matched = 0
            for at, word in enumerate(word_ids, 1):
                state, matched = auto.step(state, matched, word)
                if number >= n:
                    self.places[state].add((number - n, at))
            if number < n:
                end = auto.shortened(state, len(word_ids))
                self.phrases[end].add((len(word_ids), list(phrases.values())[number]))
        for state in auto.by_length():
            if auto.link[state] in self.phrases:
                self.phrases[state] |= self.phrases[auto.link[state]]
        for state in reversed(auto.by_length()):
            self.places[auto.link[state]] |= self.places.get(state, set())
        self.phrases, self.places = dict(self.phrases), dict(self.places)

    def links(self, ids: list[int], places: list[tuple[int, str]], offset: int
              ) -> Iterator[tuple[int, int, int]]:
        """(end, state, length) of the matches that can't go on; fills ``places`` of phrases."""
        state = matched = 0
        for at, word in enumerate(ids):
            after, length = self.automaton.step(state, matched, word)
            if length <= matched and matched >= self.least_match:
                yield offset + at, state, matched
            state, matched = after, length
            for size, label in self.phrases.get(state, ()):
                if size <= matched:
                    places.append((offset + at + 1 - size, label))
        if matched >= self.least_match:
            yield offset + len(ids), state, matched

    def spans(self, links: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """Chains of links, the longest covered ones first for each label; they don't overlap."""
        by_template = defaultdict(list)
        for end, state, length in links:
            for template, stop in self.places.get(state, ()):
                by_template[template].append((end - length, end, stop - length, stop))
        found = []
        for template, own in by_template.items():
            own.sort()
            chains: list[list] = []  # first, end, template end, covered
            for first, end, begin, stop in own:
                best = None
                for chain in reversed(chains):
                    if first - chain[1] > self.most_gap:
                        break
                    skip = begin - chain[2]
                    if first >= chain[1] and 0 <= skip <= self.most_gap and (
                            best is None or chain[3] > best[3]):
                        best = chain
                size = end - first
                insort(chains, [best[0] if best else first, end, stop,
                                size + (best[3] if best else 0)], key=lambda c: c[1])
            for first, end, _, covered in chains:
                coverage = covered / self.sizes[template]
                if coverage >= self.least_coverage:
                    found.append((first, end, self.labels[template], min(1.0, coverage)))
        kept: dict[str, list[tuple[int, int, str, float]]] = defaultdict(list)
        for span in sorted(found, key=lambda s: (-s[3], s[0], -s[1], s[2])):
            own = kept[span[2]]
            at = bisect_left(own, span)
            if (not at or own[at - 1][1] <= span[0]) and (at == len(own) or span[1] <= own[at][0]):
                own.insert(at, span)
        return sorted(span for own in kept.values() for span in own)

    def scan(self, column: pa.Array) -> pa.StructArray:
        data, offsets = text_bytes(column)
        data = lower_ascii(data)
        starts, ends, rows = word_ranges(data, offsets, NOT_PLAIN)
        ids = self.alphabet.ids(word_hashes(data, starts, ends))
        places, links = defaultdict(list), defaultdict(list)
        for row, first, end in known_runs(ids, rows, self.least):
            links[row] += self.links(ids[first:end].tolist(), places[row], first - int(rows[row]))
        spans = {row: self.spans(own) for row, own in links.items() if own}
        n = len(column)

        def listed(by_row: dict, names: list[str], types: list[pa.DataType]) -> pa.Array:
            flat = [x for row in range(n) for x in sorted(by_row.get(row, ()))]
            columns = zip(*flat) if flat else [[] for _ in names]
            return list_column(
                pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                           names),
                np.cumsum([0, *(len(by_row.get(row, ())) for row in range(n))]))

        return pa.StructArray.from_arrays(
            [pa.array(np.diff(rows), pa.int64()),
             listed(places, ["first", "label"], [pa.int64(), pa.string()]),
             listed(spans, ["first", "end", "label", "coverage"],
                    [pa.int64(), pa.int64(), pa.string(), pa.float64()])],
            ["n_words", "places", "spans"])


def scan_licenses(docs: DataFrame, *, text: str = "text", into: str = "licenses",
                  phrases: Mapping[str, str] = PHRASES,
                  templates: Sequence[tuple[str, str]] = TEMPLATES,
                  least_match: int = LEAST_MATCH, most_gap: int = MOST_GAP,
                  least_coverage: float = LEAST_COVERAGE) -> DataFrame:
    """``docs`` with a struct ``into``: word count, places of the phrases, template spans.

    Positions count words from 0; a span's ``coverage`` is the part of its template that
    its links hold. The automaton's size follows from the given wordings only. Null and
    empty texts have no words; an existing column named ``into`` is replaced.
    """
    matcher = Shared(
        docs.sparkSession, LicenseMatcher(phrases, templates, least_match, most_gap, least_coverage))

    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = matcher.value()
        for column in columns:
            yield in_slabs(own.scan, column)

    found = F.arrow_udf(scan, _FOUND).asNondeterministic()
    return docs.withColumn(into, found(F.col(text).cast("string")))
