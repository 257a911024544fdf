"""License scan: matching statistics against licence texts, chained into covered template spans.

A generalised suffix automaton holds the words of every template and phrase.  A file's words are
streamed through it, which gives the longest run of licence words ending at each place.  Phrases
are read off directly: a phrase ends wherever its state is a suffix of the state reached.  Runs
of at least `least_run` words that cannot be extended become matches; matches that go forward in
one template, with gaps of at most `most_gap` words, are chained.  A chain that covers at
least `least_cover` of its template can label the file, unless a word stands in it that tells a
related licence from this one.  Where such chains overlap, the one with the most covered words less
foreign ones stays, then the one that covers more of its template, then the first label; it is
reported as a span.

Null texts are empty: no words, no label, score 0.  Every row gives one row, repeated ones too; an
empty table gives none.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from realmwatch.llm.automaton import SuffixAutomaton, known_runs
from realmwatch.llm.texts import map_texts, words

# Phrases that name a licence, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# The standard notices of common licences.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software.""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version.""",
    "agpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""",
    "lgpl": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the
        License, or (at your option) any later version.""",
    "mit-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so.""",
    "epl-2": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use
        this software for any purpose, including commercial applications, and to alter it and redistribute it
        freely, subject to the following restrictions""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mpl-2": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "cc-by-sa": """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.""",
    "cc-by-nc": """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International
        License.""",
    "cc-by-nd": """This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International
        License.""",
    "cc-by-nc-sa": """This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0
        International License.""",
    "cc-by-nc-nd": """This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0
        International License.""",
    "cc0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights
        to this work.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software.""",
}

# Words that, in the middle of a notice, make it that of a related licence.
TELLING = frozenset(
    w.encode() for w in "affero lesser library noncommercial noderivatives noderivs sharealike nc nd sa".split()
)


@dataclass
class _Found:
    n_words: int = 0
    n_base: int = 0
    first: int | None = None
    last: int | None = None
    base: set[str] = field(default_factory=set)
    labels: set[str] = field(default_factory=set)
    score: float = 0.0
    spans: list[tuple[int, int, str, float]] = field(default_factory=list)


class LicenseScanner:
    def __init__(
        self,
        phrases: Mapping[str, str] = PHRASES,
        templates: Mapping[str, str] = TEMPLATES,
        least_run: int = 4,
        most_gap: int = 12,
        least_cover: float = 0.6,
    ) -> None:
        self.least_run, self.most_gap, self.least_cover = least_run, most_gap, least_cover
        texts = {label: words(text) for label, text in templates.items()}
        named = [(words(p), label) for p, label in phrases.items()]
        self.number: dict[bytes, int] = {}
        for word in (w for text in [*texts.values(), *(p for p, _ in named)] for w in text):
            self.number.setdefault(word, len(self.number))
        coded = {label: [self.number[w] for w in text] for label, text in texts.items()}
        coded_phrases = [([self.number[w] for w in p], label) for p, label in named]
        self.automaton = SuffixAutomaton([*coded.values(), *(p for p, _ in coded_phrases)])
        self.size = {label: len(text) for label, text in coded.items()}
        self.foreign = {label: TELLING - set(text) for label, text in texts.items()}
        self.shortest = min([least_run, *(len(p) for p, _ in coded_phrases)])
        link = self.automaton.link
        marked: dict[int, list[tuple[int, str]]] = {}
        for phrase, label in coded_phrases:
            marked.setdefault(self.automaton.state_of(phrase), []).append((len(phrase), label))
        self.phrases: list[list[tuple[int, str]]] = []
        for state in range(len(link)):
            ends, at = [], state
            while at > 0:
                ends += marked.get(at, [])
                at = link[at]
            self.phrases.append(ends)
        # Where, in each template, the runs of a state end, in order.
        self.places: list[dict[str, list[int]]] = [{} for _ in link]
        for label, text in coded.items():
            for end, (state, _) in enumerate(self.automaton.stream(text), 1):
                while state > 0:
                    self.places[state].setdefault(label, []).append(end)
                    state = link[state]

    def scan(self, text: str | None) -> _Found:
        found = _Found()
        file = words(text)
        found.n_words = len(file)
        get = self.number.get
        numbers = [get(w, -1) for w in file]
        matches: list[tuple[int, int, int]] = []  # end, length, state
        for start, stop in known_runs(numbers, self.shortest):
            before = (0, 0, 0)
            for end, (state, length) in enumerate(self.automaton.stream(numbers[start:stop]), start + 1):
                for size, label in self.phrases[state]:
                    if size <= length:
                        found.n_base += 1
                        found.base.add(label)
                        at = end - size
                        found.first = at if found.first is None else min(found.first, at)
                        found.last = at if found.last is None else max(found.last, at)
                if length <= before[1] and before[1] >= self.least_run:
                    matches.append(before)
                before = (end, length, state)
            if before[1] >= self.least_run:
                matches.append(before)
        self._chain(matches, file, found)
        found.labels |= found.base
        if found.base:
            found.score = 1.0
        return found

    def _chain(self, matches: list[tuple[int, int, int]], file: list[bytes], found: _Found) -> None:
        open_chains: dict[str, list[int]] = {}  # label: file start and end, template end, words covered
        closed: list[tuple[int, float, str, int, int]] = []

        def close(label: str) -> None:
            start, end, _, covered = open_chains.pop(label)
            if self.foreign[label].isdisjoint(file[start:end]):
                cover = min(covered / self.size[label], 1.0)
                found.score = max(found.score, cover)
                if cover >= self.least_cover:
                    closed.append((-(2 * covered - (end - start)), -cover, label, start, end))

        for end, length, state in matches:
            for label, places in self.places[state].items():
                chain = open_chains.get(label)
                place = next((p for p in places if chain and p > chain[2]), None)
                if chain and (end - length - chain[1] > self.most_gap or place is None):
                    close(label)
                    chain = None
                if chain is None:
                    open_chains[label] = [end - length, end, places[0], length]
                else:
                    chain[3] += min(length, end - chain[1], place - chain[2])
                    chain[1:3] = end, place
        for label in list(open_chains):
            close(label)
        for _, cover, label, start, end in sorted(closed):
            if all(end <= a or b <= start for a, b, _, _ in found.spans):
                found.labels.add(label)
                found.spans.append((start, end, label, -cover))
        found.spans.sort()


_SCANNERS: dict[tuple, LicenseScanner] = {}


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`id_col`, counts, labels and score of every row, and `spans`: covered template spans in words."""
    key = (tuple(phrases.items()), tuple(templates.items()))

    def rows(texts: list[str | None]) -> list[list]:
        if key not in _SCANNERS:
            _SCANNERS[key] = LicenseScanner(dict(key[0]), dict(key[1]))
        found = [_SCANNERS[key].scan(t) for t in texts]
        return [
            [f.n_words for f in found],
            [f.n_base for f in found],
            [f.first for f in found],
            [f.last for f in found],
            [",".join(sorted(f.base)) for f in found],
            [",".join(sorted(f.labels)) for f in found],
            [f.score for f in found],
            [
                [{"first_word": a, "end_word": b, "label": label, "cover": c} for a, b, label, c in f.spans]
                for f in found
            ],
        ]

    span = T.StructType([
        T.StructField("first_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("cover", T.DoubleType()),
    ])
    kinds = {
        "n_words": T.LongType(), "n_base": T.LongType(), "first_word": T.LongType(), "last_word": T.LongType(),
        "base_labels": T.StringType(), "labels": T.StringType(), "score": T.DoubleType(), "spans": T.ArrayType(span),
    }
    return map_texts(docs, text_col, [id_col], rows, [T.StructField(n, k) for n, k in kinds.items()])
