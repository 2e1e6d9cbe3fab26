"""License notices in texts, by matching statistics against a suffix automaton of templates.

All templates, as word sequences, go into one generalised suffix automaton. A text is streamed
through it: after every word the automaton knows the longest run ending there that occurs in
some template. Where there are long runs, each template's own automaton finds the maximal runs of
that template, so that none is hidden by a longer run of another. Those are segments that lie in
a template and in the text; segments of one template that go forward in both are chained across
small gaps, and a chain that covers enough of its template is a license span.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.words import alnum_spans, alnum_words, texts

SHORTEST = 4  # words of a run that counts as a segment
GAP = 24  # words between segments of a chain, in the text
COVERAGE = 0.6  # share of a template that a chain must cover
BASE_SCORE = 0.5  # of a document in which a base phrase stands

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license notices by identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License.""",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    ),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    ),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    (
        "bsd-3-clause",
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
    ),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    ),
)


class SuffixAutomaton:
    """Of several word sequences; ``ends[state]`` lists where its strings end in them."""

    def __init__(self, sequences: list[list[bytes]]) -> None:
        self.moves: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: dict[int, set[tuple[int, int]]] = {}
        for t, words in enumerate(sequences):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, word)
                own.setdefault(last, set()).add((t, i + 1))
        ends: list[set[tuple[int, int]]] = [own.get(s, set()) for s in range(len(self.moves))]
        for state in sorted(range(1, len(self.moves)), key=lambda s: -self.length[s]):
            ends[self.link[state]] = ends[self.link[state]] | ends[state]
        self.ends = [sorted(e) for e in ends]

    def _state(self, length: int, moves: dict[bytes, int], link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.moves) - 1

    def _extend(self, last: int, word: bytes) -> int:
        known = self.moves[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, known, word)
        state = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.moves[at]:
            self.moves[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.moves[at][word]
            exact = self.length[target] == self.length[at] + 1
            self.link[state] = target if exact else self._split(at, target, word)
        return state

    def _split(self, at: int, target: int, word: bytes) -> int:
        copy = self._state(self.length[at] + 1, dict(self.moves[target]), self.link[target])
        self.link[target] = copy
        while at >= 0 and self.moves[at].get(word) == target:
            self.moves[at][word] = copy
            at = self.link[at]
        return copy

    def runs(self, words: list[bytes], shortest: int) -> Iterator[tuple[int, int, int]]:
        """Maximal runs of at least ``shortest`` words that occur in a sequence: end in
        ``words``, length, state."""
        state = length = 0
        for i, word in enumerate(words):
            if word not in self.moves[state]:
                if length >= shortest:
                    yield i, length, state
                while state > 0 and word not in self.moves[state]:
                    state = self.link[state]
                    length = self.length[state]
            if word in self.moves[state]:
                state = self.moves[state][word]
                length += 1
        if length >= shortest:
            yield len(words), length, state


@dataclass
class Chain:
    """Segments of one template in order; ``covered`` counts its words in the template."""

    start: int
    stop: int
    template_stop: int
    covered: int


@dataclass
class Matcher:
    templates: list[tuple[str, list[bytes]]]
    automaton: SuffixAutomaton = field(init=False)
    own: list[SuffixAutomaton] = field(init=False)
    vocabulary: dict[bytes, int] = field(init=False)

    def __post_init__(self) -> None:
        self.automaton = SuffixAutomaton([words for _, words in self.templates])
        self.own = [SuffixAutomaton([words]) for _, words in self.templates]
        self.vocabulary = {w: 1 for _, words in self.templates for w in words}

    def stretches(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """First word and word after the last of what runs of any template cover, overlapping
        ones as one. No run crosses a word that is in no template, so only stretches of template
        words are streamed."""
        known = bytes(map(self.vocabulary.get, words, repeat(0)))
        for stretch in re.finditer(rb"\x01{%d,}" % SHORTEST, known):
            first, start, stop = stretch.start(), -1, -1
            for end, length, _ in self.automaton.runs(words[first : stretch.end()], SHORTEST):
                if end - length >= stop:
                    if start >= 0:
                        yield first + start, first + stop
                    start = end - length
                stop = end
            if start >= 0:
                yield first + start, first + stop

    def segments(self, words: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """Template, end in ``words``, length, end in the template of the maximal runs of every
        template by itself; those of one template by their ends."""
        for first, last in self.stretches(words):
            inside = words[first:last]
            for t, automaton in enumerate(self.own):
                for end, length, state in automaton.runs(inside, SHORTEST):
                    for _, template_stop in automaton.ends[state]:
                        yield t, first + end, length, template_stop

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Label, first word, word after the last, and coverage of every license span: of the
        chains that cover enough, those not inside a better one."""
        found: list[tuple[str, int, int, float, int]] = []
        recent: dict[int, deque[Chain]] = {}

        def close(t: int, chain: Chain) -> None:
            label, words_of = self.templates[t]
            share = min(chain.covered / len(words_of), 1.0)
            if share >= COVERAGE:
                found.append((label, chain.start, chain.stop, share, chain.covered))

        for t, stop, length, template_stop in self.segments(words):
            open_chains = recent.setdefault(t, deque())
            while open_chains and open_chains[0].stop < stop - length - GAP:
                close(t, open_chains.popleft())
            new = Chain(stop - length, stop, template_stop, length)
            for chain in open_chains:
                if chain.template_stop < template_stop and chain.stop < stop:
                    # Words that the earlier segment covers already do not count again.
                    fresh = min(length, template_stop - chain.template_stop, stop - chain.stop)
                    if chain.covered + fresh > new.covered:
                        new = Chain(chain.start, stop, template_stop, chain.covered + fresh)
            open_chains.append(new)
        for t, open_chains in recent.items():
            for chain in open_chains:
                close(t, chain)
        return self._best(found)

    @staticmethod
    def _best(found: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float]]:
        """Of spans of one label that overlap, that of most words covered, of equal ones the
        first, with the best coverage of any template there. Then of those without a whole
        template none that lies inside a better covered one of another label: it is what the two
        notices have in common."""
        kept: list[tuple[str, int, int, float, int]] = []
        label, reach = None, 0
        for span in sorted(found, key=lambda s: (s[0], s[1], -s[4], -s[2])):
            if span[0] == label and span[1] < reach:
                best = max(span[3], kept[-1][3])
                widest = span if span[4] > kept[-1][4] else kept[-1]
                kept[-1] = (*widest[:3], best, widest[4])
            else:
                label, reach = span[0], span[2]
                kept.append(span)
            reach = max(reach, span[2])
        kept.sort(key=lambda s: (s[1], -s[2], -s[3]))
        out: list[tuple[str, int, int, float]] = []
        around: list[tuple[str, int, int, float, int]] = []
        for span in kept:
            around = [s for s in around if s[2] > span[1]]
            if not any(s[2] >= span[2] and s[3] > span[3] and s[0] != span[0] for s in around):
                out.append(span[:4])
            around.append(span)
        return sorted(out, key=lambda s: (s[1], s[2], s[0]))


def phrase_places(words: list[bytes], phrases: list[tuple[bytes, str]]) -> list[tuple[int, str]]:
    """First word and label of every place where a phrase's words stand consecutively."""
    places = []
    if words:
        line = b" " + b" ".join(words) + b" "
        for phrase, label in phrases:
            at, seen, upto = line.find(phrase), 0, 0
            while at >= 0:
                seen += line.count(b" ", upto, at)
                upto = at
                places.append((seen, label))
                at = line.find(phrase, at + 1)
    return places


def find_licenses(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    phrases: dict[str, str] | None = None,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """The columns ``keep`` (all, if not given) of every document and a struct ``license``:

    ``n_words``; ``n_base``, ``first_word``, ``last_word``, ``base_labels`` (places of the base
    phrases, their smallest and largest start in words, their labels); ``spans`` (label, first
    and last character, end exclusive, and coverage of each license span); ``labels`` (of both
    kinds); ``score`` (the best coverage, at least ``BASE_SCORE`` where a phrase stands, else 0).

    Labels are distinct and sorted. A null or empty text has no words, labels or spans. A text
    is one row's own; repeated rows are scanned each.
    """
    kept = docs.columns if keep is None else keep
    source = f"c{kept.index(text)}" if text in kept else "t"
    inner = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)],
        *([] if text in kept else [F.col(text).alias(source)]),
    )
    schema = ", ".join(
        [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
        + [
            "license struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,"
            "base_labels:array<string>,labels:array<string>,score:double,"
            "spans:array<struct<label:string,start:int,stop:int,coverage:double>>>"
        ]
    )
    span = pa.struct(
        [("label", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("coverage", pa.float64())]
    )
    kind = pa.struct(
        [(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
        + [("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string()))]
        + [("score", pa.float64()), ("spans", pa.list_(span))]
    )
    named = [(b" " + p.encode() + b" ", label) for p, label in (PHRASES if phrases is None else phrases).items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher([(label, alnum_words(notice)) for label, notice in templates])
        for batch in batches:
            rows = []
            for value in texts(batch, source):
                words = alnum_words(value)
                places = phrase_places(words, named)
                spans = matcher.spans(words)
                at = alnum_spans(value) if spans else []
                base = {label for _, label in places}
                starts = [start for start, _ in places]
                rows.append(
                    {
                        "n_words": len(words),
                        "n_base": len(places),
                        "first_word": min(starts, default=None),
                        "last_word": max(starts, default=None),
                        "base_labels": sorted(base),
                        "labels": sorted(base | {label for label, *_ in spans}),
                        "score": max([BASE_SCORE] * bool(places) + [s[3] for s in spans], default=0.0),
                        "spans": [
                            {"label": label, "start": at[a][0], "stop": at[b - 1][1], "coverage": share}
                            for label, a, b, share in spans
                        ],
                    }
                )
            n = len(kept)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(rows, kind)], [*batch.schema.names[:n], "license"]
            )

    out = inner.mapInArrow(scan, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "license")


def op4_licenses(docs: DataFrame) -> DataFrame:
    """Base phrases and license labels of every document."""
    found = F.col("license")
    return find_licenses(docs, keep=["doc_id"]).select(
        "doc_id",
        *[found[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        F.concat_ws(",", found["base_labels"]).alias("base_labels"),
        F.concat_ws(",", found["labels"]).alias("labels"),
        found["score"].alias("score"),
    )
