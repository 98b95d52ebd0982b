"""License scans with a generalised suffix automaton of the words of license templates.

A text is streamed through the automaton, which gives at each word the longest run that
ends there and stands in some template. Runs that cannot grow (maximal matches) of
``MIN_MATCH`` words or more are chained in text and template order, with at most
``MAX_GAP`` other words between two of them. The best chain of each template covers a
share of its words; from ``MIN_COVER`` on the template's label holds and its span is
reported. Beside this, ``PHRASES`` are looked up word by word.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. NULL and
empty texts have no words, no labels and score 0. Of chains that cover as much the
earlier one is reported. Repeated rows are scanned each. An empty table gives an empty
result. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import texts_of

MIN_MATCH = 4
MAX_GAP = 20
MIN_COVER = 0.6

#: Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Wordings of licenses in wide use, with a label for each.
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions",
    ),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
        "express or implied",
    ),
    ("gpl", "this work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version",
    ),
    (
        "lgpl",
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software",
    ),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by", "licensed under CC BY 4.0"),
    (
        "cc-by",
        "This work is licensed under the Creative Commons Attribution 4.0 International License",
    ),
]

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


class Automaton:
    """Generalised suffix automaton of sequences of word numbers.

    ``places`` has for each state the (template, place of the last word) at which its
    runs stand.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for template, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.places[last].add((template, place))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.places[self.link[state]] |= self.places[state]

    def _state(self, length: int, onward: dict[int, int], link: int) -> int:
        self.next.append(onward)
        self.length.append(length)
        self.link.append(link)
        self.places.append(set())
        return len(self.next) - 1

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            onward = self.next[state][word]
            tight = self.length[onward] == self.length[state] + 1
            self.link[new] = onward if tight else self._split(state, word, onward)
        return new

    def _split(self, state: int, word: int, onward: int) -> int:
        """A state for the runs of ``onward`` that are no longer than from ``state``."""
        clone = self._state(self.length[state] + 1, dict(self.next[onward]), self.link[onward])
        while state >= 0 and self.next[state].get(word) == onward:
            self.next[state][word] = clone
            state = self.link[state]
        self.link[onward] = clone
        return clone

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """At each word the length of the longest run that ends there, and its state."""
        state, length = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            onward = self.next[state].get(word)
            if onward is not None:
                state, length = onward, length + 1
            yield length, state


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.labels = [label for label, _ in templates]
        sequences = [words_of(text) for _, text in templates]
        known = sorted({word for sequence in sequences for word in sequence})
        self._known = {word: i + 1 for i, word in enumerate(known)}
        numbered = [[self._known[word] for word in sequence] for sequence in sequences]
        self.sizes = [len(sequence) for sequence in numbered]
        self.automaton = Automaton(numbered)
        more = sorted({word for phrase in phrases for word in words_of(phrase)} - set(known))
        # Numbers above the templates' words occur in phrases only.
        self._known |= {word: len(known) + 1 + i for i, word in enumerate(more)}
        self._phrases = [
            ([self._known[word] for word in words_of(phrase)], label)
            for phrase, label in phrases.items()
        ]

    def scan(self, text: str) -> dict:
        words = words_of(text)
        ids = np.fromiter(map(self._known.get, words, repeat(0)), np.int64, len(words))
        starts, base = [], set()
        for phrase, label in self._phrases:
            n = len(ids) - len(phrase) + 1
            if n > 0:
                same = np.logical_and.reduce([ids[i : i + n] == x for i, x in enumerate(phrase)])
                found = np.flatnonzero(same)
                if len(found):
                    base.add(label)
                    starts.append(found)
        spans = self._spans(ids)
        labels = base | {span["label"] for span in spans if span["share"] >= MIN_COVER}
        return {
            "n_words": len(words),
            "n_base": sum(map(len, starts)),
            "first_word": int(min(x[0] for x in starts)) if starts else None,
            "last_word": int(max(x[-1] for x in starts)) if starts else None,
            "base_labels": sorted(base),
            "labels": sorted(labels),
            "score": max((span["share"] for span in spans), default=0.0),
            "spans": spans,
        }

    def _spans(self, ids: np.ndarray) -> list[dict]:
        """The best chain of each template that has a match."""
        matches = [match for run in _runs(ids) for match in self._matches(ids, *run)]
        best: dict[int, tuple] = {}
        open_: dict[int, list[tuple]] = {}
        for first, last, state in matches:
            for template, place in sorted(self.automaton.places[state]):
                begin = place - (last - first)
                # (covered, first word, last word, last place in the template)
                chain = (last - first + 1, first, last, place)
                near = [x for x in open_.get(template, []) if first - x[2] <= MAX_GAP + 1]
                for covered, start, end, at in near:
                    # Words that both matches hold count once.
                    twice = max(0, end + 1 - first, at + 1 - begin)
                    more = last - first + 1 - twice
                    if start < first and end < last and at < place and more > 0:
                        chain = max(chain, (covered + more, start, last, place), key=_rank)
                open_[template] = [*near, chain]
                best[template] = max(best.get(template, chain), chain, key=_rank)
        return [
            {
                "label": self.labels[template],
                "template": template,
                "first_word": start,
                "last_word": end,
                "share": covered / self.sizes[template],
            }
            for template, (covered, start, end, _) in sorted(best.items())
        ]

    def _matches(self, ids: np.ndarray, begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Maximal matches of one run of known words: first word, last word, state."""
        before, state_before = 0, 0
        for i, (length, state) in enumerate(self.automaton.statistics(ids[begin:end].tolist())):
            if length <= before and before >= MIN_MATCH:
                yield begin + i - before, begin + i - 1, state_before
            before, state_before = length, state
        if before >= MIN_MATCH:
            yield end - before, end - 1, state_before


def _rank(chain: tuple) -> tuple[int, int]:
    return chain[0], -chain[1]


def _runs(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of at least ``MIN_MATCH`` known words in a row."""
    known = np.concatenate([[0], ids > 0, [0]])
    edges = np.flatnonzero(np.diff(known))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= MIN_MATCH
    return list(zip(begins[long].tolist(), ends[long].tolist()))


@cache
def _scanner() -> Scanner:
    return Scanner(TEMPLATES, PHRASES)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, counts, labels and ``score`` (greatest share of a template), and ``spans``.

    A span names the template, its label, the first and last word of the chain, and the
    share it covers.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    strings = pa.list_(pa.string())
    spans = [
        ("label", pa.string()),
        ("template", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("share", pa.float64()),
    ]
    fields = [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", strings),
        ("labels", strings),
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct(spans))),
    ]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner()
        for batch in batches:
            found = [scanner.scan(text) for text in texts_of(batch, "text")]
            table = pa.RecordBatch.from_pylist(found, pa.schema(fields))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *table.columns], ["id", *table.schema.names]
            )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels array<string>, labels array<string>, score double, spans array<struct<"
        "label:string,template:long,first_word:long,last_word:long,share:double>>"
    )
    return rows.mapInArrow(find, schema).withColumnRenamed("id", id_column)
