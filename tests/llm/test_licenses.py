"""License scans against plain search."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import ODD_ROWS, empty, odd, sf

from factlab.llm import license_scan, queries
from factlab.llm.license_scan import Automaton, Scanner

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

small = st.lists(st.integers(1, 3), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(small, min_size=1, max_size=4), small)
def test_matching_statistics(templates, words):
    automaton = Automaton(templates)
    for i, (length, state) in enumerate(automaton.statistics(words)):
        ends = {
            k: {
                (t, p)
                for t, x in enumerate(templates)
                for p in range(k - 1, len(x))
                if x[p - k + 1 : p + 1] == words[i - k + 1 : i + 1]
            }
            for k in range(1, i + 2)
        }
        longest = max((k for k in ends if ends[k]), default=0)
        assert length == longest
        if length:
            assert automaton.places[state] == ends[length]


def slow_base(text):
    words = WORD.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), labels


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["CC", "by", "BY-cc", "all rights", "Reserved.", "é", "general", "public license", "\x7f"]), max_size=20))
def test_base_places(parts):
    text = " ".join(parts)
    found = Scanner(license_scan.TEMPLATES, license_scan.PHRASES).scan(text)
    n, n_base, first, last, labels = slow_base(text)
    assert (found["n_words"], found["n_base"]) == (n, n_base)
    assert (found["first_word"], found["last_word"]) == (first, last)
    assert found["base_labels"] == sorted(labels) and labels <= set(found["labels"])
    assert 0 <= found["score"] <= 1


def test_templates_are_found_with_gaps_and_changes():
    scanner = Scanner(license_scan.TEMPLATES, license_scan.PHRASES)
    for label, text in license_scan.TEMPLATES:
        found = scanner.scan(f"Some text before. {text} And some after.")
        assert found["score"] == 1.0 and label in found["labels"]
    words = license_scan.TEMPLATES[2][1].split()
    words[20:20] = ["inserted", "words"]
    del words[40:42]
    found = scanner.scan("x " * 10_000 + " ".join(words))
    assert found["labels"] == ["mit"] and 0.8 < found["score"] < 1
    (span,) = [x for x in found["spans"] if x["template"] == 2]
    assert span["first_word"] == 10_000 and span["last_word"] > 10_060
    assert scanner.scan("you may not use this file in any way")["labels"] == []


def test_odd_rows(spark):
    rows = license_scan.scan(odd(spark)).collect()
    assert len(rows) == len(ODD_ROWS)
    for row in rows:
        assert row.labels == [] and row.score == 0.0 and row.n_base == 0
    assert {row.doc_id: row.n_words for row in rows}[2] == 0
    assert license_scan.scan(empty(spark)).collect() == []


def test_op8_query(spark):
    texts = dict(map(tuple, sf(spark, "documents").select("doc_id", "text").collect()))
    rows = queries.QUERIES["op8_license_scan"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for row in rows:
        n, n_base, first, last, labels = slow_base(texts[row.doc_id])
        assert tuple(row)[1:6] == (n, n_base, first, last, ",".join(sorted(labels)))
        assert labels <= set(row.labels.split(","))
