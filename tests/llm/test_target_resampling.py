"""Target resampling against plain counting."""

from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from odd_tables import ODD_ROWS, empty, odd, sf, table
from xxhash import xxh64_intdigest

from factlab.llm import queries, target_resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_features(text, ngram=1):
    text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    words = WORD.findall(text)
    runs = [" ".join(words[i : i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def slow(docs, target, ngram=1, buckets=10_000, percent=10, least=20):
    def bucket(run):
        return crc32(run.encode()) % buckets

    raw = Counter(bucket(x) for _, text in docs for x in slow_features(text, ngram)[1])
    wanted = Counter(bucket(x) for text in target for x in slow_features(text, ngram)[1])
    s_all, t_all = raw.total(), wanted.total()
    gain = {
        b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets))))
        for b in raw
    }
    out, able = [], []
    for doc_id, text in docs:
        n_words, runs = slow_features(text, ngram)
        weight = sum(gain[bucket(x)] for x in runs) // len(runs) if runs else 0
        h = int(sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(runs), weight, score))
        if n_words >= least:
            able.append((-score, doc_id is None, doc_id))
    drawn = sorted(able)[: len(able) * percent // 100]
    return sorted(out, key=str), {x[2]: i + 1 for i, x in enumerate(drawn)}


def check(result, want):
    rows = result.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(row[:4]) for row in rows), key=str) == want[0]
    assert {row.doc_id: row.rank for row in rows if row.rank is not None} == want[1]


def test_op12_on_whole_table(spark):
    docs = [tuple(x) for x in sf(spark, "documents").select("doc_id", "text").collect()]
    target = [x.text for x in sf(spark, "benchmark").collect()]
    got = queries.QUERIES["op12_target_resampling"](spark, "/root/testdata/sf0.001")
    assert all(kind == "bigint" for _, kind in got.dtypes)
    want = slow(docs, target)
    assert want[1]
    check(got, want)


@pytest.mark.parametrize("ngram, part", [(1, 7), (3, 20), (3, 1 << 20)])
def test_odd_rows_and_long_texts_in_parts(spark, monkeypatch, ngram, part):
    monkeypatch.setattr(target_resampling, "_PART", part)
    target = table(spark, [("Some plain words, word by WORD",), (None,), ("",)], "text string")
    args = {"ngram": ngram, "buckets": 50, "percent": 60, "least_words": 2}
    got = target_resampling.resampled(odd(spark), target, **args)
    texts = [x[0] for x in target.collect()]
    check(got, slow([row[:2] for row in ODD_ROWS], texts, ngram, 50, 60, 2))


def test_empty_tables(spark):
    target = table(spark, [], "text string")
    assert target_resampling.resampled(empty(spark), target).collect() == []
    check(target_resampling.resampled(odd(spark), target), slow([row[:2] for row in ODD_ROWS], []))


def test_equal_hashes_of_different_words_keep_slots_of_their_own():
    words = [b"ab", b"cd", b"ab", b"efg", b"cd", b"cde"]
    data = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    starts = ends - [len(x) for x in words]
    for same in (False, True):
        keys = np.array([7 if same else xxh64_intdigest(x) for x in words], np.uint64)
        slot, owner = target_resampling.intern(data, starts, ends, keys)
        assert len(set(slot.tolist())) == 4
        assert [words[owner[s]] for s in slot] == words
