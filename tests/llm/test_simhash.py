"""SimHash classes against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import ODD_ROWS, empty, odd, sf, table
from xxhash import xxh64_intdigest

from factlab.llm import queries, simhash
from factlab.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text, n=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_roots(fps, bits=2):
    """For each fingerprint the first place that it reaches over links."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    array = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= bits).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab Cé\t\n\x1c", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == slow_fingerprint(text)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=2))
def test_some_chain_finds_every_link(value, flips):
    other = value
    for bit in flips:
        other ^= 1 << bit
    pair = np.array([value, other], np.uint64)
    for segments in (3, 5, 7):
        masks = simhash._masks(segments)
        exact = simhash._exact(2, segments)
        found = False
        for start in range(segments):
            mask = sum(masks[(start + k) % segments] for k in range(exact))
            same = value & mask == other & mask
            found |= same and bool(simhash.linked_pairs(pair, start, 2, segments))
        assert found


def clustered(n_clusters, members, seed):
    rng = random.Random(seed)
    fps = []
    for _ in range(n_clusters):
        base = rng.getrandbits(64)
        for _ in range(members):
            fp = base
            for bit in rng.sample(range(64), rng.choice([0, 1, 1, 2, 3])):
                fp ^= 1 << bit
            fps.append(fp)
            if rng.random() < 0.3:
                base ^= 1 << rng.randrange(64)
    return list(dict.fromkeys(fps))


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("bucket", [1, 4, 64])
def test_components_equal_brute_force(spark, monkeypatch, bits, bucket):
    """Small buckets make nearly all of them hot, large ones none."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    fps = clustered(6, 40, seed=bits)
    df = spark.createDataFrame([(simhash._signed(fp),) for fp in fps], "fp long")
    found = components(simhash.links(df, bits=bits)).collect()
    root = {row.node: row.root for row in found}
    got = [root.get(simhash._signed(fp), simhash._signed(fp)) for fp in fps]
    want = slow_roots(fps, bits)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    roots = dict(map(tuple, components(links).collect()))
    assert roots == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_classes_of_odd_rows(spark):
    got = simhash.classes(odd(spark)).collect()
    assert len(got) == len(ODD_ROWS)
    fps = [slow_fingerprint(text) for _, text, _ in ODD_ROWS]
    want = []
    for (i, _, _), root, fp in zip(ODD_ROWS, slow_roots(fps), fps):
        ids = [r[0] for r, x in zip(ODD_ROWS, slow_roots(fps)) if x == root and r[0] is not None]
        want.append((i, f"{fp:016x}", min(ids, default=None)))
    key = lambda row: (row[0] is None, row[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash.classes(empty(spark)).collect() == []


def test_first_of_each_keeps_one_row_and_all_columns(spark):
    docs = odd(spark)
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    # Blank texts and NULL are one group, the repeated rows another.
    assert sorted((row.doc_id or 0) for row in kept.collect()) == [0, 1, 2, 5, 6, 7, 8]
    assert simhash.first_of_each(empty(spark)).collect() == []


def test_rows_without_ids(spark):
    docs = table(spark, [(None, "a b c d", "x"), (None, "a b c d", "x"), (None, "e f", "x")])
    assert simhash.first_of_each(docs).count() == 2
    assert {row.component_id for row in simhash.classes(docs).collect()} == {None}


def test_op2_query(spark):
    docs = sorted(map(tuple, sf(spark, "documents").select("doc_id", "text").collect()))
    fps = [slow_fingerprint(text) for _, text in docs]
    want = [
        (doc_id, f"{fp:016x}", docs[root][0])
        for (doc_id, _), fp, root in zip(docs, fps, slow_roots(fps))
    ]
    got = queries.QUERIES["op2_simhash"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect())) == want
