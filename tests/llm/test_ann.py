"""Collision counting against brute force: distances exact, recall measured."""

from __future__ import annotations

import math

import numpy as np
import pytest
from odd_tables import sf, table
from pyspark.sql import functions as F

from factlab.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, query_id string"


def brute(rows, asks, k):
    """For each query its k nearest (id, distance) by full search."""
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for i, v in good:
        if asks(i):
            near = [
                (float(np.sqrt(((w - v) ** 2).sum())), j)
                for j, w in good
                if j != i and len(w) == len(v)
            ]
            out[i] = sorted(near)[:k]
    return out


def recall(got, want):
    hits = sum(len({x[2] for x in got if x[0] == q} & {j for _, j in near}) for q, near in want.items())
    return hits / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("block", [ann.BLOCK, 64])
def test_op10_on_whole_table(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rows = list(map(tuple, sf(spark, "embeddings").select("vec_id", "embedding").collect()))
    want = brute(rows, lambda i: i % 100 == 0, 10)
    got = list(map(tuple, queries.QUERIES["op10_collision_ann"](spark, "/root/testdata/sf0.001").collect()))
    assert sorted(x[:2] for x in got) == [(q, r) for q in sorted(want) for r in range(1, 11)]
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, _, i, score in got:
        assert score == pytest.approx(float(np.linalg.norm(vectors[q] - vectors[i])), abs=1e-12)
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("size", [1, 3, 32, 128])
def test_recall_and_candidates_on_clusters(size):
    """Near points are found, and most of the far ones are never verified."""
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(40, size)) * 10
    vectors = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, size))
    index = ann.Index(vectors, ann._lines(size))
    hits = verified = 0
    for q in range(0, 4000, 100):
        skip = np.arange(4000) == q
        places, distances = index.search(vectors[q], 10, skip)
        true = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        true[q] = np.inf
        best = places[np.argsort(distances[places], kind="stable")[:10]]
        hits += len(set(best.tolist()) & set(np.argsort(true, kind="stable")[:10].tolist()))
        verified += len(places)
    assert hits / 400 >= 0.95
    if size > 1:
        assert verified / (40 * 4000) < 0.35


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, [1.0, 0.0], "x"),
        (1, [1.0, 0.0], None),
        (2, [1.0, 0.0], None),
        (2, [1.0, 0.0], None),
        (3, [0.0, 0.0], None),
        (4, None, None),
        (5, [nan, 1.0], None),
        (6, [inf, 1.0], None),
        (7, [None, 1.0], None),
        (8, [], None),
        (9, [5.0, 5.0, 5.0], None),
        (None, [1.0, 0.0], None),
        (10, [0.0, 1.0], None),
        (200, [1.0, 1.0, 1.0], None),
        (300, [2.0], None),
        (400, None, None),
    ]
    got = ann.nearest(table(spark, rows, SCHEMA), F.col("vec_id") % 100 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = sorted(map(tuple, got.collect()))
    assert [row[:3] for row in found] == [(100, 1, 1), (100, 2, 2), (100, 3, 2), (100, 4, 10), (200, 1, 9)]
    assert found[3][3] == math.sqrt(2)
    none = table(spark, [], SCHEMA)
    assert ann.nearest(none, F.col("vec_id") % 100 == 0).collect() == []
    assert ann.nearest(table(spark, rows[1:3], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []


def test_one_vector_many_times(spark):
    """A third of the rows are one vector; ties go to the smaller id, across blocks."""
    rng = np.random.default_rng(5)
    rows = [
        (i, [1.0] * 8 if i % 3 == 0 else rng.normal(size=8).tolist(), None) for i in range(1500)
    ]
    found = ann.nearest(table(spark, rows, SCHEMA), F.col("vec_id") == 300).collect()
    assert [row.vec_id for row in sorted(found, key=lambda row: row["rank"])] == list(range(0, 30, 3))


@pytest.mark.parametrize("block", [ann.BLOCK, 4])
def test_repeated_query_rows_are_asked_once_for_each_vector(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rows = [(i, [float(i), 1.0], "") for i in range(1, 13)]
    rows += [(100, [0.0, 1.0], "")] * 2 + [(200, [0.0, 1.0], ""), (200, [12.4, 1.0], "")]
    got = ann.nearest(table(spark, rows, SCHEMA), F.col("vec_id").isin(100, 200), 3).collect()
    of = lambda i: sorted((x.rank, x.vec_id) for x in got if x.query_id == i)
    assert of(100) == [(1, 200), (2, 1), (3, 2)]
    assert of(200) == [(1, 12), (1, 100), (2, 11), (2, 100), (3, 1), (3, 10)]
