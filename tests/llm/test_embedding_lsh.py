"""p-stable hashing against all pairs."""

from __future__ import annotations

import math
import threading
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from odd_tables import sf, table

from factlab.llm import embedding_lsh, queries

SCHEMA = "vec_id long, embedding array<double>, node long, component_id string"


def slow(rows, similarity=0.9):
    """(id, links, component, kept) of all rows."""

    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    counts = [0] * len(rows)
    scaled = [np.array(v, float) / max(map(abs, v)) if good(v) else None for _, v in rows]
    units = [None if v is None else v / np.linalg.norm(v) for v in scaled]
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= similarity:
                counts[i] += 1
                counts[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [x for j, (x, _) in enumerate(rows) if find(j) == find(i) and x is not None]
        least = min(ids) if ids else None
        out.append((vec_id, counts[i], least, vec_id == least))
    return sorted(out, key=str)


def found(result):
    return sorted(map(tuple, result.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def test_op13_on_whole_table(spark):
    rows = [tuple(x) for x in sf(spark, "embeddings").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op13_embedding_lsh"](spark, "/root/testdata/sf0.001")
    assert found(got) == slow(rows)


@pytest.mark.parametrize("chunk", [7, embedding_lsh.CHUNK])
def test_groups_chains_and_odd_rows(spark, monkeypatch, chunk):
    """A hot group of near copies, equal rows, links at all strengths, and vectors without part."""
    monkeypatch.setattr(embedding_lsh, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        centre = rng.normal(size=16)
        rows += [centre + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.3]) for _ in range(4 if i else 60)]
    rows = [(i, (v * 10.0 ** rng.integers(-3, 4)).tolist()) for i, v in enumerate(rows)]
    rows += [(500 + i, rows[3][1]) for i in range(30)] + [(None, rows[5][1]), (None, [1.0, 2.0]), rows[9]]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [math.nan] * 16), (904, [None, 1.0]), (None, None)]
    rows += [(905, [math.inf, 1.0]), (906, [1.0, 2.0]), (907, [-1.0, -2.0]), (908, [1e200, 2e200]), (909, [3.0])]
    docs = table(spark, [(*x, 1, "n") for x in rows], SCHEMA).repartition(4)
    assert found(embedding_lsh.classes(docs)) == slow(rows)
    assert sum(x[1] > 20 for x in slow(rows)) > 50


def test_empty_table(spark):
    assert embedding_lsh.classes(table(spark, [], SCHEMA)).collect() == []


def test_pairs_at_the_limit_meet():
    """Measured on pairs of a cosine of just 0.9, as the shape promises; unrelated ones seldom meet."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(2000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.9 * a + math.sqrt(0.19) * side
    lines, tables = embedding_lsh.shape(2000)
    one, two = (embedding_lsh.keys(x, lines, tables) for x in (a, b))
    assert (one == two).any(axis=1).mean() >= 0.995
    assert (one == np.roll(one, 1, axis=0)).mean() < 2 / 2000


@pytest.mark.parametrize("round_bytes", [0, embedding_lsh.ROUND])
def test_tables_met_one_by_one_or_together(spark, monkeypatch, round_bytes):
    """Many tables and buckets, of which some are split: each link counts once."""
    for name, value in (("CELL", 20), ("CHUNK", 40), ("ROUND", round_bytes)):
        monkeypatch.setattr(embedding_lsh, name, value)
    rng = np.random.default_rng(11)
    rows = []
    for i in range(30):
        centre = rng.normal(size=12)
        rows += [centre + rng.normal(size=12) * rng.choice([0.02, 0.2, 0.3]) for _ in range(4 if i else 150)]
    rows = [(i, v.tolist()) for i, v in enumerate(rows)] + [(900, [1.0, 2.0]), (901, [1.1, 2.0]), (902, [-0.0, 1.0]), (903, [0.0, 1.0])]
    got = found(embedding_lsh.classes(table(spark, [(*x, 1, "n") for x in rows], SCHEMA).repartition(4)))
    assert got == slow(rows)
    assert max(x[1] for x in got) > 80


def test_disk_follows_the_vectors_not_the_tables(spark, monkeypatch):
    """Scratch tables and shuffle files together, at any time."""
    monkeypatch.setattr(embedding_lsh, "ROUND", 0)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(x) for x in blocks.localDirsString()] + [Path(spark.conf.get("spark.checkpoint.dir"))]

    def used():
        total = 0
        for file in (x for folder in folders for x in folder.rglob("*")):
            try:
                total += file.stat().st_size if file.is_file() else 0
            except FileNotFoundError:
                pass
        return total

    rows = np.random.default_rng(13).normal(size=(12_000, 64)).astype(np.float32)
    docs = table(spark, [(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    before, most, over = used(), [0], threading.Event()

    def watch():
        while not over.is_set():
            most[0] = max(most[0], used() - before)
            time.sleep(0.02)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        result = embedding_lsh.classes(docs)
    finally:
        over.set()
        watcher.join()
    assert 0 < most[0] < 4 * rows.nbytes
    assert used() - before < rows.nbytes
    assert result.where("n_links = 0 and kept").count() == len(rows)


def test_buckets_of_one_hash_are_told_apart():
    vectors = np.array([[1, 0], [0, 1], [1, 0.1], [0.1, 1]], np.float32)
    number = np.arange(4)
    columns = {
        "key": pa.array([np.uint16(x % 2).tobytes() for x in number], pa.binary()),
        "one": pa.array(np.zeros(4, np.int32)),
        "two": pa.array(np.zeros(4, np.int32)),
        "apart": pa.array([False] * 4),
        "node": pa.array(number),
        "copies": pa.array([1, 1, 1, 2]),
        "v": pa.array([x.tobytes() for x in vectors], pa.binary()),
        "keys": pa.array([b""] * 4, pa.binary()),
    }
    links = embedding_lsh._links(pa.table(columns), np.zeros(1, np.int64), "float32", "uint16", 0.9)
    rows = sorted((x["a"], x["b"], x["n"]) for x in links.to_pylist() if x["b"] is None)
    assert rows == [(0, None, 1), (1, None, 2), (2, None, 1), (3, None, 1)]
    assert sorted((x["a"], x["b"]) for x in links.to_pylist() if x["b"] is not None) == [(0, 2), (1, 3)]


def test_chances_match_a_draw():
    rng = np.random.default_rng(17)
    for lines in (1, 6, 40):
        x, z = rng.normal(size=(2, 20_000, lines))
        y = 0.9 * x + math.sqrt(0.19) * z
        a, b = np.abs(x).argmax(axis=1), np.abs(y).argmax(axis=1)
        at = np.arange(len(a))
        same = (a == b) & ((x[at, a] > 0) == (y[at, b] > 0))
        assert abs(same.mean() - embedding_lsh.together(lines)) < 0.015
