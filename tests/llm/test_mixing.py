"""Capped water-filling against SQL and against its own rules."""

from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest
from odd_tables import ODD_ROWS, empty, odd, table
from pyspark.sql import functions as F

from factlab.llm import mixing, queries


def by_ones(sources):
    return sources.withColumn("weight", F.lit(1))


@pytest.mark.parametrize(
    "sources, total, want",
    [
        ([("a", 5, 100), ("b", 2, 100)], 70.0, {"a": 50, "b": 20}),
        ([("a", 5, 10), ("b", 2, 100), ("c", 1, 100)], 170.0, {"a": 20, "b": 100, "c": 50}),
        ([("a", 8, 10), ("b", 4, 15), ("c", 1, 100)], 100.0, {"a": 20, "b": 30, "c": 50}),
        ([("a", 1, 10), ("b", 1, 20)], 1000.0, {"a": 20, "b": 40}),  # not to be met
        ([("a", 1, 0), ("b", 1, 20)], 30.0, {"a": 0, "b": 30}),
        ([], 0.0, {}),
    ],
)
def test_water_fill(spark, sources, total, want):
    df = table(spark, sources, "source string, weight long, source_size long")
    filled = mixing.water_fill(df, F.lit(total), 2.0).collect()
    assert {row.source: row.target for row in filled} == pytest.approx(want)


@pytest.mark.parametrize("share", [0.3, 1.0, 1.5, 1.9])
def test_sources_meet_their_targets(spark, share):
    docs = [(i, "w " * (1 + i * 7 % 40), f"s{i % 5 % 3}") for i in range(300)]
    rows = mixing.mix(table(spark, docs), by_ones, share=share).collect()
    assert len(rows) == 300
    taken, target = defaultdict(int), {}
    for row in rows:
        n = row.repeats * row["size"] + row.extra_words
        assert 0 <= row.extra_words <= row["size"] and n <= 2 * row["size"]
        taken[row.source] += n
        target[row.source] = row.target
    assert all(abs(taken[source] - target[source]) <= 0.5 for source in target)
    assert sum(target.values()) == pytest.approx(share * sum(row["size"] for row in rows))


def test_whole_documents_come_near(spark):
    docs = [(i, "w " * (1 + i * 7 % 40), f"s{i % 2}") for i in range(200)]
    rows = mixing.mix(table(spark, docs), by_ones, share=1.3, whole_documents=True)
    out = mixing.repeated(rows, ["doc_id", "text", "source"])
    assert out.columns == ["doc_id", "text", "source"]
    for source in ("s0", "s1"):
        want = rows.where(F.col("source") == source).first().target
        words = sum(len(row.text.split()) for row in out.where(F.col("source") == source).collect())
        assert abs(words - want) <= 20  # half of the largest document


def test_hot_source_and_reruns(spark):
    docs = [(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 50}") for i in range(3000)]
    df = table(spark, docs)
    first = sorted(map(str, mixing.mix(df, by_ones).collect()))
    assert first == sorted(map(str, mixing.mix(df.repartition(7), by_ones).collect()))
    rows = mixing.mix(df, by_ones).where("source = 'hot'").collect()
    got = sum(row.repeats * row["size"] + row.extra_words for row in rows)
    assert abs(got - rows[0].target) <= 0.5


def test_many_sources_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    docs = [(i, "w " * 5, f"s{i % 40}") for i in range(400)]
    assert mixing.mix(table(spark, docs), by_ones).count() == 400


def test_odd_rows(spark):
    rows = mixing.mix(odd(spark), by_ones).collect()
    assert len(rows) == len(ODD_ROWS)
    sizes = {row.doc_id: row["size"] for row in rows}
    assert (sizes[2], sizes[3], sizes[4], sizes[8]) == (0, 0, 0, 3000)
    assert mixing.mix(empty(spark), by_ones).collect() == []
    blank = table(spark, [(1, None, "a"), (2, "", None)])
    assert {row.target for row in mixing.mix(blank, by_ones).collect()} == {0.0}


def duck(docs, query):
    """The rows that the SQL of ``query`` gives on documents."""
    connection = duckdb.connect()
    connection.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    if docs:
        connection.executemany("insert into documents values (?, ?, ?)", docs)
    return connection.execute(queries.ORACLES[query]).fetchall()


@pytest.mark.parametrize("which", ["odd", "empty", "skewed"])
def test_op4_query_equals_its_sql(spark, tmp_path, which):
    docs = {
        "odd": ODD_ROWS,
        "empty": [],
        "skewed": [(i // 2, "w " * (i % 13), "hot" if i % 3 else f"s{i % 11}") for i in range(500)],
    }[which]
    table(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op4_mixing"](spark, str(tmp_path))
    key = lambda row: tuple((x is not None, x) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(duck(docs, "op4_mixing"), key=key)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
