"""The pipeline stage by stage against brute force, and on odd and empty tables."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from odd_tables import ODD_ROWS, empty, odd, sf
from pyspark.sql import functions as F
from test_simhash import slow_fingerprint, slow_roots

import corpus_pipeline  # noqa: I001
from factlab.llm import importance, line_crf
from factlab.llm.common import stored
from factlab.llm.queries import by_turns

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_on_documents(spark):
    docs = sf(spark, "documents")
    columns, results = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(stored(stage(spark, results[-1], SF), name.replace(" ", "-")))
    assert all(x.columns == columns for x in results[:-1])
    raw, drawn, ruled, single, mixed, pieces = (x.collect() for x in results)

    ids = [{row.doc_id for row in x} for x in (raw, drawn, ruled, single)]
    # Of 200 documents the classifier may keep all: its labels are too few to part them.
    assert ids[3] <= ids[2] <= ids[1] <= ids[0] and len(single) < len(drawn) <= len(raw)
    # Stage 1 keeps what the operator draws, stage 2 what it judges so.
    labels = sf(spark, "labels")
    kept = importance.resampled(results[0], labels).where("kept").collect()
    assert {row.doc_id for row in kept} == ids[1]
    judged = line_crf.judged(results[1], line_crf.train(results[1], labels))
    assert {row.doc_id for row in judged.where("kept").collect()} == ids[2]
    # Stage 3: the first document of each group of all pairs.
    rows = sorted(ruled, key=lambda row: row.doc_id)
    roots = slow_roots([slow_fingerprint(row.text) for row in rows])
    assert ids[3] == {rows[i].doc_id for i in set(roots)}
    # Stage 4: whole documents, none over twice, words near the targets.
    times = Counter(row.doc_id for row in mixed)
    assert set(times) <= ids[3] and max(times.values()) <= 2
    sizes = {row.doc_id: len(WORD.findall(row.text)) for row in single}
    assert abs(sum(sizes[i] * n for i, n in times.items()) / sum(sizes.values()) - 1.5) < 0.1
    # Stage 5: each document's ids lie in pieces, as often as it is in the mix.
    tokens = Counter()
    for row in pieces:
        tokens[row.doc_id] += row.length
    whole = {row.doc_id: row.doc_tokens for row in pieces}
    assert tokens == {i: whole[i] * n for i, n in times.items()}
    assert results[-1].columns[:5] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def test_boilerplate_goes_from_unlabelled_input(spark):
    """The rules' field comes from the raw table, whatever the classifier has left."""
    sf_dir = "/root/testdata/sf0.01"
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = line_crf.judged(raw, line_crf.train(raw, labels))
    plant = judged.where("not kept and not base_failed").select("doc_id")
    good = judged.where("kept").select("doc_id").limit(50)
    ids = plant.unionByName(good)
    docs = raw.join(ids, "doc_id").select(*raw.columns).withColumn("doc_id", F.col("doc_id") + 10**9)
    left = corpus_pipeline.quality_rules(spark, docs, sf_dir).select(F.col("doc_id") - 10**9)
    left = {row[0] for row in left.collect()}
    gone = {row.doc_id for row in plant.collect()}
    assert gone and not left & gone
    assert len(left) == 50


def test_run_is_the_stages(spark):
    first = corpus_pipeline.run(spark, SF)
    digest = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    again = corpus_pipeline.run(spark, SF)
    for name in ("doc_id", "doc_tokens"):
        assert first.select(name).distinct().count() == again.select(name).distinct().count()
    assert first.agg({"length": "sum"}).first()[0] == again.agg({"length": "sum"}).first()[0]
    assert set(digest) <= set(first.columns)


@pytest.mark.parametrize("which", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_and_empty_tables(spark, which):
    stage = dict(corpus_pipeline.STAGES)[which]
    docs = odd(spark)
    got = stage(spark, docs, SF)
    if which != "packing":
        assert got.columns == docs.columns
        texts = {row[1] for row in ODD_ROWS}
        assert all(row.text in texts for row in got.collect())
    else:
        assert got.select("doc_id").distinct().count() == 9
    assert stage(spark, empty(spark), SF).collect() == []


def test_weights_follow_code_points(spark):
    sources = spark.createDataFrame([(x,) for x in ("b", "B", "é", None, "z")], "source string")
    got = {row.source: row.weight for row in by_turns(sources).collect()}
    assert got == {"B": 5, "b": 2, "z": 1, "é": 5, None: 2}
