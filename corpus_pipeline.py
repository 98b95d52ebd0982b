"""A training corpus from raw documents: five stages, each an operator of ``factlab.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All
but the last return the columns of the documents; the last returns packed pieces. Names
of other columns do not matter, repeated rows and NULL in any column are handled as the
operators state, and an empty table runs through to an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlab.llm import importance, line_crf, simhash
from factlab.llm.common import by_place, importable, place_of, read_table, stored
from factlab.llm.mixing import mix, repeated
from factlab.llm.packing import pack
from factlab.llm.queries import by_turns, pieces_digest


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance weight; those not drawn go."""
    drawn = importance.resampled(docs, read_table(spark, sf_dir, "labels"), as_placed=True)
    return drawn.where("kept").drop("log_weight", "draw", "kept").toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and consist of content lines for the most part.

    The field is trained on the raw documents, as ``docs`` has few labelled bad ones left.
    """
    raw = read_table(spark, sf_dir, "documents")
    crf = line_crf.train(raw, read_table(spark, sf_dir, "labels"))
    return line_crf.clean(docs, crf)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of two bits link, the one of the smallest id."""
    return simhash.first_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources come near their target weights."""
    names = {x: place_of(docs, y) for x, y in COLUMNS.items()}
    rows = by_place(docs)
    mixed = mix(rows, by_turns, whole_documents=True, **names)
    return repeated(mixed, rows.columns).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens, with the digest of their ids."""
    return pieces_digest(pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


COLUMNS = {"id_column": "doc_id", "text_column": "text", "source_column": "source"}

STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("packing", packing),
]

#: The field, the trained weights and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents, each result written and read again."""
    importable(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
