"""The queries of this package on the given tables, and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factlab.llm import (
    ann,
    conversation_repair,
    embedding_lsh,
    importance,
    license_scan,
    line_crf,
    simhash,
    target_resampling,
    url_filter,
)
from factlab.llm.common import importable, read_table, stored
from factlab.llm.mixing import mix, taken_words
from factlab.llm.packing import pack
from factlab.llm.token_counts import count_tokens
from factlab.llm.token_files import read_token_files, write_token_files
from factlab.sources.scratch import fresh_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def _query(function):
    @wraps(function)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = query
    return query


# ---- token counts -------------------------------------------------------------


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counts = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


# ---- mixing -------------------------------------------------------------------


def by_turns(sources: DataFrame) -> DataFrame:
    """Weights 5, 2, 1 by turns over the sources in code point order, NULL last."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) % 3
    return sources.withColumn(
        "weight", F.when(turn == 1, 5).when(turn == 2, 2).otherwise(1).cast("long")
    )


@_query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"), by_turns)
    return mixed.select(
        "doc_id", "size", "source_size", "target", taken_words().alias("taken")
    )


# The same clamping as a recursion: each round sums what the clamped sources give.
ORACLES["op4_mixing"] = r"""
with recursive sized as (
  select doc_id, source, md5('17:' || coalesce(doc_id::varchar, '')) as draw,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         case row_number() over (order by source collate "C" nulls last) % 3
           when 1 then 5 when 2 then 2 else 1 end as weight
  from sized group by source),
goal as (select sum(source_size) * 1.5::double as total from sources),
rounds as (
  select 0 as r, 0::bigint as n, (select total from goal) as rest,
         (select sum(weight) from sources)::bigint as weight
  union all
  select r.r + 1, s.n, (select total from goal) - s.given, s.weight
  from rounds as r, lateral (
    select count(*) filter (where over) as n, coalesce(sum(cap) filter (where over), 0) as given,
           (sum(w) filter (where not over))::bigint as weight
    from (select weight as w, source_size * 2.0::double as cap,
                 weight * r.rest / r.weight > source_size * 2.0::double as over
          from sources)) as s
  where s.n > r.n and s.weight is not null),
settled as (select rest, weight as left_weight from rounds order by r desc limit 1),
targets as (
  select source, source_size,
         least(weight * rest / left_weight, source_size * 2.0::double) as target
  from sources, settled),
plans as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as epochs from targets),
drawn as (
  select s.*, p.source_size, p.target, p.epochs,
         round(p.target - p.epochs * p.source_size)::bigint as part,
         sum(s.size) over (partition by s.source, s.draw) as there,
         sum(s.size) over (partition by s.source order by s.draw range unbounded preceding) as upto
  from sized as s join plans as p on s.source is not distinct from p.source)
select doc_id, size, source_size::bigint as source_size, target,
       (epochs * size + case when upto <= part then size
          when upto - there < part then (part - (upto - there)) * size // there
          else 0 end)::bigint as taken
from drawn
"""


# ---- token files and packing --------------------------------------------------


@_query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = fresh_path(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    manifest = stored(write_token_files(docs, folder, tokenizer, end_id=0), "token-manifest")
    return read_token_files(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pieces_digest(pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


# ---- near-duplicates ----------------------------------------------------------


@_query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(read_table(spark, sf_dir, "documents"))


# ---- quality ------------------------------------------------------------------


@_query
def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    crf = line_crf.train(docs, read_table(spark, sf_dir, "labels"))
    return line_crf.judged(docs, crf)


@_query
def op9_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.resampled(docs, read_table(spark, sf_dir, "labels"))
    return drawn.select("doc_id", "log_weight", "draw", "kept")


# ---- licenses -----------------------------------------------------------------


@_query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


# ---- nearest neighbours -------------------------------------------------------


@_query
def op10_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, F.col("vec_id") % 100 == 0)


# ---- urls ---------------------------------------------------------------------

URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


@_query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    judged = url_filter.judged(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


# ---- conversations ------------------------------------------------------------------


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(read_table(spark, sf_dir, "conversations"))


# ---- target distribution --------------------------------------------------------------


@_query
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return target_resampling.resampled(docs, target)


# ---- near-duplicate embeddings ----------------------------------------------------------


@_query
def op13_embedding_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_lsh.classes(read_table(spark, sf_dir, "embeddings"))
