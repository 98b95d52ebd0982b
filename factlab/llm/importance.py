"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams (words and pairs of words, ``BUCKETS``
buckets) are counted: one over all documents, one over those named as target. A
document's log weight is the sum of log(target / raw) over its n-grams. Adding seeded
Gumbel noise and taking the k greatest draws k documents without replacement by weight;
the others are rejected.

``calibrated_share`` finds k from labelled documents: as many as have a weight above the
one that parts labelled good from bad ones best, where a good document lost counts
``CARE`` times as much as a bad one kept.

NULL and empty texts have log weight 0. Repeated rows with one id get the same noise, and
rows that tie at the last place are all taken. A NULL id is drawn like any other. An
empty table, or one without target documents, gives weights of 0. Results keep the
columns of their input, whatever their names, with ``log_weight`` and ``draw`` behind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from factlab.llm.common import by_place, place_of, stored, texts_of

BUCKETS = 1 << 14
#: The target starts from so many n-grams a bucket, spread as in the raw texts.
SMOOTHING = 10.0
#: Of these many labelled rows at most, the good ones of one half are the target; the
#: other half calibrates, on documents that the target does not hold.
LABELLED = 20_000
#: What the loss of all good documents counts against the stay of all bad ones.
CARE = 10.0
#: Words whose hash a worker keeps.
_MEMO_WORDS = 400_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SLOTS = 4096
_words: dict[str, int] = {}


def ngrams(text: str) -> np.ndarray:
    """The buckets of all words and pairs of neighbouring words, repeats included."""
    tokens = _TOKEN.findall(text.lower())
    if len(_words) > _MEMO_WORDS:
        _words.clear()
    for token in set(tokens).difference(_words):
        _words[token] = crc32(token.encode("utf-8", "surrogatepass"))
    ones = np.fromiter(map(_words.__getitem__, tokens), np.uint64, len(tokens))
    pairs = ones[:-1] * np.uint64(0x9E3779B97F4A7C15) + ones[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    # Any word said twice in a row is one and the same pair.
    pairs[ones[:-1] == ones[1:]] = 1
    both = np.concatenate([ones * np.uint64(0xD6E8FEB86659FD93), pairs])
    return ((both ^ both >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)


def fit(docs: DataFrame, target: Column, text_column: str = "text") -> np.ndarray:
    """log(target / raw) of each bucket; counts run over all documents.

    Each task gives its sums, so what is shuffled depends on the buckets and tasks, and
    the driver gets one row for each bucket.
    """
    rows = docs.select(F.col(text_column).alias("text"), target.alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, chosen in zip(texts_of(batch, "text"), batch.column("target").to_pylist()):
                found = np.bincount(ngrams(text), minlength=BUCKETS)
                sums[0] += found
                if chosen:
                    sums[1] += found
        some = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (some, sums[0][some], sums[1][some])], ["bucket", "n", "chosen"]
        )

    counted = rows.mapInArrow(count, "bucket long, n long, chosen long")
    sums = np.zeros((2, BUCKETS))
    for row in counted.groupBy("bucket").agg(F.sum("n"), F.sum("chosen")).collect():
        sums[:, row[0]] = row[1], row[2]
    if not sums[1].any():
        return np.zeros(BUCKETS)
    raw = (sums[0] + 1) / (sums[0].sum() + BUCKETS)
    chosen = sums[1] + SMOOTHING * BUCKETS * raw
    return np.log(chosen / chosen.sum()) - np.log(raw)


def weighted(docs: DataFrame, weights: np.ndarray, text: str) -> DataFrame:
    """``docs`` and a last column ``log_weight``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [float(weights[ngrams(x)].sum()) for x in texts_of(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.float64())],
                [*batch.schema.names, "log_weight"],
            )

    fields = [*docs.schema.fields, StructField("log_weight", DoubleType())]
    return docs.mapInArrow(add, StructType(fields))


def gumbel(id_column: str, seed: int) -> Column:
    """Gumbel noise from a hash of the id, the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column)), 11)
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def kth_greatest(table: DataFrame, column: str, k: int) -> float:
    """The k-th greatest value, found by counts in ever narrower ranges.

    A pass counts the values of ``_SLOTS`` equal ranges and goes on in the one that holds
    the place, until that range holds one value; no task and no driver sorts them all.
    """
    low, high, above = *table.agg(F.min(column), F.max(column)).first(), 0
    while True:
        width = (high - low) / _SLOTS
        if width == 0 or low + width == low:
            return low
        slot = F.least(F.floor((F.col(column) - low) / width), F.lit(_SLOTS - 1))
        inside = table.where(F.col(column).between(low, high)).groupBy(slot.alias("slot"))
        found = inside.agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for row in sorted(found.collect(), key=lambda row: -row["slot"]):
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
        else:
            return low
        if low == high:
            return low


def resampled(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
    as_placed: bool = False,
) -> DataFrame:
    """``docs`` with ``log_weight``, ``draw`` (weight and noise) and ``kept``.

    ``labels`` has the id and ``quality`` (1 good, 0 bad); its good documents are the
    target. ``share`` of the documents is drawn; without it, as many as the labels show.
    The table is written once, as the k greatest are known only after all are weighed.
    ``as_placed`` leaves the columns of ``docs`` named by place (``common.by_place``), for
    input that has columns of the added names.
    """
    id_, text = place_of(docs, id_column), place_of(docs, text_column)
    rows = by_place(docs)
    known = labelled(labels, id_column)
    marked = rows.join(
        F.broadcast(known), F.col(id_) == F.col("label_id"), "left"
    )
    target = (F.col("quality") == 1) & F.col("is_target")
    log_ratio = fit(marked, F.coalesce(target, F.lit(False)), text)
    scored = weighted(rows, log_ratio, text).withColumn(
        "draw", F.col("log_weight") + gumbel(id_, seed)
    )
    scored = stored(scored, "importance")
    n = scored.count()
    if share is None:
        held_out = F.broadcast(known.where("not is_target"))
        known = scored.join(held_out, F.col(id_) == F.col("label_id"))
        share = calibrated_share(known, scored, n)
    k = round(share * n)
    last = kth_greatest(scored, "draw", k) if k else float("inf")
    drawn = scored.withColumn("kept", F.col("draw") >= last)
    names = rows.columns if as_placed else docs.columns
    return drawn.toDF(*names, "log_weight", "draw", "kept")


def labelled(labels: DataFrame, id_column: str = "doc_id", most: int = LABELLED) -> DataFrame:
    """At most ``most`` labelled ids with their quality, and every other one a target, by a hash."""
    once = labels.where("quality is not null").select(F.col(id_column).alias("label_id"), "quality")
    once = once.where("label_id is not null").groupBy("label_id").agg(F.max("quality").alias("quality"))
    once = once.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
    return once.withColumn("is_target", F.pmod(F.xxhash64(F.lit(1), "label_id"), F.lit(2)) == 0)


def calibrated_share(known: DataFrame, scored: DataFrame, n: int) -> float:
    """The share of documents from the best weight on; all of them without both labels."""
    once = known.groupBy("label_id").agg(F.min("log_weight").alias("log_weight"), F.max("quality").alias("quality"))
    rows = once.collect()  # at most LABELLED
    weights = np.array([row["log_weight"] for row in rows])
    good = np.array([row["quality"] == 1 for row in rows], bool)
    if not n or good.all() or not good.any():
        return 1.0
    order = np.argsort(weights, kind="stable")
    lost = np.cumsum(good[order]) / good.sum()
    gone = np.cumsum(~good[order]) / (~good).sum()
    # A cut may stand only between different weights.
    last = np.append(np.diff(weights[order]) > 0, True)
    best = int(np.argmax(np.where(last, gone - CARE * lost, -np.inf)))
    if gone[best] <= CARE * lost[best]:
        return 1.0
    cut = float(weights[order][best])
    return scored.where(F.col("log_weight") > cut).count() / n
