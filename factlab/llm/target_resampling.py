"""Importance resampling towards a target text, n-grams interned in open-addressed tables.

Texts are lower-cased (A-Z only) and cut into words; features are all runs of 1 to
``ngram`` words, joined by one space. A feature's bucket is its bytes' crc32 modulo
``buckets``. Bucket counts of all documents and of all target texts give each bucket a
gain in thousandths of a nat; a document's weight is the floored mean of its features'
gains, and with a seeded Gumbel number per id as its score the highest are drawn.

Within a task, features are interned in parts of about ``_PART`` bytes: a power-of-two
table of slots is probed linearly from the feature's XXH64. An empty slot goes to one of
those that reach it, and a feature owns or shares a slot only if its bytes equal those of
the slot's owner, so equal hashes of different features cost a further probe and nothing
else. Bucket and count stand once per slot. Counting adds the slots' counts to their
buckets; weighing gathers the slots' gains by the slot of each occurrence.

Only the sums per bucket meet, at most ``buckets`` rows for each task. Long texts are taken
in parts, whole. NULL and empty texts have no feature and weight 0. A NULL id draws by the
empty text in its place and is last among ties. Repeated rows are judged each. With an
empty table the result is empty; with an empty target all gains come from the raw texts.
Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_intdigest

from factlab.llm.common import stored
from factlab.operators.numbering import numbered

NGRAM = 1
BUCKETS = 10_000
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
_PART = 1 << 20
_SPACE = 32
_MADE = ["n_words", "n_features", "weight"]

_bytes = np.arange(256)
_LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
_IN_WORD = (_bytes >= 48) & (_bytes <= 57) | (_bytes >= 97) & (_bytes <= 122) | (_bytes >= 128)


def parts(texts: Iterator[str], ngram: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Features of texts in turn, some ``_PART`` bytes at once.

    Each part has its words joined by single spaces, and of every feature there its first
    byte, its end and the number of its text.
    """
    waiting, size = [], 0
    for i, text in enumerate(texts):
        for piece, seen in _pieces(text.encode("utf-8", "surrogatepass"), ngram):
            waiting.append((piece, i, seen))
            size += len(piece)
            if size >= _PART:
                yield _features(waiting, ngram)
                waiting, size = [], 0
    if waiting:
        yield _features(waiting, ngram)


def _pieces(data: bytes, ngram: int) -> Iterator[tuple[bytes, int]]:
    """The text, or stretches of whole words with how many of the stretch before they repeat."""
    if len(data) <= _PART:
        if data:
            yield data, 0
        return
    starts, ends = _words(np.frombuffer(data, np.uint8))
    at = seen = 0
    while at + seen < len(starts):
        upto = int(np.searchsorted(ends, starts[at] + _PART, "right"))
        upto = min(len(starts), max(upto, at + seen + 1))
        yield data[starts[at] : ends[upto - 1]], seen
        seen = min(ngram - 1, upto)
        at = upto - seen


def _features(pieces: list[tuple[bytes, int, int]], ngram: int):
    joined = np.frombuffer(b" ".join([piece for piece, _, _ in pieces]), np.uint8)
    starts, ends = _words(joined)
    # The words anew, one space between them, so that a run of words is a run of bytes.
    lengths = ends - starts
    new_ends = np.cumsum(lengths + 1) - 1
    new_starts = new_ends - lengths
    data = np.full(int(new_ends[-1]) if len(new_ends) else 0, _SPACE, np.uint8)
    data[_spans(new_starts, lengths)] = _LOWER[joined[_spans(starts, lengths)]]
    bounds = np.cumsum([len(piece) + 1 for piece, _, _ in pieces])
    piece = np.searchsorted(bounds, starts, "right")
    first, end = (np.searchsorted(piece, piece, side) for side in ("left", "right"))
    # A run of words that a stretch repeats was counted in the stretch before.
    seen = first + np.array([x[2] for x in pieces])[piece]
    owner = np.array([x[1] for x in pieces])[piece]
    at, out = np.arange(len(starts)), []
    for n in range(1, ngram + 1):
        whole = np.flatnonzero((at + n <= end) & (at + n > seen))
        out.append((new_starts[whole], new_ends[whole + n - 1], owner[whole]))
    return data.tobytes(), *map(np.concatenate, zip(*out))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the words."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[_LOWER[data]]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the stretches, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def intern(data: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each occurrence, and of each slot the occurrence that owns it, or -1.

    Occurrences share a slot if, and only if, their bytes are equal.
    """
    size = 1 << max(4, int(2 * len(keys)).bit_length())
    owner = np.full(size, -1, np.int64)
    slot = np.empty(len(keys), np.int64)
    at = (keys & np.uint64(size - 1)).astype(np.int64)
    waiting = np.arange(len(keys))
    text = np.frombuffer(data, np.uint8)
    while len(waiting):
        place = at[waiting]
        free = owner[place] < 0
        owner[place[free]] = waiting[free]
        held = owner[place]
        same = (keys[held] == keys[waiting]) & (ends[held] - starts[held] == ends[waiting] - starts[waiting])
        same[same] = _equal(text, starts, ends, held[same], waiting[same])
        slot[waiting[same]] = place[same]
        waiting = waiting[~same]
        at[waiting] = (at[waiting] + 1) & (size - 1)
    return slot, owner


def _equal(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether occurrences ``a`` and ``b`` of equal lengths, none empty, have equal bytes."""
    if not len(a):
        return np.zeros(0, bool)
    lengths = ends[a] - starts[a]
    differ = text[_spans(starts[a], lengths)] != text[_spans(starts[b], lengths)]
    return ~np.logical_or.reduceat(differ, np.cumsum(lengths) - lengths)


def _slots(data: bytes, starts: np.ndarray, ends: np.ndarray, buckets: int):
    """Slots of the occurrences, the used slots, and the bucket and count of each of these."""
    spans = zip(starts.tolist(), ends.tolist())
    keys = np.fromiter((xxh64_intdigest(data[a:b]) for a, b in spans), np.uint64, len(starts))
    slot, owner = intern(data, starts, ends, keys)
    used = np.flatnonzero(owner >= 0)
    of_used = owner[used]
    spans = zip(starts[of_used].tolist(), ends[of_used].tolist())
    bucket = np.fromiter((crc32(data[a:b]) % buckets for a, b in spans), np.int64, len(used))
    count = np.bincount(slot, minlength=len(owner))[used]
    return slot, used, bucket, count


def bucket_counts(texts: DataFrame, text: str, ngram: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """Columns bucket, n: how many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for data, starts, ends, _ in parts(_texts(batch, 0), ngram):
                if len(starts):
                    _, _, bucket, n = _slots(data, starts, ends, buckets)
                    np.add.at(sums, bucket, n)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], ["bucket", "n"])

    counted = texts.select(text).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[str]:
    return (text.as_py() or "" for text in batch.column(column))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, from at most ``buckets`` sums of either side."""
    sums = np.zeros((2, buckets), np.int64)
    for i, counts in enumerate((raw, target)):
        for row in counts.collect():
            sums[i, row.bucket] = row.n
    of_raw, of_target = sums.sum(axis=1)
    ratio = (sums[1] + 1) * float(of_raw + buckets) / ((sums[0] + 1) * float(of_target + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, text: str, gain: np.ndarray, ngram: int = NGRAM) -> DataFrame:
    """``docs`` without its texts, and last columns n_words, n_features and weight (long)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = None
        for batch in batches:
            place = batch.schema.names.index(text) if place is None else place
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for data, starts, ends, owner in parts(_texts(batch, place), ngram):
                if not len(starts):
                    continue
                slot, used, bucket, _ = _slots(data, starts, ends, len(gain))
                of_slot = np.zeros(int(used[-1]) + 1, np.int64)
                of_slot[used] = gain[bucket]
                np.add.at(total, owner, of_slot[slot])
                np.add.at(features, owner, 1)
                single = np.frombuffer(data, np.uint8) == _SPACE
                inner = np.concatenate([[0], np.cumsum(single)])
                np.add.at(words, owner[inner[starts] == inner[ends]], 1)
            weight = np.floor_divide(total, np.maximum(features, 1))
            made = [pa.array(x, pa.int64()) for x in (words, features, weight)]
            rest = batch.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*rest.columns, *made], [*rest.schema.names, *_MADE])

    fields = [field for field in docs.schema.fields if field.name != text]
    fields += [StructField(name, LongType()) for name in _MADE]
    return docs.mapInArrow(weigh, StructType(fields))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    ngram: int = NGRAM,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """The id, n_features, weight, score and rank of every document; NULL rank if not drawn.

    Of the documents of ``least_words`` or more, floor(percent / 100 of them) are drawn.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    gain = gains(
        bucket_counts(texts, "text", ngram, buckets),
        bucket_counts(target, target_column, ngram, buckets),
        buckets,
    )
    rows = weighed(texts, "text", gain, ngram)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    luck = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    rows = stored(rows.withColumn("score", F.col("weight") + luck), "target-weights")
    # NULL is the least value in ``numbered``, and the last id here.
    able = rows.where(F.col("n_words") >= least_words).withColumn("no_id", F.col("id").isNull())
    n = able.count() * percent // 100
    able = numbered(able, ["-score", "no_id", "id"], "rank").drop("no_id")
    able = able.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    short = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    drawn = able.unionByName(short)
    return drawn.select(F.col("id").alias(id_column), "n_features", "weight", "score", "rank")
