"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has a bit set where over half of the hashes of its word shingles
have it. Two fingerprints link at ``bits`` differing bits or fewer. The 64 bits form a
ring of ``segments``. If two fingerprints link, then from some segment on every chain of
l consecutive segments holds at most floor(l * bits / segments) of their differences: the
first ``_exact`` segments then agree, and buckets of equal such segments hold all
candidates. Of these the whole chain is checked, then the Hamming distance.

A bucket of over ``BUCKET`` fingerprints is not paired. Two fingerprints of at most two
differences have a value in common that differs from each in one bit at most; so each
fingerprint of such buckets meets its own value and its 64 neighbours, at most 65
fingerprints at each, and links to the smallest there. Nothing is left out, and the work
grows with the fingerprints, however many are alike. Copies share one fingerprint and
count once.

Documents without words have fingerprint zero, linked like any other. A NULL id is kept,
and never the id of a component with other members. Repeated rows are kept by
``classes``, and one of them by ``first_of_each``. An empty table gives an empty result.
``first_of_each`` returns the columns of its input, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_intdigest

from factlab.llm.common import by_place, place_of, stored, texts_of
from factlab.llm.components import components

WORDS = 3
BITS = 2
SEGMENTS = 5
BUCKET = 64
_SEED = 42
_COUNTED = 1 << 16


def fingerprint(text: str, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit integer."""
    found = text.encode().lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    spans = zip(starts[:n].tolist(), ends[len(found) - n :].tolist())
    hashes = np.array([xxh64_intdigest(line[a:b], _SEED) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for first in range(0, n, _COUNTED):
        part = hashes[first : first + _COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str, words: int = WORDS) -> DataFrame:
    """``docs`` and a last column ``fp`` (long)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(x, words) for x in texts_of(batch, text)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, fps], [*batch.schema.names, "fp"]
            )

    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField("fp", LongType())]))


# ---- links ----------------------------------------------------------------------


def _masks(segments: int) -> list[int]:
    """The bits of each segment, as even as 64 bits allow."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def _exact(bits: int, segments: int) -> int:
    """How many segments at the start of a chain have no room for a difference."""
    return max(k for k in range(segments + 1) if k * bits < segments)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def linked_pairs(fps: np.ndarray, start: int, bits: int, segments: int) -> list[tuple[int, int]]:
    """Links that join the members of one bucket of segment ``start`` as all its links do."""
    masks = _masks(segments)
    differ = fps[:, None] ^ fps[None, :]
    alive = np.triu(np.ones(differ.shape, bool), 1)
    found = np.zeros(differ.shape, np.int64)
    for k in range(segments):
        mask = np.uint64(masks[(start + k) % segments])
        found += np.bitwise_count(differ & mask)
        alive &= found <= (k + 1) * bits // segments
    alive &= found <= bits  # the full Hamming check: the last sum is over all segments
    root = list(range(len(fps)))
    links = []
    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(alive))):
        a, b = _root(root, i), _root(root, j)
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((i, j))
    return links


def _root(root: list[int], i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def links(fps: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Columns a, b: links between the distinct values of ``fp`` that join what links.

    ``bits`` is 0, 1 or 2: hot buckets are met at one difference from either side.
    """
    if not 0 <= bits <= 2 < segments:
        raise ValueError("at most 2 differing bits, and more segments than that")
    masks, exact = _masks(segments), _exact(bits, segments)
    chains = []
    for i in range(segments):
        mask = _signed(sum(masks[(i + k) % segments] for k in range(exact)))
        chain = F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(mask)).alias("same"))
        chains.append(chain)
    keyed = fps.select("fp", F.explode(F.array(*chains)).alias("key")).select("fp", "key.*")
    keyed = stored(keyed, "simhash-segments")
    sizes = keyed.groupBy("start", "same").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stored(sizes, "simhash-buckets")
    shared = keyed.join(sizes, ["start", "same"])
    buckets = (
        shared.where(F.col("n") <= BUCKET)
        .groupBy("start", "same")
        .agg(F.collect_list("fp").alias("fps"))
        .select("start", "fps")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for row in batch.to_pylist():
                values = row["fps"]
                array = np.array(values, np.int64).view(np.uint64)
                for i, j in linked_pairs(array, row["start"], bits, segments):
                    a.append(values[i])
                    b.append(values[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    found = buckets.mapInArrow(check, "a long, b long")
    if bits:
        hot = shared.where(F.col("n") > BUCKET).select("fp").distinct()
        found = found.unionByName(_met(hot, bits))
    return found


def _met(fps: DataFrame, bits: int) -> DataFrame:
    """Links of fingerprints to the smallest one that meets them at a common value."""
    near = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]]
    spots = fps.select("fp", F.posexplode(F.array(*near)).alias("i", "spot"))
    at_spot = spots.groupBy("spot").agg(
        F.collect_list("fp").alias("fps"), F.min("fp").alias("b"), F.max(F.when(F.col("i") == 0, F.col("fp"))).alias("own")
    )
    members = at_spot.where(F.size("fps") > 1)
    if bits == 1:
        # One difference: only where the value itself is a fingerprint.
        members = members.where("own is not null").withColumn("b", F.col("own"))
    return members.select(F.explode("fps").alias("a"), "b").where("a <> b").distinct()


def _rooted(nodes: DataFrame, bits: int, segments: int) -> DataFrame:
    """``nodes`` (distinct fp and more columns) with the root of each component."""
    roots = components(links(nodes.select("fp"), bits, segments))
    return nodes.join(roots, F.col("fp") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "fp")
    )


# ---- operators ------------------------------------------------------------------


def classes(
    docs: DataFrame,
    words: int = WORDS,
    bits: int = BITS,
    segments: int = SEGMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The id, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of each document.

    ``component_id`` is the smallest id that the document reaches over links.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    prints = stored(with_fingerprints(texts, "text", words).select("id", "fp"), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    rooted = stored(_rooted(nodes, bits, segments), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.select("fp", "root").join(least, "root").drop("root"), "simhash-classes")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def first_of_each(
    docs: DataFrame,
    words: int = WORDS,
    bits: int = BITS,
    segments: int = SEGMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id.

    The rows are numbered when they are written, so that of repeated rows one stays.
    """
    id_, text = place_of(docs, id_column), place_of(docs, text_column)
    rows = with_fingerprints(by_place(docs), text, words)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "simhash-rows")
    first = F.min(F.struct(F.col(id_).isNull(), F.col(id_), F.col("row"))).alias("first")
    nodes = stored(rows.groupBy("fp").agg(first), "simhash-nodes")
    kept = _rooted(nodes, bits, segments).groupBy("root").agg(F.min("first").alias("first"))
    kept = stored(kept.select(F.col("first.row").alias("row")), "simhash-kept")
    # The kept rows grow with the input, so both sides are shuffled at any size.
    kept_rows = rows.join(kept.hint("merge"), "row", "left_semi")
    return kept_rows.drop("row", "fp").toDF(*docs.columns)
