"""Near-duplicate embeddings by hashing on extreme Gaussian projections, verified by exact cosine.

A table hashes a vector by two sets of K seeded Gaussian lines: of each set counts the line
on which the vector's projection is farthest from zero, with its sign, and equal pairs of
lines share a bucket. Projections of two vectors on a line are normal with their cosine as
correlation, so the chance that they share a bucket follows from K and the cosine alone
(``together``). K grows with the root of the vectors, so that unrelated vectors share about
one bucket in two; there are as many tables as let a pair just at ``similarity`` miss all of
them with probability ``MISS`` at most. Nearer pairs miss far less often. Vectors are
counted by ``CELL`` for that, as all pairs of a bucket are compared; up to ``CELL`` vectors
are one bucket of one table, which misses nothing.

Tables are met one after the other, or some at once where vectors are few (``ROUND``), and
what a step leaves on disk goes as soon as the next has read it. So the disk in use follows
the vectors and not the tables: their bytes, a key of four bytes a table, and one shuffle of
both. Vectors are kept as the bytes of their floats or doubles; rows meet their vectors by a
digest of these.

Equal vectors are one node. Larger buckets than ``CHUNK`` are dealt to pairs of chunks, so a
task holds two chunks whatever the bucket; how large a bucket is, a part of the nodes tells
once there are many, which only picks the way. All pairs of a bucket are compared in single
precision, and those nearer to ``similarity`` than its error in double precision. A pair
counts in the first table in which it shares a bucket, so each link counts once; of the links
of a bucket or chunk pair, those of a spanning forest are passed on.

Vectors that are NULL, zero, or hold NULL or a value that is not finite link with nothing;
vectors link only with those of the same length. Every row is a vector of its own: rows of
equal vectors link, also those of the same id, whose links are given for each row. A NULL
id is no component's smallest id unless all its members lack one. An empty table gives an
empty result. Only the two columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from functools import lru_cache
from hashlib import blake2b
from math import ceil, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import shuffles_freed, stored, stored_while
from factlab.llm.components import components
from factlab.sources.scratch import fresh_path

SIMILARITY = 0.9
MISS = 0.0001
#: Vectors that may share a bucket by chance.
CELL = 1024
CHUNK = 16384
#: Bytes of the vectors of a chunk.
CHUNK_BYTES = 1 << 23
#: Bytes of vectors and keys that one round may shuffle, if it has several tables.
ROUND = 1 << 28
#: Nodes, about, whose buckets are counted.
COUNTED = 1 << 20
SEED = 29
#: Vectors compared with all later ones at once.
_BLOCK = 256
#: Cosines this near to the limit are taken anew from the vectors as given.
_CLOSE = 1e-9
_NODE = "digest binary, v binary, least long, copies long, node long"


@lru_cache(64)
def together(lines: int, similarity: float = SIMILARITY) -> float:
    """The probability that of one set of lines two vectors of this cosine are extreme on the same.

    By quadrature: they are so on a line at x and y, with the same sign, and within x and y
    on all others. Above a cosine of 0.99 that of 0.99 is given, which is less.
    """
    cosine = min(similarity, 0.99)
    rest = 1 - cosine * cosine
    step = min(0.02, sqrt(rest) / 8)
    at = np.arange(step / 2, 7, step)
    x, y = at[:, None], at[None, :]
    same, other = (
        np.exp((2 * c * x * y - x * x - y * y) / (2 * rest)) * step * step / (pi * sqrt(rest)) for c in (cosine, -cosine)
    )
    within = same + other
    for axis in (0, 1):
        within = within.cumsum(axis=axis) - within / 2
    return float(lines * (same * np.minimum(within, 1) ** (lines - 1)).sum())


def shape(n: int, similarity: float = SIMILARITY) -> tuple[int, int]:
    """Lines of a set, and tables, for ``n`` vectors."""
    lines = ceil(sqrt(2 * max(n, 1)) / 2)
    return lines, ceil(log(MISS) / log(1 - min(together(lines, similarity) ** 2, 1 - MISS)))


@lru_cache(4)
def _lines(size: int, lines: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, tables * 2 * lines), dtype=np.float32)


def keys(vectors: np.ndarray, lines: int, tables: int) -> np.ndarray:
    """The buckets of normalised vectors, one for each table. Without lines there is one bucket."""
    n, size = vectors.shape
    if not lines:
        return np.zeros((n, tables), np.int32)
    places = (vectors.astype(np.float32) @ _lines(size, lines, tables)).reshape(-1, lines)
    far = np.abs(places).argmax(axis=1)
    far = (2 * far + (places[np.arange(len(far)), far] > 0)).reshape(n, tables, 2)
    return (far[:, :, 0] * (2 * lines) + far[:, :, 1]).astype(np.int32)


def _units(vectors: np.ndarray) -> np.ndarray:
    """The vectors normalised, in single precision."""
    # Divided by the largest part first, so that no square leaves the range.
    vectors = (vectors / np.abs(vectors).max(axis=1, keepdims=True)).astype(np.float32)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def links_of(
    vectors: np.ndarray, keys_: np.ndarray, apart: np.ndarray | None, copies: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """The links of one bucket that share no key: their number for each vector, a forest of pairs.

    ``keys_`` are those of earlier tables. With ``apart``, pairs lie across its two values.
    """
    n, tables = keys_.shape
    # Near copies have most keys in common. By the first keys, their pairs go in blocks.
    order = np.lexsort(keys_[:, 2::-1].T) if tables else np.arange(n)
    vectors, keys_, copies = vectors[order], np.ascontiguousarray(keys_[order].T), copies[order]
    copies = copies.astype(np.float32 if copies.sum() < 1 << 24 else np.float64)
    units, slack = _units(vectors), (vectors.shape[1] + 4) * 2.0**-22
    left = right = np.arange(n)
    if apart is not None:
        left, right = np.flatnonzero(~apart[order]), np.flatnonzero(apart[order])
    counts, root, forest = np.zeros(n), np.arange(n), [np.zeros((0, 2), np.int64)]
    for first in range(0, len(left), _BLOCK):
        rows, columns = left[first : first + _BLOCK], right if apart is not None else right[first:]
        for key in keys_[:3]:
            if (key[rows] == key[rows[0]]).all():
                columns = columns[key[columns] != key[rows[0]]]
        if not len(columns):
            continue
        cosines = units[rows] @ units[columns].T
        near = cosines >= similarity - slack
        later = list(keys_)
        while (many := 16 * np.count_nonzero(near) > near.size) and later:
            key = later.pop(0)
            near &= key[rows][:, None] != key[columns]
        if many:
            if apart is None:
                near &= rows[:, None] < columns
            y, x = _places(near & (cosines < similarity + slack))
            wrong = ~_near(vectors, rows[y], columns[x], similarity)
            near[y[wrong], x[wrong]] = False
            linked = near.astype(copies.dtype)
            counts[rows] += linked @ copies[columns]
            counts[columns] += copies[rows] @ linked
            while (near := near & (root[rows][:, None] != root[columns])).any():
                # One link of each column and of each row at once.
                y, x = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                i = np.concatenate([rows[y], rows[near[:, x].argmax(axis=0)]])
                forest += _joined(root, i, np.concatenate([columns[near[y].argmax(axis=1)], columns[x]]))
        else:
            y, x = _places(near)
            i, j, cosines = rows[y], columns[x], cosines[y, x]
            live = np.ones(len(i), bool) if apart is not None else i < j
            for key in later if live.any() else ():
                live &= key[i] != key[j]
            doubtful = np.flatnonzero(live & (cosines < similarity + slack))
            live[doubtful] = _near(vectors, i[doubtful], j[doubtful], similarity)
            i, j = i[live], j[live]
            if len(i):
                counts += np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
                forest += _joined(root, i, j)
    out = np.empty(n, np.int64)
    out[order] = counts.astype(np.int64)
    return out, order[np.concatenate(forest)]


def _places(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # Much faster than for two dimensions.
    return np.divmod(np.flatnonzero(near), near.shape[1])


def _near(vectors: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the cosines of pairs reach ``similarity``, in double precision."""
    near = np.zeros(len(i), bool)
    for first in range(0, len(i), _BLOCK):
        a, b = (vectors[x[first : first + _BLOCK]].astype(np.float64) for x in (i, j))
        one, two = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
        dot = lambda x, y: np.einsum("ij,ij->i", x, y)
        cosines = dot(one, two) / (np.sqrt(dot(one, one)) * np.sqrt(dot(two, two)))
        for k in np.flatnonzero(np.abs(cosines - similarity) < _CLOSE):
            cosines[k] = _cosine(a[k], b[k])
        near[first : first + _BLOCK] = cosines >= similarity
    return near


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return np.dot(a, b) / (sqrt(np.dot(a, a)) * sqrt(np.dot(b, b)))


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[np.ndarray]:
    """Those of the links i, j that join trees; ``root``, the least of each tree, is kept up."""
    while True:
        a, b = root[i], root[j]
        new = a != b
        if not new.any():
            return
        i, j, a, b = i[new], j[new], a[new], b[new]
        # Each root that is not the smaller end of all its links hangs itself to one such end.
        roots, at = np.unique(np.maximum(a, b), return_index=True)
        yield np.stack([i[at], j[at]], axis=1)
        root[roots] = np.minimum(a, b)[at]
        while (root[root] != root).any():
            root[:] = root[root]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, digest, v: the bytes of vectors that take part, and a digest of these."""
    for batch in batches:
        lists = batch.column("v")
        # A NULL becomes NaN, and 0 is added as there are two zeros.
        values = lists.values.to_numpy(zero_copy_only=False) + lists.type.value_type.to_pandas_dtype()(0)
        ends = lists.offsets.to_numpy()
        some, odd = (np.concatenate([[0], x.cumsum()])[ends] for x in (values != 0, ~np.isfinite(values)))
        good = (np.diff(some) > 0) & (np.diff(odd) == 0) & lists.is_valid().to_numpy(zero_copy_only=False)
        ends, data = (ends * values.itemsize).tolist(), values.tobytes()
        packed = [data[a:b] if x else None for x, a, b in zip(good.tolist(), ends, ends[1:])]
        digests = [None if x is None else blake2b(x, digest_size=16).digest() for x in packed]
        columns = [batch.column("id"), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "v"])


def _unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of bytes, and where each row's begin and the last end."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind)
    return values, (ends - ends[0]) // values.itemsize


def _key_kind(lines: int) -> str:
    return "uint16" if (2 * lines) ** 2 <= 1 << 16 else "uint32"


def _hashed(kind: str, lines: int, tables: int):
    """Adds the keys of v to batches of nodes, as bytes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ends = _unpacked(batch.column("v"), kind)
            sizes, out = np.diff(ends), np.empty((batch.num_rows, tables), _key_kind(lines))
            for size in np.unique(sizes).tolist():
                chosen = np.flatnonzero(sizes == size)
                for first in range(0, len(chosen), _BLOCK):
                    at = chosen[first : first + _BLOCK]
                    out[at] = keys(_units(values[ends[at][:, None] + np.arange(size)]), lines, tables)
            made = pa.array([row.tobytes() for row in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "keys"])

    return hashed


def near_links(nodes: DataFrame, kind: str, lines: int, tables: int, similarity: float = SIMILARITY) -> DataFrame:
    """Columns a, b, n of ``nodes`` (node, copies, v, keys): links a, b, or with b NULL, n links of a.

    ``kind`` is the type of the numbers in v. Each round is written before the next begins,
    so their shuffles are not on disk together.
    """
    spark, key_kind = nodes.sparkSession, _key_kind(lines)
    width = np.dtype(key_kind).itemsize
    nodes = nodes.select("node", "copies", "v", "keys", F.octet_length("v").alias("size"))
    n, volume = nodes.agg(F.count("*"), F.sum(F.col("size") + width * tables)).first()
    at_once = max(1, ROUND // max(volume or 0, 1))
    # Where there are many nodes, a part of them tells which buckets are large.
    part = 1 + n // COUNTED
    chunk = F.least(F.lit(CHUNK), F.greatest(F.lit(1), F.floor(CHUNK_BYTES / F.col("size"))))
    counted = _keyed(nodes.where(F.pmod(F.xxhash64("node"), F.lit(part)) == 0), range(tables), width)
    counted = counted.groupBy("size", "at", "key").agg((F.count("*") * part).alias("n"))
    counted = counted.withColumn("chunks", F.ceil(F.col("n") / chunk)).where("chunks > 1").drop("n")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in _whole_groups(batches, "bucket"):
            yield _links(rows, starts, kind, key_kind, similarity)

    path = fresh_path(spark, "lsh-links")
    with stored_while(counted, "lsh-buckets") as large:
        for first in range(0, tables, at_once):
            met = _keyed(nodes, range(first, min(first + at_once, tables)), width)
            met = met.join(F.broadcast(large), ["size", "at", "key"], "left")
            # A bucket of several chunks meets as pairs of these, a node in as many as there are.
            chunks = F.coalesce("chunks", F.lit(1).cast("long"))
            met = met.withColumn("mine", F.pmod(F.xxhash64("node"), chunks))
            met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
            one, two = (f("mine", "other").cast("int") for f in (F.least, F.greatest))
            met = met.withColumns({"one": one, "two": two, "apart": F.col("mine") > F.col("other")})
            met = met.select(
                F.xxhash64("size", "at", "key", "one", "two").alias("bucket"),
                "key",
                "one",
                "two",
                "apart",
                "node",
                "copies",
                "v",
                F.substr("keys", F.lit(1), F.col("at") * width).alias("keys"),
            )
            dealt = met.repartition("bucket").sortWithinPartitions("bucket")
            found = dealt.mapInArrow(check, "a long, b long, n long")
            found.groupBy("a", "b").agg(F.sum("n").alias("n")).write.mode("append").parquet(path)
    return spark.read.schema("a long, b long, n long").parquet(path)


def _keyed(nodes: DataFrame, tables: range, width: int) -> DataFrame:
    """``nodes`` in each of the tables, with the key there."""
    every = F.explode(F.array(*map(F.lit, tables)))
    return nodes.withColumn("at", every).withColumn("key", F.substr("keys", F.col("at") * width + 1, F.lit(width)))


def _whole_groups(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole groups with the starts of these, a batch or a group at once."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        ids = batch.column(group).to_numpy()
        starts = np.flatnonzero(ids[1:] != ids[:-1]) + 1
        if waiting and waiting[-1].column(group)[0].as_py() != ids[0]:
            starts = np.concatenate([[0], starts])
        if len(starts):
            rows = pa.Table.from_batches([*waiting, batch.slice(0, starts[-1])])
            yield rows, np.concatenate([[0], starts[:-1] + sum(map(len, waiting))])
            waiting = []
        waiting.append(batch.slice(starts[-1] if len(starts) else 0))
    if waiting:
        yield pa.Table.from_batches(waiting), np.zeros(1, np.int64)


def _links(rows: pa.Table, starts: np.ndarray, kind: str, key_kind: str, similarity: float) -> pa.RecordBatch:
    """The new links of whole groups: a forest of pairs, and numbers of links with b NULL."""
    rows = rows.combine_chunks()
    values, ends, earlier, key_ends, groups = _columns(rows, kind, key_kind)
    begins = np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1
    if not np.isin(begins, starts).all():
        # Two buckets of one hash.
        number = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(rows)))
        rows = rows.take(np.lexsort([*groups, number])).combine_chunks()
        values, ends, earlier, key_ends, groups = _columns(rows, kind, key_kind)
        begins = np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1
    node, copies, apart = (rows.column(name).to_numpy() for name in ("node", "copies", "apart"))
    counts, pairs = np.zeros(len(node), np.int64), [np.zeros((0, 2), np.int64)]
    for a, b in zip([0, *begins], [*begins, len(node)]):
        if b - a > 1:
            vectors = values[ends[a] : ends[b]].reshape(b - a, -1)
            before = earlier[key_ends[a] : key_ends[b]].reshape(b - a, key_ends[a + 1] - key_ends[a])
            across = apart[a:b] if groups[3, a] != groups[4, a] else None
            counts[a:b], forest = links_of(vectors, before, across, copies[a:b], similarity)
            pairs.append(forest + a)
    linked = np.flatnonzero(counts)
    ends = node[np.concatenate(pairs)]
    a = np.concatenate([ends[:, 0], node[linked]])
    b = pa.concat_arrays([pa.array(ends[:, 1]), pa.nulls(len(linked), pa.int64())])
    n = pa.concat_arrays([pa.nulls(len(ends), pa.int64()), pa.array(counts[linked])])
    return pa.RecordBatch.from_arrays([pa.array(a), b, n], ["a", "b", "n"])


def _columns(rows: pa.Table, kind: str, key_kind: str) -> tuple[np.ndarray, ...]:
    """Vectors, earlier keys and where each begins; what makes a bucket: length, table, key, chunks."""
    values, ends = _unpacked(rows.column("v").chunk(0), kind)
    earlier, key_ends = _unpacked(rows.column("keys").chunk(0), key_kind)
    key, _ = _unpacked(rows.column("key").chunk(0), key_kind)
    groups = np.stack([np.diff(ends), np.diff(key_ends), key, *(rows.column(x).to_numpy() for x in ("one", "two"))])
    return values, ends, earlier, key_ends, groups


def classes(
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The id, n_links, component_id and kept of each row of ``vectors``.

    ``n_links`` counts other rows linked directly, ``component_id`` is the smallest id
    reached, and the rows that have it are ``kept``.
    """
    spark = vectors.sparkSession
    single = vectors.schema[vector_column].dataType.simpleString() == "array<float>"
    kind = "float32" if single else "float64"
    numbers = F.col(vector_column).cast("array<float>" if single else "array<double>")
    packed = vectors.select(F.col(id_column).cast("long").alias("id"), numbers.alias("v"))
    packed = packed.mapInArrow(_packed, "id long, digest binary, v binary")
    with shuffles_freed(spark):
        with stored_while(packed, "lsh-rows") as rows:
            ids = stored(rows.select("id", "digest"), "lsh-ids")
            nodes = rows.where("v is not null").groupBy("digest", "v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
            nodes = nodes.withColumn("node", F.monotonically_increasing_id())
            nodes = (passing := ExitStack()).enter_context(stored_while(nodes, "lsh-nodes"))
        n = nodes.count()
        lines, tables = shape(ceil(n / CELL), similarity) if n > CELL else (0, 1)
        with passing:
            keyed = nodes.mapInArrow(_hashed(kind, lines, tables), f"{_NODE}, keys binary")
            keyed = (passing := ExitStack()).enter_context(stored_while(keyed, "lsh-keys"))
        with passing:
            found = near_links(keyed, kind, lines, tables, similarity)
            counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
            roots = components(found.where("b is not null").select("a", "b"))
            rooted = (
                keyed.select("node", "digest", "least", "copies")
                .join(roots.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
                .join(counts, F.col("node") == F.col("a"), "left")
                .select("digest", "least", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
            )
            rooted = stored(rooted, "lsh-roots")
        least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "lsh-least")
        named = stored(rooted.join(least, "root").select("digest", "n_links", "component_id"), "lsh-classes")
    linked = ids.where("digest is not null").join(named.hint("merge"), "digest").drop("digest")
    alone = ids.where("digest is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
