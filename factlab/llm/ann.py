"""Approximate nearest neighbours by collision counting, with query-centred windows.

Every vector is projected on ``HASHES`` seeded random lines. A block of vectors sorts
each projection once. A query opens a window around its own projection on every line and
counts how many windows a vector falls into; ``THRESHOLD`` of them make it a candidate,
whose true distance is taken. Windows widen by virtual rehashing (``GROWTH``) until k
verified candidates lie within the radius the windows stand for, so that a vector nearer
than those has had its chance. A window of half-width r holds a vector at distance r on a
line with probability 0.683, and one of twice the distance with 0.383.

All vectors are indexed and there is no cap on candidates: where windows come to hold a
whole block, all of it is verified. Each block of vectors is shuffled and indexed once, and
all queries pass by it in batches; the block results of a query are merged by distance.

Vectors that are NULL, zero, or hold NULL or a value that is not finite take no part, nor
do rows without id. Only vectors of the same length are compared. Ties go to the smaller
id; repeated ids are candidates each, except for a query of their id. Query rows of one id
are asked once for each different vector, ranks being given for each. Distances are
Euclidean, in double precision. An empty table, or one without queries, gives an empty
result. Only the two columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from factlab.llm.common import stored

HASHES = 40
THRESHOLD = 0.55
GROWTH = 1.15
SEED = 17
#: Rows of a block of vectors.
BLOCK = 16_384


class Index:
    """The sorted projections of one block."""

    def __init__(self, vectors: np.ndarray, lines: np.ndarray):
        self.vectors, self._lines = vectors, lines
        # One row for each line, as windows are stretches of a row.
        places = np.ascontiguousarray((vectors @ lines).T)
        self._order = np.argsort(places, axis=1, kind="stable").astype(np.int32)
        self._sorted = np.take_along_axis(places, self._order, axis=1)
        spread = self._sorted[:, -1] - self._sorted[:, 0]
        self._width = float(spread.mean()) or 1.0

    def search(self, query: np.ndarray, k: int, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of at least the k nearest found; ``skip`` marks the query's own."""
        hashes, n = self._order.shape
        centres = query @ self._lines
        need = int(np.ceil(THRESHOLD * hashes))
        counts = np.zeros(n, np.uint8)
        verified = np.array(skip, bool)
        distances = np.full(n, np.inf)
        wanted = min(k, n - int(skip.sum()))
        low = [int(np.searchsorted(x, c)) for x, c in zip(self._sorted, centres)]
        high = list(low)
        radius = self._width / 32
        while True:
            for i, (line, order) in enumerate(zip(self._sorted, self._order)):
                a = int(np.searchsorted(line, centres[i] - radius, "left"))
                b = int(np.searchsorted(line, centres[i] + radius, "right"))
                counts[order[a : low[i]]] += 1
                counts[order[high[i] : b]] += 1
                low[i], high[i] = min(a, low[i]), max(b, high[i])
            new = np.flatnonzero((counts >= need) & ~verified)
            if len(new):
                apart = self.vectors[new] - query
                distances[new] = np.sqrt(np.einsum("ij,ij->i", apart, apart))
                verified[new] = True
            if (distances <= radius).sum() >= wanted or verified.all():
                return np.flatnonzero(np.isfinite(distances)), distances
            radius *= GROWTH


def _lines(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, HASHES))


def valid(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Columns query_id, rank (from 1), the id, score: the k nearest of each query.

    ``queries`` tells the rows of the table that are queries.
    """
    rows = vectors.where(valid(F.col(vector_column)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    )
    rows = stored(rows.withColumn("size", F.size("v")), "vectors")
    n = rows.count()
    blocks = -(-max(n, 1) // BLOCK)
    # A third of the rows may have one id: the vector decides the block too.
    block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks))
    base = rows.select("size", block.alias("block"), F.lit(False).alias("asks"), "id", "v")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
    asks = rows.where("asks").groupBy("size", "id", "v").agg(F.first("asks").alias("asks"))
    asks = asks.select("size", every.alias("block"), "asks", "id", "v")
    # A block's vectors come before the queries, which then pass by its index batch by batch.
    met = base.unionByName(asks).repartition("size", "block").sortWithinPartitions("size", "block", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, index, ids = None, [], None, None
        for rows in _runs(batches):
            size, asking = rows.column("size")[0].as_py(), rows.column("asks")[0].as_py()
            key = (size, rows.column("block")[0].as_py())
            if key != at:
                at, parts, index = key, [], None
            if not asking:
                parts.append(_arrays(rows, size))
                continue
            if index is None:
                if not parts:
                    continue
                ids = np.concatenate([x for x, _ in parts])
                index, parts = Index(np.concatenate([x for _, x in parts]), _lines(size)), [()]
            found = []
            for query_id, query in zip(*_arrays(rows, size)):
                places, distances = index.search(query, k, ids == query_id)
                best = places[np.lexsort((ids[places], distances[places]))[:k]]
                ask = xxh64_intdigest(query.tobytes()) >> 1
                found.append((np.full(len(best), query_id), np.full(len(best), ask), ids[best], distances[best]))
            columns = [pa.array(np.concatenate(x)) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "ask", "id", "score"])

    near = met.mapInArrow(search, "query_id long, ask long, id long, score double")
    order = Window.partitionBy("query_id", "ask").orderBy("score", "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut where length, block or kind of row change."""
    for batch in batches:
        kinds = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("size", "block", "asks")]
        change = np.any([kind[1:] != kind[:-1] for kind in kinds], axis=0)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def _arrays(rows: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    values = rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return rows.column("id").to_numpy(), values
