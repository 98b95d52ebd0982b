"""Token counts of whole texts; huge documents by overlap resynchronisation.

A document of at most ``chunk`` characters is encoded whole. A longer one is cut into
chunks that reach ``overlap`` characters into the next, which other tasks encode with
offsets. Two neighbours are spliced at a place of their overlap where both have a token
boundary and the tokenizer proves a boundary in any surroundings (``tokens.cuts``): left
of it the first chunk is right, from it on the second. Where an overlap holds no such
place, the document is cut anew with overlaps eight times as wide, at last in one chunk.
Tokenizers without proven cuts encode whole texts.

NULL and empty texts have no tokens. Repeated rows are counted each; huge texts that are
copies of each other are encoded once. An empty table gives an empty result. Only the id
and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import stored, texts_of
from factlab.llm.tokens import codec, cut_mode, cuts

CHUNK = 1 << 16
OVERLAP = 1 << 10
WIDER = 8
#: A chunk's end may split what follows these many characters before it.
_AHEAD = 2


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The id, ``n_bytes`` (UTF-8) and ``n_tokens`` of each document.

    ``tokenizer`` is the path of a vocabulary file, which every executor has.
    """
    texts = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    bytes_ = F.octet_length("text").cast("long").alias("n_bytes")
    id_type = texts.schema["id"].dataType.simpleString()
    huge = F.length("text") > chunk
    if cut_mode(tokenizer) is None:
        huge = F.lit(False)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = codec(tokenizer)
        for batch in batches:
            n = [len(ids.encode(text)) // 4 for text in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    small = (
        texts.where(~huge)
        .select("id", "text", bytes_)
        .mapInArrow(whole, f"id {id_type}, n_bytes long, n_tokens long")
    )
    if cut_mode(tokenizer) is None:
        return small.withColumnRenamed("id", id_column)
    large = texts.where(huge).select("id", "text", bytes_, F.sha2("text", 256).alias("key"))
    counts = _spliced(large.select("key", "text"), tokenizer, chunk, overlap)
    counted = large.drop("text").join(counts, "key").select("id", "n_bytes", "n_tokens")
    return small.unionByName(counted).withColumnRenamed("id", id_column)


def _spliced(texts: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """Columns key, n_tokens: one row for each distinct text."""
    done = []
    while True:
        parts = stored(_encoded(_chunks(texts, chunk, overlap), tokenizer), "chunks")
        left = parts.where("tail is not null").select("key", "k", "tail")
        right = parts.where("k > 0").select("key", (F.col("k") - 1).alias("k"), "head")
        splice = F.udf(_splice, "long")
        joined = left.join(right, ["key", "k"]).select("key", splice("tail", "head").alias("cut"))
        sums = (
            parts.select("key", F.col("n_tokens").alias("n"), F.lit(False).alias("open"))
            .unionByName(
                joined.select(
                    "key",
                    (-F.coalesce("cut", F.lit(0))).alias("n"),
                    F.col("cut").isNull().alias("open"),
                )
            )
            .groupBy("key")
            .agg(F.sum("n").alias("n_tokens"), F.max("open").alias("open"))
        )
        sums = stored(sums, "spliced")
        done.append(sums.where("not open").select("key", "n_tokens"))
        again = sums.where("open").select("key")
        if again.isEmpty():
            return reduce(DataFrame.unionByName, done)
        texts = texts.join(again, "key", "left_semi")
        overlap *= WIDER


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """One row for each chunk, however many copies its text has.

    ``zone`` is the place at which the overlap with the next chunk starts, ``reach`` the
    width of the one with the chunk before.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                step = chunk if overlap < len(text) else len(text)
                starts = range(0, len(text), step)
                for k, start in enumerate(starts):
                    part = text[start : start + step + overlap]
                    row = {"key": key, "k": k, "zone": step, "reach": overlap, "text": part}
                    row["last"] = k + 1 == len(starts)
                    yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema(
        [
            ("key", pa.string()),
            ("k", pa.int64()),
            ("zone", pa.int64()),
            ("reach", pa.int64()),
            ("last", pa.bool_()),
            ("text", pa.string()),
        ]
    )
    rows = texts.mapInArrow(
        cut, "key string, k long, zone long, reach long, last boolean, text string"
    )
    return rows.dropDuplicates(["key", "k"])


def _encoded(chunks: DataFrame, tokenizer: str) -> DataFrame:
    """For each chunk its tokens, and where its two overlaps hold a boundary.

    ``head`` and ``tail`` give, by place from the start of the overlap, the tokens of
    this chunk before that place (head) or from it on (tail).
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = codec(tokenizer)
        for batch in batches:
            for row in batch.to_pylist():
                text, k = row["text"], row["k"]
                found = ids.library.encode(text, add_special_tokens=False).offsets
                starts, ends = [x for x, _ in found], [x for _, x in found]
                sure = sorted(cuts(text, ids.mode))
                tail = None
                if not row["last"]:
                    places = sure[bisect_left(sure, row["zone"]) :]
                    places = [p for p in places if p <= len(text) - _AHEAD]
                    tail = [
                        {"at": p - row["zone"], "n": len(found) - bisect_left(starts, p)}
                        for p in places
                        if _between(starts, ends, p)
                    ]
                head = None
                if k:
                    head = [
                        {"at": p, "n": bisect_left(starts, p)}
                        for p in sure[: bisect_right(sure, row["reach"])]
                        if _between(starts, ends, p)
                    ]
                yield pa.RecordBatch.from_pylist(
                    [{"key": row["key"], "k": k, "n_tokens": len(found), "head": head, "tail": tail}],
                    schema,
                )

    spots = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))
    schema = pa.schema(
        [
            ("key", pa.string()),
            ("k", pa.int64()),
            ("n_tokens", pa.int64()),
            ("head", spots),
            ("tail", spots),
        ]
    )
    return chunks.mapInArrow(
        encode,
        "key string, k long, n_tokens long, head array<struct<at:long,n:long>>, "
        "tail array<struct<at:long,n:long>>",
    )


def _between(starts: list[int], ends: list[int], place: int) -> bool:
    """Whether no token reaches over ``place``."""
    i = bisect_left(starts, place)
    return i == 0 or ends[i - 1] <= place


def _splice(tail, head):
    """Tokens that both neighbours have between them too many; None without a common place."""
    before = {spot["at"]: spot["n"] for spot in head}
    common = [(spot["at"], spot["n"]) for spot in tail if spot["at"] in before]
    if not common:
        return None
    # In the middle of the overlap both have the most text around the place.
    at, after = common[len(common) // 2]
    return after + before[at]
