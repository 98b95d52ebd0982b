"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents. They are cut into blocks of ``BLOCK`` ids,
the last one filled up with its last id. A block stores its smallest id, and of each id
the difference to it in as many bits as the ``PERCENTILE`` of the differences needs; the
higher bits of the few larger ones go to a list of exceptions (place, high bits). An
index of block starts and of documents stands at the end, so a reader gets to any
document without decoding what lies before.

    magic | blocks | block starts uint64 | document ids int64, known uint8, lengths uint64
          | counts: ids, blocks, documents uint64 | magic
    block:  smallest uint32, width uint8, exceptions uint16, packed words, places uint16,
            high bits uint32; all little-endian

Documents are written in ascending order of their id, NULL first, repeated ids in the
order of a hash of their texts. NULL and empty texts consist of their end id. An empty
table gives no file and an empty result. Only the id (an integer) and text columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlab.llm.common import texts_of
from factlab.llm.tokens import codec

MAGIC = b"PFOR0001"
BLOCK = 1024
PERCENTILE = 0.9
#: Blocks coded at once, and ids of documents in a batch that is read back.
_BLOCKS = 256
_BATCH_IDS = 1 << 20
_HEAD = struct.Struct("<IBH")
_COUNTS = struct.Struct("<QQQ")


# ---- blocks ---------------------------------------------------------------------


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``values`` below 2 ** width, 64 of them in ``width`` words."""
    rows = values.reshape(len(values), -1, 64).astype(np.uint64)
    words = np.zeros((*rows.shape[:2], width), np.uint64)
    for i in range(64 if width else 0):
        word, shift = divmod(i * width, 64)
        words[:, :, word] |= rows[:, :, i] << np.uint64(shift)
        if shift + width > 64:
            words[:, :, word + 1] |= rows[:, :, i] >> np.uint64(64 - shift)
    return words.reshape(len(values), -1)


def unpack_bits(words: np.ndarray, width: int, n: int) -> np.ndarray:
    """The ``n`` values of each row that ``pack_bits`` packed."""
    if not width:
        return np.zeros((len(words), n), np.uint64)
    rows = words.reshape(len(words), -1, width)
    values = np.empty((len(words), n // 64, 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = rows[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | rows[:, :, word + 1] << np.uint64(64 - shift)
        values[:, :, i] = value & mask
    return values.reshape(len(words), n)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """``ids`` of shape (blocks, BLOCK), each block as bytes."""
    least = ids.min(axis=1)
    above = ids - least[:, None]
    at = int(PERCENTILE * (ids.shape[1] - 1))
    usual = np.partition(above, at, axis=1)[:, at]
    widths = np.array([int(x).bit_length() for x in usual])
    blocks: list[bytes] = [b""] * len(ids)
    for width in set(widths.tolist()):
        chosen = np.flatnonzero(widths == width)
        rows = above[chosen]
        words = pack_bits(rows & np.uint32((1 << width) - 1), width).astype("<u8", copy=False)
        high = (rows.astype(np.uint64) >> np.uint64(width)).astype("<u4")
        for i, word, rest in zip(chosen.tolist(), words, high):
            places = np.flatnonzero(rest)
            blocks[i] = b"".join(
                (
                    _HEAD.pack(int(least[i]), width, len(places)),
                    word.tobytes(),
                    places.astype("<u2").tobytes(),
                    rest[places].tobytes(),
                )
            )
    return blocks


def decode_blocks(blocks: list[bytes], size: int = BLOCK) -> np.ndarray:
    """What ``encode_blocks`` coded, of shape (blocks, size)."""
    heads = [_HEAD.unpack_from(block) for block in blocks]
    ids = np.empty((len(blocks), size), np.uint32)
    for width in {head[1] for head in heads}:
        chosen = [i for i, head in enumerate(heads) if head[1] == width]
        n = width * size // 64
        words = np.stack([np.frombuffer(blocks[i], "<u8", n, _HEAD.size) for i in chosen])
        values = unpack_bits(words, width, size)
        for row, i in zip(values, chosen):
            least, _, extra = heads[i]
            at = _HEAD.size + 8 * n
            places = np.frombuffer(blocks[i], "<u2", extra, at)
            high = np.frombuffer(blocks[i], "<u4", extra, at + 2 * extra)
            row[places] |= high.astype(np.uint64) << np.uint64(width)
            ids[i] = row + np.uint64(least)
    return ids


# ---- files ----------------------------------------------------------------------


class FileWriter:
    """Adds documents to a file one after the other; memory holds a few blocks and the index."""

    def __init__(self, out):
        self._out = out
        self._waiting, self._n_waiting = [], 0
        self._starts, self._docs, self._known, self._lengths = [], [], [], []
        self._at = out.write(MAGIC)
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._docs.append(doc_id or 0)
        self._known.append(doc_id is not None)
        self._lengths.append(len(ids) // 4)
        self._waiting.append(ids)
        self._n_waiting += len(ids) // 4
        self.n_ids += len(ids) // 4
        if self._n_waiting >= BLOCK * _BLOCKS:
            self._flush(self._n_waiting // BLOCK * BLOCK)

    def _flush(self, upto: int) -> None:
        ids = np.frombuffer(b"".join(self._waiting), "<u4")
        for first in range(0, upto, BLOCK * _BLOCKS):
            part = ids[first : min(upto, first + BLOCK * _BLOCKS)].reshape(-1, BLOCK)
            for block in encode_blocks(part):
                self._starts.append(self._at)
                self._at += self._out.write(block)
        self._waiting = [ids[upto:].tobytes()]
        self._n_waiting = len(ids) - upto

    def close(self) -> None:
        if self._n_waiting:
            ids = np.frombuffer(b"".join(self._waiting), "<u4")
            fill = np.full(-len(ids) % BLOCK, ids[-1], "<u4")
            self._waiting = [np.concatenate([ids, fill]).tobytes()]
            self._flush(len(ids) + len(fill))
        self._out.write(np.array(self._starts, "<u8").tobytes())
        self._out.write(np.array(self._docs, "<i8").tobytes())
        self._out.write(np.array(self._known, "u1").tobytes())
        self._out.write(np.array(self._lengths, "<u8").tobytes())
        self._out.write(_COUNTS.pack(self.n_ids, len(self._starts), len(self._docs)) + MAGIC)


class FileReader:
    """Documents of one file, all in order or any range of ids by the index."""

    def __init__(self, file, size: int):
        self._file = file
        file.seek(size - _COUNTS.size - len(MAGIC))
        end = file.read(_COUNTS.size + len(MAGIC))
        if end[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a complete file of token blocks")
        self.n_ids, n_blocks, n_docs = _COUNTS.unpack(end[: _COUNTS.size])
        index = 8 * n_blocks + 17 * n_docs
        at = size - _COUNTS.size - len(MAGIC) - index
        file.seek(at)
        data = file.read(index)
        starts = np.frombuffer(data, "<u8", n_blocks).astype(np.int64)
        self._starts = np.append(starts, at)
        at = 8 * n_blocks
        docs = np.frombuffer(data, "<i8", n_docs, at).tolist()
        known = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs).tolist()
        self.doc_ids = [doc if there else None for doc, there in zip(docs, known)]
        self.lengths = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on; decodes the blocks that hold them."""
        if n == 0:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK, (start + n - 1) // BLOCK + 1
        base = self._starts[first]
        self._file.seek(int(base))
        data = self._file.read(int(self._starts[last] - base))
        cuts = (self._starts[first : last + 1] - base).tolist()
        blocks = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        at = start - first * BLOCK
        return decode_blocks(blocks).reshape(-1)[at : at + n]

    def documents(self) -> Iterator[tuple[int, int, list[bytes]]]:
        """First document, its start and the ids of as many as make a batch."""
        first = 0
        while first < len(self.lengths):
            start = int(self.starts[first])
            last = int(np.searchsorted(self.starts + self.lengths, start + _BATCH_IDS, "right"))
            last = max(last, first + 1)
            n = self.lengths[first:last]
            data = self.ids(start, int(n.sum())).astype("<u4", copy=False).tobytes()
            ends = (4 * np.cumsum(n)).tolist()
            yield first, start, [data[a:b] for a, b in zip([0, *ends], ends)]
            first = last


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


# ---- Spark ----------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Writes one file for each range of ids below ``path``, which all executors share.

    Returns the lazy manifest (shard, file, n_docs, n_ids): whoever writes it runs the
    job. Each attempt of a task writes a file of its own, which is never renamed or removed;
    the manifest, which Spark commits, names those that count. What failed attempts leave
    behind is named nowhere.
    """
    texts = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange("id", tie).sortWithinPartitions("id", tie)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(path)
        ids, end = codec(tokenizer), struct.pack("<I", end_id)
        shard, file, n_docs = TaskContext.get().partitionId(), None, 0
        name = f"part-{shard:06d}-{uuid.uuid4().hex}.pfor"
        for batch in batches:
            if file is None and batch.num_rows:
                store.create_dir(folder, recursive=True)
                file = store.open_output_stream(f"{folder}/{name}")
                writer = FileWriter(file)
            for doc_id, text in zip(batch.column("id").to_pylist(), texts_of(batch, "text")):
                writer.add(doc_id, ids.encode(text) + end)
            n_docs += batch.num_rows
        if file is not None:
            writer.close()
            file.close()
            row = {"shard": shard, "file": f"{path}/{name}", "n_docs": n_docs, "n_ids": writer.n_ids}
            yield pa.RecordBatch.from_pylist([row])

    return ordered.mapInArrow(write, "shard long, file string, n_docs long, n_ids long")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Columns doc_id, start (ids of all documents before), n_tokens, ids (binary).

    A row of the manifest is a file of many documents: their order needs one window
    over as many rows as there are files.
    """
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = manifest.withColumn("before", F.sum("n_ids").over(order) - F.col("n_ids"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, name = _open(row["file"])
                with store.open_input_file(name) as file:
                    reader = FileReader(file, store.get_file_info(name).size)
                    for first, _, ids in reader.documents():
                        these = slice(first, first + len(ids))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[these], pa.int64()),
                                pa.array(reader.starts[these] + row["before"], pa.int64()),
                                pa.array(reader.lengths[these], pa.int64()),
                                pa.array(ids, pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    return files.repartitionByRange(n, "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )


def read_document(file: str, doc_id: int) -> list[int]:
    """The ids of one document of one file, found by the index; on the driver, for a look."""
    store, name = _open(file)
    with store.open_input_file(name) as opened:
        reader = FileReader(opened, store.get_file_info(name).size)
        at = reader.doc_ids.index(doc_id)
        return reader.ids(int(reader.starts[at]), int(reader.lengths[at])).tolist()
