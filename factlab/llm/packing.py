"""Packing documents into token windows with a bounded number of open windows.

A partition tokenizes its documents in turn, cuts full windows off long ones and puts
each rest into the open window it fits best, the one it leaves the least room in. Where
none fits, the fullest is emitted and a new one opened. What is open at the end of the
partitions is merged: the windows of ``MERGED`` partitions are strung together and cut
at full windows, so each such group leaves one window that is not full.

A document consists of the ids of its text and ``end_id``; NULL and empty texts of
``end_id`` alone. Repeated rows are packed each. An empty table gives an empty result.
Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import stored, texts_of
from factlab.llm.tokens import codec

WINDOW = 4096
OPEN_WINDOWS = 64
MERGED = 32
_ROWS = 256
_PIECES = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("open", pa.bool_()),
    ("ids", pa.binary()),
]


class Windows:
    """The open windows of one partition; ``place`` returns what it had to emit."""

    def __init__(self, size: int, most: int):
        self._size, self._most = size, most
        self._open: list[tuple[list, int]] = []  # pieces, tokens

    def place(self, piece, length: int) -> list | None:
        room = [self._size - used for _, used in self._open]
        fits = [(free, i) for i, free in enumerate(room) if free >= length]
        if fits:
            _, i = min(fits)
            pieces, used = self._open[i]
            pieces.append((used, piece))
            self._open[i] = (pieces, used + length)
            if used + length == self._size:
                return self._open.pop(i)[0]
            return None
        emitted = None
        if len(self._open) == self._most:
            emitted = self._open.pop(room.index(min(room)))[0]
        self._open.append(([(0, piece)], length))
        return emitted

    def rest(self) -> list[list]:
        return [pieces for pieces, _ in self._open]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each piece: id, start, length, doc_tokens, sequence_id, offset, ids.

    ``start`` counts the document's ids before the piece, ``offset`` the window's;
    ``ids`` are little-endian unsigned 32-bit integers.
    """
    texts = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    id_type = texts.schema["id"].dataType.simpleString()
    kinds = "start long, length long, doc_tokens long, sequence_id long, offset long"

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = codec(tokenizer), struct.pack("<I", end_id)
        windows, made = Windows(window, open_windows), 0
        base = TaskContext.get().partitionId() << 32
        out = _Rows([("id", texts_id), *_PIECES])
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), texts_of(batch, "text")):
                data = ids.encode(text) + end
                n = len(data) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    piece = (doc_id, start, length, n, data[4 * start : 4 * (start + length)])
                    if length == window:
                        closed = [(0, piece)]
                    else:
                        closed = windows.place(piece, length)
                    if closed:
                        out.add(closed, base + made, False)
                        made += 1
                        yield from out.full()
        for pieces in windows.rest():
            out.add(pieces, base + made, True)
            made += 1
        yield from out.full(last=True)

    def string(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows([("id", texts_id), *_PIECES])
        made, used, waiting = (1 << 62) + (key[0].as_py() << 32), 0, []
        table = pa.Table.from_batches(rows).sort_by(
            [("sequence_id", "ascending"), ("offset", "ascending")]
        )
        for row in table.to_pylist():
            done = 0
            while done < row["length"]:
                part = min(window - used, row["length"] - done)
                data = row["ids"][4 * done : 4 * (done + part)]
                piece = (row["id"], row["start"] + done, part, row["doc_tokens"], data)
                waiting.append((used, piece))
                used, done = (used + part) % window, done + part
                if used == 0:
                    out.add(waiting, made, False)
                    made, waiting = made + 1, []
        if waiting:
            out.add(waiting, made, True)
        yield from out.full(last=True)

    texts_id = _arrow_type(texts)
    schema = f"id {id_type}, {kinds}, open boolean, ids binary"
    filled = stored(texts.mapInArrow(fill, schema), "packed")
    left = filled.where("open").withColumn("group_", F.expr(f"(sequence_id >> 32) div {MERGED}"))
    merged = left.groupBy("group_").applyInArrow(string, schema)
    pieces = filled.where("not open").unionByName(merged).drop("open")
    return pieces.withColumnRenamed("id", id_column)


def _arrow_type(texts: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(texts.schema["id"].dataType)


class _Rows:
    """Pieces gathered to batches."""

    def __init__(self, fields: list):
        self._schema = pa.schema(fields)
        self._rows: list[tuple] = []

    def add(self, pieces: list, sequence_id: int, is_open: bool) -> None:
        for offset, (doc_id, start, length, doc_tokens, ids) in pieces:
            self._rows.append(
                (doc_id, start, length, doc_tokens, sequence_id, offset, is_open, ids)
            )

    def full(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if len(self._rows) >= _ROWS or last and self._rows:
            columns = list(zip(*self._rows))
            arrays = [pa.array(x, field.type) for x, field in zip(columns, self._schema)]
            self._rows = []
            yield pa.RecordBatch.from_arrays(arrays, schema=self._schema)
