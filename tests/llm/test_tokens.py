"""Token counts, token files and packing against the libraries on whole texts."""

from __future__ import annotations

import io
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import ODD_ROWS, empty, odd, sf, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factlab.llm import queries
from factlab.llm.common import stored
from factlab.llm.packing import Windows, pack
from factlab.llm.token_counts import count_tokens
from factlab.llm.token_files import (
    BLOCK,
    FileReader,
    FileWriter,
    decode_blocks,
    encode_blocks,
    read_document,
    read_token_files,
    write_token_files,
)
from factlab.llm.tokens import codec

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"

LIBRARY = {path: Tokenizer.from_file(path) for path in (WORD, BYTE)}
ALPHABET = st.sampled_from(list("ab Z'!<|>.#$=\n\t ́éÉßΣ日1 ") + [" the", "<|endoftext|>", "'s"])


def library_ids(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(parts=st.lists(ALPHABET, max_size=30))
def test_codec_equals_library(path, parts):
    text = "".join(parts)
    assert array("I", codec(path).encode(text)).tolist() == library_ids(path, text)


def test_codec_modes():
    assert (codec(WORD).mode, codec(BYTE).mode, codec(PIECE).mode) == ("dropped", "spaced", None)
    assert len(codec(PIECE).encode("hello world")) > 0


# ---- token counts ----------------------------------------------------------------


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("chunk, overlap", [(64, 16), (100, 2), (10_000, 1_000)])
def test_spliced_counts_equal_library(spark, path, chunk, overlap):
    texts = [row[1] for row in ODD_ROWS]
    texts += ["ab'cd " * 60, "<|endoftext|>" * 30, "é́ " * 90, "no.spaces" * 40, "a b " * 5 + "y" * 300]
    docs = table(spark, [(i, text, None) for i, text in enumerate(texts + texts[-2:])])
    got = {row[0]: row[1:] for row in count_tokens(docs, path, chunk=chunk, overlap=overlap).collect()}
    assert got == {
        i: (len((text or "").encode()), len(library_ids(path, text)))
        for i, text in enumerate(texts + texts[-2:])
    }


def test_counts_of_odd_and_empty_tables(spark):
    got = Counter(map(tuple, count_tokens(odd(spark), WORD, chunk=1000, overlap=50).collect()))
    assert got == Counter(
        (i, len((text or "").encode()), len(library_ids(WORD, text))) for i, text, _ in ODD_ROWS
    )
    assert count_tokens(empty(spark), WORD).collect() == []
    assert count_tokens(odd(spark), PIECE).count() == len(ODD_ROWS)


def test_op3_query(spark):
    texts = dict(map(tuple, sf(spark, "documents").select("doc_id", "text").collect()))
    got = queries.QUERIES["op3_token_counts"](spark, SF).collect()
    assert len(got) == len(texts)
    for row in got:
        n = len(library_ids(WORD, texts[row.doc_id]))
        assert (row.n_tokens, row.over_limit) == (n, n > 2048)


# ---- token files -----------------------------------------------------------------


@settings(max_examples=50, deadline=None)
@given(
    low=st.integers(0, 2**32 - 1),
    width=st.integers(0, 32),
    outliers=st.lists(st.integers(0, 2**32 - 1), max_size=200),
)
def test_blocks_round_trip(low, width, outliers):
    rng = np.random.default_rng(width)
    ids = np.minimum(low + rng.integers(0, 2**width, (3, BLOCK)), 2**32 - 1).astype(np.uint32)
    ids[1, : len(outliers)] = outliers
    assert (decode_blocks(encode_blocks(ids)) == ids).all()


def test_file_round_trip_and_index():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype("<u4") for n in (0, 1, 5, BLOCK, 300 * BLOCK + 7, 3)]
    out = io.BytesIO()
    writer = FileWriter(out)
    for i, ids in enumerate(docs):
        writer.add(i or None, ids.tobytes())
    writer.close()
    reader = FileReader(out, out.tell())
    assert reader.doc_ids == [None, 1, 2, 3, 4, 5]
    for i, ids in enumerate(docs):
        assert (reader.ids(int(reader.starts[i]), len(ids)) == ids).all()
    read = [x for _, _, part in reader.documents() for x in part]
    assert read == [ids.tobytes() for ids in docs]
    with pytest.raises(ValueError):
        FileReader(io.BytesIO(out.getvalue()[:-1]), out.tell() - 1)


def _files(spark, docs, path):
    return stored(write_token_files(docs, str(path), BYTE, end_id=0), "manifest")


def test_token_files_of_odd_rows(spark, tmp_path):
    manifest = _files(spark, odd(spark), tmp_path / "odd")
    got = sorted(map(tuple, read_token_files(manifest).collect()), key=lambda row: row[1])
    at = 0
    for _, start, n, ids in got:
        assert (start, 4 * n) == (at, len(ids))
        at += n
    assert [row[0] for row in got] == sorted((r[0] for r in ODD_ROWS), key=lambda x: (x is not None, x))
    want = Counter(tuple([i, *library_ids(BYTE, text), 0]) for i, text, _ in ODD_ROWS)
    assert Counter((row[0], *array("I", row[3])) for row in got) == want
    for row in manifest.collect():
        if 7 in FileReader(open(row.file, "rb"), (tmp_path / "odd" / row.file).stat().st_size).doc_ids:
            assert read_document(row.file, 7) == [*library_ids(BYTE, ODD_ROWS[8][1]), 0]
            break
    else:
        raise AssertionError("document 7 is in no file")


def test_files_of_a_committed_manifest_outlive_other_attempts(spark, tmp_path):
    """Attempts that end, or die with their file half written, touch no file but their own."""
    manifest = _files(spark, odd(spark), tmp_path / "files")
    want = sorted(map(str, read_token_files(manifest).collect()))
    again = _files(spark, odd(spark), tmp_path / "files")
    broken = odd(spark).withColumn("text", F.expr("if(doc_id = 7, raise_error('lost'), text)"))
    with pytest.raises(Exception, match="lost"):
        _files(spark, broken, tmp_path / "files")
    assert sorted(map(str, read_token_files(manifest).collect())) == want
    assert not {row.file for row in manifest.collect()} & {row.file for row in again.collect()}


def test_token_files_of_empty_table(spark, tmp_path):
    assert read_token_files(_files(spark, empty(spark), tmp_path / "none")).collect() == []


def test_op5_query(spark):
    docs = sorted(map(tuple, sf(spark, "documents").select("doc_id", "text").collect()))
    want, start = [], 0
    for doc_id, text in docs:
        ids = [*library_ids(BYTE, text), 0]
        want.append((doc_id, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    got = queries.QUERIES["op5_token_files"](spark, SF)
    assert sorted(map(tuple, got.collect())) == want


# ---- packing ---------------------------------------------------------------------


def test_best_fit_and_fullest_first():
    windows = Windows(10, 2)
    assert windows.place("a", 6) is None and windows.place("b", 5) is None
    assert windows.place("c", 4) == [(0, "a"), (6, "c")]  # the window it fills
    assert windows.place("d", 7) is None
    assert windows.place("e", 6) == [(0, "d")]  # none fits: the fullest goes
    assert windows.rest() == [[(0, "b")], [(0, "e")]]


def check_pieces(pieces, docs, window):
    """Every id of every document once, windows without gaps; returns the padding."""
    by_window = defaultdict(list)
    for row in pieces:
        by_window[row.sequence_id].append(row)
    for rows in by_window.values():
        at = 0
        for row in sorted(rows, key=lambda row: row.offset):
            assert row.offset == at and len(row.ids) == 4 * row.length > 0
            at += row.length
        assert at <= window
    got = Counter()
    for row in pieces:
        for i, token in enumerate(array("I", row.ids)):
            got[row.id, row.doc_tokens, row.start + i, token] += 1
    want = Counter()
    for doc_id, text in docs:
        ids = [*library_ids(WORD, text), 2]
        want.update((doc_id, len(ids), i, token) for i, token in enumerate(ids))
    assert got == want
    total = sum(row.length for row in pieces)
    return 1 - total / (window * len(by_window)) if by_window else 0


@pytest.mark.parametrize("window, most", [(16, 1), (100, 4), (4096, 64)])
def test_packing_of_odd_rows(spark, window, most):
    pieces = pack(odd(spark), WORD, 2, window, most).withColumnRenamed("doc_id", "id").collect()
    check_pieces(pieces, [row[:2] for row in ODD_ROWS], window)


def test_packing_leaves_little_padding(spark):
    docs = sf(spark, "documents").select("doc_id", "text").repartition(8)
    pieces = pack(docs, WORD, 2, window=512, open_windows=8).withColumnRenamed("doc_id", "id")
    assert check_pieces(pieces.collect(), list(map(tuple, docs.collect())), 512) < 0.02


def test_packing_of_empty_table(spark):
    assert pack(empty(spark), WORD, 2).collect() == []


def test_op7_query(spark):
    texts = dict(map(tuple, sf(spark, "documents").select("doc_id", "text").collect()))
    ids = {i: [*library_ids(WORD, text), 2] for i, text in texts.items()}
    got = queries.QUERIES["op7_packing"](spark, SF).collect()
    seen = Counter()
    for row in got:
        part = ids[row.doc_id][row.start : row.start + row.length]
        assert row.ids_crc32 == zlib.crc32(array("I", part).tobytes())
        seen[row.doc_id] += row.length
    assert seen == {i: len(x) for i, x in ids.items()}
