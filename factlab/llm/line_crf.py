"""Quality rules: a linear-chain conditional random field labels lines, their share decides.

A document is the sequence of its lines that hold a word. Each line has a few properties
in bins (``line_bins``); the field weighs them by label and neighbouring labels, and
Viterbi decoding finds the best labels of all lines at once: content or boilerplate. A
document is kept if the base rules pass and at least ``MIN_SHARE`` of its words stand in
content lines.

``train`` fits the field on a bounded sample of labelled documents. Labels there say of a
whole document whether it is good, so lines of bad documents are first taken as
boilerplate, a field without transitions is fitted, and the lines it takes for content
count as content in the fit of the whole field.

NULL and empty texts have no words, fail the base rules and are rejected. Repeated rows
are judged alike. Without labels of both kinds every line is content, so the base rules
decide alone. An empty table gives an empty result. ``judged`` reads the id and text
columns only; ``clean`` returns the columns of its input, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import by_place, place_of, texts_of

MIN_WORDS = 10
MAX_REPEATED = 20  # of 100 words
REPEAT = 5
MIN_SHARE = 0.5
#: Bounds of the sample that trains: documents, and lines of one.
SAMPLE = 3000
SAMPLE_LINES = 200
BOILERPLATE, CONTENT = 0, 1

_SPACES = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_DIGITS = b"0123456789"
_ENDS = b".!?:;"
#: Upper bounds of the bins of each property; a value beyond the last has one more bin.
_BOUNDS = (
    (1, 2, 4, 8, 16, 32, 64),  # words
    (0, 0.02, 0.05, 0.1, 0.2, 0.5),  # symbols for each word
    (0, 0.1, 0.25, 0.5, 0.9),  # words in capitals
    (0.2, 0.4, 0.6, 0.8, 0.95),  # different words
    (3, 4, 6, 8, 12, 20),  # bytes of a word
    (0, 0.02, 0.1, 0.3),  # digits of all bytes
    (0, 0.1, 0.4),  # doubled exclamation marks for each word
    (0,),  # line seen before in the document
    (0,),  # end of a sentence at the line's end
)
_BASES = np.cumsum([0, *[len(bounds) + 1 for bounds in _BOUNDS]])
N_BINS = int(_BASES[-1])


class Base(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEATED * self.n_words


class Crf(NamedTuple):
    """Scores by label: of each bin, of the first line, of a label after a label."""

    bins: np.ndarray
    first: np.ndarray
    after: np.ndarray


# ---- one document ---------------------------------------------------------------


def measured(text: str) -> tuple[Base, np.ndarray, np.ndarray]:
    """Base figures, the bins of each line with a word, and how many words it has."""
    data = text.encode()
    words: list[bytes] = []
    rows, seen, n_dup = [], set(), 0
    for line in data.split(b"\n"):
        found = line.split()
        if not found:
            continue
        again = line in seen
        n_dup += again
        seen.add(line)
        words += found
        n, size = len(found), sum(map(len, found))
        rows.append(
            (
                n,
                sum(map(line.count, _SYMBOL_BYTES)) / n,
                sum(map(bytes.isupper, found)) / n,
                len(set(found)) / n,
                size / n,
                1 - len(line.translate(None, _DIGITS)) / len(line),
                line.count(b"!!") / n,
                again,
                found[-1][-1] in _ENDS,
            )
        )
    base = Base(
        len(words),
        len(text) - sum(map(data.count, _SPACE_BYTES)),
        sum(map(data.count, _SYMBOL_BYTES)),
        n_dup,
        repeated_words(words),
    )
    values = np.array(rows, float).reshape(-1, len(_BOUNDS))
    bins = [np.searchsorted(b, values[:, i]) + _BASES[i] for i, b in enumerate(_BOUNDS)]
    return base, np.stack(bins, axis=1), values[:, 0].astype(np.int64)


_SPACE_BYTES = [bytes([x]) for x in _SPACES]
_SYMBOL_BYTES = [bytes([x]) for x in _SYMBOLS]


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of ``REPEAT`` words that stand in the text twice or more."""
    windows = list(zip(*[words[i:] for i in range(REPEAT)]))
    if len(set(windows)) == len(windows):
        return 0
    counts, n, upto = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            n += i + REPEAT - max(upto, i)
            upto = i + REPEAT
    return n


def viterbi(scores: np.ndarray, crf: Crf) -> np.ndarray:
    """The best labels of lines with these scores by label; of equal ones content."""
    ((bb, bc), (cb, cc)) = crf.after.tolist()
    came: list[tuple[int, int]] = []
    rows = scores.tolist()
    b, c = rows[0][0] + crf.first[0], rows[0][1] + crf.first[1]
    for to_b, to_c in rows[1:]:
        from_b, from_c = int(c + cb >= b + bb), int(c + cc >= b + bc)
        came.append((from_b, from_c))
        b, c = (
            (c + cb if from_b else b + bb) + to_b,
            (c + cc if from_c else b + bc) + to_c,
        )
    label = int(c >= b)
    labels = [label]
    for back in reversed(came):
        label = back[label]
        labels.append(label)
    return np.array(labels[::-1])


def content_share(bins: np.ndarray, words: np.ndarray, crf: Crf | None) -> float:
    if not len(words):
        return 0.0
    if crf is None:
        return 1.0
    labels = viterbi(crf.bins[:, bins].sum(axis=2).T, crf)
    return float(words[labels == CONTENT].sum() / words.sum())


# ---- training -------------------------------------------------------------------


class _Layout(NamedTuple):
    """Lines of all sequences in one row: first lines, then second ones, and so on.

    Sequences come longest first, so those that reach a place are the first ones.
    """

    starts: np.ndarray  # of each place
    n_at: np.ndarray  # sequences that reach it
    row: np.ndarray  # the sequence of each line
    later: np.ndarray  # lines that have a line before
    before: np.ndarray  # that line


def _layout(lengths: np.ndarray) -> _Layout:
    n_at = (lengths[:, None] > np.arange(lengths[0])).sum(axis=0)
    starts = np.cumsum(n_at) - n_at
    row = np.arange(n_at.sum()) - np.repeat(starts, n_at)
    later = np.arange(n_at[0], n_at.sum())
    before = np.repeat(starts[:-1], n_at[1:]) + row[n_at[0] :]
    return _Layout(starts, n_at, row, later, before)


def fit(lines: list[np.ndarray], labels: list[np.ndarray], chain: bool = True) -> Crf:
    """The field of greatest likelihood, by gradient ascent with momentum and decay.

    Sums run forward and backward over all sequences at once. Without ``chain`` lines do
    not depend on each other. Lines of equal bins are scored once.
    """
    order = np.argsort([-len(x) for x in lines], kind="stable")
    layout = _layout(np.array([len(lines[i]) for i in order]))
    place = np.repeat(np.arange(len(layout.n_at)), layout.n_at)
    offsets = np.concatenate([[0], np.cumsum([len(lines[i]) for i in order])])
    at = offsets[layout.row] + place
    kinds, kind = np.unique(np.concatenate([lines[i] for i in order])[at], axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    truth = np.eye(2)[np.concatenate([labels[i] for i in order])[at]]
    held = np.zeros((len(kinds), N_BINS))
    held[np.arange(len(kinds))[:, None], kinds] = 1
    n = layout.n_at[0]
    seen = _Sums(truth, truth[:n].sum(axis=0), truth[layout.before].T @ truth[layout.later])
    weights = np.zeros((N_BINS, 2)), np.zeros(2), np.zeros((2, 2))
    moved = [np.zeros_like(x) for x in weights]
    squares = [np.zeros_like(x) for x in weights]
    for step in range(1, 101):
        scores = (held @ weights[0])[kind]
        if chain:
            expected = _expected(scores, weights[1], weights[2], layout)
        else:
            alone = np.exp(scores - np.logaddexp(scores[:, :1], scores[:, 1:]))
            expected = _Sums(alone, seen.first, seen.steps)
        gap = seen.lines - expected.lines
        by_kind = [np.bincount(kind, gap[:, label], len(kinds)) for label in (0, 1)]
        slopes = [
            held.T @ np.stack(by_kind, axis=1),
            seen.first - expected.first,
            seen.steps - expected.steps,
        ]
        for x, slope, m, s in zip(weights, slopes, moved, squares):
            slope = slope / len(kind) - 1e-4 * x
            m += 0.1 * (slope - m)
            s += 0.01 * (slope**2 - s)
            x += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Crf(weights[0].T.copy(), *weights[1:])


class _Sums(NamedTuple):
    lines: np.ndarray
    first: np.ndarray
    steps: np.ndarray


def _expected(scores: np.ndarray, first: np.ndarray, after: np.ndarray, layout: _Layout) -> _Sums:
    """Expected labels, first labels and steps under the field."""
    starts, n_at = layout.starts.tolist(), layout.n_at.tolist()
    ahead, behind = scores.copy(), np.zeros_like(scores)
    n = n_at[0]
    ahead[:n] += first
    for t in range(1, len(n_at)):
        x = ahead[starts[t - 1] : starts[t - 1] + n_at[t]]
        ahead[starts[t] : starts[t] + n_at[t]] += np.logaddexp(
            x[:, :1] + after[0], x[:, 1:] + after[1]
        )
    for t in range(len(n_at) - 2, -1, -1):
        here = slice(starts[t + 1], starts[t + 1] + n_at[t + 1])
        x = behind[here] + scores[here]
        behind[starts[t] : starts[t] + n_at[t + 1]] = np.logaddexp(
            x[:, :1] + after[:, 0], x[:, 1:] + after[:, 1]
        )
    log_z = np.logaddexp(*(ahead[:n] + behind[:n]).T)[layout.row][:, None]
    lines = np.exp(ahead + behind - log_z)
    # The sum of a step is the product of what leads to it and what follows, over z.
    onward = (scores + behind - log_z)[layout.later]
    ahead = ahead[layout.before]
    steps = np.array(
        [
            [np.exp(ahead[:, i] + after[i, j] + onward[:, j]).sum() for j in (0, 1)]
            for i in (0, 1)
        ]
    )
    return _Sums(lines, lines[:n].sum(axis=0), steps)


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> Crf | None:
    """The field fitted on at most ``SAMPLE`` documents of ``labels`` (id, quality).

    The sample is drawn by a hash of the id. Of documents of over ``SAMPLE_LINES`` lines
    none is taken, so the driver gets a bounded number of bins.
    """
    once = labels.where(f"quality is not null and `{id_column}` is not null")
    once = once.groupBy(F.col(id_column).alias("label_id")).agg(F.max("quality").alias("quality"))
    chosen = once.orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [measured(text)[1] for text in texts_of(batch, "text")]
            short = [0 < len(x) <= SAMPLE_LINES for x in bins]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").filter(pa.array(short, pa.bool_())),
                    batch.column("quality").filter(pa.array(short, pa.bool_())),
                    pa.array([x.astype("u1").tobytes() for x, y in zip(bins, short) if y], pa.binary()),
                ],
                ["id", "quality", "bins"],
            )

    id_type, quality = (rows.schema[x].dataType.simpleString() for x in ("id", "quality"))
    found = (
        rows.select("id", "quality", "text")
        .mapInArrow(measure, f"id {id_type}, quality {quality}, bins binary")
        .groupBy("id")
        .agg(F.max("quality").alias("quality"), F.min("bins").alias("bins"))
        .orderBy("id")
        .collect()
    )
    lines = [np.frombuffer(row["bins"], "u1").reshape(-1, len(_BOUNDS)) for row in found]
    good = [row["quality"] == 1 for row in found]
    if all(good) or not any(good):
        return None
    taken = [np.full(len(x), CONTENT if y else BOILERPLATE) for x, y in zip(lines, good)]
    alone = fit(lines, taken, chain=False)
    for i, y in enumerate(good):
        if not y:
            scores = alone.bins[:, lines[i]].sum(axis=2)
            taken[i] = np.where(scores[CONTENT] > scores[BOILERPLATE], CONTENT, BOILERPLATE)
    return fit(lines, taken)


# ---- operators ------------------------------------------------------------------


def judged(
    docs: DataFrame, crf: Crf | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id, base figures, ``base_failed``, ``kept`` and ``content_share``."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    names = [*Base._fields, "base_failed", "kept", "content_share"]
    kinds = [pa.int64()] * len(Base._fields) + [pa.bool_(), pa.bool_(), pa.float64()]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in texts_of(batch, "text"):
                base, bins, words = measured(text)
                share = content_share(bins, words, crf)
                out.append((*base, base.failed, not base.failed and share >= MIN_SHARE, share))
            columns = list(zip(*out)) or [()] * len(names)
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *names])

    id_type = rows.schema["id"].dataType.simpleString()
    longs = ", ".join(f"{name} long" for name in Base._fields)
    schema = f"id {id_type}, {longs}, base_failed boolean, kept boolean, content_share double"
    return rows.mapInArrow(judge, schema).withColumnRenamed("id", id_column)


def clean(docs: DataFrame, crf: Crf | None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept."""
    text, rows = place_of(docs, text_column), by_place(docs)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = []
            for value in texts_of(batch, text):
                base, bins, words = measured(value)
                stay.append(not base.failed and content_share(bins, words, crf) >= MIN_SHARE)
            yield batch.filter(pa.array(stay, pa.bool_()))

    return rows.mapInArrow(keep, rows.schema).toDF(*docs.columns)


def labelled_lines(
    docs: DataFrame, crf: Crf, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each line with a word: id, place, line, ``is_content``."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, places, lines, content = [], [], [], []
            for i, text in enumerate(texts_of(batch, "text")):
                _, bins, words = measured(text)
                found = [x for x in enumerate(text.split("\n")) if x[1].encode().split()]
                if found:
                    labels = viterbi(crf.bins[:, bins].sum(axis=2).T, crf)
                    at += [i] * len(found)
                    places += [place for place, _ in found]
                    lines += [line for _, line in found]
                    content += (labels == CONTENT).tolist()
            arrays = [pa.array(places, pa.int64()), pa.array(lines, pa.string()), pa.array(content, pa.bool_())]
            ids = batch.column("id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *arrays], ["id", "place", "line", "is_content"])

    return rows.mapInArrow(
        label, f"id {id_type}, place long, line string, is_content boolean"
    ).withColumnRenamed("id", id_column)
