"""URL filters: rules first, then naive Bayes on words that host names are split into.

A url's host and path are cut at dots, hyphens and other marks. Viterbi decoding splits
each letter run into the most likely words of a unigram model; runs of digits become one
token. Multinomial naive Bayes over hashed tokens then scores block against allow.

Both models are counted here, over the whole table: word counts on the pages' texts;
token counts on all urls, those taken as blocked that hold a word of ``SEEDS`` as a token.
A tie of the scores allows. Words stay in Spark, where the substrings of each different
run meet their counts; the driver gets those of ``SHORT`` letters and the seeds only.
Words and runs may be of any length: words of over ``LONGEST`` letters meet the runs that
hold their first letters.

A rule is a host and the start of a path. It fits the host and its subdomains; of fitting
rules the longest text wins, then the one first in code point order. NULL urls and urls
without ``://`` have an empty host and path, fit no rule and are allowed. Repeated rows
are judged each. An empty table gives an empty result. ``judged`` returns the columns of
its input with host, path, rule, verdict and score behind, in place of any so named.
"""

from __future__ import annotations

import re
from collections import ChainMap, Counter
from collections.abc import Iterator
from math import log
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import by_place, place_of, stored

#: Words of more letters are sought by their first ``LONGEST`` letters; no word is left out.
LONGEST = 20
#: Words of so many letters at most are sent to all tasks; there are under 19,000 such words.
SHORT = 3
BUCKETS = 1 << 16
#: Parameter: words that mark a url as one to block when the model is trained.
SEEDS = ("spam", "pills", "casino", "poker", "bets", "ads", "viagra", "porn", "loan")
#: What a seed counts as in the word model, so that names are split at it; in large
#: tables this share of all words, or a second word would cost more than a seed gains.
_SEED_COUNT = 1000
_SEED_SHARE = 0.001
#: Letter runs whose words a worker keeps.
_MEMO_RUNS = 100_000
#: Substrings of runs in one batch.
_BATCH = 1 << 16
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_HTML_WORDS = re.compile(r"<(?:script|style)\b.*?</(?:script|style)>|<[^>]*>|([a-z]+)", re.S)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# ---- parts and rules ------------------------------------------------------------


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(rules: list[Rule], host: Column, path: Column, give: str) -> Column:
    """``text`` or ``verdict`` of the rule that wins, NULL if none fits."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), _last_first(r.host + r.path))):
        fits = (host == rule.host) | host.endswith(f".{rule.host}")
        value = rule.host + rule.path if give == "text" else rule.verdict
        found = F.when(fits & path.startswith(rule.path), value).otherwise(found)
    return found


def _last_first(text: str) -> list[int]:
    return [-ord(c) for c in text]


# ---- word model -----------------------------------------------------------------


class Words:
    """Unigram probabilities; a run that is no word costs more with each letter."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = total or sum(counts.values()) or 1
        self._total = total
        self._cost = {word: log(total) - log(n) for word, n in counts.items()}
        self._lengths = {len(word) for word in counts}
        self._unknown = log(total) - log(10)
        self._memo: dict[str, tuple[str, ...]] = {}

    def split(self, run: str) -> tuple[str, ...]:
        if len(self._memo) > _MEMO_RUNS:
            self._memo.clear()
        if run not in self._memo:
            self._memo[run] = self._best(run)
        return self._memo[run]

    def _best(self, run: str) -> tuple[str, ...]:
        """The cheapest words that make ``run``; of equal ones the longest last word."""
        best, back = [0.0], [0]
        lengths = sorted(size for size in self._lengths if size <= len(run))
        # The best start of an unknown piece stays the best as the piece grows.
        open_cost, open_start = 0.0, 0
        for end in range(1, len(run) + 1):
            options = [(best[open_start] + self._unknown + log(10) * (end - open_start), open_start)]
            for size in lengths:
                if size > end:
                    break
                cost = self._cost.get(run[end - size : end])
                if cost is not None:
                    options.append((best[end - size] + cost, end - size))
            cost, start = min(options)
            best.append(cost)
            back.append(start)
            if cost - log(10) * end < open_cost:
                open_cost, open_start = cost - log(10) * end, end
        words, end = [], len(run)
        while end:
            words.append(run[back[end] : end])
            end = back[end]
        return tuple(reversed(words))

    def with_more(self, counts: dict[str, int]) -> Words:
        """These words and those of ``counts``, of the same total."""
        more = Words({}, self._total)
        more._cost = ChainMap({word: log(self._total) - log(n) for word, n in counts.items()}, self._cost)
        more._lengths = self._lengths | {len(word) for word in counts}
        return more


def runs(host: str, path: str) -> set[str]:
    """The letter runs of a url."""
    return {x for text in (host, path.lower()) for x in _PARTS.findall(text) if not x[0].isdigit()}


def tokens(host: str, path: str, split: dict[str, list[str]]) -> list[str]:
    """Tokens of host and path, those of the path marked as such; runs not in ``split`` stay whole."""
    found = []
    for mark, text in (("", host), ("/", path.lower())):
        for part in _PARTS.findall(text):
            found += [mark + x for x in (("0",) if part[0].isdigit() else split.get(part, (part,)))]
    return found


def count_words(pages: DataFrame, html: str) -> DataFrame:
    """Columns word, n: all words of all pages' texts.

    Urls are not counted: a run that only urls hold would be a word by itself, and one
    word costs less than the several it is made of.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column("html").to_pylist():
                counts.update(x[1] for x in _HTML_WORDS.finditer((text or "").lower()) if x[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "n"],
            )

    rows = pages.select(F.col(html).alias("html"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def split_runs(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Columns run, words: those of the different runs of ``found`` that do not stay whole.

    Each run meets the counts of its substrings of up to ``LONGEST`` letters; a longer word
    meets the runs that hold its first ``LONGEST`` letters, whose tasks look for all of it.
    So no word of ``counts`` is left out, and a run of n letters gives ``LONGEST`` * n rows
    at most, which carry its number in place of its text.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    more = max(_SEED_COUNT, round(_SEED_SHARE * total))
    known = counts.where((F.length("word") <= SHORT) | F.col("word").isin(*SEEDS)).collect()
    few = {row["word"]: row["n"] for row in known}
    few |= {seed: few.get(seed, 0) + more for seed in SEEDS}
    common = Words(few, total + more * len(SEEDS))

    def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, words = [], []
            for place, run in zip(batch.column("id").to_pylist(), batch.column("run").to_pylist()):
                seen = set()
                for start in range(len(run)):
                    for end in range(start + SHORT + 1, min(len(run), start + LONGEST) + 1):
                        seen.add(run[start:end])
                    if len(seen) >= _BATCH or start == len(run) - 1:
                        of += [place] * len(seen)
                        words += seen
                        seen = set()
                    if len(of) >= _BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(words)], ["id", "start"])
                        of, words = [], []
            kinds = [pa.array(of, pa.int64()), pa.array(words, pa.string())]
            yield pa.RecordBatch.from_arrays(kinds, ["id", "start"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, words = [], []
            for row in batch.to_pylist():
                run, known = row["run"], row["known"] or ()
                counts = {x["word"]: x["n"] for x in known if x["word"] not in SEEDS and x["word"] in run}
                best = common.with_more(counts).split(run)
                if len(best) > 1:
                    of.append(run)
                    words.append(list(best))
            kinds = [pa.array(of, pa.string()), pa.array(words, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(kinds, ["run", "words"])

    once = found.select("run").distinct().withColumn("id", F.monotonically_increasing_id())
    once = stored(once, "url-runs")
    words = counts.select(F.substring("word", 1, LONGEST).alias("start"), "word", "n")
    met = once.mapInArrow(substrings, "id long, start string").join(words.hint("merge"), "start")
    # Starts that stand at several places of a run come once for each batch of it.
    met = met.groupBy("id").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    gathered = once.join(met.hint("merge"), "id", "left").select("run", "known")
    return gathered.mapInArrow(split, "run string, words array<string>")


def parsed(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Columns host, path, n, split: each different pair once, with its number of rows."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for place, host, path in zip(*(batch.column(x).to_pylist() for x in ("id", "host", "path"))):
                some = runs(host, path)
                at += [place] * len(some)
                found += some
            kinds = [pa.array(at, pa.int64()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(kinds, ["id", "run"])

    urls = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    urls = urls.groupBy("host", "path").agg(F.count("*").alias("n"))
    urls = stored(urls.withColumn("id", F.monotonically_increasing_id()), "urls")
    found = urls.select("id", "host", "path").mapInArrow(explode, "id long, run string")
    counts = stored(count_words(pages, html), "url-words")
    split = stored(split_runs(found, counts), "url-splits")
    met = found.join(split.hint("merge"), "run").groupBy("id")
    met = met.agg(F.collect_list(F.struct("run", "words")).alias("split"))
    return urls.join(met.hint("merge"), "id", "left").drop("id")


def _tokens_of(batch: pa.RecordBatch) -> Iterator[list[str]]:
    for host, path, split in zip(*(batch.column(x).to_pylist() for x in ("host", "path", "split"))):
        yield tokens(host, path, {x["run"]: x["words"] for x in split or ()})


# ---- naive Bayes ----------------------------------------------------------------


class Bayes(NamedTuple):
    prior: float
    weights: np.ndarray  # log(block / allow) of each bucket


def bucket(token: str) -> int:
    return crc32(token.encode()) % BUCKETS


def fit(urls: DataFrame) -> Bayes:
    """Counts over all urls; the driver gets one row for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((2, BUCKETS), np.int64), [0, 0]
        for batch in batches:
            for found, n in zip(_tokens_of(batch), batch.column("n").to_pylist()):
                blocked = int(any(token.lstrip("/") in SEEDS for token in found))
                rows[blocked] += n
                for token in found:
                    sums[blocked, bucket(token)] += n
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1, *some.tolist()], pa.int64()),
                pa.array([rows[0], *sums[0][some].tolist()], pa.int64()),
                pa.array([rows[1], *sums[1][some].tolist()], pa.int64()),
            ],
            ["bucket", "allow", "block"],
        )

    counted = urls.mapInArrow(count, "bucket long, allow long, block long").groupBy("bucket")
    sums, rows = np.zeros((2, BUCKETS)), (0, 0)
    for row in counted.agg(F.sum("allow"), F.sum("block")).collect():
        if row[0] < 0:
            rows = row[1], row[2]
        else:
            sums[:, row[0]] = row[1], row[2]
    # One more of each token that occurs; a bucket without any says nothing.
    used = sums.any(axis=0)
    sums += used
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = np.log(sums / sums.sum(axis=1, keepdims=True))
        weights = np.where(used, logs[1] - logs[0], 0.0)
    return Bayes(log(rows[1] + 1) - log(rows[0] + 1), weights)


# ---- operator -------------------------------------------------------------------


def judged(
    pages: DataFrame, rules: list[Rule], url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``pages`` with host, path, ``rule`` (its text or NULL), ``verdict`` and ``score``.

    ``score`` is the log odds of block by the models, whether or not a rule decides.
    """
    urls = stored(parsed(pages, url_column, html_column), "urls-parsed")
    bayes = fit(urls)
    url, rows = place_of(pages, url_column), by_place(pages)
    rows = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    made = ["host", "path", "rule", "verdict", "score"]
    kept = [(f"c{i}", name) for i, name in enumerate(pages.columns) if name not in made]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = [bayes.prior + sum(bayes.weights[bucket(x)] for x in found) for found in _tokens_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("path"), pa.array(odds, pa.float64())],
                ["host", "path", "score"],
            )

    rows = rows.select(*[place for place, _ in kept], "host", "path")
    odds = urls.mapInArrow(score, "host string, path string, score double")
    scored = rows.join(odds.hint("merge"), ["host", "path"])
    host, path = F.col("host"), F.col("path")
    by_model = F.when((F.col("score") > 0) & (host != ""), "block").otherwise("allow")
    return scored.select(
        *[F.col(place).alias(name) for place, name in kept],
        "host",
        "path",
        best_rule(rules, host, path, "text").alias("rule"),
        F.coalesce(best_rule(rules, host, path, "verdict"), by_model).alias("verdict"),
        "score",
    )
