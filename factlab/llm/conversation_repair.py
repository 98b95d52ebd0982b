"""Repair of turn structure by depth-first branch and bound.

A conversation's rows are kept, rerolled, deleted, and rows inserted between them, so that
the initials of the roles read ``(s?(ua)+)?`` at the least cost; of equal costs the audit,
the edits' initials in order, that is least in ASCII. Deleting is required for blank rows
and repeats of an earlier role and text.

The search has a node for each row and state of the pattern (nothing yet, after s, u, a)
and an explicit stack. The lower bound of a node is the least cost of any suffix, audits
left aside; a prefix goes if its cost and bound exceed the incumbent's (cost, audit), or if
its node was reached by a better (cost, audit) before. Children are pushed so that the one
of least bound, then letter, is popped first; an empty stack proves the incumbent.

Rows are range partitioned by conversation and turn and read in stretches of ``STRETCH``
rows, so a conversation of any length is many tasks. Each stretch is solved between all
states it may start and end in, and stretches are joined in order, one short row for each.
Texts take no part in that: rows carry a digest, and equal rows are counted before they
meet. The digest of a repaired conversation is taken in one pass over its sorted texts,
which a SHA-256 cannot be spared, holding one text at a time.

Order is by turn (NULL first), role, the first 64 characters of text, the text's SHA-256.
A NULL role or text is one space, which no repair keeps; nor does one keep a role whose
initial is not s, u or a, an empty one included. NULL conversation ids are one
conversation. Repeated rows are repeats like any other. A conversation without rows has
zeros and empty strings; an empty table gives an empty result. Columns are taken by the
names given, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import stored

STRETCH = 256
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the pattern: nothing yet, after s, after u, after a; the end is the first or last.
START, S, U, A = range(4)
ENDS = (START, A)
_NEXT = {START: U, S: U, U: A, A: U}
_ROLES = {U: "user", A: "assistant"}
_NONE = 1 << 60
_LEGAL = ("su", "ua", "au")
_BLANK = r"\A[\x20\x09-\x0D]*\z"
_CUT = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row that is kept, or None if the pattern forbids it."""
    if initial == "s":
        return S if state == START else None
    if initial == "u":
        return U if state in (START, S, A) else None
    return A if initial == "a" and state == U else None


#: A row to decide on: its initial, whether it is truncated, and how many rows must go instead.
Row = tuple[str, bool, int]


def _steps(row: Row, state: int) -> list[tuple[str, int, int]]:
    """Letters, cost and next state of the edits that take a row in."""
    initial, cut, doomed = row
    if doomed:
        return [("D" * doomed, DELETE * doomed, state)]
    extra = TRUNCATED if cut else 0
    steps = [("D", DELETE, state), ("R", REROLE + extra, _NEXT[state])]
    after = kept_state(state, initial)
    if after is not None:
        steps.append(("K", extra, after))
    return steps


def bounds(rows: list[Row], ends: tuple[int, ...]) -> list[list[int]]:
    """For each row and state the least cost of any suffix that ends in one of ``ends``."""
    least = [[0 if state in ends else _NONE for state in range(4)]]
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            after = least[-1]
            here = [min(cost + after[to] for _, cost, to in _steps(rows[i], q)) for q in range(4)]
            least.append(here)
        here = least[-1]
        for _ in range(3):
            for state in range(4):
                here[state] = min(here[state], INSERT + here[_NEXT[state]])
    return least[::-1]


def search(rows: list[Row], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """The least (cost, audit) from state ``start`` to one of ``ends``."""
    rest = bounds(rows, ends)
    if rest[0][start] >= _NONE:
        return None
    best: tuple[int, str] | None = None
    met: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + rest[i][state]
        if least >= _NONE or best and (least, audit) > (best[0], best[1][: len(audit)]):
            continue
        if (i, state) in met and met[i, state] <= (cost, audit):
            continue
        met[i, state] = (cost, audit)
        if i == len(rows) and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        children = [(i, _NEXT[state], cost + INSERT, audit + "I")]
        if i < len(rows):
            children += [(i + 1, to, cost + more, audit + letter) for letter, more, to in _steps(rows[i], state)]
        children.sort(key=lambda x: (x[2] + rest[x[0]][x[1]], x[3]), reverse=True)
        stack += children
    return best


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """Roles and texts that an audit makes of the rows (role, text)."""
    state = START
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = kept_state(state, role[:1])
        else:
            state = _NEXT[state]
            role = _ROLES[state]
        yield role, text


# ---- rows ------------------------------------------------------------------------


def damaged(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Columns conv, turn, role, text and times, how often the row is there after damage.

    The crc32 of ``id:turn`` modulo 20 drops the row (0), empties its text (1), takes its
    full stops, exclamation and question marks (2), doubles it (3) or makes it a user's (4).
    """

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col(id_column).cast("long").alias("conv"),
        F.col(turn_column).cast("long").alias("turn"),
        text_of(role_column).alias("role"),
        text_of(text_column).alias("text"),
    )
    kind = F.crc32(F.concat_ws(":", text_of("conv"), text_of("turn")).cast("binary")) % 20
    rows = rows.withColumn("kind", kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("times"),
    )


_ORDER = ["conv", "turn", "role", "head", "digest"]


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("head", F.substring("text", 1, 64)).withColumn("digest", F.unhex(F.sha2("text", 256)))


def judged_rows(rows: DataFrame) -> DataFrame:
    """The different rows of ``damaged``, how often they are there, and their faults.

    The first of ``times`` equal rows is a repeat unless ``first``, the others always are.
    """
    light = _ordered(rows).withColumn("blank", F.col("text").rlike(_BLANK)).withColumn("cut", F.col("text").rlike(_CUT))
    light = light.groupBy(*_ORDER, "blank", "cut").agg(F.sum("times").alias("times"))
    light = stored(light, "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    firsts = light.where("times > 0").groupBy(
        F.col("conv").alias("of"), F.col("role").alias("by"), F.col("digest").alias("same")
    ).agg(F.min(place).alias("earliest"))
    firsts = stored(firsts, "repair-firsts")
    same = light["conv"].eqNullSafe(firsts["of"]) & (light["role"] == firsts["by"]) & (light["digest"] == firsts["same"])
    joined = light.join(firsts.hint("merge"), same, "left")
    first = F.col("earliest.at").eqNullSafe(F.col("turn"))
    return joined.withColumn("first", first).select(*_ORDER, "blank", "cut", "times", "first")


# ---- stretches ---------------------------------------------------------------------

_COUNTS = ["rows", "blank", "duplicate", "truncated", "illegal", "distinct"]
_STRETCHES = (
    "conv long, part long, at long, rows long, blank long, duplicate long, truncated long, illegal long, "
    "distinct long, low long, high long, initial string, final string, ways string"
)


class Stretch:
    """Consecutive rows of one conversation."""

    def __init__(self) -> None:
        self.rows: list[Row] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self._turn = None
        self.initial = self.final = None

    def add(self, turn: int | None, role: str, blank: bool, cut: bool, times: int, first: bool) -> None:
        """Takes in ``times`` equal rows."""
        if not times:
            return
        counts, initial = self.counts, role[:1]
        counts["rows"] += times
        if turn is not None and turn != self._turn:
            counts["distinct"] += 1
            self._turn = turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.final is not None:
            counts["illegal"] += self.final + initial not in _LEGAL
        counts["illegal"] += times - 1  # no initial may follow itself
        self.initial = initial if self.initial is None else self.initial
        self.final = initial
        doomed = times if blank else times - first
        counts["blank" if blank else "duplicate"] += doomed
        if doomed < times:
            counts["truncated"] += cut
            self.rows.append((initial, cut, 0))
        if doomed:
            if self.rows and self.rows[-1][2]:
                doomed += self.rows.pop()[2]
            self.rows.append(("", False, doomed))

    def ways(self, whole_start: bool, whole_end: bool) -> str:
        """``start end cost audit`` of each pair of states that the stretch can lie between."""
        found = []
        for start in (START,) if whole_start else range(4):
            for ends in (ENDS,) if whole_end else ((0,), (1,), (2,), (3,)):
                way = search(self.rows, start, ends)
                if way:
                    found.append(f"{start} {ends[-1]} {way[0]} {way[1]}")
        return "\n".join(found)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, out = TaskContext.get().partitionId(), []
    rows = (row for batch in batches for row in batch.to_pylist())
    at, known_start, waiting = 0, part == 0, None

    def line(conv, stretch: Stretch, whole_start: bool, whole_end: bool) -> dict:
        return {
            "conv": conv, "part": part, "at": at, **stretch.counts, "low": stretch.low, "high": stretch.high,
            "initial": stretch.initial, "final": stretch.final, "ways": stretch.ways(whole_start, whole_end),
        }

    for conv, group in groupby(rows, key=lambda row: row["conv"]):
        if waiting:  # another conversation follows: what waits is the end of its own
            out.append(line(*waiting, True))
            at, known_start = at + 1, True
        stretch = Stretch()
        for row in group:
            if len(stretch.rows) >= STRETCH:
                out.append(line(conv, stretch, known_start, False))
                at, known_start, stretch = at + 1, False, Stretch()
            stretch.add(row["turn"], row["role"], row["blank"], row["cut"], row["times"], row["first"])
        waiting = (conv, stretch, known_start)
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)
            out = []
    if waiting:
        out.append(line(*waiting, False))
    if out:
        yield pa.RecordBatch.from_pylist(out, _SCHEMA)


_SCHEMA = pa.schema(
    [(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _STRETCHES.split(", ")]
)
_RESULT = pa.schema(
    [(x, pa.int64()) for x in ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)


def _joined(conv: int | None, stretches: Iterator[dict]) -> dict:
    """The result of one conversation from its stretches in order."""
    sums = dict.fromkeys(_COUNTS, 0)
    low = high = final = None
    paths = {START: (0, "")}
    for row in stretches:
        for name in _COUNTS:
            sums[name] += row[name]
        if row["low"] is not None:
            sums["distinct"] -= row["low"] == high
            low = row["low"] if low is None else low
            high = row["high"]
        if row["initial"] is not None:
            sums["illegal"] += final is not None and final + row["initial"] not in _LEGAL
            final = row["final"]
        after: dict[int, tuple[int, str]] = {}
        for way in row["ways"].split("\n"):
            start, end, cost, audit = way.split(" ")
            if int(start) in paths:
                before = paths[int(start)]
                path = (before[0] + int(cost), before[1] + audit)
                after[int(end)] = min(after.get(int(end), path), path)
        paths = after
    cost, audit = min(paths[end] for end in ENDS if end in paths)
    return {
        "conv": conv, "gaps": 0 if low is None else high - low + 1 - sums["distinct"],
        **{name: sums[name] for name in ("blank", "duplicate", "truncated", "illegal")},
        "cost": cost, "audit": audit,
    }


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in batch.to_pylist())
    out = []
    for conv, group in groupby(rows, key=lambda row: row["conv"]):
        out.append(_joined(conv, group))
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, _RESULT)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, _RESULT)


# ---- repaired texts -------------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired rows; its audit comes before its texts."""
    rows = (row for part in batches for a in range(0, part.num_rows, 256) for row in part.slice(a, 256).to_pylist())
    out = {"of": [], "repaired_sha256": []}
    for conv, group in groupby(rows, key=lambda row: row["conv"]):
        audit = next(group)["text"]
        each = ((row["role"], row["text"]) for row in group for _ in range(row["times"]))
        digest, mark = sha256(), b""
        for role, text in repaired(each, audit):
            digest.update(mark + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            mark = b"\n"
        out["of"].append(conv)
        out["repaired_sha256"].append(digest.hexdigest())
    yield pa.RecordBatch.from_pydict(out, pa.schema([("of", pa.int64()), ("repaired_sha256", pa.string())]))


def repair(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row for each conversation of ``damaged`` rows: counts of faults, cost, audit, digest."""
    rows = damaged(conversations, id_column, turn_column, role_column, text_column)
    judged = judged_rows(rows).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    stretches = stored(judged.mapInArrow(_stretches, _STRETCHES), "repair-stretches")
    in_order = stretches.repartition("conv").sortWithinPartitions("conv", "part", "at")
    kinds = ", ".join(f"{x} {'string' if x == 'audit' else 'long'}" for x in _RESULT.names)
    results = stored(in_order.mapInArrow(_join, kinds), "repair-results")
    heads = results.select(
        "conv", F.lit(0).alias("later"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.col("audit").alias("text"), F.lit(1).cast("long").alias("times"),
    )
    texts = rows.where("times > 0").withColumn("later", F.lit(1)).select(*heads.columns)
    texts = _ordered(heads.unionByName(texts)).repartition("conv")
    texts = texts.sortWithinPartitions("conv", "later", *_ORDER[1:]).select("conv", "role", "text", "times")
    digests = stored(texts.mapInArrow(_digests, "of long, repaired_sha256 string"), "repair-digests")
    joined = results.join(digests, results["conv"].eqNullSafe(digests["of"]))
    return joined.drop("of").withColumnRenamed("conv", id_column)
