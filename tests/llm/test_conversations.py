"""Conversation repair against a uniform-cost search over the same edits."""

from __future__ import annotations

import heapq
import random
import re
from hashlib import sha256
from zlib import crc32

import pytest
from odd_tables import sf, table

from factlab.llm import conversation_repair, queries

SCHEMA = "conv_id long, turn long, role string, text string, digest int, conv string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def slow_damage(rows):
    for row in rows:
        conv, turn, role, text = (" " if x is None else x for x in row[:4])
        kind = crc32(f"{conv}:{turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield row[0], row[1], role, text


def slow_repair(rows):
    """The contract's columns of one conversation's damaged rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        words = WORD.findall(text)
        if not words:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [turn for turn, _, _ in rows if turn is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            break
        name = {"u": "user", "a": "assistant"}[NEXT[last]]
        heapq.heappush(heap, (cost + 3, audit + "I", i, NEXT[last], (*out, (name, ""))))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
        if faults[i] in ("blank", "duplicate"):
            continue
        extra = 3 if faults[i] else 0
        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, NEXT[last], (*out, (name, text))))
        initial = role[:1]
        if initial == NEXT[last] or initial == "s" and not last:
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, initial, (*out, (role, text))))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
        sum(pair not in ("su", "ua", "au") for pair in pairs),
        cost,
        audit,
        sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest(),
    )


def expected(rows):
    by_conv = {row[0]: [] for row in rows}
    for conv, turn, role, text in slow_damage(rows):
        by_conv[conv].append((turn, role, text))
    order = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2][:64], sha256(x[2].encode()).digest())
    return {conv: slow_repair(sorted(x, key=order)) for conv, x in by_conv.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(result, id_column="conv_id"):
    rows = result.select(id_column, *COLUMNS).collect()
    assert len({row[0] for row in rows}) == len(rows)
    return {row[0]: tuple(row[1:]) for row in rows}


def test_op11_on_whole_table(spark):
    rows = [tuple(row) for row in sf(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["cost"] == "bigint"
    assert found(got) == expected(rows)


def _random_rows(seed, conversations, most):
    pick = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \t", "So it is!", "a b  c\n", None, "x" * 70 + "a", "x" * 70 + "b", "Ende "]
    roles = ["user", "assistant", "system", "tool", "", None, "unknown"]
    rows = []
    for conv in range(conversations):
        for turn in range(pick.randint(1, most)):
            turn = pick.choice([turn, turn, turn, turn * 3, None])
            rows.append((conv, turn, pick.choice(roles[: pick.choice([2, 3, 7])]), pick.choice(texts)))
    return rows


@pytest.mark.parametrize("stretch", [1, 3, conversation_repair.STRETCH])
def test_random_conversations(spark, monkeypatch, stretch):
    monkeypatch.setattr(conversation_repair, "STRETCH", stretch)
    rows = _random_rows(stretch, 60, 9)
    # One conversation has a third of all rows, another as many equal rows, and one no id.
    rows += [(1000, i, *x[2:]) for i, x in enumerate(_random_rows(7, 30, 9))]
    rows += [(1001, 1, "user", "Same?")] * 100 + [(1001, 2, "assistant", "Yes.")]
    rows += [(None, *x[1:]) for x in _random_rows(8, 3, 9)]
    got = conversation_repair.repair(table(spark, [(*x, 1, "n") for x in rows], SCHEMA).repartition(5))
    assert found(got) == expected(rows)


def test_search_is_optimal():
    for seed in range(300):
        pick = random.Random(seed)
        rows = [(pick.choice("suat"), pick.random() < 0.3, pick.choice([0, 0, 0, 2])) for _ in range(pick.randint(0, 7))]
        plain = []
        for n, (initial, cut, doomed) in enumerate(rows):
            plain += [(n, initial, "")] * doomed if doomed else [(n, initial, f"{n}" + ("" if cut else "."))]
        want = slow_repair(plain)
        assert conversation_repair.search(rows, conversation_repair.START, conversation_repair.ENDS) == want[5:7]


def test_empty_and_all_dropped(spark):
    assert conversation_repair.repair(table(spark, [], SCHEMA)).collect() == []
    dropped = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    got = conversation_repair.repair(table(spark, [(dropped, 0, "user", "Hi.", 1, "n")], SCHEMA))
    assert found(got) == {dropped: (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}
