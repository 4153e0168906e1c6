"""Repair of conversations against a search over all edits."""

import hashlib
import heapq
import itertools
import os
import random
import re
import zlib

import pytest

from siftspark.llm.queries import QUERIES
from siftspark.llm.repair import NOTHING, best, combine, damage, repair_conversations, row_cells, span_cells

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string"
STEPS = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows, faults):
    """(cost, audit, lines) by the shortest path over (row, state)."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        for symbol, to in STEPS[state]:
            if symbol != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*lines, f"{NAMES[symbol]}:")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                cut, (role, text) = 3 * (faults[i] == "truncated"), rows[i]
                for symbol, to in STEPS[state]:
                    if role[:1] == symbol:
                        heapq.heappush(heap, (cost + cut, audit + "K", i + 1, to, (*lines, f"{role}:{text}")))
                    if symbol != "s":
                        line = f"{NAMES[symbol]}:{text}"
                        heapq.heappush(heap, (cost + 3 + cut, audit + "R", i + 1, to, (*lines, line)))


def verdict(rows):
    """All columns but conv_id, from (turn, role, text) in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None
        faults.append(fault or ("truncated" if body[-1] not in ".!?" else None))
        seen.add((role, text))
    cost, audit, lines = cheapest([r[1:] for r in rows], faults)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    for conv_id, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        draw, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        yield from [(conv_id, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)


def expected(rows, after=None):
    after = list(after if after is not None else rows)
    return {c: verdict([r[1:] for r in after if r[0] == c]) for c in {r[0] for r in rows}}


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_one_split_gives_the_cell_of_all_splits():
    r = random.Random(1)
    for _ in range(150):
        kinds = "".join(r.choice("suaxSUAX-") for _ in range(r.randint(1, 7)))
        cells = {(i, i + 1): row_cells(kinds[i]) for i in range(len(kinds))}
        for size in range(2, len(kinds) + 1):
            for i in range(len(kinds) - size + 1):
                splits = [combine(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
                cells[i, i + size] = {key: min(s[key] for s in splits) for key in splits[0]}
                assert all(s == splits[0] for s in splits)
        assert span_cells(kinds) == cells[0, len(kinds)]
    assert best(NOTHING) == (0, "") and span_cells("") == NOTHING


def test_all_short_conversations():
    for n in range(4):
        for kinds in itertools.product("suaxSUAX-", repeat=n):
            rows = [(k.lower(), "") for k in kinds]
            faults = ["blank" if k == "-" else "truncated" if k.isupper() else None for k in kinds]
            assert best(span_cells("".join(kinds))) == cheapest(rows, faults)[:2]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_cyk_repair"](spark, SF_DIR)) == expected(rows, damaged(rows))


@pytest.mark.parametrize("tasks", [1, 7])
def test_long_conversations_are_cut_between_tasks(spark, tasks):
    r = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", ""], ["yes.", "no", "", " \n", "why?", "ok!"]
    rows = [(c, t, r.choice(roles), f"{r.choice(texts)}") for c in range(3) for t in range((400, 3, 60)[c])]
    rows += [(9, None, "user", "a."), (9, None, "assistant", "b."), (9, 4, "user", "a.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(repair_conversations(df, damaged=False, tasks=tasks)) == expected(rows)


def test_edges(spark):
    rows = [
        (1, 0, "user", "hi."), (1, 1, "assistant", "ho."), (1, 1, "assistant", "ho."), (1, 5, None, None),
        (2, None, "user", "a."), (2, None, None, "b!"), (2, None, "user", None), (2, 3, "system", "s."),
        (None, 0, "user", "x"), (None, None, "assistant", "y."), (None, 2, "", "z."),
        (3, 0, "system", "long " * 50_000 + "."), (3, -4, "usher", "é?"), (4, 7, "ASSISTANT", ".\t\x0b\x0c\r\n"),
        *((c, t, "user", "q?") for c in range(100, 130) for t in (0,)),
    ]
    df = spark.createDataFrame([(*r, "c", "d") for r in rows], f"{SCHEMA}, audit string, copy string")
    assert found(repair_conversations(df)) == expected(rows, damaged(rows))
    assert sorted(map(repr, damaged(rows))) == sorted(repr((r.conv_id, r.turn, r.role, r.text)) for r in damage(df).collect())
    assert repair_conversations(df.limit(0)).count() == 0
