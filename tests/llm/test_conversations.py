"""Conversation repair against a plain search over all states."""

from __future__ import annotations

import hashlib
import heapq
import random

import pytest
from pyspark.sql import functions as F

from doselake.llm import conversations as cv
from doselake.llm import queries

ROWS = "conv_id string, turn long, role string, text string, n long, key int, c int"


def plain(rows):
    """(cost, audit) of the cheapest path, least in ASCII order, by expanding (cost, audit) in order."""
    start = (0, "", 0, 0)
    heap, done = [start], set()
    while heap:
        cost, audit, i, place = heapq.heappop(heap)
        if (i, place) in done:
            continue
        done.add((i, place))
        if i == len(rows) and place in (0, 3):
            return cost, audit
        after = {0: 2, 1: 2, 2: 3, 3: 2}[place]
        heapq.heappush(heap, (cost + 5, audit + "I", i, after))
        if i == len(rows):
            continue
        initial, doomed, cut = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, place))
        if not doomed:
            more = 5 if cut else 0
            heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, after))
            if (initial == "s" and place == 0) or initial == ("a" if place == 2 else "u"):
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, 1 if initial == "s" else after))
    raise AssertionError


def some_rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice("suuaaa?"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("seed", range(300))
def test_cheapest_first_in_order(seed):
    rows = some_rows(seed, seed % 23)
    cost, audit, place = cv.cheapest(rows)
    assert (cost, audit) == plain(rows)
    assert place in (0, 3)


def test_a_long_one_ends():
    rows = some_rows(1, 400)
    assert cv.cheapest(rows)[:2] == plain(rows)


def test_unreachable_goals():
    assert cv.cheapest([("u", False, False)], 2, (0, cv.NEVER, cv.NEVER, cv.NEVER), False) is None
    assert cv.cheapest([], 0, (0, 0, 0, 0), False) == (0, "", 0)


AWKWARD = [
    (None, 1, "user", "Who?"),
    (None, None, None, None),
    ("a", 1, "user", "Hello."),
    ("a", 2, "assistant", "Hi."),
    ("a", 2, "assistant", "Hi."),
    ("a", 5, "tool", "cut off"),
    ("b", 3, "assistant", "\t\n"),
    ("b", 4, "assistant", "x"),
    ("c", 1, "user", "gone"),
    ("d", 1, "user", "word " * 50_000 + "end."),
    ("e", None, "", ""),
    ("e", -(2**60), "system", "Be kind!"),
]


@pytest.fixture(scope="module")
def awkward_turns(spark):
    rows = [(*r, 1, 2, 3) for r in AWKWARD]
    return spark.createDataFrame(rows, ROWS)


def found(df):
    return {r["conv_id"]: r.asDict() for r in df.collect()}


def test_awkward_rows(awkward_turns):
    got = found(cv.repair(awkward_turns, alive=F.col("text").isNull() | (F.col("text") != "gone")))
    assert got.keys() == {None, "a", "b", "c", "d", "e"}
    a = got["a"]
    assert (a["gaps"], a["blank"], a["duplicate"], a["truncated"], a["illegal"]) == (2, 0, 1, 1, 2)
    assert (a["cost"], a["audit"], a["repaired"]) == (4, "KKDD", "user:Hello.\nassistant:Hi.")
    assert a["repaired_sha256"] == hashlib.sha256(a["repaired"].encode()).hexdigest()
    c = got["c"]
    assert (c["gaps"], c["cost"], c["audit"], c["repaired"]) == (0, 0, "", "")
    assert c["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[None]["blank"] == 1 and got[None]["gaps"] == 0
    assert got["e"]["gaps"] == 0 and got["e"]["illegal"] == 1


def test_blocks_agree_with_whole(spark, awkward_turns, sf_dir, monkeypatch):
    """Long conversations, cut into tiny blocks, give what a search of the whole does."""
    rng = random.Random(5)
    texts = ["Yes.", "No.", "cut", "", "Why?", "So."]
    rows = [
        (rng.choice(["x", "y", None]), rng.choice([None, *range(40)]), rng.choice(["user", "assistant", "system", "t"]), rng.choice(texts))
        for _ in range(300)
    ]
    many = spark.createDataFrame([(*r, 0, 0, 0) for r in [*rows, *rows[:100], *AWKWARD]], ROWS).where("text <> 'gone'")
    monkeypatch.setattr(cv, "BLOCK", 7)
    got, want = found(cv.repair(many, long=4)), found(cv.repair(many))
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] | {"repaired": None} == row | {"repaired": None}, key


def test_empty_table(spark):
    assert cv.repair(spark.createDataFrame([], ROWS)).collect() == []


def test_query_covers_every_conversation(spark, sf_dir):
    ids = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
    rows = queries.op11_conversation_repair(spark, sf_dir).collect()
    assert len(rows) == ids and any(r.cost for r in rows)
