"""Conversations put in order by the cheapest edits: iterative-deepening A*.

A conversation's rows are taken by turn (nulls first), then by role and text. Each has at most one fault: blank,
duplicate (role and text seen earlier), or truncated (the last sign that is no white space does not end a
sentence). Edits turn the rows into roles ``(s?(ua)+)?`` by their initials: Delete costs 2 and is required of blank
and duplicate rows, Insert of an empty user or assistant row 5, Keep nothing, Rerole to user or assistant 1; a
truncated row that stays costs 5 more. The audit lists the edits by their initials.

The search goes depth first, trying edits in ASCII order, under a bound on the cost; a state is the number of
rows done and the place in the pattern. What the rows left cost at least is known for every state: at first
the faults to come, then what failed searches have shown (the transposition table). A state that cannot be finished
within the bound is not entered. If all fails, the bound rises to the least cost that exceeded it. So the first path
that accepts is of the cheapest ones the least in ASCII order.

Conversations of up to ``LONG`` rows are searched whole, each in one task that holds no other. Longer ones are cut into
blocks that tasks search on their own: first the cost of every block from each place of the pattern to each
other, then, with the costs of all that follows as goals, the best path from each place; a short walk over the blocks
picks the paths that fit together. Exact copies are counted beforehand, so a repeated row takes no more
room than one. The digest of a long conversation is taken from its blocks in order, one at a time.

Null roles and texts count as one space, null conversation ids as one conversation. Rows that ``alive`` excludes are not
there, but their conversation is: without rows it has no faults, costs nothing, and becomes the empty text. Empty
tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselake.llm.common import quoted, stored

LONG, BLOCK = 2_000, 500
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")
NEVER = 1 << 60
#: Places in the pattern: start, after s, after u, after ua. Where user or assistant leads, and system.
TURN = (2, 2, 3, 2)
SYSTEM = 1
ROLES = {2: "user", 3: "assistant"}
ACCEPT = (0, NEVER, NEVER, 0)
#: What it costs to end from each place by inserting.
ENDING = (0, 10, 5, 0)
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired string, repaired_sha256 string"
)

Row = tuple[str, bool, bool]  # initial of the role, has to be deleted, truncated


def fault_of(text: str) -> str | None:
    """Fault of a text by itself."""
    text = text.rstrip(WHITE)
    if not text:
        return "blank"
    return None if text[-1] in ENDS else "truncated"


def moves(rows: list[Row], state: int, tail: bool) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) in ASCII order."""
    i, place = state >> 2, state & 3
    insert = ("I", INSERT, (state & ~3) + TURN[place])
    if i == len(rows):
        return [insert] if tail else []
    initial, doomed, cut = rows[i]
    below = (i + 1) << 2
    out = [("D", DELETE, below + place), insert]
    if not doomed:
        stays = CUT if cut else 0
        if initial == "s" and place == 0:
            out.append(("K", stays, below + SYSTEM))
        elif initial == ("a" if place == 2 else "u"):
            out.append(("K", stays, below + TURN[place]))
        out.append(("R", stays + REROLE, below + TURN[place]))
    return out


def cheapest(
    rows: list[Row], start: int = 0, goal: tuple[int, ...] = ACCEPT, tail: bool = True
) -> tuple[int, str, int] | None:
    """(cost, audit, place at the end) of the best path; None if there is none.

    ``goal`` is what follows costs from each place; with ``tail``, rows may be inserted at the end.
    """
    n = len(rows)
    need = [0] * (4 * n + 4)
    for place in range(4):
        need[4 * n + place] = min(goal[place], INSERT if tail else NEVER)
    least = min(need[4 * n :])
    for i in range(n - 1, -1, -1):
        least += DELETE if rows[i][1] or rows[i][2] else 0
        need[4 * i : 4 * i + 4] = [least] * 4
    # whatever can be reached at all is reached by deleting all and inserting two rows, or by keeping a system row
    most = DELETE * n + 2 * INSERT + CUT + max((g for g in goal if g < NEVER), default=0)
    table: list[list | None] = [None] * (4 * n + 4)
    while (bound := need[start]) <= most:
        path: list[str] = []
        stack = [[start, bound, 0]]
        while stack:
            top = stack[-1]
            state, left, k = top
            if state >= 4 * n and goal[state & 3] <= left:
                return bound, "".join(path), state & 3
            steps = table[state]
            if steps is None:
                steps = table[state] = moves(rows, state, tail)
            while k < len(steps):
                edit, cost, after = steps[k]
                k += 1
                if cost + need[after] <= left:
                    top[2] = k
                    path.append(edit)
                    stack.append([after, left - cost, 0])
                    break
            else:
                # failed: what it costs at least is known better now
                lowest = min((cost + need[after] for _, cost, after in steps), default=NEVER)
                if state >= 4 * n:
                    lowest = min(lowest, goal[state & 3])
                need[state] = max(need[state], lowest)
                stack.pop()
                if path:
                    path.pop()
    return None


def applied(audit: str, roles: list[str], texts: list[str], start: int = 0) -> list[str]:
    """The repaired rows as ``role:text``."""
    place, i, out = start, 0, []
    for edit in audit:
        role, text = (None, "") if edit == "I" else (roles[i], texts[i])
        i += edit != "I"
        if edit == "D":
            continue
        place = SYSTEM if edit == "K" and role[:1] == "s" else TURN[place]
        out.append(f"{role if edit == 'K' else ROLES[place]}:{text}")
    return out


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repaired(turns: list[int | None], roles: list[str], texts: list[str]) -> tuple:
    """Values of ``SUMMARY`` for one conversation in order."""
    seen, faults = set(), []
    for pair in zip(roles, texts, strict=True):
        fault = fault_of(pair[1])
        faults.append("duplicate" if fault != "blank" and pair in seen else fault)
        seen.add(pair)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    cost, audit, _ = cheapest(
        [(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)]
    )
    text = "\n".join(applied(audit, roles, texts))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, text, digest(text)


def whole(rows: DataFrame, kind: str) -> DataFrame:
    """Summaries of conversations (conv, turn, role, text, alive) that fit a task."""

    def work(batches):
        last, held, out = None, None, []

        def flush():
            alive = [h[:3] for h in held if h[3]]
            turns, roles, texts = ([h[k] for h in alive] for k in range(3))
            return last, *repaired(turns, roles, texts)

        for batch in batches:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or conv != last:
                    if held is not None:
                        out.append(flush())
                    last, held = conv, []
                held.append(row)
            if out:
                yield as_batch(out, schema)
                out = []
        if held is not None:
            yield as_batch([flush()], schema)

    schema = rows.sparkSession.createDataFrame([], f"conv {kind}, {SUMMARY}").schema
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return ordered.select("conv", "turn", "role", "text", "alive").mapInArrow(work, schema)


def as_batch(rows: list[tuple], schema) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


# ---- conversations longer than a task should hold ------------------------------------


def in_blocks(rows: DataFrame) -> DataFrame:
    """(conv, block, at, role, text, n, fault) of rows (conv, turn, role, text): copies counted, in order, cut."""
    same = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = same.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t")).agg(
        F.min(order).alias("first")
    )
    match = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    seen = F.col("first.turn").eqNullSafe(F.col("turn"))
    marked = same.join(first, match).select("conv", "turn", "role", "text", "n", (~seen).alias("later"))
    keys = ["conv", "turn", "role", "text"]

    def cut(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            place = pa.array(range(at, at + batch.num_rows), pa.int64())
            block = pa.array([k // BLOCK for k in range(at, at + batch.num_rows)], pa.int64())
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, block, place], names=[*batch.schema.names, "block", "at"])

    kind = rows.schema["conv"].dataType.simpleString()
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("turn")
    schema = f"conv {kind}, role string, text string, n bigint, later boolean, block bigint, at bigint"
    return ordered.mapInArrow(cut, schema)


def judged(block) -> tuple[list[Row], list[str]]:
    """Rows of a block for the search, and the fault of their first copies."""
    faults = []
    for text, later in zip(block["text"], block["later"], strict=True):
        fault = fault_of(text)
        faults.append("duplicate" if fault != "blank" and later else fault)
    initials = [r[:1] for r in block["role"]]
    pairs = zip(initials, faults, strict=True)
    return [(i, f in ("blank", "duplicate"), f == "truncated") for i, f in pairs], faults


def long_conversations(rows: DataFrame) -> DataFrame:
    """Summaries of conversations (conv, turn, role, text) of any length; ``repaired`` is null."""
    import pandas as pd

    kind = rows.schema["conv"].dataType.simpleString()
    blocks = stored(in_blocks(rows), "conversation-blocks")

    def costs(key, block):
        found, _ = judged(block.sort_values("at"))
        goals = [tuple(0 if k == end else NEVER for k in range(4)) for end in range(4)]
        system = any(initial == "s" and not doomed for initial, doomed, _ in found)
        can = [[0, 1, 2, 3] if system else [0, 2, 3], [1, 2, 3], [2, 3], [2, 3]]
        paths = [
            cheapest(found, start, goals[end], False) if end in can[start] else None
            for start in range(4)
            for end in range(4)
        ]
        return pd.DataFrame({"conv": [key[0]], "block": [key[1]], "cost": [[p[0] if p else NEVER for p in paths]]})

    def backwards(conv):
        goal, out = ENDING, []
        for row in conv.sort_values("block", ascending=False).itertuples():
            out.append((row.conv, row.block, list(goal)))
            goal = tuple(min(min(row.cost[4 * a + b] + goal[b], NEVER) for b in range(4)) for a in range(4))
        return pd.DataFrame(out, columns=["conv", "block", "goal"])

    def paths(key, block):
        block = block.sort_values("at")
        found, faults = judged(block)
        copies, out = block["n"].tolist(), []
        roles, texts = block["role"].tolist(), block["text"].tolist()
        counts = {f: sum(n for n, x in zip(copies, faults, strict=True) if x == f) for f in ("blank", "duplicate")}
        # copies of a row that is no duplicate itself are
        counts["duplicate"] += sum(n - 1 for n, x in zip(copies, faults, strict=True) if x in (None, "truncated"))
        runs = [c for r, n in zip(roles, copies, strict=True) for c in ([r[:1]] * min(n, 2))]
        illegal = sum(a + b not in LEGAL for a, b in zip(runs, runs[1:], strict=False))
        illegal += sum(n - 2 for r, n in zip(roles, copies, strict=True) if n > 2 and r[:1] * 2 not in LEGAL)
        for start in range(4):
            best = cheapest(found, start, tuple(block["goal"].iloc[0]), False)
            if best is None or best[0] >= NEVER:
                continue
            cost, audit, end = best
            lines = applied(audit, roles, texts, start)
            more = iter(copies)
            audit = "".join(e if e == "I" else e + "D" * (next(more) - 1) for e in audit)
            cost = cost - int(block["goal"].iloc[0][end]) + DELETE * (sum(copies) - len(copies))
            row = (key[0], key[1], start, end, counts["blank"], counts["duplicate"], faults.count("truncated"))
            out.append((*row, illegal, cost, audit, len(lines), "\n".join(lines), runs[0], runs[-1]))
        return pd.DataFrame(out, columns=[f.name for f in path_schema.fields])

    def walk(conv):
        place, last, out = 0, None, []
        conv = conv.sort_values(["block", "start"])
        end_of = {(r.block, r.start): (r.end, r.first, r.last) for r in conv.itertuples()}
        for block in conv["block"].unique().tolist():
            start = place
            place, first, newest = end_of[block, start]
            out.append([conv["conv"].iloc[0], block, start, int(last is not None and last + first not in LEGAL), ""])
            last = newest
        out[-1][-1] = "I" * (ENDING[place] // INSERT)
        return pd.DataFrame(out, columns=["conv", "block", "start", "border", "ending"])

    def digests(batches):
        last, state = None, None

        def result():
            counts, audits, sha, _ = state
            return (last, *counts, "".join(audits), sha.hexdigest())

        for batch in batches:
            out = []
            for conv, _, blank, duplicate, truncated, illegal, cost, audit, lines, text, ending in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if state is None or conv != last:
                    if state is not None:
                        out.append(result())
                    last, state = conv, [[0] * 5, [], hashlib.sha256(), False]
                parts = ([text] if lines else []) + (["user:", "assistant:"][-len(ending) :] if ending else [])
                new = (blank, duplicate, truncated, illegal, cost + INSERT * len(ending))
                state[0] = [a + b for a, b in zip(state[0], new, strict=True)]
                state[1].append(audit + ending)
                for part in parts:
                    state[2].update((b"\n" if state[3] else b"") + part.encode())
                    state[3] = True
            if out:
                yield as_batch(out, digest_schema)
        if state is not None:
            yield as_batch([result()], digest_schema)

    spark = rows.sparkSession
    path_schema = spark.createDataFrame(
        [],
        f"conv {kind}, block bigint, start int, end int, blank bigint, duplicate bigint, truncated bigint, "
        "illegal bigint, cost bigint, audit string, lines bigint, text string, first string, last string",
    ).schema
    digest_schema = spark.createDataFrame(
        [],
        f"conv {kind}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
        "audit string, repaired_sha256 string",
    ).schema
    parts = blocks.groupBy("conv", "block")
    known = stored(parts.applyInPandas(costs, f"conv {kind}, block bigint, cost array<bigint>"), "block-costs")
    goals = known.groupBy("conv").applyInPandas(backwards, f"conv {kind}, block bigint, goal array<bigint>")
    goals = goals.select(F.col("conv").alias("c"), F.col("block").alias("b"), "goal")
    here = F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    aimed = blocks.join(goals, here).drop("c", "b")
    found = stored(aimed.groupBy("conv", "block").applyInPandas(paths, path_schema), "block-paths")
    ends = found.select("conv", "block", "start", "end", "first", "last")
    walked = ends.groupBy("conv").applyInPandas(
        walk, f"conv {kind}, block bigint, start int, border bigint, ending string"
    )
    walked = walked.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.col("start").alias("s"), "border", "ending")
    chosen = found.join(walked, here & (F.col("start") == F.col("s")))
    chosen = chosen.select(
        "conv", "block", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("border")).alias("illegal"),
        "cost", "audit", "lines", "text", "ending",
    )
    ordered = chosen.repartition("conv").sortWithinPartitions("conv", "block")
    made = ordered.mapInArrow(digests, digest_schema)
    turns = rows.groupBy(F.col("conv").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    out = made.join(turns, F.col("conv").eqNullSafe(F.col("c")))
    return out.withColumn("repaired", F.lit(None).cast("string")).select(
        "conv", *[part.split()[0] for part in SUMMARY.split(", ")]
    )


# ---- all ------------------------------------------------------------------------------


def repair(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    alive: Column | None = None,
    long: int = LONG,
) -> DataFrame:
    """One row per conversation: ``conv_id``, faults, cost, audit, the repaired text and its digest.

    ``repaired`` holds ``role:text`` lines; it is null for conversations of more than ``long`` rows. Rows where
    ``alive`` is false are not there.
    """
    space = F.lit(" ")
    kept = rows.select(
        quoted(conv).alias("conv"),
        quoted(turn).cast("bigint").alias("turn"),
        F.coalesce(quoted(role).cast("string"), space).alias("role"),
        F.coalesce(quoted(text).cast("string"), space).alias("text"),
        (F.lit(True) if alive is None else F.coalesce(alive, F.lit(False))).alias("alive"),
    )
    kind = rows.schema[conv].dataType.simpleString()
    sizes = kept.groupBy("conv").agg(F.count("*").alias("n")).where(F.col("n") > long)
    many = stored(sizes.select(F.col("conv").alias("c")), "long-conversations")
    if many.isEmpty():
        made = whole(kept, kind)
    else:
        same = F.col("conv").eqNullSafe(F.col("c"))
        made = whole(kept.join(many, same, "left_anti"), kind)
        lengthy = kept.join(many, same, "left_semi")
        there = lengthy.where("alive").drop("alive")
        # a long conversation of which nothing is left is a short one
        gone = lengthy.groupBy("conv").agg(F.bool_or("alive").alias("any")).where("not any").select("conv")
        nothing = gone.select(
            "conv", F.lit(None).cast("bigint").alias("turn"), space.alias("role"), space.alias("text"),
            F.lit(False).alias("alive"),
        )
        made = made.unionByName(whole(nothing, kind)).unionByName(long_conversations(there))
    return made.withColumnRenamed("conv", "conv_id")
