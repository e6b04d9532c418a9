"""Repair of conversations against all edits tried row by row."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeferry.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {0: (0, "", [])}

    def grow(paths):
        while True:
            more = dict(paths)
            for state, (cost, audit, lines) in paths.items():
                for initial, after in NEXT[state].items():
                    if initial != "s":
                        own = (cost + 5, audit + "I", [*lines, NAMES[initial] + ":"])
                        if after not in more or own[:2] < more[after][:2]:
                            more[after] = own
            if more == paths:
                return paths
            paths = more

    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        step = {}

        def offer(state, own, step=step):
            if state not in step or own[:2] < step[state][:2]:
                step[state] = own

        for state, (cost, audit, lines) in grow(best).items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault not in ("b", "d"):
                late = 5 if fault == "t" else 0
                for initial, after in NEXT[state].items():
                    if initial == role[:1]:
                        offer(after, (cost + late, audit + "K", [*lines, f"{role}:{text}"]))
                    elif initial != "s":
                        offer(after, (cost + late + 1, audit + "R", [*lines, f"{NAMES[initial]}:{text}"]))
        best = step
    cost, audit, lines = min((p for q, p in grow(best).items() if q in (0, 3)), key=lambda p: p[:2])
    turns = sorted({r[1] for r in rows if r[1] is not None})
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest


def check(spark, rows, frame=None):
    frame = spark.createDataFrame(rows, SCHEMA) if frame is None else frame
    found = {r[0]: tuple(r)[1:] for r in repair.repair_damaged(frame).collect()}
    left = damaged(rows)
    wanted = {conv: plain([r for r in left if r[0] == conv]) for conv in {r[0] for r in rows}}
    assert found == wanted


def talk(n, seed, convs=40):
    chance = random.Random(seed)
    texts = ["", " \n", "a.", "b", "c?\t", "x .", "　", None, "d.", "e.", "f!", "g. h"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "Sys", None, "umpire"]
    return [(chance.randrange(convs), chance.randint(0, 9), chance.choice(roles), (chance.choice(texts) or "") + chance.choice(["", ".", "!"]) * chance.randint(0, 1) or None) for _ in range(n)]


def test_small_cases(spark):
    nulls = [(None, None, None, None), (None, None, "user", "a."), (None, 3, "user", "a."), (5, None, "assistant", "b."), (5, None, "assistant", "b."), (6, None, None, None)]
    check(spark, nulls + [(i, 0, "system", "s.") for i in range(100, 160)])
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    check(spark, talk(1500, seed))


def test_fragments_of_long_conversations(spark, monkeypatch):
    """Conversations over many fragments, tasks and unrolled blocks."""
    monkeypatch.setattr(repair, "FRAGMENT_ROWS", 7)
    monkeypatch.setattr(repair, "UNROLLED_ROWS", 3)
    rows = [(c, t, r, x) for c, _, r, x in talk(900, 3, convs=3) for t in [random.Random(f"{c}{r}{x}").randint(0, 300)]]
    rows += [(9, t, "user", f"{t}.") for t in range(400)] + [(10, t, "assistant", "cut") for t in range(200)] + [(11, t, "user", f"{t}") for t in range(100)]
    check(spark, rows, spark.createDataFrame(rows, SCHEMA).repartition(7))


def test_rows_that_all_repeat(spark):
    check(spark, [(1, 1, "user", "same.")] * 5000 + [(None, None, None, None)] * 3000)


def test_clashing_columns_and_other_types(spark):
    rows = talk(200, 4)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("at", "kind", "audit", "symbol", "same", "number", "mark", "copy", "fragment"):
        frame = frame.withColumn(name, F.lit("x"))
    check(spark, rows, frame.withColumn("turn", F.col("turn").cast("int")))
    named = spark.createDataFrame([(f"c{r[0]}", *r[1:]) for r in rows], SCHEMA.replace("conv_id long", "conv_id string"))
    assert repair.repair_damaged(named).schema["conv_id"].dataType == T.StringType()
    assert repair.repair_damaged(named).count() == len({r[0] for r in rows})


def test_long_text(spark):
    rows = [(1, 0, "user", "word " * 2_000_000 + "."), (1, 1, "assistant", "short."), (2, 0, "user", "y" * 5_000_000)]
    check(spark, rows)


def test_repaired_turns_are_what_was_hashed(spark):
    rows = talk(600, 5)
    found = repair.repair(spark.createDataFrame(damaged(rows), SCHEMA).repartition(5))
    turns = sorted(tuple(r) for r in repair.repaired_turns(found).select("at", "place", "conv_id", "role", "text", "edit").collect())
    sums = {r.conv_id: r for r in repair.summaries(found, spark.createDataFrame(rows, SCHEMA)).collect()}
    for conv, own in sums.items():
        mine = [t for t in turns if t[2] == conv]
        lines = "\n".join(f"{t[3]}:{t[4]}" for t in mine)
        assert hashlib.sha256(lines.encode()).hexdigest() == own.repaired_sha256
        assert "".join(t[5] for t in mine) == own.audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(t[3][:1] for t in mine))


def test_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    check(spark, [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()], frame)


def test_powers_equal_single_rows():
    own = repair.Repairer()
    for symbol in range(16):
        costs = own.end
        for count in range(1, 70):
            costs = own.before(symbol, 1, costs)
            assert costs == own.before(symbol, count, own.end)
