"""Conversation repair against an exhaustive search, whole and in blocks."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from signalbox.llm import turn_repair as R
from signalbox.llm.common import landed
from signalbox.llm.queries import damaged

PATTERN = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, digest string, copies int, fault string"


def faults_of(rows):
    """Faults of turns in order, by the definition."""
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else
                   "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, edits, lines) by uniform-cost search over whole edit strings (cheapest, then least)."""
    faults = faults_of(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, at, roles, lines = heapq.heappop(heap)
        # What follows depends on the place and on the initials so far, of which the pattern needs these.
        state = (at, roles == "", roles == "s", roles[-1:])
        if state in done and not (at == len(rows) and PATTERN.fullmatch(roles)):
            continue
        done.add(state)
        if at == len(rows) and PATTERN.fullmatch(roles):
            return cost, edits, lines

        def push(c, e, at2, initial, line):
            grown = roles + initial
            if initial and not any(PATTERN.fullmatch(grown + end) for end in ("", "a", "ua")):
                return
            heapq.heappush(heap, (cost + c, edits + e, at2, grown, lines + ((line,) if line is not None else ())))

        for role in ("user", "assistant"):
            push(2, "I", at, role[0], f"{role}:")
        if at < len(rows):
            role, text = rows[at]
            push(3, "D", at + 1, "", None)
            if faults[at] not in ("blank", "duplicate"):
                late = int(faults[at] == "truncated")
                if role[:1]:
                    push(late, "K", at + 1, role[:1], f"{role}:{text}")
                for other in ("user", "assistant"):
                    push(2 + late, "R", at + 1, other[0], f"{other}:{text}")
    raise AssertionError


def expected(rows):
    """Result of one conversation, from (turn, role, text) rows (no nulls in role and text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    faults = faults_of([r[1:] for r in rows])
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, lines = brute([r[1:] for r in rows])
    initials = [r[1][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def some_conversations(seed, n, most):
    rng = random.Random(seed)
    texts = ["", " ", "\t\n\x0b", "Yes.", "No!", "Well?", "cut off", "cut. ", "a", "é…", "long " * 500 + "."]
    rows = []
    for conv in range(n):
        for k in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", "User"]) \
                if rng.random() < 0.5 else ("user", "assistant")[k % 2]
            text = rng.choice(texts) if rng.random() < 0.4 else f"Turn {rng.random()}{rng.choice('.!?x')}"
            rows.append((conv, rng.choice([k, k, k, k + 3, 2, None]), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 9, "x") for r in rows], SCHEMA)


def results(spark, df, ids=None, **options):
    plans = landed(R.audits(df, ids, **options), "test-plans")
    sums = {r.conv_id: r for r in R.digests(df, plans).collect()}
    out = {}
    for r in plans.collect():
        assert r.conv_id not in out and sums[r.conv_id].audit == r.audit
        out[r.conv_id] = {k: r[k] for k in plans.columns if k != "conv_id"}
        out[r.conv_id]["repaired_sha256"] = sums[r.conv_id].repaired_sha256
    assert len(sums) == len(out)
    return out


@pytest.mark.parametrize("block, fan", [(64, 64), (3, 2)])
def test_repairs_equal_exhaustive_search(spark, block, fan):
    rows = some_conversations(3, 60, 12)
    rows += [(100, 1, "user", "Same.")] * 7 + [(None, None, "user", "Null id."), (None, 4, "assistant", "Cut")]
    got = results(spark, frame(spark, rows), block=block, fan=fan)
    by_conv = {}
    for conv, *r in rows:
        by_conv.setdefault(conv, []).append(r)
    assert got == {c: expected(r) for c, r in by_conv.items()}


def test_one_conversation_of_many_rows(spark):
    """A conversation that holds nearly all rows is cut over tasks and comes out the same."""
    rng = random.Random(5)
    rows = [(1, k, ("user", "assistant")[(k + (rng.random() < 0.1)) % 2], f"Row {rng.randint(0, 380)}{rng.choice('....x')}")
            for k in range(400)] + some_conversations(9, 5, 4)
    small = results(spark, frame(spark, rows), block=16, fan=3)
    assert small == results(spark, frame(spark, rows))
    by_conv = {}
    for conv, *r in rows:
        by_conv.setdefault(conv, []).append(r)
    assert small == {c: expected(r) for c, r in by_conv.items()}


def test_nulls_empty_tables_and_conversations_without_turns(spark):
    empty = "".encode()
    none = frame(spark, [])
    assert results(spark, none) == {} and R.repair(none).count() == 0
    ids = spark.createDataFrame([(5,), (6,), (None,)], "conv_id long")
    got = results(spark, frame(spark, [(6, None, None, None), (6, 1, None, "Hello.")]), ids)
    zero = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    zero |= {"audit": "", "repaired_sha256": hashlib.sha256(empty).hexdigest()}
    assert got[5] == got[None] == zero
    assert got[6] == expected([(None, " ", " "), (1, " ", "Hello.")])


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Bye"), (1, 2, "user", "Bye")]
    got = R.repair(frame(spark, rows)).orderBy("place").collect()
    _, _, lines = brute([r[2:] for r in rows])
    assert [f"{r.role}:{r.text}" for r in got] == list(lines)
    assert [r.place for r in got] == list(range(len(got)))


def test_query_over_a_table(spark):
    """The registered query's damage and results, against the definition, row by row."""
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    by_conv, planted = {}, set()
    for r in given.collect():
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        planted.add(kind)
        rows = by_conv.setdefault(r.conv_id, [])
        role, text = ("user" if kind == 4 else r.role), r.text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(r.turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert {0, 1, 2, 3, 4} <= planted
    from signalbox.llm import queries as Q

    got = {r.conv_id: r.asDict() for r in Q.op11_turn_repair(spark, "/root/testdata/sf0.001").collect()}
    assert got == {c: {"conv_id": c, **expected(r)} for c, r in by_conv.items()}
    assert damaged(given.withColumn("role", F.lit(None).cast("string"))).filter("role NOT IN (' ', 'user')").count() == 0
