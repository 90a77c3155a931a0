"""Conversation repair against all edits of short conversations, and a plain table of cheapest prefixes."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import repair
from tallyframe.llm.repair import GONE, KINDS, START, Costs, Tables

PLAIN, CHEAP_INSERTS = Costs(), Costs(rerole=3, delete=4, insert=1, truncated=2)
SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies int"


def cheapest(rows, costs):
    """(cost, initials, repaired rows) of a conversation by extending the best prefix for each string of states."""
    best = {"": (0, "", [])}
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def offer(into, state, cost, said, kept):
        if state not in into or (cost, said) < into[state][:2]:
            into[state] = (cost, said, kept)

    def inserted(states):
        out = dict(states)
        for _ in range(4):
            for state, (cost, said, kept) in list(out.items()):
                to = follows[state]
                offer(out, to, cost + costs.insert, said + "I", [*kept, (names[to], "")])
        return out

    for role, text, fault in rows:
        after = {}
        for state, (cost, said, kept) in inserted(best).items():
            offer(after, state, cost + costs.delete, said + "D", kept)
            if fault in ("blank", "duplicate"):
                continue
            extra = costs.truncated if fault else 0
            if role[:1] in "sua" and role and state + role[:1] in ("s", "u", "su", "ua", "au"):
                offer(after, role[:1], cost + extra, said + "K", [*kept, (role, text)])
            to = follows[state]
            offer(after, to, cost + extra + costs.rerole, said + "R", [*kept, (names[to], text)])
        best = after
    return min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda v: v[:2])


def report(rows, costs=PLAIN):
    """The report of a conversation from (turn, role, text, copies)."""
    rows = [(t, " " if r is None else r, " " if x is None else x, n) for t, r, x, n in rows]
    rows = [r for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for _ in range(r[3])]
    seen, told = set(), []
    for _, role, text, _ in rows:
        fault = (
            "blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen
            else "" if text.rstrip(" \t\n\v\f\r")[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
        told.append((role, text, fault))
    cost, audit, kept = cheapest(told, costs)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
    return (gaps, *[sum(f == k for *_, f in told) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


@pytest.mark.parametrize("costs", [PLAIN, CHEAP_INSERTS, Costs(2, 7, 3, 1)])
@pytest.mark.parametrize("block", [1, 3])
def test_tables_equal_prefixes(costs, block):
    tables, rng = Tables(costs, block), random.Random(block)
    for _ in range(300):
        kinds = np.array([rng.randrange(KINDS) for _ in range(rng.randrange(12))], np.int64)
        rows = [("suax"[(k - 1) % 4], "t", "blank" if k == GONE else "truncated" if k > 4 else "") for k in kinds.tolist()]
        audits, _, state, cost = tables.trace(kinds, tables.last, START, True)
        assert (cost, "".join(audits)) == cheapest(rows, costs)[:2]
        to, added = tables.before(kinds, np.array([tables.last]))
        assert tables.vectors[to[0]][START] + added[0] == cost
        # In two pieces, as chunks are traced.
        cut = rng.randrange(len(kinds) + 1)
        middle = tables.before(kinds[cut:], np.array([tables.last]))[0][0]
        first = tables.trace(kinds[:cut], middle, START, False)
        second = tables.trace(kinds[cut:], tables.last, first[2], True)
        assert first[0] + second[0] == audits and first[3] + second[3] == cost


def test_few_vectors():
    assert len(Tables(PLAIN, 1).vectors) < 200


def conversation(rng):
    rows = []
    for k in range(rng.choice([0, 1, 2, 5, 9, 14])):
        turn = rng.choice([k, k, k, k + rng.randrange(9), rng.choice([None, 3])])
        role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "userß", "assist"])
        text = rng.choice([f"Line {k}.", f"Line {k}", "Same!", "Same?", "", None, " \t\n", "\x0b\x0c", " ", "é. \n", "cut, ", "."])
        rows.append((turn, role, text, rng.choice([1, 1, 1, 1, 0, 2, 5])))
    return rows


@pytest.mark.parametrize(("costs", "rows"), [(PLAIN, repair.CHUNK), (PLAIN, 1), (CHEAP_INSERTS, 3)])
def test_report_equals_brute_force(spark, costs, rows):
    rng = random.Random(rows)
    told = {k: conversation(rng) for k in [None, *range(60)]}
    told[7] = [(t, rng.choice(["user", "assistant"]), rng.choice(["So.", "No", f"It is {t}."]), 1) for t in range(200)]
    told = {k: v for k, v in told.items() if v}
    made = [(k, *row) for k, v in told.items() for row in v]
    rng.shuffle(made)
    frame = spark.createDataFrame([(*r, "x", 1) for r in made], f"{SCHEMA}, audit string, part int").repartition(5)
    got = repair.repair_report(frame, F.col("copies"), costs, 2, rows)
    found = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert found == {k: report(v, costs) for k, v in told.items()}
    assert repair.repair_report(frame.limit(0)).collect() == []


def test_every_row_of_one_conversation(spark):
    """Many chunks, a row repeated often, and all texts over the size of a chunk."""
    rng = random.Random(3)
    rows = [(t, rng.choice(["user", "assistant", "system"]), f"{t % 40} " + "long " * 50 + rng.choice([".", ""]), 1) for t in range(300)]
    rows += [(7, "user", "again.", 1)] * 500
    frame = spark.createDataFrame([(1, *r) for r in rows], SCHEMA).repartition(4)
    got = repair.repair_report(frame, rows=50, size=2000).collect()
    assert [tuple(r)[1:] for r in got] == [report(rows)]


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "What?"), (1, 2, "bot", "This."), (1, 3, "user", "cut"), (2, 0, "user", " ")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.conv_id, r.place, r.role, r.text, r.edit) for r in repair.repaired_turns(frame).collect())
    assert got == [(1, 0, "user", "What?", "K"), (1, 1, "assistant", "This.", "R")]
    text_ids = frame.withColumn("conv_id", F.concat(F.lit("c"), "conv_id"))
    assert {r.conv_id for r in repair.repair_report(text_ids).collect()} == {"c1", "c2"}
