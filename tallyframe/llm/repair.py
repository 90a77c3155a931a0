"""Cheapest repair of the turn structure of conversations, by Four-Russians block tables.

A row is a turn: ``conv_id``, ``turn``, ``role``, ``text``. The repaired roles of a conversation must spell, by their initials,
nothing or an optional ``s`` and then one or more ``ua``. Edits of a row are Keep, Rerole (to user or assistant) and
Delete, and an Insert puts an empty user or assistant turn anywhere. A row that is blank, or repeats role and text of an
earlier row, must go; one that does not end with ``.``, ``!`` or ``?`` costs extra if it stays. Of the edits of least cost
those whose initials are least in ASCII are taken; as at any point only one of user and assistant can follow, these
initials fix the repair.

The cost of finishing a conversation from a point on is a vector over the four states of that grammar. Less
its minimum, such a vector is one of few, which ``Tables`` finds by closure from the end. For every one
of them and every block of ``BLOCK`` rows (of nine kinds each) it holds the vector before the block and the cost
added, so a conversation is gone through from its end by one lookup a block. To trace the edits forward, the
vectors inside a block are expanded backward from the one behind it, and the first edit in ASCII order
that keeps the cost is taken: ties cannot mislead, as all costs to the end are known.

No conversation has to fit a task. Rows that are alike count as one with a number of copies, rows are
sorted over all tasks by conversation and turn, and cut into chunks of ``CHUNK`` rows at most. A
conversation of several chunks is put together from what a chunk makes of each vector (from its end) and of each
state (from its start), one small row a chunk, in the order of the chunks and with no more than one of them in memory.

Defined results: a null role or text is one space; rows of null ``conv_id`` are one conversation. Rows are taken by turn,
nulls first, then by role and text. A role that is empty or starts with another letter cannot be kept. Other columns
are not read. A conversation without rows costs nothing and stays empty.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

from tallyframe.llm.staging import Workspace

BLOCK = 4
CHUNK, CHUNK_BYTES = 4096, 1 << 22

#: States: nothing yet, after s, after u, after a. In every state one of user and assistant can follow.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FOLLOWS = (USER, USER, ASSISTANT, USER)
ACCEPTED = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}

#: Kinds of row: one that must go, then whole and truncated rows by initial (s, u, a, other).
GONE, KINDS = 0, 9
INITIALS = "sua"
WHITE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def kind_of(initial: str, truncated: bool) -> int:
    at = INITIALS.find(initial) if initial else -1
    return 1 + (3 if at < 0 else at) + 4 * truncated


def _kept(state: int, kind: int) -> int | None:
    """Where a row of that kind leads if kept, if it may be."""
    initial = (kind - 1) % 4
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 3:
        return None
    return FOLLOWS[state] if FOLLOWS[state] == (USER, ASSISTANT)[initial - 1] else None


class Tables:
    """All cost vectors, and what a row and what a block of rows before them makes of them."""

    def __init__(self, costs: Costs, block: int = BLOCK) -> None:
        self.costs, self.block = costs, block
        far = 1 << 40
        end = self._closed([0 if s in ACCEPTED else far for s in range(STATES)])
        self.vectors, steps, self._ids = [], [], {}
        self.last = self._number(end)[0]
        for vector in self.vectors:  # grows while it is walked
            steps.append([self._number(self._before(vector, kind)) for kind in range(KINDS)])
        self.step_to, self.step_cost = (np.array([[x[k] for x in row] for row in steps], np.int64) for k in (0, 1))
        n = len(self.vectors)
        to, cost = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
        for _ in range(block):
            # A block is numbered by its kinds, the first row's the most significant digit.
            before, add = self.step_to[to], self.step_cost[to] + cost[:, :, None]
            to, cost = (x.transpose(0, 2, 1).reshape(n, -1) for x in (before, add))
        self.block_to, self.block_cost = to, cost

    def _number(self, vector: list[int]) -> tuple[int, int]:
        least = min(vector)
        normal = tuple(v - least for v in vector)
        if normal not in self._ids:
            self._ids[normal] = len(self.vectors)
            self.vectors.append(normal)
        return self._ids[normal], least

    def _closed(self, vector: list[int]) -> list[int]:
        """With inserts: each leads to the state that follows."""
        out = list(vector)
        for _ in range(STATES):
            out = [min(c, out[FOLLOWS[s]] + self.costs.insert) for s, c in enumerate(out)]
        return out

    def edits(self, state: int, kind: int) -> list[tuple[str, int, int]]:
        """The edits of a row in ASCII order of their initials: initial, state after it, cost."""
        out = [("D", state, self.costs.delete)]
        if kind != GONE:
            extra = self.costs.truncated if kind > 4 else 0
            kept = _kept(state, kind)
            if kept is not None:
                out.append(("K", kept, extra))
            out.append(("R", FOLLOWS[state], self.costs.rerole + extra))
        return out

    def _before(self, vector: tuple[int, ...], kind: int) -> list[int]:
        return self._closed([min(vector[to] + cost for _, to, cost in self.edits(s, kind)) for s in range(STATES)])

    def before(self, kinds: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What rows make of each of some vectors behind them: the vectors before them and the costs added."""
        to, cost = vectors, np.zeros(len(vectors), np.int64)
        blocks, rest = self._blocks(kinds)
        for code in blocks[::-1]:
            to, cost = self.block_to[to, code], cost + self.block_cost[to, code]
        for kind in rest[::-1]:
            to, cost = self.step_to[to, kind], cost + self.step_cost[to, kind]
        return to, cost

    def _blocks(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of whole blocks up to the end, and the kinds of the rows that are left at the beginning."""
        rest = len(kinds) % self.block
        weights = KINDS ** np.arange(self.block - 1, -1, -1)
        return kinds[rest:].reshape(-1, self.block) @ weights, kinds[:rest]

    def trace(self, kinds: np.ndarray, behind: int, state: int, is_end: bool) -> tuple[list[str], list[int], int, int]:
        """The edits up to each row, of ASCII-least initials among the cheapest: what is inserted before a row and done
        to it, and the state after it; at the end of a conversation a further entry has the inserts there. Then the
        last state and the cost."""
        blocks, rest = self._blocks(kinds)
        after = [behind]
        for code in blocks[::-1]:
            after.append(int(self.block_to[after[-1], code]))
        after.reverse()  # the vector before each block, and the last one
        audits, states, cost = [], [], 0
        pieces = ([rest] if len(rest) else []) + list(kinds[len(rest) :].reshape(-1, self.block))
        for k, piece in enumerate(pieces):
            vector = after[k if len(rest) else k + 1]
            inside = [vector]
            for kind in piece[::-1]:
                inside.append(int(self.step_to[inside[-1], kind]))
            for j, kind in enumerate(piece):
                said, state, paid = self._edit(inside[len(piece) - j], inside[len(piece) - j - 1], int(kind), state)
                audits.append(said)
                states.append(state)
                cost += paid
        if is_end:
            said = ""
            while state not in ACCEPTED:
                said, state, cost = said + "I", FOLLOWS[state], cost + self.costs.insert
            audits.append(said)
            states.append(state)
        return audits, states, state, cost

    @lru_cache(maxsize=1 << 16)  # noqa: B019
    def _edit(self, here: int, behind: int, kind: int, state: int) -> tuple[str, int, int]:
        """Inserts and the edit of one row: the first in ASCII order that reaches the least cost to the end."""
        now, then, base = self.vectors[here], self.vectors[behind], int(self.step_cost[behind, kind])
        said, paid = "", 0
        while True:
            left = now[state] + base
            edits = self.edits(state, kind)
            edits.insert(1, ("I", FOLLOWS[state], self.costs.insert))
            for initial, to, cost in edits:
                rest = now[to] + base if initial == "I" else then[to]
                if cost + rest == left:
                    break
            said, state, paid = said + initial, to, paid + cost
            if initial != "I":
                return said, state, paid


@lru_cache(maxsize=4)
def tables_for(costs: Costs, block: int) -> Tables:
    return Tables(costs, block)


_SAID, _ENDS = re.compile(f"[^{WHITE}]"), re.compile(rf"[.!?][{WHITE}]*\Z")
_LISTS = ("turns", "roles", "texts", "copies", "repeated")


def row_kinds(chunk: dict) -> tuple[np.ndarray, list[str]]:
    """The kind of each row, and its fault or an empty string."""
    kinds, faults = [], []
    for role, text, again in zip(chunk["roles"], chunk["texts"], chunk["repeated"]):
        fault = "blank" if not _SAID.search(text) else "duplicate" if again else "" if _ENDS.search(text) else "truncated"
        faults.append(fault)
        kinds.append(GONE if fault in ("blank", "duplicate") else kind_of(role[:1], fault == "truncated"))
    return np.array(kinds, np.int64), faults


def solved(chunk: dict, tables: Tables) -> dict:
    """What a chunk adds to the report of its conversation, and its repaired rows."""
    kinds, faults = row_kinds(chunk)
    audits, _, _, cost = tables.trace(kinds, chunk["behind"], chunk["state"], chunk["is_end"])
    out = {c: chunk[c] for c in ("conv_id", "part", "number")}
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    said, kept, last = [], [], None
    state = chunk["state"]
    for k, edits in enumerate(audits):
        for edit in edits:
            if edit == "I":
                kept.append((ROLES[FOLLOWS[state]], "", edit))
            elif edit in "KR":
                kept.append((chunk["roles"][k] if edit == "K" else ROLES[FOLLOWS[state]], chunk["texts"][k], edit))
            if edit in "IR":
                state = FOLLOWS[state]
            elif edit == "K":
                state = _kept(state, int(kinds[k]))
        said.append(edits)
        if k == len(kinds):  # inserts at the end
            continue
        more = chunk["copies"][k] - 1
        said.append("D" * more)
        cost += more * tables.costs.delete
        if faults[k]:
            counts[faults[k]] += 1
        counts["blank" if faults[k] == "blank" else "duplicate"] += more
        initial = chunk["roles"][k][:1]
        counts["illegal"] += more + (last is not None and last + initial not in LEGAL)
        last = initial
    seen = sorted({t for t in chunk["turns"] if t is not None})
    return out | counts | {
        "audit": "".join(said),
        "cost": cost,
        "first": chunk["roles"][0][:1] if chunk["roles"] else None,
        "last": last,
        "low": seen[0] if seen else None,
        "high": seen[-1] if seen else None,
        "n_seen": len(seen),
        "kept": [{"role": r, "text": t, "edit": e} for r, t, e in kept],
    }


def reported(rows: Iterator[dict]) -> Iterator[dict]:
    """The report of each conversation, from what its chunks add, in their order."""
    current, report = object(), None
    for row in rows:
        if report is None or row["conv_id"] != current:
            if report is not None:
                yield _closed_report(report)
            current = row["conv_id"]
            report = {"conv_id": current, **dict.fromkeys(_SUMS, 0), "audit": [], "last": None, "low": None, "high": None, "told": False}
            report["hash"] = hashlib.sha256()
        if report["last"] is not None and row["first"] is not None:
            report["illegal"] += report["last"] + row["first"] not in LEGAL
        report["n_seen"] -= row["low"] is not None and row["low"] == report["high"]
        for name in _SUMS:
            report[name] += row[name]
        report["audit"].append(row["audit"])
        for turn in row["kept"]:
            report["hash"].update((("\n" if report["told"] else "") + f"{turn['role']}:{turn['text']}").encode("utf-8"))
            report["told"] = True
        for name, value in (("last", row["last"]), ("high", row["high"])):
            report[name] = value if value is not None else report[name]
        report["low"] = row["low"] if report["low"] is None else report["low"]
    if report is not None:
        yield _closed_report(report)


def _closed_report(report: dict) -> dict:
    gaps = 0 if report["low"] is None else report["high"] - report["low"] + 1 - report["n_seen"]
    return {c: report[c] for c in ("conv_id", *_COUNTS)} | {
        "gaps": min(gaps, 2**63 - 1),
        "audit": "".join(report["audit"]),
        "repaired_sha256": report["hash"].hexdigest(),
    }


LEGAL = ("su", "ua", "au")
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_SUMS = (*_COUNTS, "n_seen")


def _chunks(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows as chunks: at most ``rows`` rows of one conversation, and about ``size`` bytes."""
    part, number, left = TaskContext.get().partitionId(), 0, None
    for batch in batches:
        table = pa.Table.from_batches([batch] if left is None else [left, batch]).combine_chunks()
        cuts = _cuts(table, rows, size)
        if cuts:
            yield _as_chunks(table, cuts, part, number)
            number += len(cuts)
        rest = table.slice(cuts[-1] if cuts else 0).combine_chunks()
        left = rest.to_batches()[0] if rest.num_rows else None
    if left is not None:
        yield _as_chunks(pa.Table.from_batches([left]), [left.num_rows], part, number)


def _cuts(table: pa.Table, rows: int, size: int) -> list[int]:
    """Where chunks end, but for the last, which the next batch may carry on."""
    codes = np.asarray(table["conv_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices)
    new = np.append(False, codes[1:] != codes[:-1]).tolist()
    sizes = pa.compute.binary_length(table["text"]).to_pylist()
    out, count, held = [], 0, 0
    for k, (is_new, n) in enumerate(zip(new, sizes)):
        if is_new or count >= rows or (count and held + n > size):
            out.append(k)
            count, held = 0, 0
        count, held = count + 1, held + n
    return out


def _as_chunks(table: pa.Table, ends: list[int], part: int, number: int) -> pa.RecordBatch:
    table = table.slice(0, ends[-1])
    offsets, starts = pa.array([0, *ends], pa.int32()), pa.array([0, *ends[:-1]])
    lists = [pa.ListArray.from_arrays(offsets, _whole(table[c])) for c in ("turn", "role", "text", "copies", "repeated")]
    numbers = [pa.array([part] * len(ends), pa.int32()), pa.array(range(number, number + len(ends)), pa.int64())]
    return pa.RecordBatch.from_arrays([_whole(table["conv_id"].take(starts)), *numbers, *lists], ["conv_id", "part", "number", *_LISTS])


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


def _rows(batches: Iterator[pa.RecordBatch], at_once: int = 16) -> Iterator[dict]:
    """Rows as dictionaries, few at a time; of chunks, without the rows of no copies, which only name their conversation."""
    for batch in batches:
        for start in range(0, batch.num_rows, at_once):
            for row in batch.slice(start, at_once).to_pylist():
                if "copies" in row:
                    here = [k for k, n in enumerate(row["copies"]) if n]
                    row |= {c: [row[c][k] for k in here] for c in _LISTS}
                yield row


def _mapped(df: DataFrame, make, schema: StructType) -> DataFrame:
    """``make`` turns an iterator of rows into one of rows, within each partition."""
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make(_rows(batches))
        while held := list(islice(made, 16)):
            yield pa.RecordBatch.from_pylist(held, types)

    return df.mapInArrow(run, schema)


def _by_conversation(df: DataFrame, backward: bool = False) -> DataFrame:
    """The rows of each conversation in one partition, in the order of its chunks."""
    order = [F.desc(c) if backward else F.asc(c) for c in ("part", "number")]
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _schema(df: DataFrame, **fields: str) -> StructType:
    """conv_id as in ``df`` and further fields."""
    out = StructType([df.schema["conv_id"]])
    for name, kind in fields.items():
        out = out.add(name, DataType.fromDDL(kind))
    return out


_PLACE = {"part": "int", "number": "bigint"}
_TURNS = "array<struct<role:string,text:string,edit:string>>"


def sorted_chunks(work: Workspace, turns: DataFrame, copies: Column, rows: int, size: int) -> DataFrame:
    """The rows as chunks of one conversation, in its order by part and number."""
    said = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("bigint").alias("copies"),
    )
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    again = work.keep(
        said.where("copies > 0")
        .select("conv_id", "role", F.md5("text").alias("digest"), when.alias("at"))
        .groupBy("conv_id", "role", "digest")
        .agg(F.min("at").alias("first"), F.max("at").alias("latest"))
        .where("first < latest")
        .select(F.col("conv_id").alias("of"), F.col("role").alias("as"), "digest", "first")
    )
    alike = said.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("as")) & (F.md5("text") == F.col("digest"))
    order = ["conv_id", "turn", "role", "text"]
    marked = (
        alike.join(again, same, "left")
        .select(*order, "copies", F.coalesce(when > F.col("first"), F.lit(False)).alias("repeated"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    lists = {"turns": "array<bigint>", "roles": "array<string>", "texts": "array<string>", "copies": "array<bigint>"}
    schema = _schema(said, **_PLACE, **lists, repeated="array<boolean>")
    return marked.mapInArrow(lambda batches: _chunks(batches, rows, size), schema)


def _entries(work: Workspace, chunks: DataFrame, costs: Costs, block: int) -> DataFrame:
    """part, number, behind, state, is_end of the chunks of conversations with several: the vector behind a chunk, the
    state it starts in and whether it is the last."""

    def effects(rows: Iterator[dict]) -> Iterator[dict]:
        tables = tables_for(costs, block)
        every = np.arange(len(tables.vectors))
        for row in rows:
            to, _ = tables.before(row_kinds(row)[0], every)
            yield {"conv_id": row["conv_id"], "part": row["part"], "number": row["number"], "effect": to.tolist()}

    def from_the_end(rows: Iterator[dict]) -> Iterator[dict]:
        tables, current, behind = tables_for(costs, block), object(), 0
        for row in rows:
            is_end = row["conv_id"] != current
            if is_end:
                current, behind = row["conv_id"], tables.last
            yield {"part": row["part"], "number": row["number"], "behind": behind, "is_end": is_end}
            behind = row["effect"][behind]

    def leads(rows: Iterator[dict]) -> Iterator[dict]:
        tables = tables_for(costs, block)
        for row in rows:
            kinds = row_kinds(row)[0]
            lead = [tables.trace(kinds, row["behind"], s, False)[2] for s in range(STATES)]
            yield {c: row[c] for c in ("conv_id", "part", "number", "behind", "is_end")} | {"lead": lead}

    def from_the_start(rows: Iterator[dict]) -> Iterator[dict]:
        current, state = object(), START
        for row in rows:
            if row["conv_id"] != current:
                current, state = row["conv_id"], START
            yield {c: row[c] for c in ("part", "number", "behind", "is_end")} | {"state": state}
            state = row["lead"][state]

    effect = _mapped(chunks, effects, _schema(chunks, **_PLACE, effect="array<int>"))
    place = "part int, number bigint, behind int, is_end boolean"
    back = work.keep(_mapped(_by_conversation(effect, backward=True), from_the_end, StructType.fromDDL(place)))
    lead = _mapped(
        chunks.join(back, ["part", "number"]),
        leads,
        _schema(chunks, **_PLACE, behind="int", is_end="boolean", lead="array<int>"),
    )
    return work.keep(_mapped(_by_conversation(lead), from_the_start, StructType.fromDDL(f"{place}, state int")))


def _solved(turns: DataFrame, copies: Column, costs: Costs, block: int, rows: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The solved chunks of conversations with one chunk, and of those with several."""
    work = Workspace(turns.sparkSession, "repair")
    chunks = work.keep(sorted_chunks(work, turns, copies, rows, size))
    # Written, so that Spark knows its size and need not shuffle the chunks where it is small.
    several = work.keep(
        chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("of"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    shared = work.keep(chunks.join(several, same, "left_semi"))
    last = tables_for(costs, block).last
    alone = chunks.join(several, same, "left_anti").select(
        "*", F.lit(last).alias("behind"), F.lit(START).alias("state"), F.lit(True).alias("is_end")
    )
    schema = _schema(
        chunks,
        **_PLACE,
        **dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), "bigint"),
        audit="string",
        cost="bigint",
        first="string",
        last="string",
        low="bigint",
        high="bigint",
        n_seen="bigint",
        kept=_TURNS,
    )

    def solve(these: Iterator[dict]) -> Iterator[dict]:
        tables = tables_for(costs, block)
        return (solved(row, tables) for row in these)

    joined = shared.join(_entries(work, shared, costs, block), ["part", "number"])
    return _mapped(alone, solve, schema), _mapped(joined, solve, schema)


def repaired_turns(
    turns: DataFrame, copies: Column | None = None, costs: Costs = Costs(), block: int = BLOCK, rows: int = CHUNK, size: int = CHUNK_BYTES
) -> DataFrame:
    """The repaired conversations, a row a turn: conv_id, part, number and place (their order), role, text, edit."""
    found = _solved(turns, F.lit(1) if copies is None else copies, costs, block, rows, size)
    return (
        found[0]
        .unionByName(found[1])
        .select("conv_id", "part", "number", F.posexplode("kept").alias("place", "turn"))
        .select("conv_id", "part", "number", "place", "turn.*")
    )


def repair_report(
    turns: DataFrame, copies: Column | None = None, costs: Costs = Costs(), block: int = BLOCK, rows: int = CHUNK, size: int = CHUNK_BYTES
) -> DataFrame:
    """A row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``copies`` says how often a row stands there; a row of 0 copies only names its conversation. The digest goes
    through a conversation in order and so in one task, a chunk at a time; the repair itself does not.
    """
    alone, shared = _solved(turns, F.lit(1) if copies is None else copies, costs, block, rows, size)
    counts = dict.fromkeys(("gaps", *_COUNTS), "bigint")
    schema = _schema(turns, **counts, audit="string", repaired_sha256="string")
    return _mapped(alone, reported, schema).unionByName(_mapped(_by_conversation(shared), reported, schema))
