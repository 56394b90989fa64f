"""Cheapest repair of conversations by iterative-deepening A*.

The role initials of a sound conversation follow ``(s?(ua)+)?``, an automaton of four
states. A row may be kept, given the role that fits (Rerole), or deleted, and empty rows
of either role may be inserted, each at its price. The search is depth-first, in the
ASCII order of the edits, under a cost bound that grows by one; a table remembers with
how much left a (row, state) has failed. The first path that accepts is the cheapest
one, and of those the least in ASCII order.

The estimate counts what the rows ahead cost at least: two for a row that must go, two
for a truncated one, one for a role that is neither of the three, and one for each of a
set of disjoint neighbours with the same role.

Conversations are sorted in Spark and streamed through the tasks, one conversation of
at most ``LIMIT`` rows and ``LIMIT_BYTES`` in memory. Longer ones are numbered in one global order
and cut into blocks of ``BLOCK`` rows; a block is searched from each state to each state, and
such tables are joined, ``FAN`` neighbours at a time, until a conversation has one. SHA-256 reads
a text from its beginning to its end, so one task streams the rows of a conversation to
digest them, whatever its length, and holds its audit, one byte an edit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import staged
from snapmart.operators.ids import add_occurrence, drop_place, stage_in_order
from snapmart.sources.staging import discard

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK, FAN = 512, 32
LIMIT, LIMIT_BYTES = 4096, 32_000_000
#: State after a kept initial: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: State after a row of the role that fits, and that role.
NEXT, FITS = (2, 2, 3, 2), ("user", "user", "assistant", "user")
GOALS = (0, 3)
_NEVER = 1 << 30
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")

#: A row for the search: role initial, must go, truncated.
Code = tuple[str, bool, bool]


def _estimates(codes: list[Code]) -> tuple[list[int], list[int]]:
    """Least cost of the rows from each place on, if a user or an assistant is to come next."""
    n = len(codes)
    user, assistant = [0] * (n + 1), [0] * (n + 1)
    base = 0
    role, pairs, behind = "", 0, 0  # of the next sound row: its role, the pairs from it on, those after it
    for i in range(n - 1, -1, -1):
        initial, forced, cut = codes[i]
        if forced or cut:
            base += DELETE
        elif initial in ("u", "a"):
            pairs, behind = (max(pairs, 1 + behind) if initial == role else pairs), pairs
            role = initial
        elif initial != "s":
            base += REROLE  # such a row may stand in for what a pair lacks: no pair across it
            role, behind = "", pairs
        user[i] = base + (max(pairs, 1 + behind) if role == "a" else pairs)
        assistant[i] = base + (max(pairs, 1 + behind) if role == "u" else pairs)
    return user, assistant


def _ends(goals: tuple[int, ...]) -> list[int]:
    """Cost of the insertions from each state to a goal."""
    out = []
    for state in range(4):
        cost = 0
        while state not in goals and cost <= 3 * INSERT:
            state, cost = NEXT[state], cost + INSERT
        out.append(cost if state in goals else _NEVER)
    return out


def search(codes: list[Code], start: int = 0, goals: tuple[int, ...] = GOALS) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from a state to one of the goals; None if no edits lead there."""
    n = len(codes)
    if not {2, 3} & set(goals) and not (start == 0 and 1 in goals and any(c[0] == "s" and not c[1] for c in codes)):
        # Nothing leads back to states 0 and 1: all rows go, or there are no such edits.
        return (DELETE * n, "D" * n) if start in goals else None
    user, assistant = _estimates(codes)
    ends = _ends(goals)
    failed = [-1] * (4 * n + 4)

    def moves(i: int, state: int) -> list[tuple[str, int, int, int]]:
        """Edit, cost, row and state after it; the last in ASCII order first."""
        out = []
        if i < n:
            initial, forced, cut = codes[i]
            if not forced:
                kept = STEP.get((state, initial))
                if kept != NEXT[state]:  # else keeping it is the same, and cheaper
                    out.append(("R", REROLE + TRUNCATED * cut, i + 1, NEXT[state]))
                if kept is not None:
                    out.append(("K", TRUNCATED * cut, i + 1, kept))
            out.append(("I", INSERT, i, NEXT[state]))
            out.append(("D", DELETE, i + 1, state))
        else:
            out.append(("I", INSERT, i, NEXT[state]))
        return out

    def least(i: int, state: int) -> int:
        if i == n:
            return ends[state]
        return assistant[i] if state == 2 else user[i]

    if n == 0 and start in goals:
        return 0, ""
    bound = least(0, start)
    while True:
        audit: list[str] = []
        stack = [(0, start, bound, moves(0, start))]
        while stack:
            i, state, left, open_ = stack[-1]
            if not open_:
                failed[4 * i + state] = max(failed[4 * i + state], left)
                stack.pop()
                if audit:
                    audit.pop()
                continue
            edit, cost, to, then = open_.pop()
            rest = left - cost
            if rest < least(to, then) or failed[4 * to + then] >= rest:
                continue
            audit.append(edit)
            if to == n and then in goals:
                return bound - rest, "".join(audit)
            stack.append((to, then, rest, moves(to, then)))
        bound += 1


#: From each state to each state: cost and audit.
Table = dict[tuple[int, int], tuple[int, str]]


def block_table(codes: list[Code]) -> Table:
    out = {}
    for start in range(4):
        for end in range(4):
            found = search(codes, start, (end,))
            if found:
                out[start, end] = found
    return out


def joined(first: Table, second: Table) -> Table:
    """The table of two neighbours. Audits of equal cost between the same states are never
    prefixes of one another, so the least whole is made of the least parts."""
    out: Table = {}
    for (start, mid), (a, left) in first.items():
        for (begin, end), (b, right) in second.items():
            if begin == mid:
                one = (a + b, left + right)
                if (start, end) not in out or one < out[start, end]:
                    out[start, end] = one
    return out


def answer(table: Table) -> tuple[int, str]:
    return min(table[0, g] for g in GOALS if (0, g) in table)


def solve(codes: list[Code]) -> tuple[int, str]:
    if len(codes) <= BLOCK:
        return search(codes)
    table = block_table(codes[:BLOCK])
    for i in range(BLOCK, len(codes), BLOCK):
        table = joined(table, block_table(codes[i : i + BLOCK]))
    return answer(table)


class Digest:
    """SHA-256 of the repaired rows, fed with the rows as they were."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0
        self.sha, self.any = hashlib.sha256(), False

    def _add(self, role: str, text: str, state: int) -> None:
        self.sha.update(f"{'\n' if self.any else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.any, self.state = True, state

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._add(FITS[self.state], "", NEXT[self.state])
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._add(role, text, STEP[self.state, role[:1]])
        elif edit == "R":
            self._add(FITS[self.state], text, NEXT[self.state])

    def hex(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _faults(rows: list[tuple[str, str]]) -> Iterator[str]:
    """The first fault of each row, or the empty text."""
    seen = set()
    for row in rows:
        solid = _LAST.search(row[1])
        if not solid:
            yield "blank"
        elif row in seen:
            yield "duplicate"
        else:
            yield "" if solid.group(1) in ".!?" else "truncated"
        seen.add(row)


def repair(rows: list[tuple[int | None, str, str]]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and digest of the (turn, role, text) of one conversation."""
    turns = {t for t, _, _ in rows if t is not None}
    said = [(role, text) for _, role, text in rows]
    faults = list(_faults(said))
    codes = [(role[:1], f in ("blank", "duplicate"), f == "truncated") for (role, _), f in zip(said, faults, strict=True)]
    cost, audit = solve(codes)
    digest = Digest(audit)
    for role, text in said:
        digest.row(role, text)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal_pairs([c[0] for c in codes]), cost, audit, digest.hex()


# ---- in Spark ----------------------------------------------------------------------

RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TYPES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text and ``copies``, 0 for a dropped row: the damage of the contract, by a checksum of id and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    rows = convs.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"), F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("hit"),
    )
    hit = F.col("hit")
    return rows.select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows as they are, in the form that ``repaired`` takes; a null role or text is one space."""
    space = F.lit(" ")
    return convs.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"), F.lit(1).alias("copies"),
    )


def repaired(rows: DataFrame, limit: int = LIMIT, limit_bytes: int = LIMIT_BYTES, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row a conversation: its id, what was wrong, and the cheapest repair.

    ``rows`` are conv_id, turn, role, text, copies as ``damaged`` gives them; a row of no
    copies counts for nothing, but its conversation is in the result. Rows follow turn (null first), then role and
    text, so repeated rows lie beside each other; rows without an id are one conversation. A
    conversation without rows, or of which no row can stay, has an empty audit or one of deletions, and the
    digest of the empty text. An empty table gives no rows.
    """
    sizes = rows.groupBy("conv_id").agg(F.sum(F.greatest("copies", F.lit(1))).alias("n"), F.sum(F.octet_length("text") * F.greatest("copies", F.lit(1))).alias("size"))
    large = sizes.where((F.col("n") > limit) | (F.col("size") > limit_bytes)).select(F.col("conv_id").alias("large_id"))
    if large.isEmpty():
        return _streamed(rows)
    large = staged(large, "large")
    same = F.col("conv_id").eqNullSafe(F.col("large_id"))
    return _streamed(rows.join(large, same, "left_anti")).unionByName(_in_blocks(rows.join(large, same, "left_semi"), block, fan))


def _streamed(rows: DataFrame) -> DataFrame:
    kind = dict(rows.dtypes)["conv_id"]
    ordered = rows.repartition("conv_id").sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out = [], []
        current, kept, began = None, [], False
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for c, turn, role, text, copies in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "turn", "role", "text", "copies")), strict=True):
                if not began or c != current:
                    if began:
                        ids.append(current)
                        out.append(repair(kept))
                    current, kept, began = c, [], True
                kept.extend([(turn, role, text)] * copies)
            if out:
                yield _batch(ids, out, id_type)
                ids, out = [], []
        if began:
            yield _batch([current], [repair(kept)], id_type)

    return ordered.mapInArrow(run, f"conv_id {kind}, {_TYPES}")


def _batch(ids: list, out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True))
    arrays = [pa.array(ids, id_type), *(pa.array(c, pa.int64()) for c in columns[:6]), *(pa.array(c, pa.string()) for c in columns[6:])]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id", *RESULT])


# ---- long conversations ----------------------------------------------------------

_PARTS = "part long, start int, past int, cost long, audit string, illegal long, head string, tail string"


def _in_blocks(rows: DataFrame, block: int, fan: int) -> DataFrame:
    kind = dict(rows.dtypes)["conv_id"]
    every = rows.select("conv_id").distinct()
    some = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
    some = some.withColumn("has_turn", F.col("turn").isNotNull())
    numbered = staged(drop_place(add_occurrence(stage_in_order(some, ["conv_id", "has_turn", "turn", "role", "text"]), ["conv_id"], "place", "of")), "numbered")
    solid = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    slim = numbered.select("conv_id", "turn", "role", "place", F.sha2("text", 256).alias("key"), solid.alias("solid"))
    first = slim.groupBy("conv_id", "role", "key").agg(F.min("place").alias("first")).withColumnsRenamed({"conv_id": "c", "role": "r", "key": "k"})
    slim = slim.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")))
    fault = F.when(F.col("solid") == "", "blank").when(F.col("place") > F.col("first"), "duplicate").when(~F.col("solid").isin(".", "!", "?"), "truncated")
    slim = staged(slim.select("conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"), F.coalesce(fault, F.lit("")).alias("fault")), "faults")

    def table_of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        codes = [(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(part.initial, part.fault, strict=True)]
        initials = [c[0] for c in codes]
        return _frame(part, block_table(codes), illegal_pairs(initials), initials[0], initials[-1])

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        whole, illegal, head, tail = None, 0, None, None
        for _, piece in part.sort_values("below").groupby("below"):
            own = {(r.start, r.past): (r.cost, r.audit) for r in piece.itertuples()}
            whole = own if whole is None else joined(whole, own)
            one = piece.iloc[0]
            illegal += one.illegal + (illegal_pairs([tail, one["head"]]) if tail is not None else 0)
            head, tail = one["head"] if head is None else head, one["tail"]
        return _frame(part, whole, illegal, head, tail)

    def _frame(part: pd.DataFrame, table: Table, illegal: int, head: str, tail: str) -> pd.DataFrame:
        out = pd.DataFrame([(s, e, c, a) for (s, e), (c, a) in sorted(table.items())], columns=["start", "past", "cost", "audit"])
        return out.assign(conv_id=part.conv_id.iloc[0], part=part["part"].iloc[0], illegal=illegal, head=head, tail=tail)[["conv_id", "part", "start", "past", "cost", "audit", "illegal", "head", "tail"]]

    schema = f"conv_id {kind}, {_PARTS}"
    parts = slim.withColumn("part", F.floor((F.col("place") - 1) / block)).groupBy("conv_id", "part").applyInPandas(table_of, schema)
    parts = staged(parts, "blocks")
    while parts.where("part > 0").limit(1).count():
        above = parts.withColumnRenamed("part", "below").withColumn("part", F.floor(F.col("below") / fan))
        last, parts = parts, staged(above.groupBy("conv_id", "part").applyInPandas(merged, schema), "blocks")
        discard(last)
    best = parts.where((F.col("start") == 0) & F.col("past").isin(*GOALS)).groupBy("conv_id").agg(F.min(F.struct("cost", "audit", "illegal")).alias("b"))
    best = staged(best.select("conv_id", "b.*"), "answers")

    turns = slim.groupBy("conv_id", "turn").agg(*(F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")))
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    lines = numbered.select("conv_id", "place", "role", "text").unionByName(best.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text")))
    digests = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")
    out = every
    for i, more in enumerate((counts, best, digests)):
        out = out.join(more.withColumnRenamed("conv_id", f"c{i}"), F.col("conv_id").eqNullSafe(F.col(f"c{i}")), "left").drop(f"c{i}")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.select("conv_id", *(zero[c].alias(c) for c in zero), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation and place, the audit at place 0, to one digest a conversation."""
    current, digest, id_type = None, None, None

    def one() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current], id_type), pa.array([digest.hex()])], ["conv_id", "repaired_sha256"])

    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        for c, place, role, text in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "place", "role", "text")), strict=True):
            if place == 0:
                if digest:
                    yield one()
                current, digest = c, Digest(text)
            else:
                digest.row(role, text)
    if digest:
        yield one()
