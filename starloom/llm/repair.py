"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is to read: maybe a system turn, then user and assistant in turn, ending
with the assistant; or nothing. Four states say what has been read: nothing, a system
turn, a user's, an assistant's. Per row the edits are to keep it, to give it the role
that fits, to delete it, and to insert an empty turn ahead of it; the cheapest sequence
is wanted, and of equally cheap ones the one whose initials (D, I, K, R) come first.

Costs of reaching each state are a vector of four, and so are costs from each state to
the end. For a stretch of rows the forward vector of its first half and the backward
vector of its second half meet at the middle row; the state to cross in is the one of
least total cost, on equal costs the one whose edits so far come first. Then each half
is solved for itself, between known states. Space is linear: only codes of rows are
held. The order of edits is carried along as the rank of each state's best edits; two
such sequences end in different letters somewhere, so ranks decide.

At scale: rows are range-sorted by conversation, turn, role and text, so one with a third
of all rows spreads over many tasks. A conversation inside one range is solved there. The
first and last of a range may go on in others; each of their segments is
summed up as costs and ranks between any two states, and since that is what a row is as
well, the same divide and conquer runs over a conversation's segments (one per range at
most), fixes the states between them, and the segments are solved in parallel again. Only
the digest of such a conversation is computed in one task, as a stream: it is sequential.

Before that, every row is damaged by a hash of its key; ``damage=False`` repairs rows
as they are. Nulls in roles, texts and hashed keys count as one space; a NULL conversation id is
a conversation of its own, NULL turns come first. Rows of one turn are ordered by role,
then text; repeated rows are duplicates. Only the first letter of a role counts, and a
role without one can't be kept. Empty tables give no row. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize, replicate

NEVER = 1 << 60
# States: nothing read, system, user, assistant. What may be inserted next, and the
# state behind it.
NEXT = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
# Costs of edits, and of ending in each state by insertions.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ENDING = (0, 2 * INSERT, INSERT, 0)
# Edits of a row in the order of their initials. Insertions ahead of a deleted row are
# left out: behind it they cost the same, and "DI" comes before "ID". Two insertions in
# front of a row lead back to where they began.
EDITS = ("D", "IK", "IR", "K", "R")
WHITE = " \t\n\x0b\x0c\r"
OK, BLANK, DUPLICATE, CUT_OFF = range(4)

Move = tuple[int, int, int, int]  # from state, to state, cost, order of the edits


def _moves(initial: str, fault: int) -> list[Move]:
    """What a row can do."""
    out = [(s, s, DELETE, 0) for s in range(4)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED if fault == CUT_OFF else 0
    for s in range(4):
        kept = {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}
        if kept.get(initial) is not None:
            out.append((s, kept[initial], extra, 3))
        out.append((s, NEXT[s], REROLE + extra, 4))
        between = NEXT[s]
        after = {"u": 2 if between == 3 else None, "a": 3 if between == 2 else None}
        if after.get(initial) is not None:
            out.append((s, after[initial], INSERT + extra, 1))
        out.append((s, NEXT[between], INSERT + REROLE + extra, 2))
    return out


INITIALS = "sua"
MOVES = [[_moves(i, fault) for i in (*INITIALS, "")] for fault in range(4)]


def moves_of(role: str, fault: int) -> list[Move]:
    return MOVES[fault][INITIALS.find(role[0]) if role and role[0] in INITIALS else 3]


# --- divide and conquer ----------------------------------------------------------


def forward(elements: list[list[Move]], low: int, high: int, start: int):
    """Least cost of each state behind elements low to high, and ranks of their edits."""
    cost, rank = [NEVER] * 4, [0] * 4
    cost[start] = 0
    for k in range(low, high):
        new, key = [NEVER] * 4, [0] * 4
        for s, t, c, order in elements[k]:
            total = cost[s] + c
            if total < new[t] or (total == new[t] and total < NEVER and rank[s] * 8 + order < key[t]):
                new[t], key[t] = total, rank[s] * 8 + order
        for place, t in enumerate(sorted(range(4), key=lambda t: (new[t] >= NEVER, key[t]))):
            rank[t] = place
        cost = [min(c, NEVER) for c in new]
    return cost, rank


def backward(elements: list[list[Move]], low: int, high: int, ending: list[int]) -> list[int]:
    """Least cost from each state ahead of elements low to high."""
    cost = list(ending)
    for k in reversed(range(low, high)):
        new = [NEVER] * 4
        for s, t, c, _ in elements[k]:
            if cost[t] + c < new[s]:
                new[s] = cost[t] + c
        cost = new
    return cost


def only(state: int) -> list[int]:
    return [0 if s == state else NEVER for s in range(4)]


def solve(elements: list[list[Move]], start: int, ending: list[int]) -> list[Move]:
    """The move of each element on the cheapest way, on equal costs the first one."""
    out: list[Move] = []
    stack = [(0, len(elements), start, ending)]
    while stack:
        low, high, start, ending = stack.pop()
        if high - low > 1:
            middle = (low + high) // 2
            cost, rank = forward(elements, low, middle, start)
            rest = backward(elements, middle, high, ending)
            cross = min(range(4), key=lambda s: (cost[s] + rest[s], rank[s]))
            stack.append((middle, high, cross, ending))
            stack.append((low, middle, start, only(cross)))
        elif high > low:
            own = [m for m in elements[low] if m[0] == start]
            out.append(min(own, key=lambda m: (m[2] + ending[m[1]], m[3])))
    return out


def summary(elements: list[list[Move]]) -> list[Move]:
    """A stretch as one element: the moves between any two states."""
    out = []
    for s in range(4):
        cost, rank = forward(elements, 0, len(elements), s)
        out += [(s, t, cost[t], rank[t]) for t in range(4) if cost[t] < NEVER]
    return out


def edit(move: Move) -> tuple[str, list[str]]:
    """Initials of a row's edits; the roles it leaves, its own last (none if deleted;
    an empty one where the row keeps its role)."""
    letters, state = EDITS[move[3]], move[0]
    roles = []
    for letter in letters:
        if letter == "K":
            roles.append("")
        elif letter != "D":
            state = NEXT[state]
            roles.append(ROLES[state])
    return letters, roles


def ending_of(state: int) -> tuple[str, list[str]]:
    roles = []
    while ENDING[state]:
        state = NEXT[state]
        roles.append(ROLES[state])
    return "I" * len(roles), roles


# --- counts ----------------------------------------------------------------------


@dataclass
class Counts:
    """Figures of a stretch of rows; stretches add up in order."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    first: str = ""
    last: str = ""
    low: int | None = None
    high: int | None = None

    @classmethod
    def of(cls, turn: int | None, role: str, fault: int) -> Counts:
        faults = [int(fault == kind) for kind in (BLANK, DUPLICATE, CUT_OFF)]
        return cls(1, *faults, 0, int(turn is not None), role[:1], role[:1], turn, turn)

    def add(self, other: Counts) -> None:
        if not self.rows:
            self.__dict__.update(other.__dict__)
            return
        self.illegal += other.illegal + (self.last + other.first not in ("su", "ua", "au"))
        self.distinct += other.distinct - (self.high is not None and self.high == other.low)
        for name in ("rows", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        self.last = other.last
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.distinct if self.low is not None else 0


# --- rows ------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped, repeated or given to the user by their key's hash."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hashed = (F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20).alias("hashed")
    kind = F.col("hashed")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.select("*", hashed)
        .filter(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(times).alias("_time"),
        )
        .drop("_time")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault`` and ``tie``, a number that tells equal rows apart.

    The first row of each role and text is found by a count that combines map-side; only
    those met twice go on, so a text that fills a third of all rows costs one row.
    """
    own = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("\x00")),
        F.lit("\x1f"),
        F.length("role").cast("string"),
        F.lit(":"),
        "role",
        "text",
    )
    rows = materialize(
        rows.select("*", F.unhex(F.md5(own)).alias("digest"), F.monotonically_increasing_id().alias("tie")),
        "turns",
    )
    again = materialize(
        rows.groupBy("digest")
        .agg(F.min(F.struct("turn", "tie")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.tie").alias("first")),
        "repeated-turns",
    )
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (
        F.when(trimmed == "", BLANK)
        .when(F.col("first").isNotNull() & (F.col("first") != F.col("tie")), DUPLICATE)
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), CUT_OFF)
        .otherwise(OK)
    )
    return rows.join(replicate(again), "digest", "left").select(
        "conv_id", "turn", "role", "text", "tie", fault.alias("fault")
    )


ROW, REPORT, HELD, SEGMENT = range(4)
FIELDS = "kind int, part int, slot int, at long, edit string, roles array<string>, role string, text string, fault int, "
STATS = "rows long, blank long, duplicate long, truncated long, illegal long, distinct long, first string, last string, low long, high long, "
REST = "moves array<array<long>>, cost long, audit string, sha256 string"


def _schema(conv_id: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv_id), *T.StructType.fromDDL(FIELDS + STATS + REST).fields])


NO_ID = object()


class _Out:
    """Rows of the given fields, as batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def put(self, **row) -> None:
        self.rows.append(row)
        self.size += 200 + len(row.get("text") or "") + len(row.get("audit") or "")

    def full(self) -> bool:
        return self.size > 4 << 20

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0
        return out


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def lines_of(roles: list[str], role: str, text: str, kept: bool) -> list[str]:
    """``role:text`` of a row's turns: insertions, then itself unless deleted."""
    own = [f"{roles[-1] or role}:{text}"] if kept else []
    return [f"{r}:" for r in (roles[:-1] if kept else roles)] + own


class Digest:
    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def add(self, lines: list[str]) -> None:
        for line in lines:
            self.sha.update(("\n" if self.any else "").encode() + line.encode("utf-8", "surrogatepass"))
            self.any = True


def _range_pass(schema: pa.Schema, with_rows: bool):
    """Solves the conversations inside a range; holds its first and last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = _Out(schema), TaskContext.get().partitionId()
        current: object = NO_ID
        held: list[tuple] = []
        first, at = True, 0

        def finish(last: bool) -> None:
            """The conversation read so far is over, or the range is."""
            elements = [moves_of(role, fault) for _, role, _, fault, _ in held]
            counts = Counts()
            for turn, role, _, fault, _ in held:
                counts.add(Counts.of(turn, role, fault))
            if first or last:
                for turn, role, text, fault, place in held:
                    out.put(conv_id=current, kind=HELD, part=part, slot=int(not first), at=place, role=role, text=text, fault=fault)
                out.put(
                    conv_id=current, kind=SEGMENT, part=part, slot=int(not first), at=held[0][4], moves=[list(m) for m in summary(elements)], **counts.__dict__
                )
                return
            way = solve(elements, 0, list(ENDING))
            digest, letters = Digest(), []
            cost = sum(m[2] for m in way)
            for (_, role, text, _, place), move in zip(held, way):
                edits, roles = edit(move)
                letters.append(edits)
                digest.add(lines_of(roles, role, text, edits != "D"))
                if with_rows:
                    out.put(conv_id=current, kind=ROW, part=part, at=place, edit=edits, roles=roles, role=role, text=text)
            end = way[-1][1]
            edits, roles = ending_of(end)
            digest.add(lines_of(roles, "", "", False))
            if with_rows and roles:
                out.put(conv_id=current, kind=ROW, part=part, at=held[-1][4] + 1, edit=edits, roles=roles)
            out.put(
                conv_id=current, kind=REPORT, cost=cost + ENDING[end], audit="".join(letters) + edits, sha256=digest.sha.hexdigest(), **counts.__dict__
            )

        for batch in batches:
            for conv_id, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if held and conv_id != current:
                    finish(last=False)
                    held, first = [], False
                    if out.full():
                        yield out.batch()
                # A trailing insertion takes the place behind a conversation's last row.
                at += 2 if conv_id != current else 1
                current = conv_id
                held.append((*row, at))
        if held:
            finish(last=True)
        if out.rows:
            yield out.batch()

    return run


def _runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[bool, tuple]]:
    """(whether the first ``keys`` columns differ from the row before, row)."""
    before = None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            yield row[:keys] != before, row
            before = row[:keys]


CHAIN = "part int, slot int, start int, end int, finish boolean, cost long, " + STATS[:-2]


def _chains(segments: DataFrame) -> DataFrame:
    """Start and end state of each segment, and on the last the conversation's figures.

    One row per range and slot: bounded by the number of ranges.
    """
    schema = T.StructType([segments.schema["conv_id"], *T.StructType.fromDDL(CHAIN).fields])
    arrow = _arrow(schema)
    names = ["conv_id", "part", "slot", "at", "moves", *(f.split()[0] for f in STATS[:-2].split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(arrow)

        def finish(chain: list[tuple]) -> None:
            elements = [[tuple(m) for m in row[4]] for row in chain]
            way, counts = solve(elements, 0, list(ENDING)), Counts()
            for row in chain:
                counts.add(Counts(*row[5:]))
            cost = sum(m[2] for m in way) + ENDING[way[-1][1]]
            for k, (row, move) in enumerate(zip(chain, way)):
                last = k + 1 == len(chain)
                out.put(
                    conv_id=row[0], part=row[1], slot=row[2], start=move[0], end=move[1], finish=last, cost=cost if last else None, **(counts.__dict__ if last else {})
                )

        chain: list[tuple] = []
        for new, row in _runs_of(batches, 1):
            if new and chain:
                finish(chain)
                chain = []
                if out.full():
                    yield out.batch()
            chain.append(row)
        if chain:
            finish(chain)
        if out.rows:
            yield out.batch()

    ordered = segments.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return ordered.mapInArrow(run, schema)


def _segment_pass(schema: pa.Schema):
    """Solves segments between their states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)

        def solved(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            part, slot, _, conv_id, *_, start, end, last = rows[0]
            way = solve([moves_of(r[4], r[6]) for r in rows], start, only(end))
            for row, move in zip(rows, way):
                edits, roles = edit(move)
                out.put(conv_id=conv_id, kind=ROW, part=part, at=row[2], edit=edits, roles=roles, role=row[4], text=row[5])
                if out.full():
                    yield out.batch()
            edits, roles = ending_of(end)
            if last and roles:
                out.put(conv_id=conv_id, kind=ROW, part=part, at=rows[-1][2] + 1, edit=edits, roles=roles)

        rows: list[tuple] = []
        for new, row in _runs_of(batches, 2):
            if new and rows:
                yield from solved(rows)
                rows = []
            rows.append(row)
        if rows:
            yield from solved(rows)
        if out.rows:
            yield out.batch()

    return run


def _digests(edits: DataFrame) -> DataFrame:
    """conv_id, audit, sha256 of conversations that span ranges; each is a stream."""
    schema = T.StructType(
        [edits.schema["conv_id"], T.StructField("audit", T.StringType()), T.StructField("sha256", T.StringType())]
    )
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, letters, current = _Out(arrow), Digest(), [], None
        for new, (conv_id, _, _, edits, roles, role, text) in _runs_of(batches, 1):
            if new and letters:
                out.put(conv_id=current, audit="".join(letters), sha256=digest.sha.hexdigest())
                digest, letters = Digest(), []
            current = conv_id
            letters.append(edits)
            digest.add(lines_of(roles, role or "", text or "", edits[-1] in "KR"))
        if letters:
            out.put(conv_id=current, audit="".join(letters), sha256=digest.sha.hexdigest())
        if out.rows:
            yield out.batch()

    slim = edits.select("conv_id", "part", "at", "edit", "roles", "role", "text")
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at").mapInArrow(run, schema)


def repair(
    conversations: DataFrame, damage: bool = True, with_rows: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(report, edits) of ``conversations``: conv_id, turn, role, text.

    The report has one row per conversation of the input. ``edits`` has a row per damaged
    row in order of (part, at): edit, roles, role, text. Its turns are the roles: an
    empty one is ``role``, the last has ``text`` unless the row is deleted, inserted ones
    and those of a row without text are empty. With ``with_rows=False`` it holds
    conversations that span ranges only.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    faulty = with_faults(damaged(rows) if damage else rows)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "tie")]
    schema = _schema(rows.schema["conv_id"].dataType)
    solved = materialize(
        faulty.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "fault")
        .mapInArrow(_range_pass(_arrow(schema), with_rows), schema),
        "repaired",
    )
    chains = materialize(_chains(solved.filter(F.col("kind") == SEGMENT)), "chains")
    states = chains.select("part", "slot", "start", "end", "finish")
    # Two rows per range at most.
    held = solved.filter(F.col("kind") == HELD).join(F.broadcast(states), ["part", "slot"])
    spanning = materialize(
        held.select("part", "slot", "at", "conv_id", "role", "text", "fault", "start", "end", "finish")
        .repartition("part", "slot")
        .sortWithinPartitions("part", "slot", "at")
        .mapInArrow(_segment_pass(_arrow(schema)), schema),
        "repaired-segments",
    )
    edits = solved.filter(F.col("kind") == ROW).unionByName(spanning)
    totals = chains.filter("finish").drop("part", "slot", "start", "end", "finish")
    other = _digests(spanning).withColumnRenamed("conv_id", "_conv_id")
    joined = totals.join(other, F.col("conv_id").eqNullSafe(F.col("_conv_id")))
    columns = ["conv_id", "blank", "duplicate", "truncated", "illegal", "distinct", "low", "high", "cost", "audit", "sha256"]
    report = solved.filter(F.col("kind") == REPORT).select(columns).unionByName(joined.select(columns))
    report = materialize(report, "repair-report").withColumnRenamed("conv_id", "_conv_id")
    zero = F.lit(0).cast("long")
    all_ids = rows.select("conv_id").distinct()
    gaps = F.when(F.col("low").isNull(), zero).otherwise(F.col("high") - F.col("low") + 1 - F.col("distinct"))
    # A conversation's row is joined by id; one of whose rows none is left has no report.
    final = all_ids.join(report, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select(
        "conv_id",
        F.coalesce(gaps, zero).alias("gaps"),
        *(F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
    return final, edits.select("conv_id", "part", "at", "edit", "roles", "role", "text")
