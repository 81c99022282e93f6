"""Conversation repair: the cheapest edits that give every conversation well-formed roles, by Hirschberg's divide and conquer.

A conversation's turns in order are kept (0), given the role user or assistant (3), deleted (4), or get an empty turn of either role
inserted before them (3); a turn that was cut off and is not deleted costs 3 more; blank and repeated turns have to be deleted.
The initials of the roles that are left must read ``(s?(ua)+)?``. Of the cheapest edits those count whose initials (D, I, K, R) are the least as text.

**States.** What has been emitted is nothing, a system turn, a user turn last, or an assistant turn last; the next role follows from the state.
So a turn is a table from state to state, with a cost and the edits' initials. Edits up to a turn end in that turn's own edit, so of two
different ones neither begins the other, and the order of whole edits is settled by a rank among the four states. Forward vectors
(cost and rank of each state) and backward vectors (cost) meet in the middle of a stretch; the cheapest crossing, the least by
rank, halves the problem, and both halves are solved in turn. Only vectors are kept, never a table over the turns.

**Long conversations.** Turns are dealt out by ranges of (conversation, turn), so a long conversation is spread over many tasks. Each task sums
up its stretch of a conversation in one table of the same kind, of fixed size. The same divide and conquer over the stretches of a conversation
gives the states in which each stretch is entered and left, and then each stretch is solved by itself. Texts take no part in
this: a turn is one byte there. They are shuffled once, when the edits are applied, and stream past their conversation's edits.
SHA-256 has to see a conversation's text in order, so that last step reads each conversation in one task, a batch at a time.

Defined results: NULL roles and texts are one blank; a NULL id is a conversation; turns without a number come first; turns of equal number
are ordered by a hash of role and text. Repeated rows are repeated turns. Columns beyond the four named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.storage import stored

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state after emitting the next role that is not system
ROLE = {USER: "user", ASSISTANT: "assistant"}
END_COST = (0, 2 * INSERT, INSERT, 0)
END_EDITS = ("", "II", "I", "")
FAR = 1 << 40
#: From any state at most 10 more than from any other brings the same end (two inserts and a deletion), so a state that is dearer by more is never used.
DOMINATED = 10
GOOD, TRUNCATED, GONE = range(3)
_BATCH = 1 << 16

#: a table lists, for each state, the (state after, cost, order) it can lead to; orders of one state can be compared
Table = tuple[tuple[tuple[int, int, object], ...], ...]


def _turn_table(initial: str, fault: int) -> Table:
    rows = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        at, inserted = state, ""
        for _ in range(3):
            found = [(at, DELETE, "D")]
            if fault != GONE:
                extra = CUT_OFF if fault == TRUNCATED else 0
                if initial == "s" and at == NOTHING:
                    found.append((SYSTEM, KEEP + extra, "K"))
                if (initial, NEXT[at]) in (("u", USER), ("a", ASSISTANT)):
                    found.append((NEXT[at], KEEP + extra, "K"))
                found.append((NEXT[at], REROLE + extra, "R"))
            for to, cost, edit in found:
                option = (cost + INSERT * len(inserted), inserted + edit)
                best[to] = min(best.get(to, option), option)
            at, inserted = NEXT[at], inserted + "I"
        rows.append(tuple((to, *option) for to, option in sorted(best.items())))
    return tuple(rows)


INITIALS = "sua"
#: the table of each code; a code is 3 * (place in ``INITIALS``, or 3) + fault
TURNS: list[Table] = [_turn_table(initial, fault) for initial in (*INITIALS, "") for fault in range(3)]


class Repair:
    """Cheapest, least edits over a sequence of items, each of which stands for a table."""

    def __init__(self, tables):
        self.tables, self.ahead, self.back = tables, {}, {}

    def _step(self, vector: tuple, item) -> tuple:
        costs, ranks = vector
        best: list = [None] * 4
        for state, options in enumerate(self.tables[item]):
            if costs[state] < FAR:
                for to, cost, order in options:
                    option = (costs[state] + cost, ranks[state], order)
                    if best[to] is None or option < best[to]:
                        best[to] = option
        least = min(b[0] for b in best if b)
        best = [b if b and b[0] - least <= DOMINATED else None for b in best]
        in_order = sorted((b[1:], to) for to, b in enumerate(best) if b)
        ranks = [0] * 4
        for rank, (_, to) in enumerate(in_order):
            ranks[to] = rank
        return (tuple(b[0] - least if b else FAR for b in best), tuple(ranks)), least

    def forward(self, items, start: int) -> tuple[tuple, int]:
        """((cost of each state above the least, rank of each state), the least cost)."""
        vector = (tuple(0 if s == start else FAR for s in range(4)), (0,) * 4)
        total, known = 0, self.ahead
        for item in items:
            after = known.get((vector, item))
            if after is None:
                after = known[vector, item] = self._step(vector, item)
            vector = after[0]
            total += after[1]
        return vector, total

    def backward(self, items, target: tuple) -> tuple:
        """The cost of each state up to a constant, given those after the items."""
        known = self.back
        for item in reversed(items):
            before = known.get((target, item))
            if before is None:
                costs = [min((cost + target[to] for to, cost, _ in options), default=FAR) for options in self.tables[item]]
                least = min(costs)
                before = known[target, item] = tuple(min(c - least, FAR) for c in costs)
            target = before
        return target

    def solve(self, items, start: int, target: tuple, visit) -> int:
        """Calls ``visit(item, state before, option)`` in order for the best way from ``start``; returns the state it ends in."""
        waiting = [(0, len(items), target)]  # stretches still to solve, the next one last
        state = start
        while waiting:
            low, high, target = waiting.pop()
            if high - low > 1:
                middle = (low + high) // 2
                (costs, ranks), _ = self.forward(items[low:middle], state)
                rest = self.backward(items[middle:high], target)
                crossing = min(range(4), key=lambda s: (costs[s] + rest[s], ranks[s]))
                waiting.append((middle, high, target))
                waiting.append((low, middle, tuple(0 if s == crossing else FAR for s in range(4))))
            elif high > low:
                option = min(self.tables[items[low]][state], key=lambda o: (o[1] + target[o[0]], o[2]))
                visit(items[low], state, option)
                state = option[0]
        return state


_turns = Repair(TURNS)  # its known steps are few: costs beyond the least are bounded


def stretch_edits(codes: bytes, start: int, target: tuple) -> tuple[str, int, int]:
    """(edits, cost, state after) of the best way over some turns."""
    edits, costs = [], []

    def visit(_item, _state, option):
        edits.append(option[2])
        costs.append(option[1])

    state = _turns.solve(codes, start, target, visit)
    return "".join(edits), sum(costs), state


def best_edits(codes: bytes) -> tuple[str, int]:
    """(edits, cost) of a whole conversation."""
    edits, cost, state = stretch_edits(codes, NOTHING, END_COST)
    return edits + END_EDITS[state], cost + END_COST[state]


def summary(codes: bytes) -> Table:
    """The table of a stretch of turns, with ranks for orders."""
    rows = []
    for state in range(4):
        (costs, ranks), least = _turns.forward(codes, state)
        rows.append(tuple((to, least + costs[to], ranks[to]) for to in range(4) if costs[to] < FAR))
    return tuple(rows)


def routes(tables: list[Table]) -> list[tuple[int, int]]:
    """The states in which the best way enters and leaves each stretch of a conversation."""
    found: list[tuple[int, int]] = []
    Repair(tables).solve(range(len(tables)), NOTHING, END_COST, lambda _item, state, option: found.append((state, option[0])))
    return found


def edited(edits: Iterator[str], turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) for each edit in turn; deleted turns come with their own role and text."""
    state = NOTHING
    for edit in edits:
        if edit == "I":
            state = NEXT[state]
            yield edit, ROLE[state], ""
            continue
        role, text = next(turns)
        if edit == "R":
            state = NEXT[state]
            role = ROLE[state]
        elif edit == "K":
            state = SYSTEM if role[:1] == "s" else NEXT[state]
        yield edit, role, text


def coded(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, mark, initial, fault): NULLs replaced, a hash of role and text, and blank (2) and cut-off (1) texts."""
    plain = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    return plain.select(
        "conv", "turn", "role", "text", F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text"))).alias("mark"),
        F.substring("role", 1, 1).alias("initial"),
        F.when(last == "", GONE).when(last.isin(".", "!", "?"), GOOD).otherwise(TRUNCATED).cast("tinyint").alias("fault"),
    )


_SEGMENT = "part int, codes binary, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, opens string, closes string, low bigint, high bigint, numbers bigint, costs array<bigint>"
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _fields(conv: T.DataType, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("conv", conv), *T._parse_datatype_string(ddl).fields])


class _Stretch:
    """What a task gathers of one conversation."""

    def __init__(self, conv):
        self.conv, self.codes = conv, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.numbers = 0
        self.opens = self.closes = self.low = self.high = None

    def add(self, turn, initial: str, fault: int, copies: int, later: bool) -> None:
        place = 3 * (INITIALS.find(initial) if initial and initial in INITIALS else 3)
        fresh = not later and fault != GONE
        self.codes += bytes([place + fault]) * fresh + bytes([place + GONE]) * (copies - fresh)
        if fault == GONE:
            self.blank += copies
        else:
            self.duplicate += copies - fresh
            self.truncated += fresh and fault == TRUNCATED
        if self.turns:
            self.illegal += (self.closes, initial) not in _LEGAL
        else:
            self.opens = initial
        self.illegal += (copies - 1) * ((initial, initial) not in _LEGAL)
        self.closes = initial
        self.turns += copies
        if turn is not None:
            self.numbers += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self, part: int) -> tuple:
        costs = [FAR] * 32
        for state, options in enumerate(summary(bytes(self.codes))):
            for to, cost, order in options:
                costs[8 * state + to], costs[8 * state + 4 + to] = cost, order
        return (self.conv, part, bytes(self.codes), self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.opens, self.closes, self.low, self.high, self.numbers, costs)


def _table(costs: list[int]) -> Table:
    return tuple(tuple((to, costs[8 * s + to], costs[8 * s + 4 + to]) for to in range(4) if costs[8 * s + to] < FAR) for s in range(4))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = _BATCH) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


def _as_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _tuples(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(c.to_pylist() for c in part.columns))


def segments(turns: DataFrame) -> DataFrame:
    """One row for each stretch of a conversation that lies in one range of turns; ``turns`` are ``coded``."""
    conv_type = turns.schema["conv"].dataType
    once = turns.groupBy("conv", "turn", "mark").agg(F.first("initial").alias("initial"), F.first("fault").alias("fault"), F.count(F.lit(1)).alias("copies"))
    once = stored(once, "turns")
    order = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    several = once.groupBy("conv", "mark").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_turns")).where("_turns > 1")
    seen = several.select(F.col("conv").alias("_conv"), F.col("mark").alias("_mark"), "_first")
    marked = once.join(seen, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("mark") == F.col("_mark")), "left")
    marked = marked.select("conv", "turn", "mark", "initial", "fault", "copies", F.coalesce(order > F.col("_first"), F.lit(False)).alias("later"))
    schema = _fields(conv_type, _SEGMENT)
    arrow = _as_arrow(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            here, at = None, TaskContext.get().partitionId()
            for conv, turn, _, initial, fault, copies, later in _tuples(parts):
                if here is None or here.conv != conv:
                    if here is not None:
                        yield here.row(at)
                    here = _Stretch(conv)
                here.add(turn, initial, fault, copies, later)
            if here is not None:
                yield here.row(at)

        yield from _batches(rows(), arrow, 4096)

    in_order = marked.repartitionByRange("conv", "turn", "mark").sortWithinPartitions("conv", "turn", "mark")
    return in_order.mapInArrow(run, schema)


def plans(cut: DataFrame) -> DataFrame:
    """(conv, part, edits, cost, state): the edits of each of the stored ``segments``, and the state they end in."""
    conv_type = cut.schema["conv"].dataType
    way = _fields(conv_type, "part int, enter int, leave int")
    plan = _fields(conv_type, "part int, edits string, cost bigint, state int")
    way_arrow, plan_arrow = _as_arrow(way), _as_arrow(plan)

    def route(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv, stretches in _tuples(parts):
                for stretch, (enter, leave) in zip(stretches, routes([_table(x["costs"]) for x in stretches])):
                    yield conv, stretch["part"], enter, leave

        yield from _batches(rows(), way_arrow)

    def solve(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}

        def rows():
            for conv, part, codes, enter, leave in _tuples(parts):
                found = known.get((codes, enter, leave))
                if found is None:
                    found = stretch_edits(codes, enter, tuple(0 if s == leave else FAR for s in range(4)))
                    if len(codes) < 64 and len(known) < 100_000:
                        known[codes, enter, leave] = found
                yield conv, part, *found

        yield from _batches(rows(), plan_arrow, 4096)

    of_conv = cut.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "costs"))).alias("stretches"))  # at most one for each task
    ways = of_conv.mapInArrow(route, way).select(F.col("conv").alias("_conv"), F.col("part").alias("_part"), "enter", "leave")
    met = cut.select("conv", "part", "codes").join(ways, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
    return met.select("conv", "part", "codes", "enter", "leave").mapInArrow(solve, plan)


_AUDIT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_COUNTED = ("turns", "blank", "duplicate", "truncated", "illegal", "opens", "closes", "low", "high", "numbers")


class _Conversation:
    """The sums over a conversation's stretches, and its edits."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.numbers = 0
        self.closes = self.low = self.high = None
        self.edits: list[str] = []

    def add(self, piece: dict) -> None:
        self.blank += piece["blank"]
        self.duplicate += piece["duplicate"]
        self.truncated += piece["truncated"]
        self.illegal += piece["illegal"] + (self.closes is not None and (self.closes, piece["opens"]) not in _LEGAL)
        self.closes = piece["closes"]
        if piece["low"] is not None:
            self.numbers += piece["numbers"] - (piece["low"] == self.high)
            self.low, self.high = piece["low"] if self.low is None else self.low, piece["high"]
        self.cost += piece["cost"]
        self.edits.append(piece["edits"])
        self.state = piece["state"]

    def finish(self) -> None:
        if self.edits:
            self.edits.append(END_EDITS[self.state])
            self.cost += END_COST[self.state]
        self.gaps = 0 if self.low is None else self.high - self.low + 1 - self.numbers


def _beside_turns(turns: DataFrame, every: DataFrame) -> DataFrame:
    """Each conversation's pieces, and after them its turns in order, conversation by conversation.

    (conv, kind, piece, role, text); kind 0 says that a conversation is there, 1 is a piece, 2 a turn.
    """
    cut = stored(segments(turns), "segments")
    pieces = cut.drop("codes", "costs").join(
        stored(plans(cut), "plans").select(F.col("conv").alias("_conv"), F.col("part").alias("_part"), "edits", "cost", "state"),
        F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")),
    )
    piece = pieces.select("conv", F.lit(1).alias("kind"), F.struct("part", "edits", "cost", "state", *_COUNTED).alias("piece"))
    there = every.groupBy("conv").agg(F.lit(0).alias("kind"))
    both = there.unionByName(piece, allowMissingColumns=True).unionByName(turns.select("conv", F.lit(2).alias("kind"), "turn", "mark", "role", "text"), allowMissingColumns=True)
    # one exchange; a conversation streams through its task and is never held there
    in_order = both.repartition("conv").sortWithinPartitions("conv", "kind", "piece.part", "turn", "mark")
    return in_order.select("conv", "kind", "piece", "role", "text")


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple[object, _Conversation, Iterator[tuple[str, str]]]]:
    """(conv, sums and edits, its turns); the turns have to be read before the next conversation is asked for."""
    row = next(rows, None)
    while row is not None:
        conv, whole, kind = row[0], _Conversation(), row[1]
        while row is not None and row[0] == conv and row[1] < 2 and row[1] >= kind:
            kind = row[1]
            if kind:
                whole.add(row[2])
            row = next(rows, None)
        whole.finish()

        def turns():
            nonlocal row
            while row is not None and row[0] == conv and row[1] == 2:
                role, text = row[3], row[4]
                row = next(rows, None)
                yield role, text

        left = turns()
        yield conv, whole, left
        for _ in left:
            pass


def repair(turns: DataFrame, every: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, position, edit, role, text): the turns of every repaired conversation in order, without what was deleted."""
    rows = coded(turns, conv, turn, role, text)
    schema = _fields(rows.schema["conv"].dataType, "position bigint, edit string, role string, text string")
    arrow = _as_arrow(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for name, whole, left in _conversations(_tuples(parts)):
                position = 0
                for edit, as_role, as_text in edited((e for piece in whole.edits for e in piece), left):
                    if edit != "D":
                        yield name, position, edit, as_role, as_text
                        position += 1

        yield from _batches(out(), arrow, 4096)

    there = rows if every is None else every.select(F.col(conv).alias("conv"))
    return _beside_turns(rows, there).mapInArrow(run, schema)


def audit(turns: DataFrame, every: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: gaps in turn numbers, faults, the edits and their cost, and the digest of the repaired text.

    ``every`` names conversations that may have no turns left; they get a row too.
    """
    rows = coded(turns, conv, turn, role, text)
    schema = _fields(rows.schema["conv"].dataType, _AUDIT)
    arrow = _as_arrow(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for name, whole, left in _conversations(_tuples(parts)):
                digest, between = hashlib.sha256(), ""
                for edit, as_role, as_text in edited((e for piece in whole.edits for e in piece), left):
                    if edit != "D":
                        digest.update(f"{between}{as_role}:{as_text}".encode())
                        between = "\n"
                yield name, whole.gaps, whole.blank, whole.duplicate, whole.truncated, whole.illegal, whole.cost, "".join(whole.edits), digest.hexdigest()

        yield from _batches(out(), arrow, 4096)

    there = rows if every is None else every.select(F.col(conv).alias("conv"))
    return _beside_turns(rows, there).mapInArrow(run, schema)
