"""Conversation structure repair by Knuth's lightest derivations.

A repaired conversation is a sequence of turns whose role initials read ``(s?(ua)+)?``.
Items of a weighted hypergraph are runs of turns together with the states of that
pattern before and after them. Editing one turn derives a longer run, joining two
neighbouring runs derives their union; both weights, (cost, audit), grow and keep their
order under these functions, so an agenda that pops the least item first finalises each
item at its lightest derivation and may stop at the goal.

Turns are ranged by conversation and place, without their texts. A task derives each
conversation it holds whole; of one that goes over its ends it derives the runs it has,
between all states, and only these are joined by conversation. A long conversation is thus
spread over as many tasks as its turns need. Last, the texts are streamed past their
conversation's audit in order, one turn held at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from terralode.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# States of the pattern: nothing yet, after s, after u, after a. Which initial leads where.
STEPS: list[dict[str, int]] = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
GOALS = (0, 3)
# The state after a turn that was given the role the pattern asks for, and that role.
NEXT = [2, 2, 3, 2]
GIVEN = ["user", "user", "assistant", "user"]
NEIGHBOURS = ("su", "ua", "au")

KEEP, REROLE, DELETE, INSERT, TRUNCATED_COST = 0, 2, 3, 2, 1
# Faults of a turn, as its row tells them.
FINE, BLANK, TRUNCATED, DUPLICATE = range(4)
# Turns of a run that is derived at once between all states.
RUN = 64
# Parts a repeated turn's group is dealt into.
SALTS = 16

BLANKS = " \t\n\x0b\x0c\r"
Weight = tuple[int, str]
# The lightest weight from state to state over a run.
Table = dict[tuple[int, int], Weight]


def derive(turns: list[tuple[int, str, int]], start: int, to_goal: bool) -> dict[int, Weight]:
    """Lightest weights over ``turns`` from a state, by the state after them; with ``to_goal`` only the best accepting one.

    A turn is fault, role initial and number of copies; of a turn that must go all copies do.
    """
    done: set[tuple[int, int]] = set()
    found: dict[int, Weight] = {}
    agenda = [(0, "", 0, start)]
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(turns):
            if not to_goal:
                found[state] = (cost, audit)
            elif state in GOALS:
                return {state: (cost, audit)}
        else:
            fault, initial, copies = turns[at]
            if fault in (BLANK, DUPLICATE):
                heapq.heappush(agenda, (cost + DELETE * copies, audit + "D" * copies, at + 1, state))
            else:
                extra = TRUNCATED_COST if fault == TRUNCATED else 0
                heapq.heappush(agenda, (cost + DELETE, audit + "D", at + 1, state))
                heapq.heappush(agenda, (cost + REROLE + extra, audit + "R", at + 1, NEXT[state]))
                if initial in STEPS[state]:
                    heapq.heappush(agenda, (cost + KEEP + extra, audit + "K", at + 1, STEPS[state][initial]))
        heapq.heappush(agenda, (cost + INSERT, audit + "I", at, NEXT[state]))
    return found


def table_of(turns: list[tuple[int, str, int]]) -> Table:
    return {(p, q): weight for p in range(len(STEPS)) for q, weight in derive(turns, p, False).items()}


def join(left: Table, right: Table) -> Table:
    """Lightest weights over two neighbouring runs: each hyperedge joins an item of either side."""
    ends: dict[int, list[tuple[int, Weight]]] = {}
    for (q, r), weight in right.items():
        ends.setdefault(q, []).append((r, weight))
    agenda = [(weight, p, q, False) for (p, q), weight in left.items()]
    heapq.heapify(agenda)
    done: Table = {}
    while agenda:
        (cost, audit), p, at, joined = heapq.heappop(agenda)
        if not joined:
            for r, (more, rest) in ends.get(at, ()):
                if (p, r) not in done:
                    heapq.heappush(agenda, ((cost + more, audit + rest), p, r, True))
        elif (p, at) not in done:
            done[p, at] = (cost, audit)
    return done


class Run:
    """What is known of neighbouring turns of one conversation."""

    NAMES = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")

    def __init__(self, counts: Iterable = (0, 0, 0, 0, 0, 0, None, None, None, None), table: Table | None = None):
        for name, value in zip(self.NAMES, counts):
            setattr(self, name, value)
        self.table = table
        self.open: list[tuple[int, str, int]] = []
        self.tables: list[tuple[int, Table]] = []

    def counts(self) -> list:
        return [getattr(self, name) for name in self.NAMES]

    def meet(self, n: int, illegal: int, turns: int, low, high, first, last) -> None:
        """Take in the counts of what comes next."""
        if n == 0:
            return
        if self.n and self.last + first not in NEIGHBOURS:
            self.illegal += 1
        self.illegal += illegal
        self.turns += turns - (1 if low is not None and low == self.high else 0)
        self.low = low if self.low is None else self.low
        self.high = high if high is not None else self.high
        self.first = first if self.n == 0 else self.first
        self.last = last
        self.n += n

    def add(self, turn: int | None, role: str, fault: int, later: bool, copies: int) -> None:
        """Take in a turn and its copies; ``later`` where role and text stood before."""
        initial = role[:1]
        self.meet(copies, copies - 1, 0 if turn is None else 1, turn, turn, initial, initial)
        if fault == BLANK:
            self.blank += copies
            self.open.append((BLANK, initial, copies))
        elif later:
            self.duplicate += copies
            self.open.append((DUPLICATE, initial, copies))
        else:
            self.truncated += fault == TRUNCATED
            self.open.append((fault, initial, 1))
            if copies > 1:
                self.duplicate += copies - 1
                self.open.append((DUPLICATE, initial, copies - 1))
        if len(self.open) >= RUN:
            self.fold()

    def fold(self) -> None:
        """Derive the open turns between all states; joined like carries of a counter, so that audits are copied few times."""
        if self.open:
            self.tables.append((1, table_of(self.open)))
            self.open = []
            while len(self.tables) > 1 and self.tables[-2][0] <= self.tables[-1][0]:
                (n, a), (m, b) = self.tables[-2:]
                self.tables[-2:] = [(n + m, join(a, b))]

    def close(self) -> Table:
        self.fold()
        while len(self.tables) > 1:
            (n, a), (m, b) = self.tables[-2:]
            self.tables[-2:] = [(n + m, join(a, b))]
        return self.tables[0][1] if self.tables else table_of([])

    def best(self) -> Weight:
        """Weight of the whole conversation."""
        if self.table is None and not self.tables:
            return next(iter(derive(self.open, 0, True).values()))
        table = self.table or self.close()
        return min(table[0, q] for q in GOALS if (0, q) in table)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def plan_fields(kind: pa.DataType) -> list[tuple[str, pa.DataType]]:
    return [("conv_id", kind), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())]


PLAN_NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
PLAN = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
TABLE = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
PART_NAMES = ["part", "nth", *(f"run_{name}" for name in Run.NAMES), "weights"]
PART_KINDS = [pa.int32(), *[pa.int64()] * 9, pa.string(), pa.string(), TABLE]
PART_TYPES = ["int", *["bigint"] * 9, "string", "string", "array<struct<p: int, q: int, cost: bigint, audit: string>>"]
PART = ", ".join(f"{name} {kind}" for name, kind in zip(PART_NAMES, PART_TYPES))


def plan_row(conv, run: Run) -> list:
    cost, audit = run.best()
    return [conv, run.gaps(), run.blank, run.duplicate, run.truncated, run.illegal, cost, audit]


def run_deriver(kind: pa.DataType):
    """Whole conversations' plans, and the runs of those that may go on in a neighbouring task."""
    fields = [*plan_fields(kind), *zip(PART_NAMES, PART_KINDS)]

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, rows, size = TaskContext.get().partitionId(), 0, [], 0
        conv, held = None, None
        nothing = [None] * len(PART_NAMES)

        def as_part() -> list:
            table = held.close()
            weights = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in table.items()]
            return [conv, *[None] * 7, part, nth, *held.counts(), weights]

        for batch in batches:
            for new, gone, turn, role, fault, later, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or new != conv:
                    if held is not None:
                        rows.append(as_part() if nth == 0 else [*plan_row(conv, held), *nothing])
                        size += held.n
                        nth += 1
                    conv, held = new, Run()
                if not gone:
                    held.add(turn, role, fault, later, copies)
            if len(rows) > 4096 or size > 1 << 20:
                yield batch_of(rows)
                rows, size = [], 0
        if held is not None:
            rows.append(as_part())
        yield batch_of(rows)

    return run


def run_joiner(kind: pa.DataType):
    """One conversation's runs, in order, to its plan."""
    fields = plan_fields(kind)

    def plan(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("nth", "ascending")])
        whole, tables = Run(), []
        for row in table.to_pylist():
            whole.blank += row["run_blank"]
            whole.duplicate += row["run_duplicate"]
            whole.truncated += row["run_truncated"]
            whole.meet(*(row[f"run_{name}"] for name in ("n", "illegal", "turns", "low", "high", "first", "last")))
            tables.append({(w["p"], w["q"]): (w["cost"], w["audit"]) for w in row["weights"]})
        while len(tables) > 1:
            tables = [join(*pair) if len(pair) > 1 else pair[0] for pair in (tables[i : i + 2] for i in range(0, len(tables), 2))]
        whole.table = tables[0]
        row = plan_row(table["conv_id"][0].as_py(), whole)
        return pa.table([pa.array([v], k) for v, (_, k) in zip(row, fields)], names=[n for n, _ in fields])

    return plan


def turn_columns(turns: DataFrame) -> DataFrame:
    """The columns that are used, nulls of role and text as one space."""
    return turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def text_key() -> Column:
    return F.unhex(F.md5("text")).alias("text_key")


def fault_of_text() -> Column:
    body = F.rtrim("text", F.lit(BLANKS))
    ended = body.endswith(".") | body.endswith("!") | body.endswith("?")
    return F.when(body == "", BLANK).when(ended, FINE).otherwise(TRUNCATED)


def place_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text_key").asc()]


def lightest_repairs(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation.

    ``turns`` has ``conv_id, turn, role, text``; ``ids`` names conversations that may have no
    turns, whose row has zeros and an empty audit. A conversation's turns stand by ``turn``,
    nulls first; those of one turn by role and then by their text's checksum, equal ones next to
    each other. A null role or text is one space; turns without conv_id are one conversation.

    Each turn's first fault counts: blank (only ASCII blanks), duplicate (role and text seen
    earlier), truncated (last other character none of ``.!?``). ``gaps`` are missing whole
    numbers between the least and the largest turn, ``illegal`` neighbours whose initials are
    not su, ua or au. ``audit`` has the initials of the cheapest edits in order: Keep costs 0,
    Rerole to user or assistant 2, Delete 3 (the only one for blank and duplicate turns), Insert
    of an empty user or assistant turn 2, and a truncated turn that stays 1 more; of equal costs
    the least text. An empty table gives no rows. Other columns are ignored.
    """
    kind = turns.schema["conv_id"].dataType
    light = turn_columns(turns).select("conv_id", F.lit(False).alias("gone"), "turn", "role", text_key(), fault_of_text().alias("fault"))
    merged = light.groupBy("conv_id", "gone", "turn", "role", "text_key", "fault").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    repeated = (
        merged.groupBy("conv_id", "role", "text_key")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .where(~F.col("low").eqNullSafe(F.col("high")))
        .select("conv_id", "role", "text_key", "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    m, r = merged.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")).alias("m"), repeated.alias("r")
    same = F.col("m.conv_id").eqNullSafe(F.col("r.conv_id"))
    for name in ("role", "text_key", "salt"):
        same = same & (F.col(f"m.{name}") == F.col(f"r.{name}"))
    own = F.struct(F.col("m.turn").isNotNull().alias("known"), F.col("m.turn").alias("turn"))
    later = F.col("r.low").isNotNull() & ~own.eqNullSafe(F.col("r.low"))
    flagged = m.join(r, same, "left").select("m.conv_id", "gone", "m.turn", "m.role", "m.text_key", "fault", later.alias("later"), "copies")
    if ids is not None:
        none = ids.select("conv_id").distinct().select(
            F.col("conv_id").cast(kind),
            F.lit(True).alias("gone"),
            F.lit(None).cast("bigint").alias("turn"),
            F.lit("").alias("role"),
            F.lit(None).cast("binary").alias("text_key"),
            F.lit(FINE).alias("fault"),
            F.lit(False).alias("later"),
            F.lit(0).cast("bigint").alias("copies"),
        )
        flagged = flagged.unionByName(none)
    order = [F.col("conv_id").asc_nulls_first(), F.col("gone").desc(), *place_order()]
    ranged = flagged.repartitionByRange(*order).sortWithinPartitions(*order).drop("text_key")
    plan = f"conv_id {kind.simpleString()}, {PLAN}"
    found = saved(ranged.mapInArrow(run_deriver(to_arrow_type(kind)), f"{plan}, {PART}"), "runs")
    whole = found.where("part is null").select("conv_id", *PLAN_NAMES)
    runs = found.where("part is not null").select("conv_id", *PART_NAMES)
    return whole.union(runs.groupBy("conv_id").applyInArrow(run_joiner(to_arrow_type(kind)), plan))


def streamer(kind: pa.DataType, fields: list[tuple[str, pa.DataType]], emit: Callable):
    """Passes each conversation's turns by its audit, in order, and yields what ``emit`` makes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        maker = None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv, role, text, plan in zip(*columns):
                if plan is not None:
                    if maker is not None:
                        rows += maker.end()
                    maker = emit(conv, plan)
                else:
                    made = maker.turn(role, text)
                    rows += made
                    size += sum(len(x[-1] or "") for x in made)
                if len(rows) >= 4096 or size > 1 << 24:
                    yield to_batch(rows)
                    rows, size = [], 0
        if maker is not None:
            rows += maker.end()
        yield to_batch(rows)

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])

    return run


class Edited:
    """The turns an audit makes of a conversation's, as ``role, text, edit``."""

    def __init__(self, conv, plan: dict):
        self.conv, self.plan, self.audit = conv, plan, plan["audit"]
        self.at = self.state = 0

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self.give(), "", "I"

    def give(self) -> str:
        role, self.state = GIVEN[self.state], NEXT[self.state]
        return role

    def edits(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = STEPS[self.state][role[:1]]
            yield role, text, "K"
        elif letter == "R":
            yield self.give(), text, "R"


class TurnMaker(Edited):
    """Rows ``conv_id, place, role, edit, text`` of the repaired conversation."""

    place = 0

    def rows(self, edits: Iterable[tuple[str, str, str]]) -> list[tuple]:
        out = []
        for role, text, edit in edits:
            out.append((self.conv, self.place, role, edit, text))
            self.place += 1
        return out

    def turn(self, role: str, text: str) -> list[tuple]:
        return self.rows(self.edits(role, text))

    def end(self) -> list[tuple]:
        return self.rows(self.inserts())


class DigestMaker(Edited):
    """One row: the plan and the checksum of the repaired ``role:text`` lines."""

    def __init__(self, conv, plan: dict):
        super().__init__(conv, plan)
        self.sha, self.empty = hashlib.sha256(), True

    def feed(self, edits: Iterable[tuple[str, str, str]]) -> None:
        for role, text, _ in edits:
            self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def turn(self, role: str, text: str) -> list[tuple]:
        self.feed(self.edits(role, text))
        return []

    def end(self) -> list[tuple]:
        self.feed(self.inserts())
        return [(self.conv, *(self.plan[n] for n in PLAN_NAMES), self.sha.hexdigest())]


def passed_by(turns: DataFrame, plans: DataFrame, fields: list[tuple[str, pa.DataType]], ddl: str, emit: Callable) -> DataFrame:
    """Each conversation's plan and then its turns, in order, through ``emit``: sorted on disk, held one by one.

    The repaired text of a conversation is one sequence, so one task passes it, whatever its length.
    """
    kind = turns.schema["conv_id"].dataType
    plan = f"struct<{', '.join(c.replace(' ', ': ') for c in PLAN.split(', '))}>"
    texts = turn_columns(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", text_key(), "text", F.lit(None).cast(plan).alias("plan"))
    heads = plans.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("text_key"),
        F.lit(None).cast("string").alias("text"),
        F.struct(*PLAN_NAMES).cast(plan).alias("plan"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("kind").asc(), *place_order()]
    both = texts.union(heads).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text", "plan")
    return both.mapInArrow(streamer(to_arrow_type(kind), fields, emit), f"conv_id {kind.simpleString()}, {ddl}")


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, place, role, edit, text`` of every turn that the plans of ``lightest_repairs`` leave or insert; edits are K, R and I."""
    fields = [("conv_id", to_arrow_type(turns.schema["conv_id"].dataType)), ("place", pa.int64()), ("role", pa.string()), ("edit", pa.string()), ("text", pa.string())]
    return passed_by(turns, plans, fields, "place bigint, role string, edit string, text string", TurnMaker)


def digest(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans with ``repaired_sha256``, of the repaired ``role:text`` joined by line ends."""
    fields = [*plan_fields(to_arrow_type(turns.schema["conv_id"].dataType)), ("repaired_sha256", pa.string())]
    return passed_by(turns, plans, fields, f"{PLAN}, repaired_sha256 string", DigestMaker)
