"""Repair of conversation structure by iterative-deepening A*.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``: a system turn at most, then user and assistant in turns. The
repair is the cheapest sequence of edits, of equally cheap ones that whose
initials are least in ASCII: D(elete) 3, I(nsert) an empty user or assistant
turn 2, K(eep) 0, R(erole) to user or assistant 2. Blank turns and repetitions
of an earlier turn (role and text) must be deleted; a truncated turn (it does
not end in ``.``, ``!`` or ``?``) that stays costs 1 more. In every state of
the pattern only one role may follow a non-system edit, so the initials alone
name the repair.

Search: depth first in the order D, I, K, R, under a cost bound that starts
at an admissible estimate and grows by one. The first accepting path is the
answer. The estimate adds what each turn costs at least and one for every
neighbouring pair that cannot stand (an edit of extra cost 2 or 3 mends two
such pairs at most). A table keeps, for a place and state, the largest budget
that failed there; it stays valid when the bound grows.

Two passes. The first works on narrow rows: initials, faults and a digest of
each text. They are range-partitioned and sorted in conversation order, and
each task searches the conversations that lie whole in it. A conversation
that crosses a partition, or is longer than a block, is cut into blocks; a
block is searched from every state to every state, and the tables of costs
are chained by rounds of ``fan`` neighbours, so one conversation may hold any
share of all rows. The second pass sorts the whole texts by conversation and
applies the edits as a stream, with one turn in memory at a time; only there
a conversation is bound to one task, because its checksum is sequential.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.llm.common import landed, worker_cache

# States of the pattern: before anything, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT_ROLE = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
DELETE, INSERT, REROLE, TRUNCATED_KEPT = 3, 2, 2, 1
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

BLOCK = 64
FAN = 64
KEPT_SHAPES = 100_000  # answers kept a worker, for conversations of at most SHAPE_TURNS turns
SHAPE_TURNS = 16
SPACES = " \t\n\x0b\x0c\r"


class Search:
    """Repairs of a row of turns, given as (initial, must be deleted, truncated), towards ``goals``."""

    def __init__(self, turns: list[tuple[str, bool, bool]], goals: tuple[int, ...], trailing: bool):
        self.turns, self.goals, self.trailing = turns, goals, trailing
        n = len(turns)
        self.least = [0] * (n + 1)
        following = None  # initial of the next turn that may stay
        for i in range(n - 1, -1, -1):
            initial, forced, cut = turns[i]
            self.least[i] = self.least[i + 1] + (DELETE if forced else cut * TRUNCATED_KEPT)
            if not forced:
                if following is not None and initial + following not in LEGAL_PAIRS:
                    self.least[i] += 1
                following = initial
        self.failed: dict[tuple[int, int], int] = {}

    def estimate(self, at: int, state: int) -> int | None:
        """A lower bound of the cost from here; None: no goal can be reached."""
        left = len(self.turns) - at
        if self.goals == (START,):
            return DELETE * left if state == START else None
        if self.goals == (SYSTEM,):
            if state > SYSTEM:
                return None
            return DELETE * (left if state == SYSTEM else left - 1) if left or state == SYSTEM else None
        return self.least[at]

    def cheapest(self, entry: int) -> tuple[int, str] | None:
        """Cost and edits of the first accepting path under the least bound that has one."""
        bound = self.estimate(0, entry)
        if bound is None:
            return None
        # Deleting everything and at most two inserted turns reach any goal that can be reached.
        last = DELETE * len(self.turns) + 2 * INSERT + TRUNCATED_KEPT
        while bound <= last:
            path: list[str] = []
            if self._descend(0, entry, bound, path):
                return bound, "".join(reversed(path))
            bound += 1
        return None

    def _descend(self, at: int, state: int, budget: int, path: list[str]) -> bool:
        """Whether a path of at most ``budget`` leads to a goal; ``path`` gets its edits, last first."""
        if at == len(self.turns) and state in self.goals:
            return True
        least = self.estimate(at, state)
        if least is None or least > budget or self.failed.get((at, state), -1) >= budget:
            return False
        role = NEXT_ROLE[state]
        if at < len(self.turns):
            initial, forced, cut = self.turns[at]
            extra = cut * TRUNCATED_KEPT
            steps = [("D", at + 1, state, DELETE), ("I", at, role, INSERT)]
            if not forced:
                if (initial, state) in KEPT:
                    steps.append(("K", at + 1, KEPT[initial, state], extra))
                steps.append(("R", at + 1, role, REROLE + extra))
        else:
            steps = [("I", at, role, INSERT)] if self.trailing else []
        for letter, then, after, cost in steps:
            if cost <= budget and self._descend(then, after, budget - cost, path):
                path.append(letter)
                return True
        self.failed[at, state] = budget
        return False


def whole_repair(turns: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cost and edits of the best repair of a conversation."""
    if len(turns) > SHAPE_TURNS:
        return Search(turns, ENDS, True).cheapest(START)
    known = worker_cache("turn shapes", dict)
    key = tuple(turns)
    if key not in known:
        if len(known) >= KEPT_SHAPES:
            known.clear()
        known[key] = Search(turns, ENDS, True).cheapest(START)
    return known[key]


def block_repairs(turns: list[tuple[str, bool, bool]]) -> list[tuple[int, str] | None]:
    """Best edits of a block from each state (rows) to each state (columns); inserts only before a turn."""
    found: list = [None] * 16
    for goal in range(4):
        search = Search(turns, (goal,), False)
        for entry in range(4):
            if goal == START != entry or goal == SYSTEM < entry:
                continue
            found[4 * entry + goal] = search.cheapest(entry)
    return found


def chained(a: list, b: list) -> list:
    """The table of two neighbouring blocks: the cheapest way through, then the least edits."""
    return [
        min(
            ((a[4 * i + k][0] + b[4 * k + j][0], a[4 * i + k][1] + b[4 * k + j][1])
             for k in range(4) if a[4 * i + k] and b[4 * k + j]),
            default=None,
        )
        for i in range(4) for j in range(4)
    ]


def closed(table: list) -> tuple[int, str]:
    """Best repair of a conversation whose blocks make up ``table``: the end may insert turns."""
    inserts = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    return min(
        (table[goal][0] + INSERT * k, table[goal][1] + "I" * k) for goal, k in inserts.items() if table[goal]
    )


COUNTS = ("turns_seen", "blank", "duplicate", "truncated", "illegal")
PIECE = (
    "conv_id long, part long, serial long, whole boolean, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", min_turn long, max_turn long, first_turn long, last_turn long, first_initial string, last_initial string, "
    "costs array<long>, edits array<string>"
)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Piece:
    """Consecutive turns of one conversation and what is known of them."""

    def __init__(self, conv_id, part: int, serial: int):
        self.conv_id, self.part, self.serial = conv_id, part, serial
        self.turns: list[tuple[str, bool, bool]] = []
        self.turns_seen = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.min_turn = self.max_turn = self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = None
        self.costs, self.edits = [], []

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if self.last_initial is None:
            self.first_turn, self.first_initial = turn, initial
        else:
            self.illegal += self.last_initial + initial not in LEGAL_PAIRS
        if turn is not None:
            self.turns_seen += self.max_turn is None or turn != self.last_turn
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn
        self.last_turn, self.last_initial = turn, initial
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == TRUNCATED
        self.turns.append((initial, fault in (BLANK, DUPLICATE), fault == TRUNCATED))

    def solve(self, whole: bool) -> dict:
        found = [whole_repair(self.turns)] if whole else block_repairs(self.turns)
        self.costs = [f and f[0] for f in found]
        self.edits = [f and f[1] for f in found]
        return {k: v for k, v in self.__dict__.items() if k != "turns"} | {"whole": whole}


def _table(piece: dict) -> list:
    return [None if c is None else (c, e) for c, e in zip(piece["costs"], piece["edits"], strict=True)]


def _joined(a: dict, b: dict) -> dict:
    """Two neighbouring pieces as one."""
    if a["first_initial"] is None or b["first_initial"] is None:
        return a if b["first_initial"] is None else b
    out = a | {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += a["last_initial"] + b["first_initial"] not in LEGAL_PAIRS
    if b["first_turn"] is not None and a["last_turn"] == b["first_turn"]:
        out["turns_seen"] -= 1
    turns = [x for x in (a["min_turn"], a["max_turn"], b["min_turn"], b["max_turn"]) if x is not None]
    out["min_turn"], out["max_turn"] = min(turns, default=None), max(turns, default=None)
    out["last_turn"], out["last_initial"] = b["last_turn"], b["last_initial"]
    table = chained(_table(a), _table(b))
    out["costs"], out["edits"] = [t and t[0] for t in table], [t and t[1] for t in table]
    return out


def _frame(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def plain_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (null: one space) and the text's digest; other columns go."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role"), filled("text")
    )
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)))


def faults(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, turn, role, digest, initial, fault, copies: one row for equal turns of a conversation.

    ``fault`` is that of the first copy; the other ``copies`` are duplicates
    (or blank). ``ids``: conversations that appear even without a turn
    (copies 0). Only narrow columns are shuffled, and equal turns are added up
    before.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    own = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    narrow = turns.select("conv_id", "turn", "role", "digest", own.alias("fault"), F.lit(1).cast("long").alias("copies"))
    if ids is not None:
        none = {"turn": F.lit(None).cast("long"), "role": F.lit(""), "digest": F.lit(b""), "fault": F.lit(NONE),
                "copies": F.lit(0).cast("long")}
        narrow = narrow.unionByName(ids.select(F.col("conv_id").cast("long").alias("conv_id"),
                                               *[c.alias(n) for n, c in none.items()]))
    same = narrow.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("copies"))
    # The first turn that holds a role and text; null turns come first.
    later = (
        same.filter("copies > 0").groupBy(F.col("conv_id").alias("k"), F.col("role").alias("r"), F.col("digest").alias("d"))
        .agg(F.count("*").alias("places"), F.min("turn").alias("least"), F.count_if(F.col("turn").isNull()).alias("nulls"))
        .filter("places > 1")
    )
    repeated = (F.col("places").isNotNull() & F.col("turn").isNotNull()
                & ((F.col("nulls") > 0) | (F.col("turn") > F.col("least"))))
    return (
        same.join(later, F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("role") == F.col("r"))
                  & (F.col("digest") == F.col("d")), "left")
        .select(
            "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"),
            F.when((F.col("fault") != BLANK) & repeated, DUPLICATE).otherwise(F.col("fault")).alias("fault"), "copies",
        )
    )


def _pieces(faulty: DataFrame, block: int) -> DataFrame:
    """Pieces of the conversations in order: whole ones solved, others as blocks."""
    schema = _arrow(PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        piece, out, opened = None, [], False  # opened: the conversation may have begun in another task, or is long

        for batch in batches:
            for conv_id, turn, initial, fault, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece is None:
                    piece, opened = Piece(conv_id, part, 0), True
                elif conv_id != piece.conv_id:
                    out.append(piece.solve(not opened))
                    piece, opened = Piece(conv_id, part, 0), False
                for copy in range(copies):
                    if len(piece.turns) == block:
                        out.append(piece.solve(False))
                        piece, opened = Piece(conv_id, part, piece.serial + 1), True
                    piece.add(turn, initial, fault if copy == 0 or fault == BLANK else DUPLICATE)
                    if len(out) >= 1000:
                        yield _frame(out, schema)
                        out = []
        if piece is not None:
            out.append(piece.solve(False))
        if out:
            yield _frame(out, schema)

    order = ["conv_id", "turn", "role", "digest"]
    return (
        faulty.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "turn", "initial", "fault", "copies").mapInArrow(run, PIECE)
    )


def audits(conversations: DataFrame, ids: DataFrame | None = None, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row per conversation: gaps, faults, illegal pairs, cost and initials of its repair.

    Turns are ordered by ``turn`` (nulls first), then role, then the text's
    SHA-256, so repeated turn numbers have a fixed order. Null role or text:
    one space. An empty role can only be deleted or given another role. A null
    conv_id is a conversation like any other. ``ids`` adds conversations
    without a turn: zeros and empty edits. Empty table: no rows.
    """
    pieces = landed(_pieces(faults(plain_turns(conversations), ids), block), "turn-pieces")
    whole = pieces.filter("whole").select("*", F.col("costs")[0].alias("cost"), F.col("edits")[0].alias("audit"))
    parts = pieces.filter("NOT whole")
    for column in ("serial", "part"):
        last = parts.agg(F.max(column)).first()[0] or 0
        while last:
            parts, last = landed(_round(parts, column, fan), "turn-chain"), last // fan
    columns = RESULT.replace("gaps long, ", "turns_seen long, min_turn long, max_turn long, ")
    schema = _arrow(columns)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["cost"], r["audit"] = closed(_table(r))
            if rows:
                yield _frame(rows, schema)

    joined = parts.mapInArrow(close, columns)
    every = whole.select(*joined.columns).unionByName(joined)
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns_seen"), F.lit(0))
    return every.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _round(parts: DataFrame, column: str, fan: int) -> DataFrame:
    """Pieces whose numbers in ``column`` fall into one run of ``fan`` are joined in order."""
    schema = _arrow(PIECE)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["near"]).to_pylist(), key=lambda p: (p["part"], p["serial"]))
        out = rows[0]
        for other in rows[1:]:
            out = _joined(out, other)
        out[column] //= fan
        return pa.Table.from_batches([_frame([out], schema)])

    key = ["conv_id", "near"] if column == "part" else ["conv_id", "part", "near"]
    near = F.floor(F.col(column) / fan).cast("long")
    return parts.withColumn("near", near).groupBy(*key).applyInArrow(run, PIECE)


def _edited(conversations: DataFrame, plans: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over (head, plan) and (turn) rows of each conversation in order; texts are shuffled once."""
    turns = plain_turns(conversations).select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", F.lit(None).cast("string").alias("audit"))
    heads = plans.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(b"").alias("digest"), F.lit("").alias("text"), "audit")
    return (
        heads.unionByName(turns).repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
        .select("conv_id", "kind", "turn", "role", "text", "audit").mapInArrow(run, schema)
    )


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, None, None, None, edits) where a conversation begins, then (conv_id, edit, turn, role, text) of its repaired turns."""
    conv_id, audit, at, state = None, "", 0, START

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, NEXT_ROLE[state]
            yield conv_id, "I", None, ROLE[state], ""

    for batch in batches:
        for conv_id_, kind, turn, role, text, plan in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                yield from inserted()
                conv_id, audit, at, state = conv_id_, plan, 0, START
                yield conv_id, None, None, None, plan
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = KEPT[role[:1], state]
                yield conv_id, "K", turn, role, text
            elif edit == "R":
                state = NEXT_ROLE[state]
                yield conv_id, "R", turn, ROLE[state], text
    yield from inserted()


REPAIRED = "conv_id long, place long, edit string, turn long, role string, text string"


def repair(conversations: DataFrame, plans: DataFrame | None = None, **options) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit (I, K or R), the turn it was, role, text.

    Deleted turns are left out. Faults, order and nulls as in ``audits``.
    """
    schema = _arrow(REPAIRED)
    plans = landed(audits(conversations, **options), "turn-plans") if plans is None else plans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, place = [], 0
        for conv_id, edit, turn, role, text in _applied(batches):
            if edit is None:
                place = 0
                continue
            rows.append({"conv_id": conv_id, "place": place, "edit": edit, "turn": turn, "role": role, "text": text})
            place += 1
            if len(rows) >= 1000:
                yield _frame(rows, schema)
                rows = []
        if rows:
            yield _frame(rows, schema)

    return _edited(conversations, plans, run, REPAIRED)


def digests(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, audit and the SHA-256 of the repaired ``role:text`` lines of every conversation in ``plans``."""
    columns = "conv_id long, audit string, repaired_sha256 string"
    schema = _arrow(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, state, first = [], None, True
        for conv_id, edit, _, role, text in _applied(batches):
            if edit is None:
                if state is not None:
                    rows[-1]["repaired_sha256"] = state.hexdigest()
                if len(rows) >= 1000:
                    yield _frame(rows, schema)
                    rows = []
                rows.append({"conv_id": conv_id, "audit": text, "repaired_sha256": None})
                state, first = hashlib.sha256(), True
                continue
            state.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
        if state is not None:
            rows[-1]["repaired_sha256"] = state.hexdigest()
            yield _frame(rows, schema)

    return _edited(conversations, plans, run, columns)
