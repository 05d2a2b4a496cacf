"""Conversation structure repair by alignment with the alternating grammar.

A conversation may start with a system turn, then user and assistant alternate, and the
assistant has the last word: `(s?(ua)+)?` in initials. Its turns are aligned (Wagner and
Fischer) with the grammar's string of each feasible length. The best cost so far is the
incumbent: it bounds the lengths that are tried, and the diagonals (Ukkonen) of each
table. Alignments of equal cost are compared by their audits, traced back.

All turns of a conversation stand sorted in one partition, and are read as a stream. One
of up to BLOCK turns is aligned as a whole. A longer one is aligned block by block, from
every state of the grammar to every other; the best way to each state is kept, and what all
of these have in common is settled and let go.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.common import BLANKS, digest16

RETAIN, RELABEL, REMOVE, ADD = "K", "R", "D", "I"
#: What an edit costs; a truncated turn that stays costs one more.
COST = {RETAIN: 0, RELABEL: 2, REMOVE: 3, ADD: 2}
CUT_OFF = 1
ROLES = {"u": "user", "a": "assistant"}
#: Turns aligned at once.
BLOCK = 32
#: States of the grammar: nothing yet, after the system turn, user expected, assistant expected.
EMPTY, OPENED, USER, ASSISTANT = range(4)
#: From any state the rest costs at most this much more than from any other: two turns
#: added, or one added and a system turn removed.
APART = COST[ADD] + COST[REMOVE]
_FAULTS = ("blank", "duplicate", "truncated")
_MUST_GO = "x"


def target(start: int, end: int, n: int) -> str | None:
    """The only string of n initials that leads from one state to another."""
    if n == 0:
        return "" if start == end else None
    if start == EMPTY and end == OPENED:
        return "s" if n == 1 else None
    if end in (EMPTY, OPENED):
        return None
    opening = ""
    if start == EMPTY and (n % 2 == 0) == (end == ASSISTANT):
        opening = "s"
    text = ("au" if start == ASSISTANT else "ua") * (n // 2 + 1)
    text = opening + text[: n - len(opening)]
    if text[-1] != ("a" if end == USER else "u"):
        return None
    return text


def _drift(d: int) -> int:
    """The least cost of d more turns in the target than so far in the conversation."""
    return COST[ADD] * d if d > 0 else -COST[REMOVE] * d


def align(turns: str, want: str, most: int) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits that turn `turns` into `want`, the least audit of
    those; None if they cost more than `most`.

    A turn is its role's initial (o: another role), a capital if truncated, or x if it must go.
    """
    n, m = len(turns), len(want)
    far = most + 1
    # cost of all that follows turn i and target j, inside the band only
    rest = [[far] * (m + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        row, below = rest[i], rest[i + 1]
        turn = turns[i] if i < n else ""
        for j in range(m, -1, -1):
            if _drift(j - i) + _drift((m - j) - (n - i)) > most:
                continue
            if i == n and j == m:
                row[j] = 0
                continue
            best = far
            if i < n:
                best = below[j] + COST[REMOVE]
            if j < m and want[j] != "s":
                best = min(best, row[j + 1] + COST[ADD])
            if i < n and j < m and turn != _MUST_GO:
                low = turn.lower()
                if low == want[j] or want[j] != "s":
                    edit = COST[RETAIN] if low == want[j] else COST[RELABEL]
                    best = min(best, below[j + 1] + edit + CUT_OFF * (turn != low))
            row[j] = min(best, far)
    if rest[0][0] > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:  # forward, by the least letter that is still cheapest
        here = rest[i][j]
        if i < n and rest[i + 1][j] + COST[REMOVE] == here:
            audit.append(REMOVE)
            i += 1
        elif j < m and want[j] != "s" and rest[i][j + 1] + COST[ADD] == here:
            audit.append(ADD)
            j += 1
        else:
            audit.append(RETAIN if turns[i].lower() == want[j] else RELABEL)
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


@lru_cache(maxsize=1 << 16)
def best_way(turns: str, start: int, end: int) -> tuple[int, str, str] | None:
    """(cost, audit, target) of the best alignment over all feasible lengths; None if there is none."""
    must = turns.count(_MUST_GO)
    usual = len(turns) - must
    best = None
    step = 0
    while True:
        lengths = {usual + step, usual - step}
        open_ = False
        for n in sorted(lengths):
            least = COST[REMOVE] * must + _drift(n - usual)
            if best is not None and least > best[0]:
                continue
            if n < 0:
                continue
            open_ = True
            want = target(start, end, n)
            if want is None:
                continue
            most = best[0] if best else COST[REMOVE] * len(turns) + COST[ADD] * n + len(turns)
            found = align(turns, want, most)
            if found and (best is None or found < best[:2]):
                best = (*found, want)
        step += 1
        # without an incumbent, longer ones stay feasible unless the end state allows none
        if not open_ or (best is None and step > len(turns) + 4):
            return best


class Conversation:
    """One conversation, its turns given one by one; `sink` gets each settled repaired turn."""

    def __init__(self, sink):
        self.sink = sink
        self.count = dict.fromkeys(_FAULTS, 0)
        self.illegal = 0
        self.first = self.last = None
        self.distinct = 0
        self.before = None
        self.turns: list[tuple[str, str, str]] = []  # initial as in `align`, role, text
        self.ways = {EMPTY: (0, "", [])}  # state: cost, audit and pieces not settled yet
        self.cost = 0
        self.audit: list[str] = []

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if fault:
            self.count[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        if len(self.turns) == BLOCK:
            self._advance(range(4))
            self._settle()
        sign = initial if initial in ("s", "u", "a") else "o"
        if fault in ("blank", "duplicate"):
            sign = _MUST_GO
        elif fault == "truncated":
            sign = sign.upper()
        self.turns.append((sign, role, text))

    def _advance(self, ends) -> None:
        """Align the turns held; the best way to each end state stays."""
        signs = "".join(t[0] for t in self.turns)
        ways = {}
        for end in ends:
            for start, (cost, audit, pieces) in self.ways.items():
                found = best_way(signs, start, end)
                if found is None:
                    continue
                way = (cost + found[0], audit + found[1])
                if end not in ways or way < ways[end][:2]:
                    ways[end] = (*way, pieces, found)
        least = min(w[0] for w in ways.values())
        turns, self.turns = self.turns, []
        self.ways = {
            end: (cost, audit, [*pieces, (found[1], found[2], turns)])
            for end, (cost, audit, pieces, found) in ways.items()
            if cost <= least + APART
        }

    def _settle(self) -> None:
        """Hand over what all remaining ways begin with."""
        ways = list(self.ways.values())
        same = 0
        while same < len(ways[0][2]) and all(
            w[2][same][2] is ways[0][2][same][2] and w[2][same][:2] == ways[0][2][same][:2] for w in ways
        ):
            same += 1
        if not same:
            return
        cut = 0
        for audit, want, turns in ways[0][2][:same]:
            self._hand_over(audit, want, turns)
            cut += len(audit)
        self.ways = {s: (c, a[cut:], p[same:]) for s, (c, a, p) in self.ways.items()}

    def _hand_over(self, audit: str, want: str, turns: list) -> None:
        self.audit.append(audit)
        i = j = 0
        for edit in audit:
            if edit == ADD:
                self.sink(edit, ROLES[want[j]], "")
            elif edit != REMOVE:
                role, text = turns[i][1:]
                self.sink(edit, role if edit == RETAIN else ROLES[want[j]], text)
            i += edit != ADD
            j += edit != REMOVE

    def end(self) -> None:
        self._advance((EMPTY, USER))
        self.cost, _, pieces = min(self.ways.values(), key=lambda w: w[:2])
        for piece in pieces:
            self._hand_over(*piece)

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.distinct


def sorted_turns(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """Turns with their first fault, all of one conversation in one partition and in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        (F.lit(True) if present is None else present).alias("present"),
    )
    core = F.btrim("text", F.lit(BLANKS))
    # the repartitioning serves the window, which sorts only
    seen = Window.partitionBy("conv_id", "present", "role", digest16(F.col("text"))).orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(core == "", "blank")
        .when(F.row_number().over(seen) > 1, "duplicate")
        .when(~F.right(core, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return (
        rows.repartition("conv_id")
        .withColumn("fault", fault)
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    )


def _conversations(batches, sink_of, done):
    """Run over sorted turns. `sink_of(conv_id)` gives the sink of the next conversation, `done(conv_id,
    conversation)` is called at its end; yields after each batch."""
    current, at = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "fault")]
        for conv_id, turn, role, text, present, fault in zip(*columns, strict=True):
            if current is None or conv_id != at:
                if current is not None:
                    current.end()
                    done(at, current)
                current, at = Conversation(sink_of(conv_id)), conv_id
            if present:
                current.add(turn, role, text, fault)
        yield
    if current is not None:
        current.end()
        done(at, current)
        yield


_AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_TURNS = "conv_id long, place long, edit string, role string, text string"
_AUDIT_ARROW = pa.schema(
    [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _AUDIT.split(", ")]
)
_TURNS_ARROW = pa.schema(
    [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _TURNS.split(", ")]
)


def _audited(batches):
    rows: list[tuple] = []
    digest = None

    def sink_of(conv_id):
        nonlocal digest
        digest, first = hashlib.sha256(), True

        def sink(edit, role, text):
            nonlocal first
            digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False

        return sink

    def done(conv_id, c):
        rows.append(
            (conv_id, c.gaps, *(c.count[f] for f in _FAULTS), c.illegal, c.cost, "".join(c.audit), digest.hexdigest())
        )

    for _ in _conversations(batches, sink_of, done):
        yield _batch(rows, _AUDIT_ARROW)
        rows.clear()


def _repaired(batches):
    rows: list[tuple] = []

    def sink_of(conv_id):
        place = -1

        def sink(edit, role, text):
            nonlocal place
            place += 1
            rows.append((conv_id, place, edit, role, text))

        return sink

    for _ in _conversations(batches, sink_of, lambda *_: None):
        yield _batch(rows, _TURNS_ARROW)
        rows.clear()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def audit_conversations(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conv_id: gaps, faults, illegal neighbours, cost and audit of the repair, and the
    digest of the repaired conversation (`role:text`, joined by line feeds).

    `rows` has conv_id, turn, role and text. Turns are taken by turn, nulls first; turns of equal
    number by role and text. A null role or text counts as one space, a null conv_id is a
    conversation of its own. Rows that are not `present` only name their conversation. A
    conversation without turns has zeros, an empty audit and the digest of nothing. A text of any
    length is handled whole; a conversation of any length is streamed, with its audit held.
    Repeated rows are duplicates. An empty table gives an empty table; other columns are ignored.
    """
    return sorted_turns(rows, present).mapInArrow(_audited, _AUDIT)


def repair_conversations(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """The turns of all repaired conversations: conv_id, place (from 0), edit (K: as it was, R: with another
    role, I: added), role and text. Rules as in `audit_conversations`."""
    return sorted_turns(rows, present).mapInArrow(_repaired, _TURNS)


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows damaged by the digest of their name, as a table to repair; and which of them remain."""
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    text, role = F.coalesce(F.col("text").cast("string"), blank), F.coalesce(F.col("role").cast("string"), blank)
    kind = F.crc32(name.cast("binary")) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("stays"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ), F.col("stays")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows, stays = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return audit_conversations(rows, stays)
