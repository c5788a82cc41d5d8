"""Conversation structure repair: the cheapest edits that make the roles alternate, by streaming.

Rows are dealt out by conversation and sorted by turn; a task then reads them in order, batch after batch,
and carries the state of a dynamic program over the four places where the role pattern ``(s?(ua)+)?`` can
stand. Only cost differences and the order of the four best audits matter for what comes next, so the
program is itself a small automaton whose steps are worked out once and looked up afterwards. Each row leaves
one backpointer (a shared object). A conversation longer than a window does not collect in the task: at the
window's end every place gets the hash of its repaired text so far, and its backpointers go out, compressed,
as rows of a written table, from which the audit is put together at the end.

Two audits of different places never agree up to the end of the shorter one (each ends in the letter of the
same row, and letters determine the place), so comparing best audits place by place, row by row, gives the
ASCII-least of all cheapest audits.

Duplicates may lie far apart, so they are not remembered in the task: rows are grouped by a 128-bit hash of
(conversation, role, text), and the few groups that span several turns are joined back.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, landed, ship

#: rows, and characters of text, after which a conversation's decided state goes out
WINDOW, WINDOW_CHARS = 8192, 4_000_000
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3

#: a place that costs more than this beyond the best is never least again: from the best one, an insertion and the
#: deletion of a system's row do all that it can do
SLACK = INSERT_COST + DELETE_COST

#: where the pattern can stand: nothing yet, after the system's row, after the user's, after the assistant's
START, SYSTEM, USER, ASSISTANT = range(4)
#: the place after a row that is inserted or given a role, and that role
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: what is wrong with a row: nothing, truncated, blank, duplicate
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)

_FIRST = ((0, None, None, None), (0, 0, 0, 0))


def _moves(initial: int, fault: int) -> Iterator[tuple[int, str, int, int]]:
    """(place before, letters, place after, cost). An insertion before a deletion is never least: the same two
    the other way round cost as much and come first."""
    for p in range(4):
        yield p, "D", p, DELETE_COST
    if fault >= BLANK:
        return
    extra = TRUNCATED_COST * (fault == TRUNCATED)
    if initial == SYSTEM:
        yield START, "K", SYSTEM, KEEP_COST + extra
    for p in range(4):
        for letters, at, cost in (("", p, extra), ("I", _NEXT[p], extra + INSERT_COST)):
            yield p, letters + "R", _NEXT[at], cost + REROLE_COST
            if initial == _NEXT[at]:
                yield p, letters + "K", initial, cost + KEEP_COST


@lru_cache(maxsize=None)  # differences of costs are bounded, so there are few states
def step(state: tuple, initial: int, fault: int) -> tuple[tuple, int, tuple]:
    """(state after the row, cost that all places have in common, place and letters by which each was reached)."""
    costs, ranks = state
    best: list[tuple | None] = [None] * 4
    for p, letters, to, cost in _moves(initial, fault):
        if costs[p] is not None:
            new = (costs[p] + cost, ranks[p], letters, p)
            if best[to] is None or new < best[to]:
                best[to] = new
    low = min(b[0] for b in best if b)
    best = [b if b and b[0] - low <= SLACK else None for b in best]
    order = sorted(b[1:3] for b in best if b)
    return ((tuple(b[0] - low if b else None for b in best), tuple(order.index(b[1:3]) if b else 0 for b in best)),
            low, tuple((b[3], b[2]) if b else None for b in best))


def last_step(state: tuple) -> tuple[int, str, int]:
    """(cost, letters, place before them) of the end: an assistant's row, or nothing at all."""
    costs, ranks = state
    ends = [(costs[p] + INSERT_COST * n, ranks[p], "I" * n, p)
            for p, n in ((START, 0), (ASSISTANT, 0), (USER, 1), (SYSTEM, 2)) if costs[p] is not None]
    cost, _, letters, p = min(ends)
    return cost, letters, p


def trace(backs: list[tuple], place: int) -> tuple[int, list[str]]:
    """(place before the first row, letters of each row) of the best way to a place."""
    out = []
    for back in reversed(backs):
        place, letters = back[place]
        out.append(letters)
    return place, out[::-1]


def edited(rows: list[tuple[str, str]], letters: list[str], place: int) -> Iterator[tuple[str, str, str]]:
    """(role, text, letter) of each row that stays or comes, from a place on; letters may end in further ones."""
    for i, edits in enumerate(letters):
        for e in edits:
            if e == "D":
                continue
            if e == "K":
                role, text = rows[i]
                place = _INITIAL[role[0]]
            else:
                place = _NEXT[place]
                role, text = _ROLE[place], rows[i][1] if e == "R" else ""
            yield role, text, e


class _Conversation:
    """What is carried from row to row."""

    def __init__(self, id_):
        self.id = id_
        self.state, self.cost, self.windows, self.entry_hashes = _FIRST, 0, 0, {START: None}
        self.backs, self.rows, self.chars = [], [], 0
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.low = self.high = self.previous = self.initial = None
        self.turns = 0

    def add(self, turn, role: str, text: str, initial: int, fault: int) -> None:
        if self.previous == (role, text) and fault != BLANK:
            fault = DUPLICATE  # rows of one turn are sorted, so equal ones stand side by side
        self.previous = role, text
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.initial is not None:
            self.illegal += (self.initial, initial) not in _LEGAL
        self.initial = initial
        self.faults[fault] += 1
        self.state, cost, back = step(self.state, initial, fault)
        self.cost += cost
        self.backs.append(back)
        self.rows.append((role, text))
        self.chars += len(text)

    def _hash(self, place: int, letters: list[str]):
        h = self.entry_hashes[place]
        first, h = h is None, h.copy() if h else hashlib.sha256()
        for role, text, _ in edited(self.rows, letters, place):
            h.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
        return None if first else h

    def window(self) -> dict:
        """The window's backpointers as a row; its rows are not needed again."""
        ways = [trace(self.backs, p) if c is not None else None for p, c in enumerate(self.state[0])]
        self.entry_hashes = {p: self._hash(*w) for p, w in enumerate(ways) if w}
        out = {"conv_id": self.id, "window": self.windows, "places": [w[0] if w else -1 for w in ways],
               "audits": [zlib.compress("".join(w[1]).encode(), 1) if w else b"" for w in ways]}
        self.windows += 1
        self.backs, self.rows, self.chars = [], [], 0
        return out

    def end(self) -> dict:
        cost, more, place = last_step(self.state)
        place, letters = trace(self.backs, place)
        letters.append(more)
        self.rows.append(("", ""))
        h = self._hash(place, letters)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.id, "gaps": gaps if gaps < 1 << 63 else None, "blank": self.faults[BLANK],
                "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED], "illegal": self.illegal,
                "cost": self.cost + cost, "audit": "".join(letters), "place": place, "windows": self.windows,
                "repaired_sha256": (h or hashlib.sha256()).hexdigest()}


RESULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_FIELDS = [*[(c, pa.int64(), "long") for c in RESULTS[:6]], ("audit", pa.string(), "string"),
           ("repaired_sha256", pa.string(), "string"), ("place", pa.int32(), "int"), ("windows", pa.int32(), "int"),
           ("window", pa.int32(), "int"), ("places", pa.list_(pa.int32()), "array<int>"),
           ("audits", pa.list_(pa.binary()), "array<binary>")]


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, tuple, bool]]:
    """(type of the id, row, whether it is the first of its conversation) of rows whose first column is the
    id's text and whose second is the id."""
    seen = object()
    for batch in batches:
        kind = batch.schema.field(1).type
        for row in zip(*(column for column in batch.columns)):
            row = tuple(v.as_py() for v in row)
            yield kind, row, row[0] != seen
            seen = row[0]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[dict] = []
    kind, now = pa.null(), None

    def out():
        columns = [pa.array([d["conv_id"] for d in done], kind),
                   *[pa.array([d.get(c) for d in done], t) for c, t, _ in _FIELDS]]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *[c for c, _, _ in _FIELDS]])

    for kind, (_, id_, turn, role, text, gone, initial, fault), first in _by_conversation(batches):
        if first:
            if now:
                done.append(now.end())
            now = _Conversation(id_)
        if not gone:
            now.add(turn, role, text, initial, fault)
            if len(now.rows) >= WINDOW or now.chars >= WINDOW_CHARS:
                done.append(now.window())
                yield out()
        if len(done) >= 2000:
            yield out()
    if now:
        done.append(now.end())
    if done:
        yield out()


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits of conversations of several windows: the end first, then the windows, last one first."""
    names, final, place, parts = ["conv_id", *RESULTS], None, 0, []

    def out():
        final["audit"] = "".join([*reversed(parts), final["audit"]])
        return pa.RecordBatch.from_arrays(
            [pa.array([final[c]], t) for c, t in (("conv_id", kind), *[(c, t) for c, t, _ in _FIELDS[:8]])], names)

    for batch in batches:
        kind = batch.schema.field(1).type
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["window"] is None:
                if final:
                    yield out()
                final, place, parts = row, row["place"], []
            else:
                parts.append(zlib.decompress(row["audits"][place]).decode())
                place = row["places"][place]
    if final:
        yield out()


def prepared(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
             gone_col: str | None) -> DataFrame:
    """key, conv_id, turn, role, text, gone, initial, fault of each row, dealt out by conversation and sorted."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col(conv_col).cast("string").alias("key"), F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), space).alias("text"),
        (F.coalesce(F.col(gone_col), F.lit(False)) if gone_col else F.lit(False)).alias("gone"))
    rows = rows.withColumns({"h1": F.xxhash64("key", "role", "text"), "h2": F.xxhash64(F.lit(1), "key", "role", "text")})
    # of rows that stand in several turns: the first turn (null: one without a turn comes first)
    again = landed(rows.where("not gone").groupBy("h1", "h2").agg(
        F.min("turn").alias("least"), F.max("turn").alias("most"), F.max(F.isnull("turn")).alias("unnumbered"))
        .where("least < most or (unnumbered and least is not null)")
        .select("h1", "h2", F.when(~F.col("unnumbered"), F.col("least")).alias("least"), F.lit(True).alias("again")),
        "conversation_repeats")
    seen = F.coalesce("again", F.lit(False)) & F.col("turn").isNotNull() & F.coalesce(F.col("turn") > F.col("least"), F.lit(True))
    initial = F.substring("role", 1, 1)
    fault = (F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK).when(seen, DUPLICATE)
             .when(~F.col("text").rlike(f"[.!?][{SPACE}]*\\z"), TRUNCATED).otherwise(FINE))
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(START)
    joined = rows.join(again, ["h1", "h2"], "left").select(
        "key", "conv_id", "turn", "role", F.when(~F.col("gone"), F.col("text")).alias("text"), "gone",
        code.cast("int").alias("initial"), fault.cast("int").alias("fault"))
    return joined.repartition("key").sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text")


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """One row per conversation: conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit (K, R, D, I:
    keep, rerole, delete, insert) and repaired_sha256 (of ``role:text`` lines).

    A conversation's rows are taken by turn, nulls first, ties by role and text. Null role or text: one space.
    Null conv_col: a conversation of its own. gone_col: rows where it is true name their conversation and nothing
    more. No (other) rows: zeros, an empty audit, the hash of an empty text. Repeated rows: the second is a
    duplicate. Gaps beyond a long: null. Conversations and texts of any length; empty table: no rows.
    """
    ship(conversations.sparkSession)
    rows = prepared(conversations, conv_col, turn_col, role_col, text_col, gone_col)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = ", ".join([f"conv_id {kind}", *[f"{c} {t}" for c, _, t in _FIELDS]])
    found = landed(rows.mapInArrow(_stream, schema), "conversations")
    short = found.where("window is null and windows = 0").select("conv_id", *RESULTS)
    long = found.where("window is not null or windows > 0").select(F.col("conv_id").cast("string").alias("key"), "*")
    whole = long.repartition("key").sortWithinPartitions("key", F.desc_nulls_first("window")).mapInArrow(
        _assemble, ", ".join([f"conv_id {kind}", *[f"{c} {t}" for c, _, t in _FIELDS[:8]]]))
    return short.union(whole).withColumnRenamed("conv_id", conv_col)


_REPAIRED = [("position", pa.int64(), "long"), ("role", pa.string(), "string"), ("text", pa.string(), "string"),
             ("edit", pa.string(), "string")]


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows of conversations that come as their audit, then their rows."""
    out: list[tuple] = []
    kind, audit, at, place, position, id_ = pa.null(), "", 0, START, 0, None

    def rows():
        columns = list(zip(*out)) if out else [()] * (1 + len(_REPAIRED))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(c, t) for c, (_, t, _) in zip(columns[1:], _REPAIRED)]],
                                          ["conv_id", *[c for c, _, _ in _REPAIRED]])

    def put(row, letters):
        nonlocal place, position
        for role, text, edit in edited([row], [letters], place):
            place = _INITIAL[role[0]]
            out.append((id_, position, role, text, edit))
            position += 1

    for kind, (_, new, role, text), first in _by_conversation(batches):
        if first:
            put(("", ""), audit[at:])
            id_, audit, at, place, position = new, text, 0, START, 0
        else:
            end = at
            while audit[end] == "I":
                end += 1
            put((role, text), audit[at:end + 1])
            at = end + 1
        if len(out) >= 2000:
            yield rows()
    put(("", ""), audit[at:])
    yield rows()


def repaired_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """The repaired conversations: conv_col, position (gapless from 0), role, text, edit (K, R or I) of each row.

    Cases as for ``repair``; a conversation without rows left has none."""
    ship(conversations.sparkSession)
    audits = repair(conversations, conv_col, turn_col, role_col, text_col, gone_col)
    space = F.lit(" ")
    key = F.col(conv_col).cast("string").alias("key")
    rows = conversations if gone_col is None else conversations.where(f"not coalesce(`{gone_col}`, false)")
    both = audits.select(key, F.col(conv_col).alias("conv_id"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                         F.lit("").alias("role"), F.col("audit").alias("text")).union(
        rows.select(key, conv_col, F.lit(1), F.col(turn_col).cast("long"), F.coalesce(F.col(role_col).cast("string"), space),
                    F.coalesce(F.col(text_col).cast("string"), space)))
    kind = both.schema["conv_id"].dataType.simpleString()
    return (both.repartition("key").sortWithinPartitions("key", "kind", F.asc_nulls_first("turn"), "role", "text")
            .select("key", "conv_id", "role", "text")
            .mapInArrow(_replay, ", ".join([f"conv_id {kind}", *[f"{c} {t}" for c, _, t in _REPAIRED]]))
            .withColumnRenamed("conv_id", conv_col))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows damaged by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space):
    0 goes (``gone``), 1 empties the text, 2 takes its ``.!?`` away, 3 doubles the row, 4 makes the role user."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("kind") == 0).alias("gone"), copies.alias("copy")).drop("copy")
