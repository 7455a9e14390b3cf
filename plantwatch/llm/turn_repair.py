"""Cheapest repair of the turn structure of conversations, by iterative-deepening A*.

A conversation should read, by the first letters of its roles, ``(s?(ua)+)?``. Edits are D (delete
a row, 4), I (insert an empty row, 3), K (keep, 0) and R (give the row the role due, 3); what a row
lacks at its end costs 3 unless it is deleted, and blank or repeated rows must be deleted. Edits
are tried in ASCII order under a cost bound that starts at a lower bound and rises to the least
cost seen beyond it. A table of failed states holds what a state is known to need at least, so
that no state fails twice at one bound; the first path that is accepted is the cheapest one and,
of those, the least in ASCII order.

Rows are brought in order by a range sort over conversation and turn, which spreads a long
conversation over many tasks, and cut there into blocks of ``BLOCK`` rows. A conversation of one
block is searched as a whole. Of a longer one each block is searched for every state it may begin
and end in; the cheapest chain of blocks, ties by the blocks' edits, is the cheapest repair, since
all paths through a block end with one of its rows. What meets of a conversation in one task are
some ten bytes a row; its texts stream past it once, since a digest cannot be taken in parts.

Nulls: a null conversation is one of its own; null roles and texts count as one space; null turns
come first. Rows of one turn are ordered by role and a digest of their text; equal rows are
neighbours. Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from plantwatch.session import materialise

BLOCK = 16
SPACE = r"\x20\x09-\x0D"

# A row for the search: its role's letter and whether it is whole, lacks its end, or must go.
ROLES = "sua"
WHOLE, CUT, GONE = 0, 1, 2
# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
DELETE, INSERT, REROLE, UNENDED = 4, 3, 3, 3
# What is inserted behind the last row, by state.
ENDINGS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
NEVER = 1 << 40
WHOLE_SEARCH = -1


def symbol(role: str, state: int) -> int:
    """One byte: the role's first letter (3: any other) and the row's state."""
    place = ROLES.find(role[0]) if role else -1
    return (3 if place < 0 else place) + 4 * state


class _Search:
    """Iterative deepening over the rows of one block from one state to another.

    ``goal`` is a state, which the last row must lead to, or WHOLE_SEARCH: rows may then be
    inserted behind the last one and the end must be that of a sound conversation.
    """

    def __init__(self, rows: bytes, goal: int):
        self.rows, self.goal, self.failed = rows, goal, {}
        self.least = [0] * (len(rows) + 1)
        for i in range(len(rows) - 1, -1, -1):
            self.least[i] = self.least[i + 1] + (0, UNENDED, DELETE)[rows[i] >> 2]

    def low(self, i: int, state: int) -> int:
        return self.failed.get((i, state), self.least[i])

    def accepts(self, state: int) -> bool:
        return state in (START, ASSISTANT) if self.goal == WHOLE_SEARCH else state == self.goal

    def moves(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        rows, due = self.rows, DUE[state]
        inside = i < len(rows)
        if inside:
            yield "D", DELETE, i + 1, state
        if inside or self.goal == WHOLE_SEARCH:
            yield "I", INSERT, i, due
        if inside and rows[i] >> 2 != GONE:
            end = UNENDED if rows[i] >> 2 == CUT else 0
            kept = KEPT.get((state, rows[i] & 3))
            if kept is not None:
                yield "K", end, i + 1, kept
            yield "R", REROLE + end, i + 1, due

    def deepen(self, i: int, state: int, budget: int) -> str | None:
        if i == len(self.rows) and self.accepts(state):
            return ""
        if self.low(i, state) > budget:
            return None
        need = NEVER
        for edit, cost, j, to in self.moves(i, state):
            if cost + self.low(j, to) <= budget:
                rest = self.deepen(j, to, budget - cost)
                if rest is not None:
                    return edit + rest
            need = min(need, cost + self.low(j, to))
        self.failed[i, state] = need
        return None

    def run(self, entry: int) -> tuple[int, str] | None:
        bound = self.low(0, entry)
        while bound < NEVER:
            path = self.deepen(0, entry, bound)
            if path is not None:
                return bound, path
            bound = self.low(0, entry)
        return None


@lru_cache(maxsize=1 << 14)
def repair(rows: bytes) -> tuple[int, str]:
    """Cost and edits of a conversation of one block."""
    return _Search(rows, WHOLE_SEARCH).run(START)


@lru_cache(maxsize=1 << 10)
def passages(rows: bytes) -> tuple[tuple[int, ...], bytes]:
    """For every entry and exit state the cost (NEVER: none) and the edits, packed."""
    costs, paths = [], []
    system = any(r & 3 == 0 and r >> 2 != GONE for r in rows)
    searches = [_Search(rows, goal) for goal in range(4)]  # what is known to fail holds for every entry
    for entry in range(4):
        for goal, search in enumerate(searches):
            # Neither the start nor the place behind a system row is reached from later states.
            reached = goal >= USER or goal == entry or (goal == SYSTEM and entry == START and system)
            found = search.run(entry) if reached else None
            costs.append(found[0] if found else NEVER)
            paths.append(found[1] if found else "")
    return tuple(costs), zlib.compress(",".join(paths).encode())


def chain(blocks: list[tuple[tuple[int, ...], bytes]]) -> tuple[int, str]:
    """The cheapest way through all blocks, ties by the edits in ASCII order."""
    ahead = [[len(ENDINGS[s]) * INSERT for s in range(4)]]
    for costs, _ in reversed(blocks):
        ahead.append([min(min(costs[4 * q + r] + ahead[-1][r] for r in range(4)), NEVER) for q in range(4)])
    ahead.reverse()
    state, edits = START, []
    for (costs, packed), rest in zip(blocks, ahead[1:]):
        paths = zlib.decompress(packed).decode().split(",")
        best = min(costs[4 * state + r] + rest[r] for r in range(4))
        path, state = min(
            (paths[4 * state + r], r) for r in range(4)
            if costs[4 * state + r] < NEVER and costs[4 * state + r] + rest[r] == best
        )
        edits.append(path)
    return ahead[0][START], "".join(edits) + ENDINGS[state]


# ---- rows in order ------------------------------------------------------------------------


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("null"))


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    plain = rows.select(
        _key(F.col(conv)).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    return plain.withColumn("digest", F.md5(F.col("text").cast("binary")))


ORDER = ("turn", "role", "digest")
BLOCK_ROWS = (
    "conv string, place long, whole boolean, symbols binary, costs array<long>, paths binary, first_turn long, "
    "last_turn long, turns long, first_role string, last_role string, blank long, duplicate long, truncated long, "
    "illegal long"
)
FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _faults(rows: DataFrame) -> DataFrame:
    """Each different row once, with how often it stands there and whether its like came earlier."""
    met = rows.groupBy("conv", *ORDER).agg(
        F.count("*").alias("n"),
        F.first(~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        F.first(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"),
    )
    met = materialise(met, "turn-rows")
    first = met.groupBy("conv", "role", "digest").agg(
        F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns")
    ).filter("turns > 1").drop("turns")
    known = met.join(first, ["conv", "role", "digest"], "left")
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return known.select("conv", *ORDER, "n", "blank", "cut", later.alias("later"))


class _Block:
    """Rows of a conversation, up to a block, and what is counted of them."""

    def __init__(self, conv: str):
        self.conv, self.rows = conv, bytearray()
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_role = self.last_role = None

    def add(self, turn: int | None, role: str, blank: bool, repeated: bool, cut: bool) -> None:
        letter = role[:1]
        if self.rows and self.last_role + letter not in ("su", "ua", "au"):
            self.illegal += 1
        self.first_role = letter if self.first_role is None else self.first_role
        self.last_role = letter
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut and not blank and not repeated
        self.rows.append(symbol(role, GONE if blank or repeated else CUT if cut else WHOLE))

    def row(self, place: int, whole: bool) -> dict:
        rows = bytes(self.rows)
        costs, paths = (None, None) if whole else passages(rows)
        return {
            "conv": self.conv, "place": place, "whole": whole, "symbols": rows if whole else None,
            "costs": costs, "paths": paths, "first_turn": self.first_turn, "last_turn": self.last_turn,
            "turns": self.turns, "first_role": self.first_role, "last_role": self.last_role, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
        }


BLOCK_SCHEMA = pa.schema([
    ("conv", pa.string()), ("place", pa.int64()), ("whole", pa.bool_()), ("symbols", pa.binary()),
    ("costs", pa.list_(pa.int64())), ("paths", pa.binary()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("turns", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted rows of a task; only inner conversations are known to be whole."""

    def blocks() -> Iterator[dict]:
        place = TaskContext.get().partitionId() << 40
        edge = True
        conversations = groupby(_records(batches), key=lambda r: r[0])
        current = next(conversations, None)
        while current is not None:
            conv, rows = current
            held, block = None, _Block(conv)
            for _, turn, role, _, n, blank, cut, later in rows:
                for copy in range(n):
                    if len(block.rows) == BLOCK:
                        if held is not None:
                            yield held.row(place, False)
                            place += 1
                        held, block = block, _Block(conv)
                    block.add(turn, role, blank, later or copy > 0, cut)
            current = next(conversations, None)
            alone = held is None and not edge and current is not None
            if held is not None:
                yield held.row(place, False)
                place += 1
            yield block.row(place, alone)
            place, edge = place + 1, False

    return _batched(blocks(), BLOCK_SCHEMA)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its blocks in order."""
    schema = pa.schema([
        ("conv", pa.string()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
        ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ])
    names = BLOCK_SCHEMA.names

    def folded() -> Iterator[dict]:
        for conv, rows in groupby(_records(batches), key=lambda r: r[0]):
            total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            turns, lowest, highest, role, parts, answer = 0, None, None, None, [], None
            for row in rows:
                b = dict(zip(names, row))
                for name in total:
                    total[name] += b[name]
                if role is not None and role + b["first_role"] not in ("su", "ua", "au"):
                    total["illegal"] += 1
                role = b["last_role"]
                if b["turns"]:
                    turns += b["turns"] - (b["first_turn"] == highest)
                    lowest = b["first_turn"] if lowest is None else lowest
                    highest = b["last_turn"]
                if b["whole"]:
                    answer = repair(b["symbols"])
                else:
                    parts.append((tuple(b["costs"]), b["paths"]))
            cost, audit = answer or chain(parts)
            gaps = highest - lowest + 1 - turns if turns else 0
            yield {"conv": conv, "gaps": gaps, **total, "cost": cost, "audit": audit}

    return _batched(folded(), schema)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation (as a key) its counts of faults, the cost and the edits."""
    order = ("conv", *[F.col(c).asc_nulls_first() for c in ORDER])
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    faults = materialise(_faults(rows), "turn-faults")
    blocks = (
        faults.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        .select("conv", *ORDER, "n", "blank", "cut", "later").mapInArrow(_cut, BLOCK_ROWS)
    )
    dealt = blocks.repartition(tasks, "conv").sortWithinPartitions("conv", "place")
    return dealt.mapInArrow(_fold, f"conv string, {FACTS}, audit string")


# ---- repaired conversations ---------------------------------------------------------------


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each repaired row, given the rows in order."""
    state = START
    for edit in audit:
        if edit == "I":
            role, text = ("assistant", "user")[DUE[state] == USER], ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                role = ("assistant", "user")[DUE[state] == USER]
        state = KEPT[state, ROLES.index(role[0])]
        yield edit, role, text


def _walk(batches: Iterator[pa.RecordBatch], visit: Callable[[tuple | None, Iterator], Iterator[dict]]) -> Iterator[dict]:
    """Conversations of a task, each with its audit row (None: it has no rows) and its texts."""
    for conv, rows in groupby(_records(batches), key=lambda r: r[0]):
        first = next(rows)
        texts = ((r[2], r[3]) for r in rows if r[1] == 1)
        yield from visit(first if first[1] == 0 else (conv, *[None] * (len(first) - 1)), texts)


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def visit(head: tuple, texts: Iterator[tuple[str, str]]) -> Iterator[dict]:
        digest, first = hashlib.sha256(), True
        audit = head[-1] or ""
        for _, role, text in edited(audit, texts):
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        facts = dict(zip(NUMBERS, (v or 0 for v in head[4:10])))
        yield {"conv": head[0], **facts, "audit": audit, "repaired_sha256": digest.hexdigest()}

    schema = pa.schema([("conv", pa.string()), *[(n, pa.int64()) for n in NUMBERS], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])
    return _batched(_walk(batches, visit), schema)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def visit(head: tuple, texts: Iterator[tuple[str, str]]) -> Iterator[dict]:
        for place, (edit, role, text) in enumerate(edited(head[-1] or "", texts)):
            yield {"conv": head[0], "position": place, "edit": edit, "role": role, "text": text}

    schema = pa.schema([("conv", pa.string()), ("position", pa.int64()), ("edit", pa.string()),
                        ("role", pa.string()), ("text", pa.string())])
    return _batched(_walk(batches, visit), schema)


def _dealt(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Audits (kind 0) before the texts (1) of their conversation, and ids that need a row (2)."""
    none = {"turn": "long", "role": "string", "text": "string", "digest": "string"}
    empty = {n: F.lit(None).cast(t) for n, t in none.items()}
    numbers = {n: F.lit(None).cast("long") for n in NUMBERS} | {"audit": F.lit(None).cast("string")}
    met = audits(rows).withColumns({"kind": F.lit(0), **empty})
    met = met.unionByName(rows.withColumns({"kind": F.lit(1), **numbers}))
    if ids is not None:
        met = met.unionByName(ids.distinct().withColumns({"kind": F.lit(2), **empty, **numbers}))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        met.repartition(tasks, "conv")
        .sortWithinPartitions("conv", "kind", *[F.col(c).asc_nulls_first() for c in ORDER])
        .select("conv", "kind", "role", "text", *NUMBERS, "audit")
    )


def _conv_id(kind) -> Column:
    return F.when(F.col("conv") != "null", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")


def repair_conversations(
    rows: DataFrame, ids: DataFrame | None = None, conv_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """One row per conversation: faults, least cost, the edits and a digest of the repaired rows.

    ``ids`` (column as in ``rows``) names conversations that get a row even if they have none.
    """
    plain = _rows(rows, conv_column, turn_column, role_column, text_column)
    named = None if ids is None else ids.select(_key(F.col(conv_column)).alias("conv"))
    done = _dealt(plain, named).mapInArrow(_report, f"conv string, {FACTS}, audit string, repaired_sha256 string")
    return done.select(_conv_id(rows.schema[conv_column].dataType), *NUMBERS, "audit", "repaired_sha256")


def repaired_turns(
    rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """The repaired conversations: ``position`` from 0, the edit that left each row, role and text."""
    plain = _rows(rows, conv_column, turn_column, role_column, text_column)
    done = _dealt(plain, None).mapInArrow(
        _turns, "conv string, position long, edit string, role string, text string")
    return done.select(_conv_id(rows.schema[conv_column].dataType), "position", "edit", "role", "text")


def damage(rows: DataFrame) -> DataFrame:
    """Faults planted by a checksum of conversation and turn, one kind per remainder."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    part = F.pmod(F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn")).cast("binary")), F.lit(20))
    hit = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), part.alias("hit"))
    text = (
        F.when(F.col("hit") == 1, F.lit(""))
        .when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    return hit.filter("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
