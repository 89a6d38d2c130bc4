"""Repair of conversation structure by the cheapest edits.

Every row of a conversation is kept, given another role or deleted, and empty turns may be inserted,
so that the roles read: perhaps system, then user and assistant in turn. Edits form a path through a
directed acyclic graph of (rows read, state of the role order). A path's weight is one whole number:
its high digits are the cost, its low digits, of fixed width, the audit letters by position, with
zeros after the last. So the smallest number is the cheapest path, and of equally cheap ones that
whose letters come first.

Long conversations are worked out in blocks of ``BLOCK`` rows, each by itself for every pair of states
before and after; blocks are then joined two by two, again by the smallest number. Of two audits of
one block and one cost neither begins with the other, as what follows would be insertions alone, so
the best of a block stays the best whatever follows. Tasks see one letter a row; texts meet their
audit in a second pass, row by row.

Defined results: a null role or text is one space; rows go by turn, null first, then role, then
SHA-256 of the text; rows that repeat are duplicates; a role is known by its first letter; a null
conv_id is a conversation; no rows give zeros, an empty audit and the hash of nothing; other columns
are ignored. The digest of one conversation's repaired text is worked out by one task.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.token_alignment import rows_of
from basketry.llm.token_files import ddl
from basketry.session import stored

BLOCK = 256
# Costs of the edits and what a truncated row that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States of the role order: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ACCEPTING = (START, ASSISTANT)
# Where a new or changed turn leads, and its role.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(START, "s"): SYSTEM} | {(s, "u"): USER for s in (START, SYSTEM, ASSISTANT)} | {(USER, "a"): ASSISTANT}
LEGAL = ("su", "ua", "au")
# Audit letters as digits of three bits, in the order of their codes; 0 stands after the last letter.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
BITS = 3
AS_DIGITS, AS_LETTERS = str.maketrans("DIKR", "1234"), str.maketrans("1234", "DIKR")

BLOCKS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("blank", pa.int64()), ("duplicate", pa.int64()),
     ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
     ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("costs", pa.list_(pa.int64())),
     ("audits", pa.list_(pa.string()))]
)
REPORT = pa.schema(
    [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
     ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
)
DIGESTS = pa.schema([*REPORT, ("repaired_sha256", pa.string())])
TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

OK, BLANK, DUPLICATE, CUT = "ok", "blank", "duplicate", "truncated"
Path = tuple[int, str]


class Row(NamedTuple):
    turn: int | None
    initial: str
    fault: str


def number(path: Path, width: int) -> int:
    """Cost and audit as one whole number with room for ``width`` letters."""
    cost, audit = path
    return (cost << BITS * width) + (int(audit.translate(AS_DIGITS) or "0", 8) << BITS * (width - len(audit)))


def through(rows: list[Row], entry: int) -> list[Path | None]:
    """The best path from a state before the rows to each state after them."""
    width = 3 * len(rows)

    def weight(cost: int, letter: str, at: int) -> int:
        return (cost << BITS * width) + (DIGITS[letter] << BITS * (width - 1 - at))

    best: dict[int, tuple[int, int]] = {entry: (0, 0)}
    for _, initial, fault in rows:
        # From a state at most two insertions lead to another one.
        ready = dict(best)
        for state, (value, at) in best.items():
            for _ in range(2):
                state, value, at = NEXT[state], value + weight(INSERT, "I", at), at + 1
                if state not in ready or value < ready[state][0]:
                    ready[state] = value, at
        after: dict[int, tuple[int, int]] = {}
        stays = TRUNCATED if fault == CUT else 0
        for state, (value, at) in ready.items():
            edges = [(state, DELETE, "D")]
            if fault in (OK, CUT):
                edges.append((NEXT[state], REROLE + stays, "R"))
                if (state, initial) in KEPT:
                    edges.append((KEPT[state, initial], stays, "K"))
            for to, cost, letter in edges:
                reached = value + weight(cost, letter, at)
                if to not in after or reached < after[to][0]:
                    after[to] = reached, at + 1
        best = after
    found: list[Path | None] = [None] * STATES
    for state, (value, at) in best.items():
        low = value & ((1 << BITS * width) - 1)
        audit = f"{low >> BITS * (width - at):o}".translate(AS_LETTERS) if at else ""
        found[state] = value >> BITS * width, audit
    return found


def joined(one: list[Path | None], two: list[Path | None]) -> list[Path | None]:
    """Best paths through two blocks, by state before and state after."""
    found: list[Path | None] = []
    for before, after in itertools.product(range(STATES), range(STATES)):
        ways = [
            (a[0] + b[0], a[1] + b[1])
            for middle in range(STATES)
            if (a := one[before * STATES + middle]) and (b := two[middle * STATES + after])
        ]
        width = max((len(audit) for _, audit in ways), default=0)
        found.append(min(ways, key=lambda way: number(way, width), default=None))
    return found


def closed(paths: list[Path | None]) -> Path:
    """The best whole path, from the start to an accepting state."""
    ways = []
    for state, path in enumerate(paths[:STATES]):
        while path and state not in ACCEPTING:
            state, path = NEXT[state], (path[0] + INSERT, path[1] + "I")
        if path:
            ways.append(path)
    width = max(len(audit) for _, audit in ways)
    return min(ways, key=lambda way: number(way, width))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by a checksum of their conversation and turn."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 0, F.array()).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def _rows(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows without their text: how often they stand there, and whether they are blank, said before or cut short."""
    text = F.col("text")
    own = _rows(rows).select(
        "conv_id", "turn", "role", F.sha2(text, 256).alias("digest"),
        (~text.rlike("[^\\x20\\x09-\\x0D]")).alias("blank"), (~text.rlike("[.!?][\\x20\\x09-\\x0D]*\\z")).alias("cut"),
    )
    own = stored(own.groupBy(*own.columns).agg(F.count("*").alias("n")), "turns")
    said = own.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    said = stored(said.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"), "said")
    same = own.conv_id.eqNullSafe(said.c) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again = (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("again")
    return own.join(said, same).select(*own.columns, again, F.substring("role", 1, 1).alias("initial"))


def read_rows(batches) -> Iterator[tuple[int | None, Row]]:
    """(conv_id, row) of every turn, in order; a row that stands there n times comes n times."""
    names = ("conv_id", "turn", "initial", "blank", "again", "cut", "n")
    for rows in batches:
        for conv, turn, initial, blank, again, cut, n in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
            for copy in range(n):
                yield conv, Row(turn, initial, BLANK if blank else DUPLICATE if again or copy else CUT if cut else OK)


def block_task(size: int):
    """Task: rows in order to blocks."""

    def summary(conv, part: int, seq: int, begins: bool, rows: list[Row]) -> tuple:
        # Rows before these may be in another partition or block; otherwise the path starts here.
        paths = [p for entry in range(STATES) for p in (through(rows, entry) if entry == START or not begins else [None] * STATES)]
        turns = [t for t, _ in itertools.groupby(r.turn for r in rows if r.turn is not None)]
        fault = [r.fault for r in rows]
        return (
            conv, part, seq, fault.count(BLANK), fault.count(DUPLICATE), fault.count(CUT),
            sum(x.initial + y.initial not in LEGAL for x, y in itertools.pairwise(rows)), rows[0].initial, rows[-1].initial,
            turns[0] if turns else None, turns[-1] if turns else None, len(turns),
            [p and p[0] for p in paths], [p and p[1] for p in paths],
        )

    def task(batches):
        part, held = TaskContext.get().partitionId(), []
        for k, (conv, rows) in enumerate(itertools.groupby(read_rows(batches), key=lambda entry: entry[0])):
            for seq in itertools.count():
                block = [row for _, row in itertools.islice(rows, size)]
                if not block:
                    break
                held.append(summary(conv, part, seq, k > 0 and seq == 0, block))
            if len(held) >= 1000:
                yield rows_of(BLOCKS, **dict(zip(BLOCKS.names, zip(*held, strict=True), strict=True)))
                held = []
        if held:
            yield rows_of(BLOCKS, **dict(zip(BLOCKS.names, zip(*held, strict=True), strict=True)))

    return task


def report_task(batches):
    """Task: blocks in order to one row a conversation."""

    def report(conv, blocks: list[dict]) -> tuple:
        paths = [[None if c is None else (c, a) for c, a in zip(b["costs"], b["audits"], strict=True)] for b in blocks]
        while len(paths) > 1:
            paths = [joined(*pair) if len(pair) == 2 else pair[0] for pair in (paths[i : i + 2] for i in range(0, len(paths), 2))]
        cost, audit = closed(paths[0])
        illegal = sum(b["illegal"] for b in blocks)
        illegal += sum(x["last_initial"] + y["first_initial"] not in LEGAL for x, y in itertools.pairwise(blocks))
        timed = [b for b in blocks if b["turns"]]
        turns = sum(b["turns"] for b in timed) - sum(x["last_turn"] == y["first_turn"] for x, y in itertools.pairwise(timed))
        gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - turns if timed else 0
        return conv, gaps, *(sum(b[n] for b in blocks) for n in ("blank", "duplicate", "truncated")), illegal, cost, audit

    def blocks_of() -> Iterator[dict]:
        for rows in batches:
            yield from rows.to_pylist()

    held = []
    for conv, blocks in itertools.groupby(blocks_of(), key=lambda b: b["conv_id"]):
        held.append(report(conv, list(blocks)))
        if len(held) >= 1000:
            yield rows_of(REPORT, **dict(zip(REPORT.names, zip(*held, strict=True), strict=True)))
            held = []
    if held:
        yield rows_of(REPORT, **dict(zip(REPORT.names, zip(*held, strict=True), strict=True)))


def reports(rows: DataFrame, block: int | None = None) -> DataFrame:
    """Per conversation with rows: gaps, faults, adjacent roles that are illegal, cost and audit of the cheapest edits."""
    order = ["conv_id", "turn", "role", "digest"]
    told = stored(faults(rows), "faults")
    ordered = told.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = stored(ordered.mapInArrow(block_task(block or BLOCK), ddl(BLOCKS)), "blocks")
    order = ["conv_id", "part", "seq"]
    return blocks.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(report_task, ddl(REPORT))


def edited(batches) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Reports, each followed by its rows in order, to (report, repaired (role, text))."""

    def entries() -> Iterator[dict]:
        for rows in batches:
            yield from rows.to_pylist()

    def turns(audit: str, rows: Iterator[dict]) -> Iterator[tuple[str, str]]:
        state, waiting = START, None
        for letter in audit:
            if letter == "I":
                state = NEXT[state]
                yield ROLE[state], ""
                continue
            # A row that stands there n times is read n times.
            if waiting is None or not waiting["n"]:
                waiting = next(rows)
            waiting["n"] -= 1
            if letter == "K":
                state = KEPT[state, waiting["role"][:1]]
                yield waiting["role"], waiting["text"]
            elif letter == "R":
                state = NEXT[state]
                yield ROLE[state], waiting["text"]

    for _, rows in itertools.groupby(entries(), key=lambda e: e["conv_id"]):
        head = next(rows)
        yield head, turns(head["audit"], rows)


def digest_task(batches):
    """Task: one row a conversation with the hash of its repaired text."""
    held = []
    for head, turns in edited(batches):
        digest = hashlib.sha256()
        for k, (role, text) in enumerate(turns):
            digest.update(f"{chr(10) * (k > 0)}{role}:{text}".encode())
        held.append((*(head[n] for n in REPORT.names), digest.hexdigest()))
        if len(held) >= 1000:
            yield rows_of(DIGESTS, **dict(zip(DIGESTS.names, zip(*held, strict=True), strict=True)))
            held = []
    if held:
        yield rows_of(DIGESTS, **dict(zip(DIGESTS.names, zip(*held, strict=True), strict=True)))


def turn_task(batches):
    """Task: the repaired turns themselves."""
    for head, turns in edited(batches):
        for k, group in itertools.groupby(enumerate(turns), key=lambda entry: entry[0] // 1000):
            told = [(head["conv_id"], k, role, text) for k, (role, text) in group]
            yield rows_of(TURNS, **dict(zip(TURNS.names, zip(*told, strict=True), strict=True)))


def _met(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Each report before the rows of its conversation."""
    own = _rows(rows).select("conv_id", "turn", "role", "text", F.lit(1).alias("n"), F.lit(1).alias("level"))
    heads = told.withColumn("level", F.lit(0))
    order: list[str | Column] = ["conv_id", "level", "turn", "role", F.sha2("text", 256)]
    return heads.unionByName(own, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*order)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, role and text of every turn after the repair."""
    return _met(rows, stored(reports(rows), "reports")).mapInArrow(turn_task, ddl(TURNS))


def repair_digests(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The report of every conversation, also of those without rows, and the hash of its repaired text."""
    told = reports(rows)
    every = conversations.select("conv_id").distinct()
    other = told.withColumnRenamed("conv_id", "c")
    zeros = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in REPORT.names[1:-1]]
    told = every.join(other, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    told = stored(told.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit")), "reports")
    return _met(rows, told).mapInArrow(digest_task, ddl(DIGESTS))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    return repair_digests(damaged(conversations), conversations)
