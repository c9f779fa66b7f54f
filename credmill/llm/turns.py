"""Repair of conversations whose turns are lost, empty, doubled, cut short or of the wrong role.

The cheapest edits make the initials of the roles read ``(s?(ua)+)?``: Keep costs 0, Rerole to
user or assistant 1, Delete 2, Insert an empty user or assistant turn anywhere 5.  Blank and
duplicate rows have to be deleted; a truncated row that stays costs 5 more.  Among the cheapest
edits the sequence of initials that is least in ASCII wins.

One integer decides both.  The weight of the edits from some row on is

    cost * 2**WIDTH + letters,

where the letters D, I, K, R are the digits 1 to 4 in fixed places of three bits, the first
letter highest, and places behind the last letter hold zero.  Putting an edit in front
adds its cost to the high digits, moves the letters one place down and writes its own letter into
the highest place.  Then the least weight at every node (row, role expected next) of the
graph of edits is an ordinary minimum of integers, taken from the last row to the first, and the
digits of the least weight at the start spell the edits.

Integers as long as the conversation would make this quadratic, so it runs over blocks of
``BLOCK`` rows.  Two ways through a block from one state that lead to different states differ in a
letter before either ends, because both end with the edit of a row; so behind a block its
cost alone is carried on, and the result does not depend on the size of blocks.

Order and shuffles: rows of a conversation by turn (NULL first), of one turn by role, then by the
SHA-256 of role and text.  Marks of the rows, without texts, are shuffled by conversation and sorted; a
task streams through them and holds one byte a row of one conversation, no more than the
edits it returns.  Then texts are sorted behind their edits the same way and streamed through
once.  So a conversation may be larger than memory; it cannot be split over tasks, since its edits
and the digest of its repaired rows are values of one row.

Defined cases: a NULL role or text is one space, so such a text is blank; NULL conversation ids
are one conversation; turns may repeat; a role without a first letter s, u or a cannot be kept; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from credmill.llm.arrow import one_task_batches, slices
from credmill.llm.shipping import ship

RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LETTERS = "DIKR"
BLOCK = 64
# A gap between rows takes two inserts at most: they lead back to where they began.
GAP = 2
_BITS = 3
_NEVER = 1 << 60

# What is expected next: any first turn; the first user turn; an answer; a user turn or the end.
START, OPENED, ASKED, ANSWERED = range(4)
STATES = range(4)
ENDS = (START, ANSWERED)
USER = {START: ASKED, OPENED: ASKED, ANSWERED: ASKED}
ASSISTANT = {ASKED: ANSWERED}
MOVES = {"s": {START: OPENED}, "u": USER, "a": ASSISTANT}
TURN = USER | ASSISTANT
ROLE_INTO = {ASKED: "user", ANSWERED: "assistant"}

# A row's mark: the initial of its role (other: 0) and its first fault.
INITIALS = {"s": 1, "u": 2, "a": 3}
NONE, CUT, BLANK, DUPLICATE = 0, 4, 8, 12
LEGAL = {(1, 2), (2, 3), (3, 2)}


def row_edits(mark: int) -> list[list[tuple[int, int, int]]]:
    """For each state the edits of a row: state behind it, cost, digit."""
    fault = mark & 12
    edits = [[(state, DELETE, LETTERS.index("D") + 1)] for state in STATES]
    if fault in (BLANK, DUPLICATE):
        return edits
    more = TRUNCATED if fault == CUT else 0
    initial = next((name for name, number in INITIALS.items() if number == mark & 3), "")
    for state, then in MOVES.get(initial, {}).items():
        edits[state].append((then, more, LETTERS.index("K") + 1))
    for state, then in TURN.items():
        edits[state].append((then, RELABEL + more, LETTERS.index("R") + 1))
    return edits


_EDITS = [row_edits(mark) for mark in range(16)]
_INSERT_DIGIT = LETTERS.index("I") + 1


class Weights:
    """Least weights over a block of rows, behind which each state has a known cost."""

    def __init__(self, rows: int):
        self.width = _BITS * ((1 + GAP) * rows + GAP)
        self.letters = (1 << self.width) - 1

    def before(self, weight: int, cost: int, digit: int) -> int:
        """The weight with one more edit in front."""
        high = (weight >> self.width) + cost
        low = (weight & self.letters) >> _BITS | digit << (self.width - _BITS)
        return high << self.width | low

    def gap(self, weights: list[int]) -> list[int]:
        """Weights before the inserts that may come next."""
        least = weights
        for _ in range(GAP):
            least = [
                min(weights[state], self.before(least[TURN[state]], INSERT, _INSERT_DIGIT))
                for state in STATES
            ]
        return least

    def block(self, marks: bytes, costs: list[int], last: bool) -> tuple[list[int], list[int]]:
        """Cost and letters of the best way from each state before the rows."""
        weights = [cost << self.width for cost in costs]
        if last:
            weights = self.gap(weights)
        for mark in reversed(marks):
            weights = self.gap([
                min(self.before(weights[then], cost, digit) for then, cost, digit in edits)
                for edits in _EDITS[mark]
            ])
        return [w >> self.width for w in weights], [w & self.letters for w in weights]

    def spell(self, letters: int) -> str:
        found = []
        for place in range(self.width - _BITS, -1, -_BITS):
            digit = letters >> place & 7
            if not digit:
                break
            found.append(LETTERS[digit - 1])
        return "".join(found)


def follow(state: int, letter: str, initial: str) -> int:
    """The state behind an edit."""
    if letter == "D":
        return state
    return MOVES[initial][state] if letter == "K" else TURN[state]


def cheapest(marks: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of the rows with these marks."""
    if not marks:
        return 0, ""
    begins = range(0, len(marks), block)
    weights = Weights(block)
    costs = [0 if state in ENDS else _NEVER for state in STATES]
    ways = []
    for begin in reversed(begins):
        costs, letters = weights.block(marks[begin : begin + block], costs, begin == begins[-1])
        ways.append(letters)
    initials = {number: name for name, number in INITIALS.items()}
    state, spelled, row = START, [], 0
    for letters in reversed(ways):
        part = weights.spell(letters[state])
        for letter in part:
            initial = "" if letter == "I" else initials.get(marks[row] & 3, "")
            state = follow(state, letter, initial)
            row += letter != "I"
        spelled.append(part)
    return costs[START], "".join(spelled)


# --- in Spark ----------------------------------------------------------------------------

_PLAN = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_SPACE = " \t\n\x0b\x0c\r"
ROWS = 2048


def _plain(rows: DataFrame) -> DataFrame:
    """The four columns, with one space for a NULL role or text."""
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text"), 256))


def marks(rows: DataFrame) -> DataFrame:
    """Order and mark of each row, laid out by conversation."""
    shown = F.rtrim("text", F.lit(_SPACE))
    again = Window.partitionBy("conv_id", "digest").orderBy(F.asc_nulls_first("turn"))
    initial = F.expr("CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END")
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.row_number().over(again) > 1, DUPLICATE)
        .when(F.col("cut"), CUT)
        .otherwise(NONE)
    )
    return (
        rows.select(
            "conv_id", "turn", "role", _digest().alias("digest"), initial.alias("initial"),
            (F.length(shown) == 0).alias("blank"), (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        )
        .repartition("conv_id")
        .withColumn("mark", (F.col("initial") + fault).cast("int"))
    )


@dataclass
class _Conversation:
    """What is gathered of the rows of one conversation, in order."""

    conv_id: int | None
    marks: bytearray = field(default_factory=bytearray)
    first: int | None = None
    last: int | None = None
    turns: int = 0

    def add(self, turn: int | None, mark: int) -> None:
        self.marks.append(mark)
        if turn is None:
            return
        if self.first is None:
            self.first = turn
        if turn != self.last:
            self.turns += 1
            self.last = turn

    def plan(self) -> tuple:
        faults = [mark & 12 for mark in self.marks]
        initials = [mark & 3 for mark in self.marks]
        illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:]))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        counts = [faults.count(fault) for fault in (BLANK, DUPLICATE, CUT)]
        return (self.conv_id, gaps, *counts, illegal, *cheapest(bytes(self.marks)))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))])


def plans(rows: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, the cost and the letters of its repair."""
    schema = _schema("conv_id long, " + _PLAN)

    def planned(batches) -> Iterator[tuple]:
        held = None
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "turn", "mark"))
            for conv_id, turn, mark in zip(*columns, strict=True):
                if held is None or held.conv_id != conv_id:
                    if held:
                        yield held.plan()
                    held = _Conversation(conv_id)
                held.add(turn, mark)
        if held:
            yield held.plan()

    return (
        marks(rows)
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
        .select("conv_id", "turn", "mark")
        .mapInArrow(lambda batches: one_task_batches(planned(batches), schema, ROWS), "conv_id long, " + _PLAN)
    )


_REPAIRED = "conv_id long, place long, edit string, role string, text string, " + _PLAN
_SORTED = "conv_id long, kind int, turn long, role string, digest binary, text string, " + _PLAN
_FAULTS = tuple(each.split()[0] for each in _PLAN.split(", "))
_NO_PLAN = (None,) * len(_FAULTS)


class _Repair:
    """Follows the edits of one conversation while its rows pass by."""

    def __init__(self, conv_id: int | None, edits: str):
        self.conv_id, self.edits = conv_id, edits
        self.state, self.place, self.done = START, 0, 0

    def _row(self, letter: str, role: str, text: str) -> tuple:
        self.place += 1
        return (self.conv_id, self.place - 1, letter, role, text, *_NO_PLAN)

    def inserts(self) -> Iterator[tuple]:
        """The rows inserted before the next row, or behind the last one."""
        while self.done < len(self.edits) and self.edits[self.done] == "I":
            self.done += 1
            self.state = follow(self.state, "I", "")
            yield self._row("I", ROLE_INTO[self.state], "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserts()
        letter = self.edits[self.done]
        self.done += 1
        self.state = follow(self.state, letter, role[:1])
        if letter == "K":
            yield self._row(letter, role, text)
        elif letter == "R":
            yield self._row(letter, ROLE_INTO[self.state], text)


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows of each conversation, in order within their partition.

    ``place`` counts them from 0 and ``edit`` names what was done.  A row at place -1 without role
    and text comes first and holds the numbers of faults, the cost and the letters of all edits.
    """
    ship(conversations.sparkSession)
    rows = _plain(conversations)
    schema = _schema(_REPAIRED)

    def repaired(part: pa.RecordBatch, current: _Repair | None) -> Iterator[tuple]:
        columns = (part.column(name).to_pylist() for name in ("conv_id", "role", "text", *_FAULTS))
        for conv_id, role, text, *plan in zip(*columns, strict=True):
            if role is not None:
                yield from current.row(role, text)
                continue
            if current:
                yield from current.inserts()
            current = _Repair(conv_id, plan[-1])
            yield (conv_id, -1, None, None, None, *plan)
        return current

    def of(batches):
        current = None
        for part in slices(batches):
            found: list[tuple] = []
            steps = repaired(part, current)
            while True:
                try:
                    found.append(next(steps))
                except StopIteration as end:
                    current = end.value
                    break
            yield from one_task_batches(iter(found), schema, ROWS)
        if current:
            yield from one_task_batches(current.inserts(), schema, ROWS)

    heads = plans(rows).withColumn("kind", F.lit(0))
    texts = rows.withColumns({"kind": F.lit(1), "digest": _digest()})
    return (
        heads.unionByName(texts, allowMissingColumns=True)
        .select(*(each.split()[0] for each in _SORTED.split(", ")))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "digest")
        .drop("kind", "turn", "digest")
        .mapInArrow(of, _REPAIRED)
    )


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: what ``repair`` found and the SHA-256 of its rows."""
    out = "conv_id long, " + _PLAN + ", repaired_sha256 string"
    schema = _schema(out)

    def hashed(batches) -> Iterator[tuple]:
        head, digest = None, None
        names = ("conv_id", "place", "role", "text", *_FAULTS)
        for batch in batches:
            for conv_id, place, role, text, *plan in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if place < 0:
                    if head:
                        yield (*head, digest.hexdigest())
                    head, digest = (conv_id, *plan), hashlib.sha256()
                else:
                    digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if head:
            yield (*head, digest.hexdigest())

    return repaired.mapInArrow(lambda batches: one_task_batches(hashed(batches), schema, ROWS), out)


# --- the query -----------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """Drop, empty, cut, repeat or rerole a twentieth of the rows each, by the crc32 of their name."""
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    kind = F.col("kind")
    changed = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    return (
        conversations.select("conv_id", "turn", "role", "text", (F.crc32(name) % 20).alias("kind"))
        .where(kind != 0)
        .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                changed.alias("text"), F.expr("explode(if(kind = 3, array(0, 1), array(0))) AS copy"))
        .drop("copy")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: faults and repair of every conversation, after the damage."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = digests(repair(damage(conversations)))
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    found = found.withColumnRenamed("conv_id", "found_id")
    joined = every.join(found, every["conv_id"].eqNullSafe(found["found_id"]), "left")
    zeros = {name: F.coalesce(name, F.lit(0).cast("long")) for name in _FAULTS[:-1]}
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id",
        *(value.alias(name) for name, value in zeros.items()),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
