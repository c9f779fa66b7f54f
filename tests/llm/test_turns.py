"""Repair of conversations, against the enumeration of all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from credmill.llm import turns

ROLES = ["system", "user", "assistant", "tool", " ", "", "udder"]
TEXTS = ["Good.", "Why?", "cut off", "", " \t\n", "Good. ", "ends!\n", "été.", " "]
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Fault of each (role, text)."""
    seen, found = set(), []
    for role, text in rows:
        visible = VISIBLE.findall(text)
        if not visible:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def options(role, text, fault):
    """(letter, cost, role, text) of each edit of a row; None where no row is left."""
    yield "D", 2, None, None
    if fault in ("blank", "duplicate"):
        return
    more = 5 * (fault == "truncated")
    if role[:1] in ("s", "u", "a"):
        yield "K", more, role, text
    for other in ("user", "assistant"):
        yield "R", 1 + more, other, text


def least(rows, most=2):
    """The cheapest edits, by trying all."""
    between = [
        [("I", 5, role, "") for role in inserted]
        for n in range(most + 1)
        for inserted in itertools.product(("user", "assistant"), repeat=n)
    ]
    parts = [between]
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        parts += [[[edit] for edit in options(role, text, fault)], between]
    best = None
    for choice in itertools.product(*parts):
        edits = [edit for part in choice for edit in part]
        kept = [edit for edit in edits if edit[2] is not None]
        if not LEGAL.fullmatch("".join(edit[2][:1] for edit in kept)):
            continue
        cost = sum(edit[1] for edit in edits)
        letters = "".join(edit[0] for edit in edits)
        if best is None or (cost, letters) < best[:2]:
            best = cost, letters, [(edit[2], edit[3]) for edit in kept]
    return best


def ordered(rows):
    """Rows of (turn, role, text) in the order that the module defines."""
    return sorted(
        rows,
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest()),
    )


def expected(rows):
    """All columns but the id, for rows of (turn, role, text) without NULL roles and texts."""
    rows = ordered(rows)
    pairs = [row[1:] for row in rows]
    found = faults(pairs)
    numbers = sorted({row[0] for row in rows if row[0] is not None})
    gaps = numbers[-1] - numbers[0] + 1 - len(numbers) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    cost, letters, kept = simple(pairs)
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
    counts = [found.count(name) for name in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, letters, digest)


def simple(pairs):
    """The cheapest edits from first to last, by tuples of cost and letters; for longer conversations."""
    ways = {"": (0, "", [])}

    def improve(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def shift(state, role):
        """Roles so far, as few as tell what may follow."""
        if role[:1] == "s":
            return "s" if state == "" else None
        if role[:1] == "u":
            return "u" if state in ("", "s", "a") else None
        return "a" if state == "u" else None

    def inserted(table):
        for _ in range(2):
            for state, (cost, letters, kept) in list(table.items()):
                for role in ("user", "assistant"):
                    then = shift(state, role)
                    if then is not None:
                        improve(table, then, (cost + 5, letters + "I", [*kept, (role, "")]))
        return table

    for (role, text), fault in zip(pairs, faults(pairs), strict=True):
        after = {}
        for state, (cost, letters, kept) in inserted(ways).items():
            for letter, price, new, words in options(role, text, fault):
                then = state if new is None else shift(state, new)
                if then is not None:
                    more = kept if new is None else [*kept, (new, words)]
                    improve(after, then, (cost + price, letters + letter, more))
        ways = after
    return min((way for state, way in inserted(ways).items() if state in ("", "a")), key=lambda way: way[:2])


def mark(role, fault):
    kinds = {"": turns.NONE, "truncated": turns.CUT, "blank": turns.BLANK, "duplicate": turns.DUPLICATE}
    return turns.INITIALS.get(role[:1], 0) + kinds[fault]


def test_least_weight_against_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        pairs = [(rng.choice(ROLES[:4]), rng.choice(TEXTS[:4])) for _ in range(rng.randrange(4))]
        marks = bytes(map(mark, *zip(*zip((p[0] for p in pairs), faults(pairs)), strict=True))) if pairs else b""
        assert turns.cheapest(marks) == least(pairs, 2 if len(pairs) < 3 else 1)[:2]
        assert simple(pairs) == least(pairs, 2 if len(pairs) < 3 else 1)


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_blocks_do_not_change_the_edits(block):
    rng = random.Random(block)
    for _ in range(60):
        pairs = [(rng.choice(ROLES), rng.choice(TEXTS) + str(rng.randrange(9))) for _ in range(rng.randrange(120))]
        marks = bytes(mark(role, fault) for (role, _), fault in zip(pairs, faults(pairs), strict=True))
        assert turns.cheapest(marks, block) == simple(pairs)[:2]


def found(frame):
    return {row[0]: tuple(row)[1:] for row in frame.collect()}


def test_conversations(spark):
    rng = random.Random(8)
    by_conv = {}
    for conv_id in (None, *range(40)):
        n = rng.choice([1, 3, 9, 60])
        numbers = [None, *range(n)] if conv_id is None or conv_id % 4 == 0 else range(3, n + 4)
        by_conv[conv_id] = [(rng.choice(numbers), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)]
    rows = [(conv_id, *row) for conv_id, own in by_conv.items() for row in own]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("kind", "mark", "digest", "cost", "audit", "place"):  # clashing names
        frame = frame.withColumn(name, turns.F.lit("x"))
    repaired = turns.repair(frame)
    assert found(turns.digests(repaired)) == {conv_id: expected(own) for conv_id, own in by_conv.items()}
    rows_of = {}
    for row in repaired.where("place >= 0").collect():
        rows_of.setdefault(row.conv_id, []).append((row.place, row.role, row.text))
    for conv_id, own in by_conv.items():
        kept = simple([row[1:] for row in ordered(own)])[2]
        assert sorted(rows_of.get(conv_id, [])) == [(place, *row) for place, row in enumerate(kept)]


def damaged(conv_id, turn, role, text):
    name = ":".join(" " if part is None else str(part) for part in (conv_id, turn))
    kind = zlib.crc32(name.encode()) % 20
    role, text = (" " if part is None else part for part in (role, text))
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (kind != 0) * (1 + (kind == 3))


def of_table(rows):
    by_conv = {}
    for conv_id, *row in rows:
        by_conv.setdefault(conv_id, []).extend(damaged(conv_id, *row))
    return {conv_id: expected(own) for conv_id, own in by_conv.items()}


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found(turns.query(spark, sf_dir)) == of_table(map(tuple, rows.collect()))


def test_query_of_odd_rows(spark, tmp_path):
    """NULLs, a long text, repeated rows, a conversation that loses all its rows, an empty table."""
    rng = random.Random(3)
    gone = next(i for i in range(10**6) if not damaged(i, 0, "user", "x"))
    rows = [(gone, 0, "user", "x"), (1, None, None, None), (None, 2, "user", "Hm."), (5, 1, "user", "long " * 10**6 + "?")]
    rows += [(7, rng.choice([None, 1, 2, 5]), rng.choice([None, *ROLES]), rng.choice([None, *TEXTS])) for _ in range(40)]
    rows += rows[-5:]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.withColumn("kind", turns.F.lit(1)).write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert found(turns.query(spark, f"{tmp_path}/a")) == of_table(rows)
    frame.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert found(turns.query(spark, f"{tmp_path}/b")) == {}
