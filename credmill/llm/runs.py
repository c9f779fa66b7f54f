"""Periodic runs of words, by a suffix automaton and the access operation of link-cut trees.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical) of at least ``max(min_length, min_exponent * q)`` words that no neighbouring word
extends.

The suffix automaton of a stretch of words is built whole, so the tree of its suffix links
stands still.  Then the words are gone through once more.  Appending the word at ``end``
accesses the state of that prefix: every state on its way to the root has its last
occurrence recoloured to ``end``.  States of one colour lie on the way one below the other;
of each such segment the longest string, of ``l`` words, ended at ``seen`` before.  With
``d = end - seen`` the last ``l + d`` words have period ``d``, so from ``l >= d`` on they hold a
square.  The last occurrence is the nearest one, which makes ``d`` the smallest period where
``l >= 2 * d``, and the longest string makes the stretch reach as far to the left as it
can.  It is a run where the next word breaks the period.  The preferred paths of the access
are stacks on the heavy paths of the tree, which take the place of splay trees as no link is
ever cut; an access changes O(log n) segments on average.

All but the first ``q`` words of a run come again within it, so any run is covered by
windows of ``min_length - min_length // min_exponent`` words that its document has twice.
Words outside such windows are in no run; the automaton is built for each unbroken stretch of
the others.  An automaton takes some 420 bytes a word of its stretch (measured on 200,000
words), and a stretch is part of one text.

Defined cases: a NULL or empty text has no words and no run; a NULL document id and repeated
rows are treated like others; a very long text is one slice, with arrays of 8 bytes a word; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.llm import words
from credmill.llm.arrow import raw_texts, slices
from credmill.llm.shipping import ship

MIN_LENGTH = 24
MIN_EXPONENT = 3

Run = tuple[int, int, int]  # start, length, period
Change = Callable[[int | None, list[bytes]], list[bytes]]


class SuffixAutomaton:
    """States of all substrings of a sequence, joined by their suffix links."""

    def __init__(self, items: list[int]):
        length, link, edges = [0], [-1], [{}]
        self.prefixes = prefixes = []
        last = 0
        for item in items:
            new = len(length)
            length.append(length[last] + 1)
            edges.append({})
            state = last
            while state >= 0 and item not in edges[state]:
                edges[state][item] = new
                state = link[state]
            if state < 0:
                link.append(0)
            else:
                target = edges[state][item]
                if length[target] == length[state] + 1:
                    link.append(target)
                else:
                    clone = new + 1
                    link.append(clone)
                    length.append(length[state] + 1)
                    link.append(link[target])
                    edges.append(dict(edges[target]))
                    while state >= 0 and edges[state].get(item) == target:
                        edges[state][item] = clone
                        state = link[state]
                    link[target] = clone
            last = new
            prefixes.append(new)
        self.length, self.link = length, link

    def heads(self) -> list[int]:
        """For each state the first state of its heavy path, seen from the root."""
        length, link = self.length, self.link
        order = np.argsort(np.array(length), kind="stable").tolist()
        size = [1] * len(length)
        heavy = [0] * len(length)
        largest = [0] * len(length)
        for state in reversed(order[1:]):
            above = link[state]
            size[above] += size[state]
            if size[state] > largest[above]:
                largest[above], heavy[above] = size[state], state
        head = list(range(len(length)))
        for state in order[1:]:
            if heavy[link[state]] == state:
                head[state] = head[link[state]]
        return head

    def last_occurrences(self) -> Iterator[tuple[int, int, int]]:
        """Per prefix and segment recoloured: its end, the end seen before, the words they share."""
        length, link, head = self.length, self.link, self.heads()
        # Segments of a heavy path, the one next to the root last: longest length, last end.
        segments: dict[int, list[tuple[int, int]]] = {}
        for end, state in enumerate(self.prefixes):
            colour = -1
            while state > 0:
                top, depth = head[state], length[state]
                stack = segments.setdefault(top, [])
                met = []
                while stack:
                    longest, seen = stack[-1]
                    met.append((seen, min(longest, depth)))
                    if longest > depth:
                        break
                    stack.pop()
                    if longest == depth:
                        break
                for seen, shared in reversed(met):
                    if seen != colour:  # a segment may go on in the next heavy path
                        yield end, seen, shared
                        colour = seen
                stack.append((depth, end))
                state = link[top]


def runs_of(items: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """The runs of a sequence by start, then period."""
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(item, len(numbers)) for item in items]
    found = []
    for end, seen, shared in SuffixAutomaton(ids).last_occurrences():
        period = end - seen
        if shared < (min_exponent - 1) * period or shared + period < min_length:
            continue
        if end + 1 == len(ids) or ids[end + 1] != ids[end + 1 - period]:
            found.append((end + 1 - shared - period, shared + period, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(of: words.Words, width: int) -> list[tuple[int, int]]:
    """Bounds of the unbroken stretches of words in windows that a document has twice or more."""
    hashes, doc_of = of.hashes(), of.doc_of
    n = len(hashes) - width + 1
    if n <= 0:
        return []
    inside = np.flatnonzero(doc_of[width - 1 :] == doc_of[:n])
    keys = words.window_hashes(hashes, width)[inside]
    keys ^= words.mix(doc_of[inside].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    equal = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    steps = np.zeros(len(hashes) + 1, np.int64)
    steps[inside[again]] += 1
    steps[inside[again] + width] -= 1
    covered = np.cumsum(steps)[:-1] > 0
    # A stretch ends where its document does.
    begins = covered & np.insert(~covered[:-1] | (doc_of[1:] != doc_of[:-1]), 0, True)
    ends = covered & np.append(~covered[1:] | (doc_of[1:] != doc_of[:-1]), True)
    return list(zip(np.flatnonzero(begins).tolist(), (np.flatnonzero(ends) + 1).tolist(), strict=True))


def runs_of_texts(
    texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[list[Run]]:
    """The runs of each list of words."""
    of = words.split([b" ".join(text) for text in texts])
    found: list[list[Run]] = [[] for _ in texts]
    for first, end in stretches(of, min_length - min_length // min_exponent):
        doc = int(np.searchsorted(of.doc_words, first, side="right")) - 1
        begin = first - int(of.doc_words[doc])
        stretch = texts[doc][begin : begin + end - first]
        found[doc] += [(begin + s, n, p) for s, n, p in runs_of(stretch, min_length, min_exponent)]
    return found


def without_repeats(text: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words but for those of a run behind its first period."""
    if not runs:
        return text
    dropped = np.zeros(len(text), bool)
    for start, length, period in runs:
        dropped[start + period : start + length] = True
    return [word for word, gone in zip(text, dropped.tolist(), strict=True) if not gone]


def periodic_runs(
    docs: DataFrame,
    *,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    change: Change | None = None,
) -> DataFrame:
    """Runs of each document and its words without their repeats, joined by spaces.

    ``change`` is applied to the document id and the words before.
    """
    ship(docs.sparkSession)
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def of(batches):
        for part in slices(batches):
            ids = part.column("doc_id").to_pylist()
            texts = [text.split() for text in raw_texts(part.column("text"))]
            if change:
                texts = [change(doc_id, text) for doc_id, text in zip(ids, texts, strict=True)]
            found = runs_of_texts(texts, min_length, min_exponent)
            kept = [b" ".join(without_repeats(*each)) for each in zip(texts, found, strict=True)]
            structs = [[dict(zip(("start", "length", "period"), each, strict=True)) for each in runs] for runs in found]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(structs, pa.list_(run)), pa.array(kept, pa.binary()).cast(pa.string())],
                schema=schema,
            )

    kinds = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, kinds)


def plant_run(doc_id: int | None, text: list[bytes]) -> list[bytes]:
    """The query's damage: a tenth of all documents end in a run.  No id, no damage."""
    n = len(text)
    if doc_id is None or not n:
        return text
    number = zlib.crc32(str(doc_id).encode())
    if number % 10:
        return text
    g = number // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return text[:first] + [text[first + i % period] for i in range(n - first)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: number and greatest of the runs, and digests of all runs and of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Exact comparison of length / period; the earlier run, then the shorter period, wins a tie.
    greater = "a.length * b.period > b.length * a.period"
    tie = "a.length * b.period = b.length * a.period AND (a.start, a.period) <= (b.start, b.period)"
    best = f"reduce(runs, runs[0], (a, b) -> if(({greater}) OR ({tie}), a, b))"
    lines = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"
    return (
        periodic_runs(docs, change=plant_run)
        .withColumn("best", F.expr(f"if(size(runs) > 0, {best}, NULL)"))
        .selectExpr(
            "doc_id",
            "cast(size(runs) AS long) AS n_runs",
            "best.start AS start",
            "best.length AS length",
            "best.period AS period",
            "1000 * best.length div best.period AS exponent_milli",
            f"sha2(concat_ws('', {lines}), 256) AS runs_sha256",
            "sha2(collapsed, 256) AS collapsed_sha256",
        )
    )
