"""Periodic runs, against the comparison of all pairs of words at every distance."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from texts import prose

from credmill.llm import runs


def plain_runs(text, min_length=24, min_exponent=3):
    numbers = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in text])
    found = []
    for period in range(1, len(text) // min_exponent + 1):
        equal = np.concatenate([[False], ids[period:] == ids[:-period], [False]])
        bounds = np.flatnonzero(equal[1:] != equal[:-1]).tolist()
        for start, end in zip(bounds[::2], bounds[1::2], strict=True):
            length = end - start + period
            if length >= max(min_length, min_exponent * period):
                stretch = text[start : start + length]
                smaller = (p for p in range(1, period) if period % p == 0)
                if not any(stretch[p:] == stretch[:-p] for p in smaller):
                    found.append((start, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def periodic(rng, n, letters):
    text = [b"%d" % rng.randrange(letters) for _ in range(n)]
    for _ in range(3):
        first = rng.randrange(n)
        period = rng.randrange(1, 14)
        for i in range(first + period, min(n, first + rng.randrange(1, 80))):
            text[i] = text[i - period]
    return text


@pytest.mark.parametrize(("min_length", "min_exponent"), [(24, 3), (6, 3), (9, 4)])
def test_runs(min_length, min_exponent):
    rng = random.Random(min_length)
    texts = [periodic(rng, rng.randrange(1, 120), rng.choice([1, 2, 3, 50])) for _ in range(600)] + [[]]
    found = runs.runs_of_texts(texts, min_length, min_exponent)
    assert found == [plain_runs(text, min_length, min_exponent) for text in texts]


def test_neighbouring_documents_do_not_join():
    text = [b"a", b"b"] * 8
    assert runs.runs_of_texts([text, text]) == [[], []]


def test_a_long_run_over_the_whole_text():
    text = [b"%d" % (i % 3333) for i in range(30_000)]
    assert runs.runs_of_texts([text]) == [[(0, 30_000, 3333)]]


def row(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    kept = b" ".join(word for i, word in enumerate(words) if i not in gone)
    best = (None,) * 4
    if found:
        start, length, period = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = start, length, period, 1000 * length // period
    return (doc_id, len(found), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def checked(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    frame = runs.query(spark, str(folder))
    assert frame.columns == COLUMNS
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(str(row(*each)) for each in table)


def test_query(spark, sf_dir):
    checked(spark, sf_dir)


def test_query_of_odd_rows(spark, odd_rows, documents, tmp_path):
    rng = random.Random(2)
    lines = "one two three four\n" * 30
    more = [(100 + i, b" ".join(periodic(rng, 200, 3)).decode()) for i in range(60)]
    rows = [*odd_rows, (20, lines), (20, lines), (None, lines), (21, "é ñ " * 12), (22, lines + prose(rng, 50) + lines), *more]
    frame = documents(*rows).withColumn("runs", runs.F.lit("x")).withColumn("collapsed", runs.F.lit("x"))
    frame.write.parquet(f"{tmp_path}/a/documents.parquet")
    checked(spark, tmp_path / "a")
    frame.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    checked(spark, tmp_path / "b")
