"""Personal data: the base against its patterns, the votes against simulated labelers."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest

from credmill.llm import personal

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == personal.IP:
        return all(int(part) <= 255 for part in found.split("."))
    if kind == personal.CARD:
        doubled = "".join(str(int(d) * (1 + place % 2)) if int(d) * (1 + place % 2) < 10 else str(int(d) * 2 - 9)
                          for place, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and sum(map(int, doubled)) % 10 == 0
    return kind == personal.EMAIL or 10 <= len(digits) <= 15


def plain(text):
    return sorted(
        (match.start(), kind, match.end())
        for kind, pattern in enumerate(PATTERNS)
        for match in re.finditer(pattern, text)
        if passes(kind, match.group())
    )


@pytest.mark.parametrize("letters", ["a.@-é 1%", "12.@+ -()", "0123456789 -+", "1.2 345", "ab@.c", "2.5 5.0"])
def test_base(letters):
    rng = random.Random(letters)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(70)))
        assert [(s.start, s.kind, s.end) for s in personal.base_spans(text)] == plain(text)


def card(rng, start="4", right=True):
    while True:
        digits = start + "".join(rng.choice("0123456789") for _ in range(16 - len(start)))
        if passes(personal.CARD, digits) == right:
            return digits


def corpus():
    """Rows of (text, texts to be found)."""
    rng = random.Random(9)
    rows = []
    for i in range(300):
        word = rng.choice(["alpha", "gamma"])
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        mail, ip = f"{word}.{i}@mail{i % 9}.example.com", ".".join(str(rng.randrange(1, 223)) for _ in range(4))
        wanted = rng.choice([[card(rng)], [phone], [mail], [ip], [card(rng), card(rng)], [phone, ip], [phone, card(rng)]])
        rows.append((f"some {word} words " + " ".join(wanted) + " and others", wanted))
        rows.append((f"no {word} here " + card(rng, rng.choice("0789"), right=False) + " or version 2.0 at 12:30", []))
    rows.append(("écrire à zoé.78@mail9.example.com demain", ["zoé.78@mail9.example.com"]))
    rows.append(("write to jo.doe (at) example (dot) com today", ["jo.doe (at) example (dot) com"]))
    rows.append(("host 10[.]20[.]30[.]40 is down", ["10[.]20[.]30[.]40"]))
    rows.append(("call (212) 555-0187 now", ["(212) 555-0187"]))
    rows.append(("they meet at noon. dot and at it", []))
    return rows


def test_added_spans(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(rows)], "doc_id long, text string")
    model = personal.train(docs)
    for row in personal.find_spans(docs, model).collect():
        text, wanted = rows[row.doc_id]
        whole = [(s.start, s.end) for s in row.spans]
        parts = [(a, b) for a, b in whole if any(c <= a and b <= d and (a, b) != (c, d) for c, d in whole)]
        assert [text[a:b] for a, b in whole if (a, b) not in parts] == wanted
    hidden = {row.doc_id: row.text for row in personal.masked(docs, model).collect()}
    assert hidden[len(rows) - 5] == "écrire à [email] demain"
    assert hidden[len(rows) - 1] == rows[-1][0]


def test_reliabilities_of_simulated_labelers():
    rng = np.random.default_rng(4)
    real = rng.random(40_000) < 0.3
    on_real = np.array([0.9, 0.97, 0.8, 0.7, 0.95, 0.9])
    on_false = np.array([0.1, 0.12, 0.4, 0.2, 0.9, 0.8])
    says = rng.random((len(real), 6)) < np.where(real[:, None], on_real, on_false)
    said = np.where(rng.random(says.shape) < 0.2, personal.NOTHING, np.where(says, personal.YES, personal.NO))
    rows, n = np.unique(said, axis=0, return_counts=True)
    found_real, found_false, posterior, share = personal.reliabilities(rows, n.astype(float))
    assert np.abs(found_real - on_real).max() < 0.03
    assert np.abs(found_false - on_false).max() < 0.03
    assert abs(share - 0.3) < 0.02
    assert ((posterior >= 0) & (posterior <= 1)).all()


def test_fit_has_no_slope_left():
    rng = np.random.default_rng(1)
    x = np.hstack([np.ones((50, 1)), rng.integers(0, 2, (50, 4))]).astype(float)
    target, n = rng.random(50), rng.integers(1, 1000, 50).astype(float)
    weights = personal.fit(x, target, n)
    p = 1 / (1 + np.exp(-(x @ weights)))
    assert np.abs(x.T @ (n * (p - target)) + personal.RIDGE * weights).max() < 1e-5


@pytest.mark.parametrize("text", ["a" * 10**6, "1" * 10**6, "1." * 300_000, "a@" * 10**5, "1234 " * 10**5,
                                  "+1(" * 10**5, "é.1@b.de " * 30_000, "(at)" * 10**5])
def test_time_grows_with_the_text(text):
    begin = time.process_time()
    personal.spans_of(text, personal.Model({}))
    assert time.process_time() - begin < 10


def expected(doc_id, text):
    base = plain(text or "")
    names = [f"{personal.KINDS[kind]}:{start}:{end}" for start, kind, end in base]
    counts = [sum(span[1] == kind for span in base) for kind in range(4)]
    return (doc_id, *counts, hashlib.sha256(",".join(names).encode()).hexdigest()), names


def checked(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = personal.query(spark, str(folder))
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    found = sorted(map(tuple, found.collect()), key=str)
    wanted = sorted((expected(*row) for row in rows), key=lambda pair: str(pair[0]))
    assert [row[:6] for row in found] == [row for row, _ in wanted]
    by_id = {}
    for row in found:
        by_id.setdefault(row[:6], row[6].split(",") if row[6] else [])
    for row, names in wanted:
        spans = by_id[row]
        assert set(names) <= set(spans)
        order = [(int(start), personal.KINDS.index(kind), int(end)) for kind, start, end in (s.split(":") for s in spans)]
        assert order == sorted(order)


def test_query(spark, sf_dir):
    checked(spark, sf_dir)


def test_query_of_odd_rows(spark, odd_rows, documents, tmp_path):
    more = [(100 + i, text) for i, (text, _) in enumerate(corpus()[:40])]
    frame = documents(*odd_rows, *more, *more[:3], (500, "word " * 300_000 + "4" * 5000))
    for name in ("spans", "kind", "votes", "n"):
        frame = frame.withColumn(name, personal.F.lit("x"))
    frame.write.parquet(f"{tmp_path}/a/documents.parquet")
    checked(spark, tmp_path / "a")
    frame.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    checked(spark, tmp_path / "b")
