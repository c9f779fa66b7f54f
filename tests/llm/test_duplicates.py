"""Near duplicates, repeats and components against brute force."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from texts import prose

from credmill.llm import components, embeddings, minhash, phrases, repeats, suffixes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def grouped(links, nodes):
    above = {n: n for n in nodes}

    def root(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)]
    links += [(i, i + 1) for i in range(300, 360)]  # a long chain
    rows = components.connected(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in rows} == grouped(links, nodes)
    assert len(rows) == len(nodes)


def test_components_of_nothing(spark):
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def near_brute(rows, width, percent=80):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").encode().translate(lower))
        runs = zip(*(words[i:] for i in range(width))) if len(words) >= width else [tuple(words)] if words else []
        sets[doc_id] = set(runs)
    ids = sorted(i for i in sets if i is not None)
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]
    ]
    return {i: len(sets[i]) for i in sets}, grouped(links, ids)


@pytest.mark.parametrize(("width", "block"), [(2, 256), (5, 256), (2, 2)])
def test_near_duplicates(documents, width, block):
    rng = random.Random(width)
    rows = []
    for family in range(12):
        base = prose(rng, rng.choice([1, 2, 5, 12, 18, 30, 200]), 3000)
        for _ in range(rng.choice([1, 3, 12])):
            words = base.split()
            for _ in range(rng.randint(0, max(1, len(words) // 15))):
                words[rng.randrange(len(words))] = rng.choice(["new", "x9", "W1"])
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    found = minhash.near_duplicates(documents(*rows), shingle_words=width, block=block).collect()
    sizes, component = near_brute(rows, width)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {
        i: (sizes[i], component[i]) for i in sizes
    }
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_odd_rows(odd, odd_rows):
    found = minhash.near_duplicates(odd, shingle_words=2).collect()
    named = [r for r in odd_rows if r[0] is not None]
    sizes, component = near_brute(named, 2)
    assert len(found) == len(odd_rows)
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.n_shingles, row.component_id) == (sizes[row.doc_id], component[row.doc_id])
    kept = minhash.keep_first(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in set(component) if component[i] == i)
    assert ids.count(None) == 2


def test_texts_of_one_id_are_judged_apart(documents):
    rng = random.Random(6)
    a, b, c, d = (prose(rng, 80, 5000) for _ in range(4))
    near_a, near_b = a + " more", b + " more"
    rows = [(1, a), (1, b), (2, near_a), (0, near_b), (1, a), (3, c), (3, d), (4, None), (4, ""), (None, a), (-7, c)]
    kept = sorted(map(str, ((r.doc_id, r.text) for r in minhash.keep_first(documents(*rows)).collect())))
    assert kept == sorted(map(str, [(1, a), (0, near_b), (3, d), (4, None), (4, ""), (None, a), (-7, c)]))
    none_near = minhash.keep_first(documents((1, a), (1, b), (2, c))).collect()
    assert sorted(r.text for r in none_near) == sorted([a, b, c])


def test_which_of_repeated_rows_stays_does_not_depend_on_their_order(documents):
    rows = [(1, "one two three four five six")] * 3
    frame = documents(*rows).withColumn("source", minhash.F.monotonically_increasing_id().cast("string"))
    found = {minhash.keep_first(frame.repartition(n)).first().source for n in (1, 2, 3)}
    assert len(found) == 1


@pytest.mark.parametrize("block", [2, 256])
def test_a_chain_of_growing_sets(documents, block):
    """Each document holds the one before and some more words: links reach over the bands of sizes."""
    rng = random.Random(block)
    words = [f"u{i}" for i in range(1200)]
    rows, size = [], 30
    while size < 1200:
        rows.append((len(rows), " ".join(words[:size])))
        size += max(1, round(size * rng.choice([0.05, 0.2, 0.24, 0.26])))
    rng.shuffle(rows)
    found = minhash.near_duplicates(documents(*rows), shingle_words=2, block=block).collect()
    _, component = near_brute(rows, 2)
    assert {r.doc_id: r.component_id for r in found} == {i: component[i] for i, _ in rows}
    assert len(set(component.values())) > 1


def test_a_long_list_sends_each_class_to_few_blocks(spark):
    """One list of 60,000 classes of all sizes: bands halve the rows sent, and more with less crowded ones."""
    n = 60_000
    known = spark.range(n).selectExpr(
        "7L AS value", "id AS rep", "cast(30 + pow(1.0002, id % 40000) AS bigint) AS n", "id AS component", "60000L AS size"
    )
    grouped = minhash._grouped(known, 80)
    sent = grouped.selectExpr("sum(ceil(size / 256)) AS rows").first().rows
    assert grouped.count() <= 2 * n
    assert sent < n * (n // 256) / 2


def test_near_duplicates_of_nothing(documents):
    assert minhash.keep_first(documents((1, "a")).filter("false")).count() == 0
    assert minhash.near_duplicates(documents((1, "a")).filter("false")).count() == 0


def repeats_brute(rows, items_of, width):
    """Flags of the items that go, for rows with an id."""
    first = {}
    for doc_id, text in rows:
        items = items_of(text)
        if doc_id is not None:
            for at in range(len(items) - width + 1):
                window = tuple(items[at : at + width])
                first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        items = items_of(text)
        gone = [False] * len(items)
        for at in range(len(items) - width + 1 if doc_id is not None else 0):
            if first[tuple(items[at : at + width])] < doc_id:
                gone[at : at + width] = [True] * width
        out.append((doc_id, items, gone))
    return out


def mixed_rows(seed):
    rng = random.Random(seed)
    passages = [prose(rng, rng.choice([14, 20, 60])) for _ in range(4)]
    rows = []
    for doc_id in rng.sample(range(100), 30):
        parts = [rng.choice(passages) if rng.random() < 0.4 else prose(rng, rng.randint(1, 80)) for _ in range(3)]
        rows.append((doc_id, " ".join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(8)]  # copies
    return rows + [(300, "ab" * 400), (301, "ab" * 300), (302, "é" * 90), (303, "é" * 70)]


@pytest.fixture(params=[1 << 14, 2])
def small_slices(monkeypatch, request):
    """Several buckets even for small tables, with no hot anchor and with many; set where the tasks are made."""
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 4096)
    monkeypatch.setattr(repeats, "HOT_ANCHOR", request.param)


@pytest.mark.parametrize("seed", range(2))
def test_substrings(documents, small_slices, seed):
    rows = mixed_rows(seed)
    found = {r.doc_id: tuple(r)[1:] for r in suffixes.digests(documents(*rows)).collect()}
    for doc_id, items, gone in repeats_brute(rows, lambda t: t.encode(), 50):
        kept = bytes(b for b, g in zip(items, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        assert found[doc_id] == (len(items), sum(gone), spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(2))
def test_passages(documents, small_slices, seed):
    rows = mixed_rows(seed)
    found = {r.doc_id: tuple(r)[1:] for r in phrases.digests(documents(*rows)).collect()}
    for doc_id, items, gone in repeats_brute(rows, lambda t: WORD.findall(t.encode()), 13):
        kept = b" ".join(w for w, g in zip(items, gone) if not g)
        assert found[doc_id] == (len(items), sum(gone), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("kind", [suffixes.byte_kind(), phrases.word_kind()])
def test_hot_anchors_are_spread(spark, documents, monkeypatch, kind):
    """Documents that share a short phrase between different text: no group of segments grows with them."""
    rng = random.Random(3)
    phrase = "the terms of this site apply to all of its pages here" if kind.words else "~~ terms of this site apply here ~~"
    monkeypatch.setattr(repeats, "HOT_ANCHOR", 200)

    def largest(n, spread=True):
        rows = [(i, f"{prose(rng, 30, 10**6)} {phrase} {prose(rng, 30, 10**6)}") for i in range(n)]
        named = repeats.identified(documents(*rows).repartition(4)).cache()
        found = repeats._shared_anchors(repeats._anchors(named, kind, 4), 4, repeats.HOT_ANCHOR)
        hot = repeats._hot_filter(found)
        assert len(hot)
        hot = hot if spread else hot[:0]
        places = repeats._by_document(found.filter("doc_id IS NOT NULL"))
        rows = repeats.packed(named, kind).join(places, ["doc_id", "version"])
        dealt = repeats._segments(rows.selectExpr("*", "CAST(NULL AS array<struct<first:long,last:long>>) AS known"), kind, 4, hot)
        sizes = Counter()
        for row in dealt.filter("hashes IS NOT NULL").collect():
            for key, size in zip(np.frombuffer(row.hashes, "<u8").tolist(), np.frombuffer(row.sizes, "<u4").tolist()):
                sizes[key] += size
        return max(sizes.values())

    # What is not hot has at most so many segments, give or take the rounding of counts.
    bound = 1.5 * 200 * (kind.runs + kind.width - 1) * (9 if kind.words else 1)
    assert largest(1500) < bound and largest(4500) < bound
    assert largest(4500, spread=False) > 2 * bound


def test_repeats_of_odd_rows(odd, odd_rows):
    expected = sorted(
        (str(i), len(items), sum(gone)) for i, items, gone in repeats_brute(odd_rows, lambda t: (t or "").encode(), 50)
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffixes.digests(odd).collect()) == expected
    expected = sorted(
        (str(i), len(items), sum(gone))
        for i, items, gone in repeats_brute(odd_rows, lambda t: WORD.findall((t or "").encode()), 13)
    )
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in phrases.digests(odd).collect()) == expected


def test_cleaned_documents_keep_their_columns_and_whole_characters(odd, odd_rows, documents):
    cleaned = suffixes.without_repeats(odd)
    assert cleaned.schema == odd.schema
    rows = cleaned.collect()
    assert len(rows) == len(odd_rows)
    assert sum(r.text is None for r in rows) == 2
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    # One byte of the first é of the second text belongs to a repeat, one does not.
    pair = documents((1, "é" * 60), (2, "a" + "é" * 60 + "b"))
    texts = {r.doc_id: r.text for r in suffixes.without_repeats(pair).collect()}
    assert texts == {1: "é" * 60, 2: "ab"}


def test_repeats_of_nothing(documents):
    empty = documents((1, "a")).filter("false")
    assert suffixes.digests(empty).count() == 0
    assert phrases.digests(empty).count() == 0
    assert suffixes.without_repeats(empty).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embeddings(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 16))
    rows = [
        (i, (centres[i % 6] + rng.normal(size=16) * (0.05 if i % 3 else 0.6)).astype(np.float32).tolist(), 0)
        for i in range(240)
    ]
    matrix = np.array([r[1] for r in rows], float)
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    linked = matrix @ matrix.T >= 0.95
    np.fill_diagonal(linked, False)
    component = grouped([tuple(p) for p in np.argwhere(linked).tolist()], range(240))
    odd = [
        (300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0),
        (304, [None] * 16, 0), (305, [float("inf")] + [1.0] * 15, 0), (306, [1.0] * 4, 0), (None, [1.0] * 16, 0),
        (307, [1.0] * 4, 0),
    ]
    found = embeddings.near_duplicates(vectors(spark, rows + odd), tile_rows=16).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    for i in range(240):
        assert by_id[i] == (int(linked[i].sum()), component[i], component[i] == i)
    for i in range(300, 306):
        assert by_id[i] == (0, i, True)
    assert by_id[306] == (1, 306, True) and by_id[307] == (1, 306, False)
    assert by_id[None] == (0, None, True)


def test_embeddings_of_nothing(spark):
    assert embeddings.near_duplicates(vectors(spark, [])).count() == 0


def test_memory_for_linked_vectors_stays_with_the_block():
    """Vectors of pairs are gathered in small parts, even if all pairs have to be looked at to the end."""
    rng = np.random.default_rng(3)
    units = rng.normal(size=64) + rng.normal(size=(1024, 64)) * 0.01
    units /= np.linalg.norm(units, axis=1)[:, None]
    turn = np.linalg.eigh(units.T @ units)[1][:, ::-1].copy()
    one, other = (embeddings.Tile(np.arange(1024).tobytes(), units.tobytes(), turn) for _ in range(2))
    tracemalloc.start()
    try:
        a, _ = embeddings.linked_pairs(one, other, 0.95)
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()
    assert len(a) == 1024**2


def test_vectors_are_not_sent_to_more_pairs_in_a_larger_table(spark):
    def sent(n):
        placed = spark.range(n).selectExpr(
            "64 AS length", "CAST(id % 3 AS int) AS cell", "id AS place", "id AS vec_id", "CAST('' AS binary) AS vector"
        )
        pairs = embeddings.dealt(placed, 16).groupBy("length", "one", "other").count().collect()
        assert max(p["count"] for p in pairs) <= 4 * 16 * embeddings.TILE_GROWTH
        return sum(p["count"] for p in pairs) / n

    assert sent(800) < 1.5 * sent(200)


@pytest.mark.parametrize("size", [7, 64])
def test_links_of_pairs_that_come_in_pieces(monkeypatch, size):
    """Tiles and pairs may begin and end anywhere in the batches; rows of one id have no links."""
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(9)
    rows = (rng.normal(size=(4, 8))[np.arange(60) % 4] + rng.normal(size=(60, 8)) * 0.15).astype(np.float32)
    ids = np.arange(60) // 2 * 2 + (np.arange(60) > 9) * (np.arange(60) % 2)  # five ids twice
    tile = np.arange(60) // 20
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    sent = [
        (8, i, j, k, int(ids[r]), rows[r].tobytes())
        for i, j in pairs for k, t in enumerate((i, j)[: 1 + (i != j)]) for r in np.flatnonzero(tile == t)
    ]
    names = ["length", "one", "other", "second", "vec_id", "vector"]
    table = pa.table(dict(zip(names, map(list, zip(*sent)))))
    turn = np.linalg.qr(rng.normal(size=(8, 8)))[0]
    found = list(embeddings.links(table.to_batches(size), {8: turn}, 0.95, np.dtype("f4")))
    counts, edges = {}, []
    for kind, a, b in (row.values() for batch in found for row in batch.to_pylist()):
        if kind == "count":
            counts[a] = counts.get(a, 0) + b
        else:
            edges.append((a, b))
    units = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1)[:, None]
    linked = (units @ units.T >= 0.95) & (ids[:, None] != ids)
    expected = {i: int(linked[ids == i].sum()) for i in set(ids.tolist())}
    assert counts == {i: n for i, n in expected.items() if n}
    nodes = set(ids.tolist())
    assert grouped(edges, nodes) == grouped([(int(ids[x]), int(ids[y])) for x, y in np.argwhere(linked)], nodes)


def test_memory_for_anchors_stays_with_the_blocks():
    """Arrays of eight bytes for each item are made for one block at a time, not for the whole slice."""
    rng, kind = random.Random(5), suffixes.byte_kind()
    texts = [prose(rng, 300, 10**6).encode() for _ in range(2000)]
    repeats.Slice(kind, texts[:1]).chosen()
    tracemalloc.start()
    try:
        own = repeats.Slice(kind, texts)
        at, keys = own.chosen()
        segments = repeats._open_segments(own, at, np.zeros((0, 2), np.int64))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(at) == len(keys) > 0 and len(segments[0]) > 0
    assert peak < 20 * sum(map(len, texts))
