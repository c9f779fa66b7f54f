"""Token files, packing and byte-level BPE against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from credmill.llm import bpe, packing, token_files
from credmill.llm.tokens import Encoder

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranks_library():
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


PARTS = [
    "the", "Foo", "\n", " ", "  ", "\t", "'s", "don't", "12", "é", "ß.", ",", "!!", "\r\n", "\xa0",
    "\x1c", "<|endoftext|>", "ʼ", "日本", "a\nb", "\n\n", "²", "ª", "x.y", "%%%", "(a)",
]


def test_encoder_equals_the_library(library):
    encoder, rng = Encoder(JSON, memo_parts=50), random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) + rng.choice(["", " "]) for _ in range(rng.randint(0, 9)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(text), repr(text)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [1, 7, 8, 65, 1000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    planes = token_files.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert (token_files.from_planes(planes, n) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, odd, odd_rows, library, tmp_path, bits):
    path = str(tmp_path / "files")
    token_files.write_token_files(odd, path, tokenizer=JSON, chunk_ids=64, bits=bits)
    rows = token_files.read_token_files(spark, path).collect()
    expected, start = [], 0
    for doc_id, text in sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library(text), 2]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert [r.start for r in index] == np.cumsum([0, *(r.n_ids for r in index)])[:-1].tolist()


def test_token_files_of_nothing(spark, documents, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(documents((1, "a")).filter("false"), path, tokenizer=JSON)
    assert token_files.read_token_files(spark, path).count() == 0


def check_packing(rows, texts, library, capacity):
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append(row)
    for doc_id, text in texts.items():
        ids, at = [*library(text), 2], 0
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        for number, row in enumerate(own):
            assert (row.piece, row.start) == (number, at)
            assert row.ids_crc32 == crc(ids[at : at + row.length])
            at += row.length
        assert at == len(ids)
        assert all(row.length == capacity for row in own[1:])
    for own in by_sequence.values():
        at = 0
        for row in sorted(own, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= capacity
    return len(by_sequence)


def test_packing(odd, odd_rows, library):
    rows = packing.pack(odd, tokenizer=JSON, capacity=128, group_pieces=500).collect()
    total = sum(len(library(t)) + 1 for _, t in odd_rows)
    assert sum(row.length for row in rows) == total
    unique = {i: t for i, t in odd_rows if i not in (None, 2)}
    plain = odd.filter("doc_id IS NOT NULL AND doc_id <> 2")
    sequences = check_packing(packing.pack(plain, tokenizer=JSON, capacity=128).collect(), unique, library, 128)
    assert sequences <= 1.1 * sum(len(library(t)) + 1 for t in unique.values()) / 128 + 1


def test_packing_of_nothing(documents):
    assert packing.pack(documents((1, "a")).filter("false"), tokenizer=JSON).count() == 0


def plain_place(lengths, capacity):
    """Gaps of the sequences after each piece, every open sequence tried."""
    gaps, chosen = [], []
    for length in lengths:
        best = None
        for gap in sorted({g for g in gaps if g >= length}):
            after = list(gaps)
            after[after.index(gap)] = gap - length
            counts = Counter(g for g in after if g)
            rating = (sum(n * n for n in counts.values()), gap)
            best = min(best or rating, rating)
        if best is None:
            gap = capacity
        else:
            gap = best[1]
            gaps.remove(gap)
        gaps.append(gap - length)
        chosen.append(capacity - gap)
    return chosen


@pytest.mark.parametrize("seed", range(6))
def test_places_have_the_smallest_sum_of_squares(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([8, 13, 40]))
    lengths = np.sort(rng.integers(1, capacity + 1, 150))[::-1]
    _, offset = packing.place(lengths, capacity)
    assert offset.tolist() == plain_place(lengths.tolist(), capacity)


def test_packed_ids(odd, odd_rows, library):
    rows = packing.pack(odd, tokenizer=JSON, capacity=128, with_ids=True).collect()
    plain = packing.pack(odd, tokenizer=JSON, capacity=128).collect()
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    key = lambda r: str([r[c] for c in columns])
    assert sorted(map(key, rows)) == sorted(map(key, plain))
    assert all(crc(row.ids) == row.ids_crc32 and len(row.ids) == row.length for row in rows)
    assert sum(row.length for row in rows) == sum(len(library(t)) + 1 for _, t in odd_rows)


def test_sums_of_squares_packs_as_well_as_best_fit():
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.integers(1, 1024, 5000))[::-1]
    sequence, offset = packing.place(lengths, 1024)
    ends = {}
    for s, o, n in sorted(zip(sequence, offset, lengths)):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert max(ends.values()) <= 1024
    assert len(ends) <= 1.02 * max(lengths.sum() / 1024, (lengths > 512).sum())


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_bpe_equals_the_library(odd, odd_rows, ranks_library):
    frame = bpe.digests(odd, ranks_path=RANKS, pattern=public_tokenizers.PATTERN)
    expected = []
    for doc_id, text in odd_rows:
        ids = ranks_library(text or "")
        spelled = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), spelled, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(map(str, expected))


def test_bpe_parts_equal_the_library(ranks_library):
    own, rng = bpe.bpe(RANKS), random.Random(3)
    parts = ["a" * 3000, " " * 2000, "ab" * 1500, "\n" * 500]
    for _ in range(3000):
        parts.append("".join(rng.choice("aeinrsthogl") for _ in range(rng.randint(1, 30))))
        parts.append("".join(chr(rng.randint(0x3041, 0x30FF)) for _ in range(6)))
    for part in parts:
        assert own.encode_part(part.encode()) == ranks_library(part)


def test_bpe_encode_and_decode(spark, documents):
    docs = documents((1, "héllo wörld"), (2, None), (3, ""))
    ids = bpe.encode(docs, ranks_path=RANKS, pattern=public_tokenizers.PATTERN)
    decoded = {r.doc_id: bytes(r.decoded) for r in bpe.decode(ids, ranks_path=RANKS).collect()}
    assert decoded == {1: "héllo wörld".encode(), 2: b"", 3: b""}


def test_bpe_with_a_tiny_vocabulary():
    ranks = {bytes([b]): i for i, b in enumerate(b"abc")} | {b"ab": 3, b"bc": 4, b"abc": 5, b"ca": 6}
    own = bpe.Bpe(ranks)
    reference = tiktoken.Encoding("tiny", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        assert own.encode_part(text.encode()) == reference.encode_ordinary(text)
