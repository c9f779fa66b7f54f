"""Byte-level BPE by backtracking over longest matches, and decoding.

Each match of the split pattern is encoded by itself.  An automaton over the
tokens (bytes as Latin-1 characters) gives all tokens that match in it.  From left to
right the longest token is taken whose pairing with the token before is one that
the merges would leave as it is; if none is, the token before gives way to its next
shorter one, and the place where it ended is never tried again.  So each place
is left at most once, and the time is linear in the bytes.

Two adjacent tokens are compatible if undoing their merges, highest rank first, never
shows a pair across the border that the merges would have joined earlier.  The
answer depends on the two tokens only and is remembered.

Defined cases: a NULL text is empty: no ids, the hash of nothing; ids are equal to those
of the rank-file library for any text; NULL document ids and repeated rows are
encoded like others; an empty table gives an empty result; further columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.llm.arrow import slices
from credmill.llm.shipping import ship

# Parts and pairs that one worker remembers; then it begins anew.
MEMO_PARTS = 400_000
MEMO_PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Bpe:
    """Tokens by rank, with what the backtracking needs to know of them."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.tokens = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.shorter = self._shorter_prefixes(ranks)
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.tokens):
            self._find_halves(ranks, rank)
        self.pairs.clear()  # answers from before all merges were known

    @staticmethod
    def _shorter_prefixes(ranks: dict[bytes, int]) -> dict[int, int | None]:
        shorter: dict[int, int | None] = {}
        for token, rank in ranks.items():
            shorter[rank] = next(
                (ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None
            )
        return shorter

    def _find_halves(self, ranks: dict[bytes, int], rank: int) -> None:
        """The two tokens whose merge makes this one, if it is made by a merge."""
        token = self.tokens[rank]
        left = self.shorter[rank]
        while left is not None:
            right = ranks.get(token[len(self.tokens[left]) :])
            if right is not None and max(left, right) < rank and self._undo(left, right):
                self.halves[rank] = (left, right)
                self.joined[left, right] = rank
                return
            left = self.shorter[left]

    def compatible(self, left: int, right: int) -> bool:
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            answer = self.pairs[left, right] = self._undo(left, right)
        return answer

    def _undo(self, left: int, right: int) -> bool:
        """Undo merges on both sides of the border, the later one first."""
        bound = float("inf")
        while True:
            merged = self.joined.get((left, right))
            if merged is not None and merged < bound:
                return False
            # The side that was merged last is undone; on a tie the right one, which
            # the merges, going from left to right, reach later.
            for side in (("left", "right") if left > right else ("right", "left")):
                halves = self.halves.get(left if side == "left" else right)
                if halves is None:
                    continue
                if side == "left":
                    bound, left = left, halves[1]
                else:
                    bound, right = right + 1, halves[0]
                break
            else:
                return True

    def encode_part(self, part: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        n = len(part)
        longest: list[int | None] = [None] * n
        for end, (rank, length) in self.automaton.iter(part.decode("latin-1")):
            longest[end + 1 - length] = rank  # a longer one ends later
        ids: list[int] = []
        open_end = bytearray(b"\1") * (n + 1)
        at, token = 0, longest[0] if n else None
        tokens, shorter = self.tokens, self.shorter
        while at < n:
            if token is None:
                if not ids:
                    raise ValueError("the ranks do not cover all bytes")
                open_end[at] = 0
                token = ids.pop()
                at -= len(tokens[token])
                token = shorter[token]
                continue
            end = at + len(tokens[token])
            if open_end[end] and (not ids or self.compatible(ids[-1], token)):
                ids.append(token)
                at = end
                token = longest[at] if at < n else None
            else:
                token = shorter[token]
        return ids


@cache
def bpe(path: str) -> Bpe:
    """One for each worker process."""
    return Bpe(read_ranks(path))


class _Parts(dict):
    """Ids of a part, spelled in decimals, and their number."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> np.ndarray:
        ids = self[part] = np.array(self.encode(part.encode()), "<u4").tobytes()
        return ids


def _pattern(split_pattern: str):
    import regex

    return regex.compile(split_pattern)


def encode(docs: DataFrame, *, ranks_path: str, pattern: str) -> DataFrame:
    """Add nothing but ``doc_id`` and the ids of the text as an array."""

    def rows(doc_ids, encoded):
        return [doc_ids, pa.array([np.frombuffer(ids, "<i4") for ids in encoded], pa.list_(pa.int32()))]

    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return _each_slice(docs, ranks_path, pattern, rows, schema, "doc_id long, ids array<int>")


def decode(ids: DataFrame, *, ranks_path: str) -> DataFrame:
    """The bytes of each row's ids."""
    ship(ids.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def of(batches):
        tokens = bpe(ranks_path).tokens
        for batch in batches:
            texts = [b"".join([tokens[i] for i in row or ()]) for row in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.binary())], schema=schema)

    return ids.select("doc_id", "ids").mapInArrow(of, "doc_id long, decoded binary")


def digests(docs: DataFrame, *, ranks_path: str, pattern: str) -> DataFrame:
    """Number and hash of the ids of each text, and the hash of what they decode to.

    Encodes and decodes in one pass, so the ids need not leave the worker.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
            ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
        ]
    )

    def rows(doc_ids, encoded):
        tokens = bpe(ranks_path).tokens
        out = []
        for packed in encoded:
            ids = np.frombuffer(packed, "<u4").tolist()
            spelled = " ".join(map(str, ids)).encode()
            decoded = b"".join(map(tokens.__getitem__, ids))
            out.append(
                (len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(decoded).hexdigest())
            )
        return [doc_ids, *(pa.array(list(c), f.type) for c, f in zip(zip(*out), list(schema)[1:]))]

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _each_slice(docs, ranks_path, pattern, rows, schema, kinds)


def _each_slice(docs, ranks_path, pattern, rows, schema, kinds) -> DataFrame:
    ship(docs.sparkSession)

    def of(batches):
        parts = _worker_parts(ranks_path)
        find = _pattern(pattern).findall
        for batch in slices(batches):
            encoded = []
            for text in batch.column("text").to_pylist():
                if len(parts) > MEMO_PARTS:
                    parts.clear()
                encoded.append(b"".join(map(parts.__getitem__, find(text or ""))))
            yield pa.record_batch(rows(batch.column("doc_id"), encoded), schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, kinds)


@cache
def _worker_parts(ranks_path: str) -> _Parts:
    return _Parts(bpe(ranks_path).encode_part)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: ids of all documents, and what they decode to."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(
        docs,
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
    )
