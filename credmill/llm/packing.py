"""Best-fit packing by sums of squares.

Every document becomes token ids with an end id.  A longer one than a sequence is
cut into pieces, of which all but the first are full, so one piece for each document
is left to be placed.  Pieces go into sequences in falling order of length.  A piece is
put where the sum over all gaps of the squared number of open sequences with that gap
becomes smallest, which keeps many different gaps open for what follows; a new
sequence is opened only when no open one has room.

The pieces are dealt into groups of a bounded expected size by a hash, and each group is
packed by itself: the last few sequences of a group are all that is lost by
that.  A group holds numbers only, about ``GROUP_PIECES`` rows of them.

Defined cases: a NULL or empty text is the end id alone; NULL document ids and repeated
rows are packed like others; an empty table gives an empty result; further columns are
not read, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.llm.arrow import slices
from credmill.llm.shipping import ship
from credmill.llm.tokens import END_ID, encoder
from credmill.sources.scratch import shared_dir

SEQUENCE_IDS = 1024
GROUP_PIECES = 65_536

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be short."""
    first = n_ids % capacity or min(n_ids, capacity)
    starts = [0, *range(first, n_ids, capacity)]
    return list(zip(starts, np.diff([*starts, n_ids]).tolist()))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; lengths must not rise."""
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by their gap
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    for i, length in enumerate(lengths.tolist()):
        left = np.flatnonzero(counts[length:])  # what remains of each gap with room
        if len(left):
            change = counts[left] - counts[left + length]  # half the change of the sum
            change[left == 0] -= counts[0]  # a full sequence is not open
            gap = int(left[change.argmin()]) + length
            counts[gap] -= 1
            target = open_by_gap[gap].pop()
        else:
            gap, target, opened = capacity, opened, opened + 1
        sequence[i], offset[i] = target, capacity - gap
        if gap > length:
            counts[gap - length] += 1
            open_by_gap[gap - length].append(target)
    return sequence, offset


def pieces(docs: DataFrame, *, tokenizer: str, capacity: int, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, with their ids as an array if asked for."""
    ship(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32())]
    fields += [(name, pa.int64()) for name in ("start", "length", "ids_crc32")]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)
    end = np.array([END_ID], "<u4").tobytes()

    def encode(batches):
        own = encoder(tokenizer)
        for part in slices(batches):
            rows = []
            ids_of = part.column("doc_id").to_pylist()
            for doc_id, text in zip(ids_of, part.column("text").to_pylist()):
                ids = own.encode(text or "") + end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    piece = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, number, start, length, zlib.crc32(piece))
                    rows.append((*row, np.frombuffer(piece, "<i4")) if with_ids else row)
            columns = zip(*rows)
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    kinds = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, kinds)


def pack(
    docs: DataFrame,
    *,
    tokenizer: str,
    capacity: int = SEQUENCE_IDS,
    group_pieces: int = GROUP_PIECES,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.  With ``with_ids`` their ids come too: they are
    written once and joined to the places, so no task holds the ids of a group."""
    expected = docs.agg(
        F.ceil(F.count(F.lit(1)) + F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) / (2 * capacity))
    ).first()[0]
    groups = max(1, -(-expected // group_pieces))
    cut_up = pieces(docs, tokenizer=tokenizer, capacity=capacity, with_ids=with_ids)
    if with_ids:
        folder = shared_dir(docs.sparkSession, "pieces")
        # A number of its own tells repeated rows apart.
        cut_up.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
        stored = docs.sparkSession.read.parquet(folder)
        cut_up = stored.drop("ids")
    order = ["length", "doc_id", "piece", "ids_crc32"]

    def one_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, ascending=[False, True, True, True], kind="stable")
        sequence, offset = place(frame["length"].to_numpy(), capacity)
        return frame.drop(columns="part").assign(sequence_id=sequence * groups + key[0], offset=offset)

    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    kinds = PIECES + (", row long" if with_ids else "") + ", sequence_id long, offset long"
    placed = cut_up.withColumn("part", part).groupBy("part").applyInPandas(one_group, kinds)
    if not with_ids:
        return placed
    # Places are few bytes a piece, but as many as pieces: never broadcast.
    return stored.join(placed.select("row", "sequence_id", "offset").hint("merge"), "row").drop("row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all documents in sequences of at most 1024 ids."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))
