"""Token ids in a binary file format: shuffled planes, compressed one by one.

Ids are written in ascending order of the document in chunks of a fixed number of
ids.  A chunk is an array of unsigned 32-bit integers that is transposed into its
four byte planes (or 32 bit planes), so that the high bytes, which hardly vary, lie
together; each plane is compressed with zstandard by itself.

Layout of a folder, all of it Parquet so that any store Spark writes to will do:

* ``chunks/``: one row for each chunk with its shard, its place there, its planes and
  the documents in it: ids, how many of the chunk's ids each has, and whether
  the last document goes on in the next chunk.
* ``index/``: one row for each chunk: shard, chunk, first document, number of
  ids, and ``start``, the ids before it in the whole corpus.

A shard is what one task of a range partition of ``doc_id`` wrote, so each is
bounded by the partition, and nothing passes through one task but the number
of ids of each shard.  A lost executor repeats its shards only.

Defined cases: a NULL text is empty and has the end id only; NULL document ids come
first; rows with the same document id stay apart, in the order of their texts; an empty
table gives empty files; further columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from credmill.llm.arrow import slices
from credmill.llm.shipping import ship
from credmill.llm.tokens import END_ID, encoder
from credmill.sources.scratch import shared_dir

CHUNK_IDS = 65_536
CHUNKS = (
    "shard long, chunk long, n_ids long, planes array<binary>, doc_ids array<long>, "
    "lengths array<long>, open boolean"
)
DOCUMENTS = "shard long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Transpose ids into four byte planes or 32 bit planes and compress each."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    by_id = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        by_id = np.unpackbits(by_id, axis=1, bitorder="little")
        return [squeeze(np.packbits(plane).tobytes()) for plane in by_id.T]
    return [squeeze(plane.tobytes()) for plane in by_id.T]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of a chunk."""
    expand = zstandard.ZstdDecompressor().decompress
    rows = [np.frombuffer(expand(plane), np.uint8) for plane in planes]
    if len(planes) == 32:
        rows = [np.unpackbits(row, count=n_ids) for row in rows]
        by_id = np.packbits(np.stack(rows, axis=1), axis=1, bitorder="little")
    else:
        by_id = np.stack(rows, axis=1)
    return np.ascontiguousarray(by_id).view("<u4").reshape(-1)


class _Chunker:
    """Cuts the ids of one shard into chunks."""

    def __init__(self, shard: int, chunk_ids: int, bits: bool):
        self.shard, self.chunk_ids, self.bits = shard, chunk_ids, bits
        self.chunk, self.held, self.room = 0, [], chunk_ids
        self.docs: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        at, whole = 0, len(ids) // 4
        while at < whole:
            part = min(self.room, whole - at)
            self.held.append(ids[4 * at : 4 * (at + part)])
            self.docs.append(doc_id)
            self.lengths.append(part)
            at, self.room = at + part, self.room - part
            if not self.room:
                yield self.close(goes_on=at < whole)

    def close(self, goes_on: bool = False) -> tuple:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        planes = to_planes(ids, self.bits)
        row = (self.shard, self.chunk, len(ids), planes, self.docs, self.lengths, goes_on)
        self.chunk, self.held, self.room = self.chunk + 1, [], self.chunk_ids
        self.docs, self.lengths = [], []
        return row


def write_token_files(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str,
    chunk_ids: int = CHUNK_IDS,
    bits: bool = False,
    end_id: int = END_ID,
) -> None:
    """Encode every text and write chunks and index below ``path``."""
    spark = docs.sparkSession
    ship(spark)
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema(
        [
            ("shard", pa.int64()), ("chunk", pa.int64()), ("n_ids", pa.int64()),
            ("planes", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())),
            ("lengths", pa.list_(pa.int64())), ("open", pa.bool_()),
        ]
    )

    def encode(batches):
        chunker = _Chunker(TaskContext.get().partitionId(), chunk_ids, bits)
        own = encoder(tokenizer)

        def batch(row):
            return pa.record_batch([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

        for part in slices(batches):
            ids = part.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, part.column("text").to_pylist()):
                for row in chunker.add(doc_id, own.encode(text or "") + end):
                    yield batch(row)
        if chunker.held:
            yield batch(chunker.close())

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(encode, CHUNKS).write.parquet(f"{path}/chunks")
    _index(spark.read.parquet(f"{path}/chunks")).write.parquet(f"{path}/index")


def _index(chunks: DataFrame) -> DataFrame:
    """Places of the chunks: few rows, summed up by shard before they are put in order."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    starts = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.select(
        "shard", "chunk", "n_ids", F.col("doc_ids")[0].alias("first_doc"),
        F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("within"),
    )
    return places.join(starts, "shard").select(
        "shard", "chunk", "n_ids", "first_doc", (F.col("first") + F.col("within")).alias("start")
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents from the files: id, start in the corpus, number of ids and their crc32."""
    ship(spark)
    schema = pa.schema([(n, pa.int64()) for n in ("shard", "doc_id", "local_start", "n_tokens", "ids_crc32")])

    def decode(batches):
        shard, at, done = None, 0, []
        doc = None  # id, start, ids and crc so far of a document that goes on
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, at, doc = row["shard"], 0, None
                raw, place = from_planes(row["planes"], row["n_ids"]).tobytes(), 0
                last = len(row["doc_ids"]) - 1
                for i, (doc_id, length) in enumerate(zip(row["doc_ids"], row["lengths"])):
                    start, before, crc = doc or (at, 0, 0)
                    crc = zlib.crc32(raw[4 * place : 4 * (place + length)], crc)
                    place, at = place + length, at + length
                    if i == last and row["open"]:
                        doc = (start, before + length, crc)
                    else:
                        done.append((shard, doc_id, start, before + length, crc))
                        doc = None
            if done:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*done)], schema=schema)
                done = []

    chunks = spark.read.parquet(f"{path}/chunks").repartition("shard")
    found = chunks.sortWithinPartitions("shard", "chunk").mapInArrow(decode, DOCUMENTS)
    starts = spark.read.parquet(f"{path}/index").filter("chunk = 0").select("shard", "start")
    return found.join(starts, "shard").select(
        "doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the documents as token files, written and read back."""
    import public_tokenizers

    path = shared_dir(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, path, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)
