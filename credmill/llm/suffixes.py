"""Removes long repeated substrings by the phrases of prefix-free parsing and sorted windows.

A rolling hash cuts each text into phrases.  A phrase with the bytes that follow it
stands for all windows that start in it, so long repeats are equal phrases: they are found by
grouping the parse by a 128-bit digest.  In what is left, anchors deal windows into shards, and the
windows of a shard are sorted by as many bytes as a window has, which is all that decides whether
two windows are equal.  The smallest document id of equal windows is the one that keeps them.

Not built of the method: suffix arrays of the dictionary and of the parse, and their combination
into an order of the corpus.

Matches never cross documents, and are judged on the input.

Defined cases: a NULL or empty text has no bytes and nothing is removed from it; rows with a
NULL id are kept whole and remove nothing; rows that share an id remove nothing from
each other; an empty table gives an empty result.  ``without_repeats`` keeps all columns,
whatever their names, and removes whole characters only: one that is partly repeated
stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.llm.arrow import raw_texts, slices
from credmill.llm.repeats import (
    PACKED_SLICE, TEXT_SLICE, Kind, Segments, find_repeats, identified, packed, removed, unpack,
)
from credmill.llm.words import table

BYTES = 50
CONTINUES = table(bytes(range(0x80, 0xC0)))


def byte_kind(width: int = BYTES) -> Kind:
    return Kind(words=False, width=width, anchor=max(1, width * 2 // 5), trigger=min(12, width), phrase=192)


def suffix_array(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their first ``width`` bytes, and which of
    them differ from the one before."""
    heads = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, width)[starts])
    heads = heads.view(f"S{width}").reshape(-1)
    order = np.argsort(heads, kind="stable")
    ordered = heads[order]
    return order, np.append(True, ordered[1:] != ordered[:-1])


def compare_bytes(width: int):
    def compare(segments: Segments) -> np.ndarray:
        sizes = np.array([len(raw) for raw in segments.raw])
        n_windows = sizes - width + 1
        begin = np.cumsum(sizes) - sizes
        segment = np.repeat(np.arange(len(sizes)), n_windows)
        within = np.arange(len(segment)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        data = np.frombuffer(b"".join(segments.raw), np.uint8)
        order, fresh = suffix_array(data, begin[segment] + within, width)
        ids = segments.ids[segment]
        first = np.flatnonzero(fresh)
        smallest = np.minimum.reduceat(ids[order], first)
        repeat = np.empty(len(ids), bool)
        repeat[order] = np.repeat(smallest, np.diff(np.append(first, len(ids)))) < ids[order]
        return repeat

    return compare


def repeated_substrings(docs: DataFrame, width: int = BYTES) -> DataFrame:
    return find_repeats(docs, byte_kind(width), compare_bytes(width))


def digests(docs: DataFrame, width: int = BYTES) -> DataFrame:
    """Sizes and hash of what stays of each row of ``docs``."""
    spans = repeated_substrings(docs, width)
    kind, keys = byte_kind(width), ["doc_id", "version"]
    longs = ("doc_id", "n_bytes", "n_removed", "n_spans")
    schema = pa.schema([*((name, pa.int64()) for name in longs), ("kept_sha256", pa.string())])

    def of(batches):
        for part in slices(batches, "packed", PACKED_SLICE):
            rows = []
            columns = (part.column(name).to_pylist() for name in ("known", "places"))
            for raw, known, places in zip(unpack(part.column("packed")), *columns):
                if not known and not places:
                    rows.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                    continue
                gone = removed(kind, len(raw), known, places)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans_gone = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                rows.append((len(raw), int(gone.sum()), spans_gone, hashlib.sha256(kept).hexdigest()))
            arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
            yield pa.record_batch([part.column("doc_id"), *arrays], schema=schema)

    kinds = ", ".join(f"{name} long" for name in longs) + ", kept_sha256 string"
    joined = packed(identified(docs), kind).join(spans, keys, "left")
    return joined.select("doc_id", "packed", "known", "places").mapInArrow(of, kinds)


def without_repeats(docs: DataFrame, width: int = BYTES) -> DataFrame:
    """The rows of ``docs`` with the repeats cut out of ``text``; ``n_chars`` follows it."""
    spans = repeated_substrings(docs, width)
    kind, schema = byte_kind(width), docs.schema
    version = identified(docs.select("doc_id", "text")).schema["version"].dataType
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast(version).alias("version"),
        F.struct("*").alias("row"),
    )
    names = docs.columns

    def of(batches):
        for batch in slices(batches, limit=TEXT_SLICE, within="row"):
            fields, text = batch.column("row").flatten(), names.index("text")
            known, places = (batch.column(name).to_pylist() for name in ("known", "places"))
            raws = raw_texts(fields[text])
            kept = [
                _cut(raw, removed(kind, len(raw), known[i], places[i])) if known[i] or places[i] else raw
                for i, raw in enumerate(raws)
            ]
            texts = [value.decode() for value in kept]
            fields[text] = pa.array(
                [None if null else value for value, null in zip(texts, fields[text].is_null().to_pylist())],
                fields[text].type,
            )
            if "n_chars" in names:
                at = names.index("n_chars")
                counts = fields[at].to_pylist()
                changed = [len(t) if len(r) != len(k) else c for t, r, k, c in zip(texts, raws, kept, counts)]
                fields[at] = pa.array(changed, fields[at].type)
            yield pa.record_batch(fields, names=names)

    joined = whole.join(spans, ["doc_id", "version"], "left")
    return joined.select("row", "known", "places").mapInArrow(of, schema)


def _cut(raw: bytes, gone: np.ndarray) -> bytes:
    """What stays, with all bytes of each character of which one stays."""
    data = np.frombuffer(raw, np.uint8)
    begins = np.flatnonzero(~CONTINUES[data])
    if not len(begins):
        return raw
    whole = np.logical_and.reduceat(gone, begins)
    return data[~np.repeat(whole, np.diff(np.append(begins, len(data))))].tobytes()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: what stays of each document without repeats of 50 bytes."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# Two hexadecimal digits stand for a byte; windows are told apart by a 64-bit hash.  Texts are cut into
# blocks of 512 bytes with the 49 behind them first, since a substring is found from the start of its text.
ORACLE_SQL = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), blocks AS (
  SELECT doc_id, len(digits) // 2 AS n, block, substr(digits, 1024 * block + 1, 1122) AS part
  FROM texts, unnest(range(0, (len(digits) // 2 + 511) // 512)) AS numbers(block)
), each_byte AS (
  SELECT doc_id, 512 * block + i AS place, substr(part, 2 * i - 1, 2) AS pair,
    CASE WHEN 512 * block + i + 49 <= n THEN hash(substr(part, 2 * i - 1, 100)) END AS run
  FROM (SELECT *, unnest(range(1, least(512, n - 512 * block) + 1)) AS i FROM blocks)
), firsts AS (
  SELECT run, min(doc_id) AS holder FROM each_byte WHERE run IS NOT NULL GROUP BY run
), covered AS (
  SELECT e.doc_id, place, pair, coalesce(bool_or(holder < e.doc_id) OVER (
    PARTITION BY e.doc_id ORDER BY place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS removed
  FROM each_byte e LEFT JOIN firsts f ON e.run = f.run
), counted AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
    count(*) FILTER (WHERE removed AND NOT before) AS n_spans,
    string_agg(pair, '' ORDER BY place) FILTER (WHERE NOT removed) AS kept
  FROM (
    SELECT *, lag(removed, 1, false) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM covered
  )
  GROUP BY doc_id
)
SELECT t.doc_id, len(digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts t LEFT JOIN counted c ON t.doc_id = c.doc_id
"""
