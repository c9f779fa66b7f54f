"""Finds runs of items that an earlier document has, too: bytes or words.

An item is removed if a window of ``width`` items that covers it also starts in a
document with a smaller id.  Listing every window of the corpus would multiply it, so
windows are compared only where they can be equal to another one:

1. *Phrases.*  Where a rolling hash triggers, a phrase ends.  A phrase with the
   ``width - 1`` items behind it holds every window that starts in it, so where an earlier
   document has an equal one, all of those windows are repeats.  That settles copies and
   long repeats with one record for each phrase.
2. *Anchors.*  Of the short runs in a window the one with the smallest hash is its anchor;
   equal windows have equal anchors, and neighbouring windows mostly share theirs.  Only
   windows whose anchor occurs in more than one document can be repeats.
3. *Segments.*  What is left of these windows, outside the repeats that are known
   already, is gathered by anchor and compared item by item by the caller's operator.

Hashes choose what meets; that two phrases are equal is decided by 128 bits, that two
windows are equal by their items.  Anchors and segments are dealt into buckets by hash,
and the number of buckets grows with the input.  An anchor or a
segment that many documents have enters a bucket once for each slice of text of a
megabyte: all others of the slice are known to be repeats right there.  Anchors that occur very
often are counted, and their windows are dealt one by one, by a hash of the whole window: equal
windows still meet, those that only share the anchor are spread.  Tasks know such anchors by a
Bloom filter of bounded size; an anchor that passes it by chance is treated alike everywhere, so
the result stays the same.

Rows are told apart by document id and a hash of their text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credmill.llm import words
from credmill.llm.arrow import give_back, raw_texts, slices
from credmill.llm.shipping import ship
from credmill.sources.scratch import shared_dir

# Text that one bucket stands for.
BUCKET_BYTES = 8 << 20
# Items that are hashed at once.
BLOCK_ITEMS = 1 << 17
# Compressed text that is handled at once.
PACKED_SLICE = 1 << 19
# Text that is handled at once.  Arrays of eight bytes for each byte of it are made for one block
# after the other, and what a slice took is free before the next one comes.
TEXT_SLICE = 1 << 20
# Occurrences from which the windows of an anchor are dealt one by one.
HOT_ANCHOR = 1 << 14
# 64-bit words of the filter of such anchors, 2 MB, however many there are.
FILTER_WORDS = 1 << 18


@dataclass(frozen=True)
class Kind:
    """What items are, and how long windows, anchors, triggers and phrases."""

    words: bool
    width: int
    anchor: int
    trigger: int
    phrase: int  # items on the average

    @property
    def runs(self) -> int:
        """Short runs in a window."""
        return self.width - self.anchor + 1


class Slice:
    """Items of some documents in a row."""

    def __init__(self, kind: Kind, texts: list[bytes]):
        self.kind = kind
        if kind.words:
            of = words.split(texts)
            self.data, self.starts, self.ends = of.data, of.starts, of.ends
            self.hashes, self.bounds = of.hashes(), of.doc_words
        else:
            self.data = np.frombuffer(b"".join(texts), np.uint8)
            self.bounds = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(text) for text in texts], out=self.bounds[1:])
        self.doc_of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.bounds))

    def values(self, first: int, last: int) -> np.ndarray:
        """A number for each item from ``first`` on, before ``last``."""
        return self.hashes[first:last] if self.kind.words else words.BYTE_VALUE[self.data[first:last]]

    def raw(self, first: int, last: int) -> bytes:
        """The items from ``first`` on, before ``last``."""
        if self.kind.words:
            return self.data[self.starts[first] : self.ends[last - 1]].tobytes()
        return self.data[first:last].tobytes()

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Items of whole documents, so few that their arrays stay in the processor's cache."""
        first = 0
        for last in self.bounds[1:].tolist():
            if last - first >= BLOCK_ITEMS:
                yield first, last
                first = last
        if first < self.bounds[-1]:
            yield first, int(self.bounds[-1])

    def run_hashes(self, width: int, first: int, last: int) -> np.ndarray:
        """Hash of each run of items of a block; 0 where none begins any more."""
        values = self.values(first, last)
        n = max(0, len(values) - width + 1)
        up, down = words.powers(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        out = np.zeros(len(values), np.uint64)
        out[:n] = words.mix((sums[width:] - sums[:n]) * down[:n]) if n else 0
        return out

    def triggers(self) -> np.ndarray:
        """Items where a phrase begins because of the hash there."""
        phrase = np.uint64(self.kind.phrase)
        found = [
            np.flatnonzero(self.run_hashes(self.kind.trigger, a, b) % phrase == 0) + a
            for a, b in self.blocks()
        ]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def anchors(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of one block after the other its first item, and for each of its items: the hash of the short
        run that begins there, the smallest one in the window that begins there (0 if that does not
        lie in one document), and whether the short run is the anchor of a window."""
        kind, edge = self.kind, np.zeros(self.kind.runs - 1, np.uint64)
        for a, b in self.blocks():
            hashes, least = self.run_hashes(kind.anchor, a, b), np.zeros(b - a, np.uint64)
            smallest = _slide(hashes, kind.runs, np.minimum)
            inside = self.bounds[self.doc_of[a:b] + 1] - np.arange(a, b) >= kind.width
            n = len(smallest)
            least[:n] = np.where(inside[:n], smallest, 0)
            smallest = inside = None
            highest = _slide(np.concatenate([edge, least]), kind.runs, np.maximum)
            yield a, hashes, least, (highest == hashes) & (hashes != 0)

    def chosen(self) -> tuple[np.ndarray, np.ndarray]:
        """Items where an anchor begins, and its hash."""
        at, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for a, hashes, _, chosen in self.anchors():
            found = np.flatnonzero(chosen)
            at.append(found + a)
            keys.append(hashes[found])
        return np.concatenate(at), np.concatenate(keys)


def _slide(values: np.ndarray, width: int, of: Callable) -> np.ndarray:
    """Minimum or maximum of each ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    done = 1
    while done * 2 <= width:
        values = of(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = of(values[: len(values) - (width - done)], values[width - done :])
    return values


def identified(docs: DataFrame) -> DataFrame:
    """Id, version and text: the version tells rows with one id but different texts apart."""
    version = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF))
    return docs.select(F.col("doc_id").cast("long"), version.alias("version"), "text")


def packed(texts: DataFrame, kind: Kind) -> DataFrame:
    """Compressed texts: doc_id, version, packed.  Words are set apart by one space."""
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("packed", pa.binary())])

    def of(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            texts = [press(_plain(kind, text)) for text in raw_texts(part.column("text"))]
            yield pa.record_batch([part.column("doc_id"), part.column("version"), pa.array(texts, pa.binary())], schema=schema)

    return texts.mapInArrow(of, "doc_id long, version long, packed binary")


def unpack(column: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(value) for value in column.to_pylist()]


def _plain(kind: Kind, text: bytes) -> bytes:
    return b" ".join(text.split()) if kind.words else text


def _longs(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _texts(kind: Kind, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    texts = [_plain(kind, text) for text in raw_texts(part.column("text"))]
    return _longs(part, "doc_id"), _longs(part, "version"), texts


# --- phrases ------------------------------------------------------------------------------


def _phrases(docs: DataFrame, kind: Kind) -> DataFrame:
    """Phrases with the items behind them: hash, document, first item, item after the last."""
    names = ("k1", "k2", "doc_id", "version", "first", "last")
    schema = pa.schema([(name, pa.int64()) for name in names])

    def of_slice(part):
        ids, versions, texts = _texts(kind, part)
        own = Slice(kind, texts)
        first = np.union1d(own.triggers(), own.bounds[:-1][np.diff(own.bounds) > 0])
        doc = own.doc_of[first]
        following = np.append(first[1:], own.bounds[-1])
        last = np.minimum(following + kind.width - 1, own.bounds[doc + 1])
        long = last - first >= kind.width
        first, last, doc = first[long], last[long], doc[long]
        spans = zip(first.tolist(), last.tolist())
        raw = b"".join([xxhash.xxh3_128_digest(own.raw(a, b)) for a, b in spans])
        keys = np.frombuffer(raw, np.int64).reshape(-1, 2)
        start = own.bounds[doc]
        columns = [keys[:, 0], keys[:, 1], ids[doc], versions[doc], first - start, last - start]
        yield pa.record_batch([pa.array(c) for c in columns], schema=schema)

    def of(batches):
        for part in slices(batches, limit=TEXT_SLICE):
            yield from of_slice(part)

    return docs.mapInArrow(of, ", ".join(f"{name} long" for name in names))


def _known_spans(phrases: DataFrame) -> DataFrame:
    """Spans of each document that an earlier one has in one phrase."""
    earliest = (
        phrases.groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"))
        .filter("earliest < latest")
    )
    repeats = phrases.join(earliest, ["k1", "k2"]).filter("earliest < doc_id")
    return repeats.groupBy("doc_id", "version").agg(F.collect_list(F.struct("first", "last")).alias("known"))


# --- buckets ----------------------------------------------------------------------------------

# Parts of a slice that belong to one bucket; arrays as bytes.  ``hashes`` is NULL for what
# needs no comparison any more.
_BUCKET = "bucket int, ids binary, versions binary, counts binary, hashes binary, places binary, sizes binary, raw binary"
_BUCKET_SCHEMA = pa.schema([("bucket", pa.int32())] + [(name.split()[0], pa.binary()) for name in _BUCKET.split(", ")[1:]])
_FOUND = "doc_id long, version long, places binary"
_FOUND_SCHEMA = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("places", pa.binary())])


def _by_doc(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ascending array, and how often each comes."""
    change = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, int)
    return doc[change], np.diff(np.append(change, len(doc)))


def _dealt(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _BUCKET_SCHEMA)], schema=_BUCKET_SCHEMA)


def _in_buckets(frame: DataFrame, buckets: int) -> DataFrame:
    return frame.repartition(buckets, "bucket").sortWithinPartitions("bucket")


def _whole_buckets(batches) -> Iterator[list[dict]]:
    """Rows of one bucket after the other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["bucket"] != row["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held
    give_back()


def _rows_by_doc(ids: np.ndarray, versions: np.ndarray, places: np.ndarray) -> pa.RecordBatch | None:
    """A row for each document with its places (one or more numbers for each)."""
    if not len(ids):
        return None
    order = np.lexsort((versions, ids))
    ids, versions, places = ids[order], versions[order], np.ascontiguousarray(places[order], "<u4")
    first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (versions[1:] != versions[:-1])))
    ends = np.append(first[1:], len(ids))
    own = [places[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())]
    return pa.record_batch([pa.array(ids[first]), pa.array(versions[first]), pa.array(own, pa.binary())], schema=_FOUND_SCHEMA)


def _of_rows(rows: list[dict], name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(row[name] or b"" for row in rows), kind)


def _docs_of_rows(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    counts = _of_rows(rows, "counts", "<u4")
    return np.repeat(_of_rows(rows, "ids", "<i8"), counts), np.repeat(_of_rows(rows, "versions", "<u4").astype(np.int64), counts)


def _numbered_docs(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and versions of the documents in the rows, and the number of each entry's document."""
    counts = _of_rows(rows, "counts", "<u4")
    doc = np.repeat(np.arange(len(counts), dtype=np.uint32), counts)
    return _of_rows(rows, "ids", "<i8"), _of_rows(rows, "versions", "<u4").astype(np.int64), doc


def _rows_of_docs(ids, versions, doc, places) -> Iterator[pa.RecordBatch]:
    """A row for each document with its places, where documents are given by number."""
    if not len(doc):
        return
    order = np.lexsort((versions, ids))
    fresh = np.append(True, (np.diff(ids[order]) != 0) | (np.diff(versions[order]) != 0))
    rank = np.empty(len(ids), np.uint32)
    rank[order] = np.cumsum(fresh) - 1
    own, named = rank[doc], order[fresh]
    by_rank = np.argsort(own, kind="stable")
    own, places = own[by_rank], np.ascontiguousarray(places[by_rank], "<u4")
    by_rank = None
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    ends = np.append(first[1:], len(own))
    cut = [places[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())]
    at = named[own[first]]
    yield pa.record_batch([pa.array(ids[at]), pa.array(versions[at]), pa.array(cut, pa.binary())], schema=_FOUND_SCHEMA)


# --- anchors ------------------------------------------------------------------------------


def _anchors(docs: DataFrame, kind: Kind, buckets: int) -> DataFrame:
    """Anchors of all documents, dealt into buckets."""

    def of_slice(part):
        ids, versions, texts = _texts(kind, part)
        own = Slice(kind, texts)
        at, keys = own.chosen()
        if not len(at):
            return
        doc = own.doc_of[at]
        places = (at - own.bounds[doc]).astype("<u4")
        order = np.lexsort((ids[doc], keys))
        first = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        low = np.minimum.reduceat(ids[doc][order], first)
        high = np.maximum.reduceat(ids[doc][order], first)
        times = np.diff(np.append(first, len(at)))
        shared = np.zeros(len(at), bool)
        shared[order] = np.repeat(low < high, times)
        # Of an anchor that several documents of the slice have, that of the smallest id goes on,
        # with the power of two next to the number of its occurrences.
        sent = ~shared
        sent[order[first]] = True
        stands_for = np.zeros(len(at), np.uint8)
        stands_for[order[first]] = np.where(low < high, np.rint(np.log2(times)), 0)
        bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        rows = []
        for chosen, dealt in ((shared, None), (sent, keys)):
            to = np.flatnonzero(chosen)
            to = to[np.argsort(bucket[to], kind="stable")] if dealt is not None else to
            cuts = np.searchsorted(bucket[to], np.arange(buckets + 1)) if dealt is not None else [0, len(to)]
            for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if a < b:
                    some = to[a:b]
                    docs_in, counts = _by_doc(doc[some])
                    rows.append(
                        (
                            number if dealt is not None else int(ids[docs_in[0]]) % buckets,
                            ids[docs_in].tobytes(), versions[docs_in].astype("<u4").tobytes(),
                            counts.astype("<u4").tobytes(),
                            dealt[some].astype("<u4").tobytes() if dealt is not None else None,
                            places[some].tobytes(),
                            stands_for[some].tobytes() if dealt is not None else None, None,
                        )
                    )
        yield _dealt(rows)

    def of(batches):
        for part in slices(batches, limit=TEXT_SLICE):
            yield from of_slice(part)

    return docs.mapInArrow(of, _BUCKET)


def _shared_anchors(dealt: DataFrame, buckets: int, hot_from: int) -> DataFrame:
    """Places of the anchors that more than one document has; several rows for a document.

    In rows without a document ``places`` are hot anchors of the bucket that ``version`` names.
    """

    def of(batches):
        for rows in _whole_buckets(batches):
            asked = [row for row in rows if row["hashes"] is not None]
            done = [row for row in rows if row["hashes"] is None]
            number = rows[0]["bucket"]
            rows.clear()
            if asked:
                keys, places = _of_rows(asked, "hashes", "<u4"), _of_rows(asked, "places", "<u4")
                stands_for = _of_rows(asked, "sizes", "u1")
                ids, versions, doc = _numbered_docs(asked)
                asked.clear()
                shared, hot = _recurring(keys, ids, doc, stands_for, hot_from)
                keys = stands_for = None
                yield from _rows_of_docs(ids, versions, doc[shared], places[shared])
                if len(hot):
                    row = [[None], [number], [hot.tobytes()]]
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(row, _FOUND_SCHEMA)], schema=_FOUND_SCHEMA)
            if done:
                ids, versions, doc = _numbered_docs(done)
                yield from _rows_of_docs(ids, versions, doc, _of_rows(done, "places", "<u4"))

    return _in_buckets(dealt, buckets).mapInArrow(of, _FOUND)


def _recurring(keys, ids, doc, stands_for, hot_from: int) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have a key that several documents have, and the hot ones of these keys.

    Keys are sorted part by part, since sorting takes many times their own memory.
    """
    shared, hot = np.zeros(len(keys), bool), []
    for part in range(16):
        some = np.flatnonzero(keys >> np.uint32(28) == part)
        if not len(some):
            continue
        some = some[np.argsort(keys[some], kind="stable")]
        first = np.flatnonzero(np.append(True, keys[some][1:] != keys[some][:-1]))
        of = ids[doc[some]]
        several = np.minimum.reduceat(of, first) < np.maximum.reduceat(of, first)
        shared[some] = np.repeat(several, np.diff(np.append(first, len(some))))
        times = np.add.reduceat(np.int64(1) << stands_for[some].astype(np.int64), first)
        hot.append(keys[some[first]][several & (times >= hot_from)])
    return shared, np.concatenate(hot)


def _by_document(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_id", "version").agg(F.collect_list("places").alias("places"))


# --- hot anchors ----------------------------------------------------------------------------


def _bits(anchors: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word of the filter and the four bits in it, for anchors as bucket and low half of the hash."""
    mixed = words.mix(anchors.astype(np.uint64))
    other = words.mix(mixed ^ np.uint64(0x9E3779B97F4A7C15))
    bits = np.zeros(len(mixed), np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= np.uint64(1) << ((other >> np.uint64(shift)) & np.uint64(63))
    return (mixed % np.uint64(n_words)).astype(np.int64), bits


def _hot_filter(found: DataFrame) -> np.ndarray:
    """Bloom filter of the hot anchors; no words if there are none."""
    rows = found.filter("doc_id IS NULL").select("version", "places")
    n_hot = (rows.agg(F.sum(F.octet_length("places"))).first()[0] or 0) // 4
    if not n_hot:
        return np.zeros(0, np.uint64)
    n_words = min(FILTER_WORDS, 1 << n_hot.bit_length())
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def of(batches):
        for batch in batches:
            for number, places in zip(*(column.to_pylist() for column in batch.columns)):
                low = np.frombuffer(places, "<u4").astype(np.uint64)
                place, bits = _bits(np.uint64(number) << np.uint64(32) | low, n_words)
                yield pa.record_batch([pa.array(place), pa.array(bits.view(np.int64))], schema=schema)

    set_bits = rows.mapInArrow(of, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = set_bits.toArrow()  # FILTER_WORDS rows at most
    out = np.zeros(n_words, np.uint64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def _hot(keys: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    """Which anchors pass the filter."""
    if not len(hot):
        return np.zeros(len(keys), bool)
    number = (keys >> np.uint64(32)) % np.uint64(buckets)
    place, bits = _bits(number << np.uint64(32) | (keys & np.uint64(0xFFFFFFFF)), len(hot))
    return hot[place] & bits == bits


# --- segments -----------------------------------------------------------------------------


def _segments(rows: DataFrame, kind: Kind, buckets: int, hot: np.ndarray) -> DataFrame:
    """Runs of windows that may be repeats, dealt by their anchor, or by window if that is hot."""

    def of_slice(part):
        own = Slice(kind, unpack(part.column("packed")))
        ids, versions = _longs(part, "doc_id"), _longs(part, "version")
        first, last, least = _open_segments(
            own, _places(own, part.column("places").to_pylist()), _known_windows(own, part)
        )
        if not len(first):
            return
        yield _deal_segments(own, ids, versions, first, last, least, buckets, hot)

    def of(batches):
        for part in slices(batches, "packed", PACKED_SLICE):
            yield from of_slice(part)

    return rows.mapInArrow(of, _BUCKET)


def _known_windows(own: Slice, part: pa.RecordBatch) -> np.ndarray:
    """First window and window after the last of each phrase that is known to be a repeat, by first window."""
    found = [
        (own.bounds[doc] + span["first"], own.bounds[doc] + span["last"] - own.kind.width + 1)
        for doc, spans in enumerate(part.column("known").to_pylist())
        for span in spans or ()
    ]
    return np.array(sorted(found), np.int64).reshape(-1, 2)


def _open_segments(own: Slice, places: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one shared anchor that are not known to be repeats: first item, item
    after the last, anchor.  A document's own places name all of its shared anchors, so a block of whole
    documents needs those in it only.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    places = np.sort(places)
    for a, hashes, least, _ in own.anchors():
        b = a + len(hashes)
        keys = np.unique(hashes[places[slice(*np.searchsorted(places, (a, b)))] - a])
        open_window = (least != 0) & _members(least, keys)
        for first, last in known[slice(*np.searchsorted(known[:, 0], (a, b)))].tolist():
            open_window[first - a : last - a] = False
        starts = np.flatnonzero(open_window)
        if not len(starts):
            continue
        of, doc = least[starts], own.doc_of[starts + a]
        cut = np.append(True, (starts[1:] != starts[:-1] + 1) | (of[1:] != of[:-1]) | (doc[1:] != doc[:-1]))
        last = np.append(starts[np.flatnonzero(cut)[1:] - 1], starts[-1]) + own.kind.width
        found.append((starts[cut] + a, last + a, of[cut]))
    return tuple(np.concatenate(column) for column in zip(*found))


def _places(own: Slice, places: list) -> np.ndarray:
    """Items of the slice where shared anchors begin."""
    found = [
        np.frombuffer(b"".join(of_doc), "<u4").astype(np.int64) + own.bounds[doc]
        for doc, of_doc in enumerate(places)
        if of_doc
    ]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _members(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the ascending keys."""
    if not len(keys):
        return np.zeros(len(values), bool)
    place = np.searchsorted(keys, values)
    place[place == len(keys)] = 0
    return keys[place] == values


def _repeats_in_slice(own: Slice, ids, first, last) -> tuple[list[bytes], np.ndarray]:
    """Segments, and which of them a document of the slice with a smaller id has, too."""
    raw = [own.raw(a, b) for a, b in zip(first.tolist(), last.tolist())]
    of = ids[own.doc_of[first]].tolist()
    smallest: dict[bytes, int] = {}
    for text, number in zip(raw, of):
        smallest[text] = min(number, smallest.get(text, number))
    return raw, np.array([smallest[text] < number for text, number in zip(raw, of)], bool)


def _deal_segments(own, ids, versions, first, last, keys, buckets, hot) -> pa.RecordBatch:
    raw, repeat = _repeats_in_slice(own, ids, first, last)
    spread = ~repeat & _hot(keys, buckets, hot)
    if spread.any():
        # Segments of hot anchors are cut into their windows, and those dealt by all of their items.
        n_windows = (last - first - own.kind.width + 1)[spread]
        within = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        at = np.repeat(first[spread], n_windows) + within
        windows, again = _repeats_in_slice(own, ids, at, at + own.kind.width)
        by_window = np.array([xxhash.xxh3_64_intdigest(window) for window in windows], np.uint64)
        raw = [text for text, gone in zip(raw, spread.tolist()) if not gone] + windows
        first, last = np.append(first[~spread], at), np.append(last[~spread], at + own.kind.width)
        keys, repeat = np.append(keys[~spread], by_window), np.append(repeat[~spread], again)
        order = np.argsort(first, kind="stable")
        first, last, keys, repeat = first[order], last[order], keys[order], repeat[order]
        raw = [raw[i] for i in order.tolist()]
    doc = own.doc_of[first]
    bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    start = own.bounds[doc]
    spans = np.stack([first - start, last - start], axis=1).astype("<u4")
    rows = []
    done = np.flatnonzero(repeat)
    if len(done):
        docs_in, counts = _by_doc(doc[done])
        rows.append(
            (
                int(bucket[done[0]]), ids[docs_in].tobytes(), versions[docs_in].astype("<u4").tobytes(),
                counts.astype("<u4").tobytes(), None, spans[done].tobytes(), None, None,
            )
        )
    asked = np.flatnonzero(~repeat)
    asked = asked[np.argsort(bucket[asked], kind="stable")]
    cuts = np.searchsorted(bucket[asked], np.arange(buckets + 1))
    for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            some = asked[a:b]
            docs_in, counts = _by_doc(doc[some])
            texts = [raw[i] for i in some.tolist()]
            rows.append(
                (
                    number, ids[docs_in].tobytes(), versions[docs_in].astype("<u4").tobytes(),
                    counts.astype("<u4").tobytes(), keys[some].astype("<u8").tobytes(),
                    spans[some].tobytes(), np.array([len(t) for t in texts], "<u4").tobytes(),
                    b"".join(texts),
                )
            )
    return _dealt(rows)


@dataclass
class Segments:
    """Segments of one bucket with one or some anchors."""

    ids: np.ndarray
    spans: np.ndarray  # first item and item after the last, in the document
    raw: list[bytes]


# Given segments, whether the window at each place is a repeat, segment after segment.
Compare = Callable[[Segments], np.ndarray]
GROUP_WINDOWS = 200_000


def _repeated_spans(dealt: DataFrame, kind: Kind, buckets: int, compare: Compare) -> DataFrame:
    """Spans of repeats of each document, from the segments."""

    def of(batches):
        for rows in _whole_buckets(batches):
            asked = [row for row in rows if row["hashes"] is not None]
            done = [row for row in rows if row["hashes"] is None]
            rows.clear()
            if done:
                spans = _of_rows(done, "places", "<u4").reshape(-1, 2)
                yield _rows_by_doc(*_docs_of_rows(done), spans)
            if asked:
                yield from _compare_bucket(asked, kind, compare)

    return _by_document(_in_buckets(dealt, buckets).mapInArrow(of, _FOUND))


def _compare_bucket(rows: list[dict], kind: Kind, compare: Compare) -> Iterator[pa.RecordBatch]:
    ids, versions = _docs_of_rows(rows)
    keys, spans = _of_rows(rows, "hashes", "<u8"), _of_rows(rows, "places", "<u4").reshape(-1, 2)
    ends = np.cumsum(_of_rows(rows, "sizes", "<u4"), dtype=np.int64)
    raw = b"".join(row["raw"] or b"" for row in rows)
    rows.clear()
    order = np.argsort(keys, kind="stable")
    windows = np.cumsum(spans[order, 1].astype(np.int64) - spans[order, 0] - kind.width + 1)
    fresh = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
    start = 0
    while start < len(order):
        # As many whole anchors as fit, one at least.
        before = windows[start - 1] if start else 0
        reach = np.searchsorted(windows, before + GROUP_WINDOWS, "right")
        stop = fresh[fresh > start]
        fitting = stop[stop <= reach]
        end = int(fitting[-1]) if len(fitting) else int(stop[0]) if len(stop) else len(order)
        if not len(stop) or windows[-1] - before <= GROUP_WINDOWS:
            end = len(order)
        some = order[start:end]
        start = end
        if (ids[some] == ids[some[0]]).all():
            continue
        texts = [raw[ends[i - 1] if i else 0 : ends[i]] for i in some.tolist()]
        repeat = compare(Segments(ids[some], spans[some], texts))
        lengths = spans[some, 1].astype(np.int64) - spans[some, 0] - kind.width + 1
        segment = np.repeat(np.arange(len(some)), lengths)
        at = np.arange(len(segment)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + spans[some[segment], 0]
        segment, at = segment[repeat], at[repeat]
        if len(at):
            cut = np.append(True, (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1))
            last = np.append(at[np.flatnonzero(cut)[1:] - 1], at[-1]) + kind.width
            own = some[segment[cut]]
            yield _rows_by_doc(ids[own], versions[own], np.stack([at[cut], last], axis=1))


# --- all together ---------------------------------------------------------------------------


def find_repeats(docs: DataFrame, kind: Kind, compare: Compare) -> DataFrame:
    """Spans of the repeats of each document that has any.

    Columns: doc_id, version, ``known`` (spans found as phrases) and ``places`` (spans
    found as windows).
    """
    spark = docs.sparkSession
    ship(spark)
    folder = shared_dir(spark, "repeats")
    named = identified(docs).filter("doc_id IS NOT NULL")
    size = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // BUCKET_BYTES))

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    keys = ["doc_id", "version"]
    phrases = stored(_phrases(named, kind), "phrases")  # read twice below
    known = stored(_known_spans(phrases), "known")
    anchors = stored(_shared_anchors(_anchors(named, kind, buckets), buckets, HOT_ANCHOR), "anchors")
    hot = _hot_filter(anchors)
    places = _by_document(anchors.filter("doc_id IS NOT NULL"))
    open_docs = packed(named, kind).join(places, keys).join(known, keys, "left")
    segments = _segments(open_docs.select(*keys, "packed", "places", "known"), kind, buckets, hot)
    found = stored(_repeated_spans(segments, kind, buckets, compare), "found")
    return known.join(found, keys, "full")


def removed(kind: Kind, n_items: int, known: list | None, places: list | None) -> np.ndarray:
    """Which items of a document go."""
    steps = np.zeros(n_items + 1, np.int64)
    for span in known or ():
        steps[span["first"]] += 1
        steps[span["last"]] -= 1
    if places:
        spans = np.frombuffer(b"".join(places), "<u4").reshape(-1, 2)
        np.add.at(steps, spans[:, 0], 1)
        np.add.at(steps, spans[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0
