"""Removes recurring passages by sharded automata over repeated phrases.

A window is a number of consecutive words of one document.  Which windows occur in more than one
document is found by hash first, shard by shard, where a shard holds all windows with certain
anchors (see ``repeats``).  Those windows are compiled into an Aho-Corasick automaton over numbers of
words, and the segments of the shard that hold one are streamed through it, which finds every
occurrence with the words themselves compared.  The smallest document id of a window's
occurrences is the one that keeps it; in all other documents the words it covers go.
Whole repeated phrases need no automaton: copies are settled by their hash.  So documents are not
streamed whole, and what the automaton reads was chosen by hashes.

Automata never hold more than a group of windows (``GROUP_WINDOWS``) or one anchor's.

Defined cases: a NULL text or one without words has nothing to remove; rows with a
NULL id are kept whole and remove nothing; rows that share an id remove nothing from
each other; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from credmill.llm.arrow import slices
from credmill.llm.repeats import (
    PACKED_SLICE, Kind, Segments, find_repeats, identified, packed, removed, unpack,
)
from credmill.llm.words import split, window_hashes

WORDS = 13


def word_kind(width: int = WORDS) -> Kind:
    return Kind(words=True, width=width, anchor=max(1, width * 2 // 5), trigger=min(2, width), phrase=32)


def confirmed(hashes: np.ndarray, starts: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """Which windows occur in more than one document.

    ``starts`` are the places of all windows in the hashes of the words.  Windows are
    confirmed by their hash here; the automaton compares the words.
    """
    keys = window_hashes(hashes, width)[starts]
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
    low, high = np.minimum.reduceat(ids[order], first), np.maximum.reduceat(ids[order], first)
    recurs = np.empty(len(keys), bool)
    recurs[order] = np.repeat(low < high, np.diff(np.append(first, len(keys))))
    return recurs


def locate(sequences: list[tuple[int, ...]], patterns: list[tuple[int, ...]], width: int) -> tuple:
    """Every occurrence of the patterns: sequence, start, pattern."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for number, pattern in enumerate(patterns):
        automaton.add_word(pattern, number)
    automaton.make_automaton()
    found = [
        (number, end - width + 1, pattern)
        for number, sequence in enumerate(sequences)
        for end, pattern in automaton.iter(sequence)
    ]
    return tuple(np.array(found, np.int64).reshape(-1, 3).T)


def compare_words(width: int):
    def compare(segments: Segments) -> np.ndarray:
        of = split(segments.raw)
        sizes, begin = np.diff(of.doc_words), of.doc_words[:-1]
        n_windows = sizes - width + 1
        window_begin = np.cumsum(n_windows) - n_windows
        segment = np.repeat(np.arange(len(sizes)), n_windows)
        within = np.arange(len(segment)) - window_begin[segment]
        recurs = confirmed(of.hashes(), begin[segment] + within, segments.ids[segment], width)
        repeat = np.zeros(len(segment), bool)
        if recurs.any():
            # Only segments with a confirmed window are read word by word.
            chosen = np.unique(segment[recurs])
            known: dict[bytes, int] = {}
            sequences = [
                tuple([known.setdefault(word, len(known)) for word in segments.raw[i].split(b" ")])
                for i in chosen.tolist()
            ]
            place = np.searchsorted(chosen, segment[recurs])
            spots = zip(place.tolist(), within[recurs].tolist())
            patterns = list({sequences[i][at : at + width] for i, at in spots})
            found, start, pattern = locate(sequences, patterns, width)
            ids = segments.ids[chosen[found]]
            smallest = np.full(len(patterns), np.iinfo(np.int64).max)
            np.minimum.at(smallest, pattern, ids)
            again = smallest[pattern] < ids
            repeat[window_begin[chosen[found[again]]] + start[again]] = True
        return repeat

    return compare


def recurring_passages(docs: DataFrame, width: int = WORDS) -> DataFrame:
    return find_repeats(docs, word_kind(width), compare_words(width))


def digests(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """Words of each row of ``docs``, words removed, and the hash of what stays."""
    spans = recurring_passages(docs, width)
    kind = word_kind(width)
    longs = ("doc_id", "n_words", "n_removed")
    schema = pa.schema([*((name, pa.int64()) for name in longs), ("kept_sha256", pa.string())])

    def of(batches):
        for part in slices(batches, "packed", PACKED_SLICE):
            rows = []
            columns = (part.column(name).to_pylist() for name in ("known", "places"))
            for raw, known, places in zip(unpack(part.column("packed")), *columns):
                n_words, kept, n_gone = (raw.count(b" ") + 1 if raw else 0), raw, 0
                if known or places:
                    gone = removed(kind, n_words, known, places)
                    n_gone = int(gone.sum())
                    kept = b" ".join([w for w, g in zip(raw.split(b" "), gone.tolist()) if not g])
                rows.append((n_words, n_gone, hashlib.sha256(kept).hexdigest()))
            arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
            yield pa.record_batch([part.column("doc_id"), *arrays], schema=schema)

    kinds = ", ".join(f"{name} long" for name in longs) + ", kept_sha256 string"
    joined = packed(identified(docs), kind).join(spans, ["doc_id", "version"], "left")
    return joined.select("doc_id", "packed", "known", "places").mapInArrow(of, kinds)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: what stays of each document without recurring passages of 13 words."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(words[pos : pos + 12], ' ') AS run
  FROM texts, unnest(range(1, len(words) - 11)) AS places(pos)
), firsts AS (
  SELECT run, min(doc_id) AS holder FROM windows GROUP BY run
), gone AS (
  SELECT DISTINCT doc_id, pos + step AS place
  FROM windows JOIN firsts USING (run), unnest(range(0, 13)) AS steps(step)
  WHERE holder < doc_id
), each_word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), counted AS (
  SELECT e.doc_id, count(g.place) AS n_removed,
    string_agg(word, ' ' ORDER BY e.place) FILTER (WHERE g.place IS NULL) AS kept
  FROM each_word e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.place = g.place
  GROUP BY e.doc_id
)
SELECT t.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN counted c ON t.doc_id = c.doc_id
"""
