"""Quality rules by the divergence of character-class and common-word histograms.

References are counted over the whole corpus: for each language the characters of
each class, and its most frequent words with all other words as one more
cell, in the documents that pass the base rules.  A document is compared with the
reference of its language by the Jensen-Shannon distance (the square root of the
divergence in bits, from 0 to 1) of both histograms, and rejected if either distance is
beyond its limit.  A short histogram is far from any reference by chance, so a
distance counts only from a minimum number of characters or words on.

Base rules: fewer than 50 words, or more than half of the words in 3-word windows
that come again in the text.

Every language with ``REFERENCE_WORDS`` words in such documents gets a reference, however
small its share of the corpus; a reference is two short histograms, so the driver and each
task hold those of all languages.  A document whose language has none is held to the base
rules only.  A document that names no language is compared with the nearest reference,
and if there is none it is kept.

Defined cases: a NULL or empty text has no words and fails the base rules; NULL
document ids and repeated rows are judged like others; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from credmill.llm import words
from credmill.llm.arrow import raw_texts, slices
from credmill.llm.shipping import ship

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COMMON_WORDS = 64
REFERENCE_WORDS = 2000
HELD_WORDS = 1_000_000

SYMBOLS = b"#*$%&|<>"
# Fixed classes of characters; the bytes after the first of a character count nowhere.
CLASSES = {
    "lower": bytes(range(97, 123)),
    "upper": bytes(range(65, 91)),
    "digit": bytes(range(48, 58)),
    "space": words.SEPARATORS,
    "stop": b".,;:?!",
    "symbol": SYMBOLS,
    "other_ascii": b"\"'()+-/=@[]\\^_`{}~" + bytes([*range(0, 9), *range(14, 32), 127]),
    "beyond_ascii": bytes(range(0xC0, 0x100)),
}
_SKIP = len(CLASSES)
_CLASS_OF = np.full(256, _SKIP, np.int64)
for _number, _members in enumerate(CLASSES.values()):
    _CLASS_OF[list(_members)] = _number
_SYMBOL = words.table(SYMBOLS)
_STOP = words.table(CLASSES["stop"])
_CONTINUES = words.table(bytes(range(0x80, 0xC0)))


@dataclass(frozen=True)
class Limits:
    """Distances beyond which a document is rejected, and when they count."""

    class_distance: float = 0.29
    word_distance: float = 0.465
    min_chars: int = 200
    min_words: int = 50


@dataclass
class Reference:
    classes: np.ndarray  # shares of the character classes
    common: np.ndarray  # hashes of the common words, ascending
    shares: np.ndarray  # their shares of all words, and at the end that of all others


def repeated_words(of: words.Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each document that lie in a 3-word window that it has twice or more."""
    doc_of = of.doc_of
    covered = np.zeros(len(hashes) + 1, np.int32)
    if len(hashes) >= 3:
        inside = np.flatnonzero(doc_of[2:] == doc_of[:-2])
        doc_key = words.mix(doc_of[inside].astype(np.uint64) + np.uint64(1))
        keys = words.window_hashes(hashes, 3)[inside] ^ doc_key
        order = np.argsort(keys)
        equal = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        found = inside[again]
        steps = np.zeros(len(hashes) + 4, np.int32)
        steps[found] += 1
        steps[found + 3] -= 1
        covered = np.cumsum(steps)[: len(hashes) + 1]
    return words.sums_by_doc(covered[: len(hashes)] > 0, of.doc_words)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(words.SEPARATORS)]
    return len(lines) - len(set(lines))


class Counts:
    """What the rules look at, for the texts of a slice."""

    def __init__(self, texts: list[bytes]):
        self.of = of = words.split(texts)
        data, bounds = of.data, of.doc_starts
        self.n_words = np.diff(of.doc_words)
        apart = words.IS_SEPARATOR[data] | _CONTINUES[data]
        self.word_chars = words.sums_by_doc(~apart, bounds)
        self.n_symbols = words.sums_by_doc(_SYMBOL[data], bounds)
        self.n_dup_lines = np.array([repeated_lines(text) for text in texts], np.int64)
        self.n_repeat_words = repeated_words(of, of.hashes())
        self.base_failed = (self.n_words < MIN_WORDS) | (
            100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words
        )
        doc_of_byte = np.repeat(np.arange(len(texts)), np.diff(bounds))
        cells = doc_of_byte * (_SKIP + 1) + _CLASS_OF[data]
        counts = np.bincount(cells, minlength=len(texts) * (_SKIP + 1))
        self.classes = counts.reshape(len(texts), _SKIP + 1)[:, :_SKIP]
        self.classes[:, list(CLASSES).index("space")] -= 1  # the space after each text

    def plain_hashes(self) -> np.ndarray:
        """Hashes of the words in lower case without a stop at the end."""
        of = self.of
        stop = _STOP[of.data[of.ends - 1]] & (of.ends - of.starts > 1)
        return words.span_hashes(words.LOWER[of.data], of.starts, of.ends - stop)


def _distance(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to the shares."""
    totals = counts.sum(axis=1, keepdims=True)
    own = counts / np.maximum(totals, 1)
    middle = (own + shares) / 2

    def against_middle(part: np.ndarray) -> np.ndarray:
        safe = np.where(part > 0, part, 1)
        return (part * np.log2(safe / np.where(middle > 0, middle, 1))).sum(axis=1)

    divergence = (against_middle(own) + against_middle(np.broadcast_to(shares, own.shape))) / 2
    return np.sqrt(np.clip(divergence, 0, 1))


def count_corpus(docs: DataFrame) -> DataFrame:
    """Counts of classes and words by language: lang, kind, key, n."""
    ship(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("key", pa.int64()), ("n", pa.int64())])

    def batch(lang, kind, keys, n):
        columns = [[lang] * len(keys), [kind] * len(keys), keys, n]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, where, np.concatenate([p[1] for p in parts]))
        return keys, sums

    def count(batches):
        held: dict[str, list] = {}
        n_held = 0
        for part in slices(batches):
            counts = Counts(raw_texts(part.column("text")))
            langs = np.array([lang or "" for lang in part.column("lang").to_pylist()], object)
            hashes, doc_of = counts.plain_hashes().view(np.int64), counts.of.doc_of
            for lang in set(langs) - {""}:
                chosen = (langs == lang) & ~counts.base_failed
                yield batch(lang, "class", np.arange(_SKIP), counts.classes[chosen].sum(axis=0))
                found = np.unique(hashes[chosen[doc_of]], return_counts=True)
                yield batch(lang, "total", [0], [int(found[1].sum())])
                held.setdefault(lang, []).append(found)
                n_held += len(found[0])
            if n_held > HELD_WORDS:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                n_held = sum(len(parts[0][0]) for parts in held.values())
                # The largest go on, so that what all languages hold stays bounded.
                for lang in sorted(held, key=lambda name: -len(held[name][0][0])):
                    if n_held <= HELD_WORDS // 2:
                        break
                    n_held -= len(held[lang][0][0])
                    yield batch(lang, "word", *held.pop(lang)[0])
        for lang, parts in held.items():
            yield batch(lang, "word", *merged(parts))

    return (
        docs.select("text", F.col("lang").cast("string"))
        .mapInArrow(count, "lang string, kind string, key long, n long")
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )


def references(docs: DataFrame, common_words: int = COMMON_WORDS) -> dict[str, Reference]:
    """References of all languages that have words enough for one."""
    first = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    total = F.max(F.when(F.col("kind") == "total", F.col("n"))).over(Window.partitionBy("lang"))
    rows = (
        count_corpus(docs)
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= max(common_words, _SKIP))
        .withColumn("total", total)
        .filter(F.col("total") >= REFERENCE_WORDS)
        .collect()
    )
    by_lang: dict[str, list] = {}
    for row in rows:
        by_lang.setdefault(row.lang, []).append(row)
    found: dict[str, Reference] = {}
    for lang, own in sorted(by_lang.items()):
        classes = np.zeros(_SKIP)
        for row in own:
            if row.kind == "class":
                classes[row.key] = row.n
        total = sum(row.n for row in own if row.kind == "total")
        common = {row.key: row.n for row in own if row.kind == "word" and row.place <= common_words}
        keys = np.array(sorted(common), np.int64)
        if not total or not classes.sum():
            continue
        shares = np.array([common[key] for key in keys.tolist()], float) / total
        shares = np.append(shares, max(0.0, 1 - shares.sum()))
        found[lang] = Reference(classes / classes.sum(), keys, shares)
    return found


def distances(counts: Counts, langs: list[str | None], known: dict[str, Reference]) -> tuple:
    """Class distance and word distance of each document of a slice."""
    n = len(langs)
    hashes, doc_of = counts.plain_hashes().view(np.int64), counts.of.doc_of
    by_class, by_word = np.zeros(n), np.zeros(n)
    nearest = np.full(n, np.inf)
    named = np.array([lang or "" for lang in langs], object)
    for lang in known if (named == "").any() else sorted(set(langs) & set(known)):
        reference = known[lang]
        rows = np.flatnonzero((named == lang) | (named == ""))
        if not len(rows):
            continue
        cell = np.searchsorted(reference.common, hashes)
        cell[cell == len(reference.common)] = 0
        size = len(reference.common) + 1
        if size > 1:
            cell = np.where(reference.common[cell] == hashes, cell, size - 1)
        histogram = np.bincount(doc_of * size + cell, minlength=n * size).reshape(n, size)
        a = _distance(counts.classes[rows], reference.classes)
        b = _distance(histogram[rows], reference.shares)
        better = a + b < nearest[rows]
        chosen = rows[better]
        by_class[chosen], by_word[chosen], nearest[chosen] = a[better], b[better], (a + b)[better]
    return by_class, by_word


def judge(docs: DataFrame, *, limits: Limits = Limits(), known: dict[str, Reference] | None = None) -> DataFrame:
    """Counts, distances and verdict of each row of ``docs``."""
    ship(docs.sparkSession)
    known = references(docs) if known is None else known
    longs = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    fields = [(name, pa.int64()) for name in longs]
    fields += [("base_failed", pa.bool_()), ("kept", pa.bool_())]
    fields += [("class_distance", pa.float64()), ("word_distance", pa.float64())]
    schema = pa.schema(fields)

    def of(batches):
        for part in slices(batches):
            counts = Counts(raw_texts(part.column("text")))
            kept, by_class, by_word = verdicts(counts, part.column("lang").to_pylist(), limits, known)
            values = [getattr(counts, name) for name in longs[1:]]
            values += [counts.base_failed, kept, by_class, by_word]
            columns = [pa.array(v, f.type) for v, f in zip(values, list(schema)[1:])]
            yield pa.record_batch([part.column("doc_id"), *columns], schema=schema)

    kinds = ", ".join(f"{name} long" for name in longs)
    kinds += ", base_failed boolean, kept boolean, class_distance double, word_distance double"
    read = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"))
    return read.mapInArrow(of, kinds)


def verdicts(counts: Counts, langs: list[str | None], limits: Limits, known: dict) -> tuple:
    by_class, by_word = distances(counts, langs, known)
    far = (by_class > limits.class_distance) & (counts.word_chars >= limits.min_chars)
    far |= (by_word > limits.word_distance) & (counts.n_words >= limits.min_words)
    return ~counts.base_failed & ~far, by_class, by_word


def keep_good(docs: DataFrame, *, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    ship(docs.sparkSession)
    known = references(docs)

    def of(batches):
        for part in slices(batches):
            counts = Counts(raw_texts(part.column("text")))
            kept, _, _ = verdicts(counts, part.column("lang").to_pylist(), limits, known)
            yield part.filter(pa.array(kept))

    return docs.mapInArrow(of, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: counts and verdict for all documents."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
