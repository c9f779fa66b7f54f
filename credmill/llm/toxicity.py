"""Toxicity by a lexicon with misspellings, and by the context of each hit.

The lexicon is learned: whole words and stems that come much more often in documents
labelled toxic than in others, with the log-odds as weights.  Its words are kept as
tries, sharded by the first and by the second half of a word.  A word is looked up by running
its Levenshtein automaton and the tries of its shards together, so that only branches
within the allowed number of errors are walked; for a word that cannot have one error,
because neither its beginning nor its end is that of a term, none are walked at all.
All learned words can be misspelled, also those for which a stem stands.

Each hit is scored in its window of neighbouring words: quotation marks around it and
verbs of reporting make it a quotation, words that address the reader make it abuse.  A
logistic model weighs the sums; it never sees labels of held-out rows, nor language,
source or id.

The lexicon counts all training rows in Spark and keeps every term that at least
``MIN_TOXIC_DOCS`` toxic documents have and whose log-odds are high and no chance, whatever
share of the documents that is; of stems only the shortest are kept.  It has no
limit: the driver and each task hold all of it, 316 to 526 bytes a word as measured on
200,000 words, so its memory grows with the number of learned words.
The logistic model, which has a handful of weights,
is fitted on about ``FIT_ROWS`` labelled rows at most, chosen by a hash of their ids.

Defined cases: a NULL or empty text has no hits and gets the score of a clean text;
without labels of both kinds all scores are 0; a document with several labels counts as
toxic if one of them says so; NULL document ids are not held out and never
trained on; repeated rows are scored like others; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.llm.arrow import slices
from credmill.llm.shipping import ship
from credmill.sources.scratch import shared_dir

THRESHOLD = 0.3
MIN_TOXIC_DOCS = 5
MIN_LOG_ODDS = 3.0
STEM_CHARS = (4, 5, 6, 7)
FIT_ROWS = 20_000
SHARES = 1 << 20
WINDOW_WORDS = 6
FUZZY_CHARS = 5  # shorter terms must match letter by letter
MEMO_WORDS = 400_000
MEMO_TRIES = 20_000

MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…¡¿"
# Fixed lists: signs of quotation, verbs of reporting, and words that address someone.
QUOTES = "\"«»“”„"
REPORTING = frozenset(
    "said says wrote writes called quote quoted quotes reported term word "
    "sagte sagt schrieb zitat zitiert wort "
    "dit disait écrit citation cité mot "
    "dijo dice escribió cita citado palabra".split()
)
ADDRESSING = frozenset("you your you're u du dich dir dein ihr tu toi vous te tú ti usted vosotros".split())
FEATURES = ("plain", "quoted", "misspelled", "addressed", "dense", "any")


def train_part(doc_id: Column) -> Column:
    """0, 1 and 3 are for training; 2 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)).cast("int")


# --- lexicon ------------------------------------------------------------------------


@dataclass
class Node:
    children: dict[str, Node] = field(default_factory=dict)
    word: float | None = None  # weight of the word that ends here


class Lexicon:
    """Terms in shards by half of their letters, each a trie once it is asked for."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.stem_sizes = sorted({len(stem) for stem in stems}, reverse=True)
        # One error leaves one half of the term whole, so a term is in the shard of each half.
        self.starts: dict[tuple[str, int], list[str]] = {}
        self.ends: dict[tuple[str, int], list[str]] = {}
        for term in words:
            size = len(term)
            if size >= FUZZY_CHARS:
                self.starts.setdefault((term[: size // 2], size), []).append(term)
                self.ends.setdefault((term[size // 2 :], size), []).append(term)
        self.tries: dict[tuple, Node] = {}

    def exact(self, word: str) -> float | None:
        """Weight of the word or of its longest stem."""
        weight = self.words.get(word)
        if weight is not None:
            return weight
        return next((self.stems[word[:n]] for n in self.stem_sizes if word[:n] in self.stems), None)

    def trie(self, key: tuple, terms: list[str]) -> Node:
        root = self.tries.get(key)
        if root is None:
            if len(self.tries) >= MEMO_TRIES:
                self.tries.clear()
            root = self.tries[key] = Node()
            for term in terms:
                node = root
                for letter in term:
                    node = node.children.setdefault(letter, Node())
                node.word = self.words[term]
        return root

    def near(self, word: str) -> float | None:
        """Largest weight of a term at one error from the word."""
        best = automaton = None
        for size in range(max(FUZZY_CHARS, len(word) - 1), len(word) + 2):
            rest = size - size // 2
            for shards, key in ((self.starts, (word[: size // 2], size)), (self.ends, (word[-rest:], size))):
                terms = shards.get(key)
                if terms is None:
                    continue
                automaton = automaton or Levenshtein(word, 1)
                walk = [(self.trie((shards is self.starts, *key), terms), automaton.start())]
                while walk:
                    node, states = walk.pop()
                    if node.word is not None and automaton.accepts(states):
                        best = max(node.word, best or node.word)
                    for letter, child in node.children.items():
                        following = automaton.step(states, letter)
                        if following:
                            walk.append((child, following))
        return best

    def look_up(self, word: str) -> tuple[float, bool] | None:
        """Weight, and whether the word is misspelled."""
        weight = self.exact(word)
        if weight is not None:
            return weight, False
        weight = self.near(word)
        return None if weight is None else (weight, True)


class Levenshtein:
    """States are places in the word with the fewest errors by which they are reached."""

    def __init__(self, word: str, errors: int):
        self.word, self.errors = word, errors

    def start(self) -> dict[int, int]:
        return {place: place for place in range(min(self.errors, len(self.word)) + 1)}

    def step(self, states: dict[int, int], letter: str) -> dict[int, int]:
        out: dict[int, int] = {}

        def reach(place: int, errors: int) -> None:
            while errors <= self.errors and errors < out.get(place, self.errors + 1):
                out[place] = errors
                if place == len(self.word):
                    return
                place, errors = place + 1, errors + 1  # a letter of the word left out

        for place, errors in states.items():
            if place < len(self.word):
                reach(place + 1, errors + (self.word[place] != letter))
            reach(place, errors + 1)  # a letter more in the term
        return out

    def accepts(self, states: dict[int, int]) -> bool:
        return len(self.word) in states


# --- features of a text -----------------------------------------------------------------


class _Memo(dict):
    """Lower-case chunk to its hit or None."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, chunk: str) -> tuple[float, bool] | None:
        word = chunk.strip(MARKS)
        hit = self[chunk] = self.lexicon.look_up(word) if word else None
        return hit


def is_quoted(chunks: list[str], at: int) -> bool:
    """Whether the window around a word quotes it."""
    before = chunks[max(0, at - WINDOW_WORDS) : at]
    after = chunks[at + 1 : at + 1 + WINDOW_WORDS]
    own = chunks[at]
    opened = any(q in c for c in before for q in QUOTES) or own[0] in QUOTES
    closed = any(q in c for c in after for q in QUOTES) or own[-1] in QUOTES
    if opened and closed:
        return True
    return any(c.strip(MARKS) in REPORTING for c in before + after)


def features(text: str, memo: _Memo) -> tuple[float, ...]:
    chunks = text.lower().split()
    hits = list(map(memo.__getitem__, chunks))
    if not any(hits):
        return (0.0,) * len(FEATURES)
    plain = quoted = misspelled = 0.0
    addressed = 0
    for at, hit in enumerate(hits):
        if hit is None:
            continue
        weight, wrong = hit
        if is_quoted(chunks, at):
            quoted += weight
        elif wrong:
            misspelled += weight
        else:
            plain += weight
        near = chunks[max(0, at - WINDOW_WORDS) : at + 1 + WINDOW_WORDS]
        addressed += any(c.strip(MARKS) in ADDRESSING for c in near)
    dense = 100 * plain / len(chunks)
    return tuple(math.log1p(x) for x in (plain, quoted, misspelled, addressed, dense)) + (float(plain > 0),)


# --- training ---------------------------------------------------------------------------


def _terms(text: str) -> set[tuple[str, bool]]:
    """Words and stems of a text; the flag marks stems."""
    words = {chunk.strip(MARKS) for chunk in text.lower().split()}
    terms = {(word, False) for word in words if 3 <= len(word) <= 40}
    for n in STEM_CHARS:
        terms |= {(word[:n], True) for word in words if len(word) > n}
    return terms


def count_terms(labelled: DataFrame) -> DataFrame:
    """For each term the numbers of toxic and of other documents that have it."""
    ship(labelled.sparkSession)
    schema = pa.schema(
        [("term", pa.string()), ("stem", pa.bool_()), ("toxic", pa.int64()), ("other", pa.int64())]
    )

    def count(batches):
        for part in slices(batches):
            toxic, other = Counter(), Counter()
            for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                (toxic if label else other).update(_terms(text or ""))
            terms = list(toxic | other)
            columns = [[t[0] for t in terms], [t[1] for t in terms], [toxic[t] for t in terms], [other[t] for t in terms]]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return (
        labelled.mapInArrow(count, "term string, stem boolean, toxic long, other long")
        .groupBy("term", "stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )


def beyond_chance(terms: DataFrame, sizes: tuple[int, int], tested: int) -> DataFrame:
    """Terms that are toxic more often than chance explains, with their log-odds as weight.

    The binomial tail of a term that comes in toxic documents as often as any other is at
    most exp(-gain); it is held against the number of terms that are tested.
    """
    toxic, other = sizes
    share = (toxic + 1) / (toxic + other + 2)
    n = F.col("toxic") + F.col("other")

    def part(count: str, expected: float) -> Column:
        return F.when(F.col(count) > 0, F.col(count) * F.log(F.col(count) / (n * expected))).otherwise(0.0)

    base = math.log((toxic + 1) / (other + 1))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("other") + 0.5)) - F.lit(base)
    gain = part("toxic", share) + part("other", 1 - share)
    return (
        terms.filter(F.col("toxic") >= MIN_TOXIC_DOCS)
        .withColumn("weight", odds)
        .filter((F.col("weight") >= MIN_LOG_ODDS) & (gain >= math.log(max(1, tested))))
    )


def merged(found: DataFrame) -> DataFrame:
    """All words, and the stems of several words for which no shorter stem stands."""

    def prefixes(rows: DataFrame, longest: Column) -> DataFrame:
        sizes = F.filter(F.array(*map(F.lit, STEM_CHARS)), lambda n: n <= longest)
        return rows.select("*", F.explode(F.transform(sizes, lambda n: F.substring("term", F.lit(1), n))).alias("prefix"))

    words, stems = found.filter(~F.col("stem")), found.filter("stem")
    # A stem of one word only is no stem.
    by_stem = (
        prefixes(words, F.length("term"))
        .groupBy(F.col("prefix").alias("term"))
        .agg(F.count(F.lit(1)).alias("words"), F.max("toxic").alias("most"))
    )
    several = stems.join(by_stem, "term", "left").filter("NOT (words <=> 1 AND most <=> toxic)").select(stems.columns)
    covered = prefixes(several.select("term"), F.length("term") - 1).join(several.select(F.col("term").alias("prefix")), "prefix")
    return words.unionByName(several.join(covered.select("term").distinct(), "term", "left_anti"))


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """The terms with the surest log-odds for toxic documents."""
    sizes = labelled.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other")).first()
    folder = shared_dir(labelled.sparkSession, "terms")
    frequent = F.col("toxic") + F.col("other") >= MIN_TOXIC_DOCS
    count_terms(labelled).filter(frequent).write.parquet(folder)  # read several times below
    terms = labelled.sparkSession.read.parquet(folder)
    rows = merged(beyond_chance(terms, (sizes["toxic"], sizes["other"]), terms.count())).collect()
    stems = {row.term: row.weight for row in rows if row.stem}
    # Words are kept for misspellings also where a stem stands for them.
    return Lexicon({row.term: row.weight for row in rows if not row.stem}, stems)


def fit_logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Weights and, last, the constant; Newton's method on the penalised likelihood."""
    x = np.append(rows, np.ones((len(rows), 1)), axis=1)
    weights = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - chance) - ridge @ weights
        bend = (x * (chance * (1 - chance))[:, None]).T @ x + ridge
        change = np.linalg.solve(bend, slope)
        weights += np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return weights


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(rows))
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _feature_rows(part: pa.RecordBatch, memo: _Memo) -> np.ndarray:
    rows = []
    for text in part.column("text").to_pylist():
        if len(memo) > MEMO_WORDS:
            memo.clear()
        rows.append(features(text or "", memo))
    return np.array(rows, float).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon from parts 0 and 1 of the training rows, weights from part 3.

    Without toxic or without other rows in part 3 there are no weights, and all scores are 0.
    """
    ship(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    part = train_part(F.col("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long"), "text")

    def labelled(*parts: int, share: float = 1.0) -> DataFrame:
        chosen = part.isin(*parts) & (F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)) < math.ceil(share * SHARES))
        # Labels grow with the documents, so they are never broadcast.
        return texts.filter(chosen).join(known.filter(chosen).hint("merge"), "doc_id").select("text", "toxic")

    lexicon = learn_lexicon(labelled(0, 1))
    schema = pa.schema([("toxic", pa.int32()), ("row", pa.list_(pa.float64()))])

    def rows(batches):
        memo = _Memo(lexicon)
        for batch in slices(batches):
            found = _feature_rows(batch, memo)
            yield pa.record_batch([batch.column("toxic"), pa.array(list(found), schema[1].type)], schema=schema)

    share = min(1.0, FIT_ROWS / max(1, known.filter(part == 3).count()))
    gathered = labelled(3, share=share).mapInArrow(rows, "toxic int, row array<double>").collect()
    targets = np.array([row.toxic for row in gathered], float)
    if len(set(targets.tolist())) < 2:
        return Model(lexicon, None)
    return Model(lexicon, fit_logistic(np.array([row.row for row in gathered]), targets))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score and prediction of each row of ``docs``."""
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def of(batches):
        memo = _Memo(model.lexicon)
        for part in slices(batches):
            scores = model.scores(_feature_rows(part, memo))
            yield pa.record_batch([part.column("doc_id"), pa.array(scores)], schema=schema)

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(train_part(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns."""
    model = train(docs, labels)

    def of(batches):
        memo = _Memo(model.lexicon)
        for part in slices(batches):
            yield part.filter(pa.array(model.scores(_feature_rows(part, memo)) < THRESHOLD))

    return docs.mapInArrow(of, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents, with a model of the training rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
