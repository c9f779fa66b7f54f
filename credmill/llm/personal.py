"""Personal data in texts: labelers vote, expectation-maximisation weighs them, a classifier decides.

Four kinds are found: email, ip, card, phone.  The base is a pattern and a test for each kind;
its spans are always kept.  Candidates are wider: addresses with letters beyond ASCII or with
"(at)" and "dot" spelled out, defanged and IPv6 addresses, cards and phones that touch another
number, which the base drops as a whole, cards with dots, national phone numbers.  Six
labelers vote yes, no or nothing on each candidate and each base span:

* regex: the base has this very span;
* value: check digit, ranges of parts, lengths of labels;
* gazetteer: issuer prefixes, top-level domains, calling codes, special networks;
* context: the three words before it;
* border: no letter, digit or joining mark touches it;
* shape: the usual grouping and characters.

Spans with the same votes and the same features count as one row, in Spark; there are at most
``MAX_PATTERNS`` such rows whatever the size of the corpus, 48 bytes each, so they are collected.
Expectation-maximisation over all of them estimates for each kind how often each labeler says
yes on real and on false candidates.  It starts from the shares in ``LABELERS``, which go on to count
like ``PRIOR_VOTES`` votes.  Its posteriors are the soft labels of a logistic regression on votes and
features, one a kind.  A candidate that scores ``THRESHOLD`` or more is added, the best first,
where it meets no other span, or holds a base span of its own kind as a part.

Both passes read all texts whole and keep no state between documents.

Defined cases: a NULL or empty text has no spans; NULL document ids and repeated rows are treated like
others; matching takes time in proportion to a text, also for very long texts; without any candidate
there is no classifier and nothing is added; an empty table gives an empty result; further columns are
not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.llm.arrow import slices
from credmill.llm.shipping import ship

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
# Labelers, and how often each is thought to say yes on real and on false candidates beforehand.
LABELERS = {
    "regex": (0.95, 0.05), "value": (0.98, 0.1), "gazetteer": (0.85, 0.3),
    "context": (0.8, 0.2), "border": (0.9, 0.7), "shape": (0.9, 0.7),
}
FEATURES = ("beyond_ascii", "separators", "many_digits", "holds_base", "first_in_line")
MAX_PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 2 ** len(FEATURES)
THRESHOLD = 0.5
PRIOR_VOTES = 12
ROUNDS = 100
RIDGE = 1.0

# The base patterns, without the backtracking that cannot lead to a match.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Candidates beyond the base.
_WIDE_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)+")
_AT = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\})\s?|\sat\s", re.IGNORECASE)
_SPELLED_DOMAIN = re.compile(r"[\w-]+(?:(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\[\.\])\s?|\sdot\s|\.)[\w-]+)+", re.IGNORECASE)
_SPELLED_DOT = re.compile(r"dot|\[\.\]", re.IGNORECASE)
_DEFANGED = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}(?![\w])")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
_GROUPS = re.compile(r"(?<![0-9])[0-9]++(?:[\x20.-][0-9]++)*+")
_NUMBER = re.compile(r"[0-9]+")
_NATIONAL = re.compile(
    r"(?<![\w.+-])(?:(?:\+|00)?1[\x20.-]?)?(?:\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}"
    r"|[0-9]{3}(?P<mark>[\x20.-])[0-9]{3}(?P=mark)[0-9]{4})(?![0-9\w])"
)
_ABROAD = re.compile(r"(?<![\w.+-])00[2-9][0-9]{0,2}(?:[\x20.-]\(?[0-9]{1,4}\)?){2,5}(?![0-9\w])")
_CARD_SHAPES = {(4, 4, 4, 4), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4)}
_LOCAL_ENDS = re.compile(r"[^\s@<>()\[\]{},;:\"'|/\\=#*&$!?]+\Z")
_LONGEST_LOCAL = 64

# Gazetteers; fixed values.
_DOMAINS = frozenset(
    "com org net edu gov mil int info biz name pro io co ai app dev me tv eu de fr es it nl be at ch uk ie pt pl se "
    "no dk fi cz sk hu ro bg gr tr ru ua us ca mx br ar cl pe au nz jp cn kr tw hk sg in id my th vn ph za ng ke eg il "
    "example test invalid localhost".split()
)
_CALLING = tuple(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 "
    "86 90 91 92 93 94 95 98 21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split()
)
_CUES = {
    EMAIL: frozenset("mail email e-mail mailto contact contacto correo courriel write schreiben kontakt reply".split()),
    IP: frozenset("ip ipv4 ipv6 host server address addr client login ping adresse dirección".split()),
    CARD: frozenset("card visa mastercard amex credit debit carte karte tarjeta payment pan".split()),
    PHONE: frozenset("phone tel telephone call mobile cell fax telefon téléphone teléfono handy whatsapp".split()),
}
_OTHER_CUES = frozenset(
    "version release v section chapter isbn issn doi order invoice token key hash commit id build license".split()
)


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: int
    base: bool
    holds_base: bool = False


class Placed:
    """Spans that can be asked for by place; those of one kind do not overlap."""

    def __init__(self, spans: list[Span] = ()):
        self.by_kind: list[list[Span]] = [[] for _ in KINDS]
        for span in spans:
            self.add(span)

    def add(self, span: Span) -> None:
        insort(self.by_kind[span.kind], span, key=lambda other: other.start)

    def met(self, start: int, end: int) -> Iterator[Span]:
        """The spans that share a character with these bounds."""
        for spans in self.by_kind:
            place = bisect_left(spans, end, key=lambda other: other.start) - 1
            while place >= 0 and spans[place].end > start:
                yield spans[place]
                place -= 1


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        if place % 2:
            digit = digit * 2 - 9 * (digit > 4)
        total += digit
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_NUMBER.findall(text))


def is_card(digits: str) -> bool:
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """The spans of the base patterns, by start and then kind."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        head = text[max(done, at - _LONGEST_LOCAL) : at]
        if len(head) == _LONGEST_LOCAL and not head.strip(_LOCAL):
            head = text[done:at]
        start = at - len(head) + len(head.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            found.append(Span(start, domain.end(), EMAIL, True))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for match in _IP.finditer(text) if "." in text else ():
            if all(map(_is_byte, match.group().split("."))):
                found.append(Span(*match.span(), IP, True))
        for match in _CARD.finditer(text):
            if match.end() - match.start() >= 14 and is_card(digits_of(match.group())):
                found.append(Span(*match.span(), CARD, True))
        for match in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(digits_of(match.group())) <= 15:
                found.append(Span(*match.span(), PHONE, True))
    return sorted(found, key=lambda span: (span.start, span.kind))


def _local(text: str, end: int) -> int:
    """Start of the local part of an address that ends there."""
    found = _LOCAL_ENDS.search(text[max(0, end - _LONGEST_LOCAL) : end])
    return end - (len(found.group().lstrip(".")) if found else 0)


def _wide(text: str) -> Iterator[tuple[int, int, int]]:
    at = text.find("@")
    while at >= 0:
        start, domain = _local(text, at), _WIDE_DOMAIN.match(text, at + 1)
        if domain and start < at:
            yield start, domain.end(), EMAIL
        at = text.find("@", at + 1)
    lower = text.lower() if "dot" in text or "at)" in text or "at]" in text or "AT" in text else ""
    if "(at)" in lower or "[at]" in lower or "{at}" in lower or (" at " in lower and " dot " in lower):
        for mark in _AT.finditer(text):
            start, domain = _local(text, mark.start()), _SPELLED_DOMAIN.match(text, mark.end())
            # A plain "at" between words says nothing unless the dot is spelled out too.
            spelled = domain and (mark.group().strip().lower() != "at" or _SPELLED_DOT.search(domain.group()))
            if spelled and start < mark.start():
                yield start, domain.end(), EMAIL
    if text.count(":") >= 7:
        yield from ((*match.span(), IP) for match in _IP6.finditer(text))
    if not _DIGIT.search(text):
        return
    if "[.]" in text or "(.)" in text:
        yield from ((*match.span(), IP) for match in _DEFANGED.finditer(text))
    for match in _GROUPS.finditer(text):
        if match.end() - match.start() >= 14:
            yield from _cards(match)
    for pattern in (_NATIONAL, _ABROAD):
        yield from ((*match.span(), PHONE) for match in pattern.finditer(text))


def _cards(groups: re.Match) -> Iterator[tuple[int, int, int]]:
    """Cards among neighbouring groups of digits: one group, or groups of a usual shape."""
    spans = [(m.start() + groups.start(), m.end() + groups.start()) for m in _NUMBER.finditer(groups.group())]
    sizes = [end - start for start, end in spans]
    for first, size in enumerate(sizes):
        if 14 <= size <= 19:
            yield *spans[first], CARD
        for shape in _CARD_SHAPES if size == 4 else ():
            if tuple(sizes[first : first + len(shape)]) == shape:
                yield spans[first][0], spans[first + len(shape) - 1][1], CARD


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Spans beyond the base that may be added to it."""
    found, placed = {}, Placed(base)
    for start, end, kind in _wide(text):
        parts = ((s.kind, start <= s.start and s.end <= end, s.end - s.start) for s in placed.met(start, end))
        if all(other == kind and inside and size < end - start for other, inside, size in parts):
            found[start, end, kind] = Span(start, end, kind, False, any(placed.met(start, end)))
    return list(found.values())


# --- labelers ------------------------------------------------------------------------------

YES, NO, NOTHING = 2, 1, 0


def _says(yes: bool) -> int:
    return YES if yes else NO


def _value(kind: int, span: str, digits: str) -> int:
    if kind == EMAIL:
        labels = _labels(span)
        return _says(all(0 < len(label) <= 63 and label.strip("-") == label for label in labels))
    if kind == IP:
        return _says(":" in span or all(map(_is_byte, _NUMBER.findall(span))))
    if kind == CARD:
        return _says(luhn(digits))
    return _says(10 <= len(digits.lstrip("0")) <= 15)


def _labels(span: str) -> list[str]:
    """The labels of the domain of an address."""
    domain = re.split(r"@|\(at\)|\[at\]|\{at\}|\sat\s", span, maxsplit=1, flags=re.IGNORECASE)[-1]
    return re.split(r"\s?(?:\(dot\)|\[dot\]|\{dot\}|\[\.\])\s?|\sdot\s|\.", domain.strip(), flags=re.IGNORECASE)


def _gazetteer(kind: int, span: str, digits: str) -> int:
    if kind == EMAIL:
        return _says(_labels(span)[-1].lower() in _DOMAINS)
    if kind == IP:
        # Multicast and reserved networks, this network and this machine.
        return NOTHING if ":" in span else _says(int(_NUMBER.findall(span)[0][-3:]) not in (0, 127, *range(224, 256)))
    if kind == CARD:
        two, four = int(digits[:2]), int(digits[:4])
        known = digits[0] == "4" or 51 <= two <= 55 or 2221 <= four <= 2720 or two in (34, 37, 30, 36, 38, 39, 62, 65)
        return _says(known or four == 6011)
    if span.startswith("+") or digits.startswith("00"):
        return _says(digits.lstrip("0").startswith(_CALLING))
    return NOTHING


def _context(kind: int, before: str) -> int:
    words = [word.strip(".,:;!?()[]\"'=#").lower() for word in before.split()[-3:]]
    if not _CUES[kind].isdisjoint(words):
        return YES
    return NO if not _OTHER_CUES.isdisjoint(words) else NOTHING


def _shape(kind: int, span: str) -> int:
    if kind == EMAIL:
        return _says("@" in span and span.isascii() and span[0].isalnum())
    if kind == IP:
        return _says(not re.search(r"[\[(]|(?<![0-9])0[0-9]", span))
    marks = set(re.sub(r"[0-9]", "", span))
    return _says(len(marks) <= 1 and "." not in marks if kind == CARD else marks <= set("+() -") and marks != {" "})


def votes(text: str, span: Span) -> int:
    """The votes of all labelers as one number, three values a place."""
    found = text[span.start : span.end]
    digits = digits_of(found)
    left, right = text[span.start - 1 : span.start], text[span.end : span.end + 2]
    touched = (left.isalnum() or left in tuple("_@")) or (right[:1].isalnum() or right[:1] in tuple("_@"))
    said = (
        YES if span.base else NOTHING,
        _value(span.kind, found, digits),
        _gazetteer(span.kind, found, digits),
        _context(span.kind, text[max(0, span.start - 60) : span.start]),
        _says(not touched),
        _shape(span.kind, found),
    )
    return sum(vote * 3**place for place, vote in enumerate(said))


def features(text: str, span: Span) -> int:
    found = text[span.start : span.end]
    is_so = (
        not found.isascii(),
        any(mark in found for mark in " -()["),
        len(digits_of(found)) > 12,
        span.holds_base,
        span.start == 0 or text[span.start - 1] == "\n",
    )
    return sum(yes << place for place, yes in enumerate(is_so))


def split_votes(codes: np.ndarray) -> np.ndarray:
    """Votes by labeler, one row a code."""
    return codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3


# --- the model ------------------------------------------------------------------------------


def reliabilities(said: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """How often each labeler says yes on real and on false candidates, and the posteriors.

    ``said`` has a row for each pattern of votes and ``n`` how many candidates have it.  Without any
    vote the posterior is the share of real ones.
    """
    yes, no = said == YES, said == NO
    on_real, on_false = priors = np.array(list(LABELERS.values())).T
    share, posterior = 0.5, np.full(len(n), 0.5)
    for _ in range(ROUNDS):
        odds = np.log(share / (1 - share))
        odds = odds + yes @ np.log(on_real / on_false) + no @ np.log((1 - on_real) / (1 - on_false))
        before, posterior = posterior, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(before - posterior).max(initial=0) < 1e-9:
            break
        real, false = n * posterior, n * (1 - posterior)
        share = (real.sum() + 1) / (n.sum() + 2)
        on_real, on_false = (
            (part @ yes + PRIOR_VOTES * prior) / (part @ (yes | no) + PRIOR_VOTES)
            for part, prior in zip((real, false), priors, strict=True)
        )
    return on_real, on_false, posterior, float(share)


def inputs(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Inputs of the classifier: one, yes and no of each labeler, the features."""
    said = split_votes(codes)
    has = bits[:, None] >> np.arange(len(FEATURES)) & 1
    return np.hstack([np.ones((len(codes), 1)), said == YES, said == NO, has]).astype(float)


def fit(x: np.ndarray, target: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (p - target)) + RIDGE * weights
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass(frozen=True)
class Model:
    """Weights of the classifier of each kind that had candidates."""

    weights: dict[int, tuple[float, ...]]

    def score(self, kind: int, code: int, bits: int) -> float:
        return _score(self.weights.get(kind), code, bits)


@lru_cache(maxsize=1 << 16)
def _score(weights: tuple[float, ...] | None, code: int, bits: int) -> float:
    if weights is None:
        return 0.0
    x = inputs(np.array([code]), np.array([bits]))[0]
    return float(1 / (1 + np.exp(-np.clip(x @ np.array(weights), -500, 500))))


def _texts(batches) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for part in slices(batches):
        yield part, [text or "" for text in part.column("text").to_pylist()]


def patterns(docs: DataFrame) -> DataFrame:
    """How many base spans and candidates have which votes and features: kind, votes, features, n."""
    ship(docs.sparkSession)
    schema = pa.schema([("kind", pa.int32()), ("votes", pa.int32()), ("features", pa.int32()), ("n", pa.int64())])

    def count(batches):
        held: Counter = Counter()
        for _, texts in _texts(batches):
            for text in texts:
                base = base_spans(text)
                for span in [*base, *candidates(text, base)]:
                    held[span.kind, votes(text, span), features(text, span)] += 1
        if held:
            columns = [*zip(*held, strict=True), list(held.values())]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    counted = docs.select("text").mapInArrow(count, "kind int, votes int, features int, n long")
    return counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Model:
    """Reliabilities over all candidates, then a classifier for each kind."""
    rows = patterns(docs).orderBy("kind", "votes", "features").collect()  # at most MAX_PATTERNS
    weights = {}
    for kind in sorted({row.kind for row in rows}):
        own = [row for row in rows if row.kind == kind]
        codes, bits, n = (np.array([row[name] for row in own]) for name in ("votes", "features", "n"))
        _, _, posterior, _ = reliabilities(split_votes(codes), n.astype(float))
        weights[kind] = tuple(fit(inputs(codes, bits), posterior, n.astype(float)).tolist())
    return Model(weights)


def spans_of(text: str, model: Model) -> list[tuple[Span, float]]:
    """Base spans and added ones with their scores, by start, kind and end."""
    base = base_spans(text)

    def scored(span: Span) -> tuple[Span, float]:
        return span, model.score(span.kind, votes(text, span), features(text, span))

    found = [scored(span) for span in base]
    more = sorted(map(scored, candidates(text, base)), key=lambda s: (-s[1], s[0].start - s[0].end, s[0].start, s[0].kind))
    added = Placed()
    for span, score in more:
        if score >= THRESHOLD and not any(added.met(span.start, span.end)):
            added.add(span)
            found.append((span, score))
    return sorted(found, key=lambda s: (s[0].start, s[0].kind, s[0].end))


def find_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id and the spans of each document in code points, with the classifier's scores."""
    ship(docs.sparkSession)
    model = train(docs) if model is None else model
    span = pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]
    )
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def of(batches):
        for part, texts in _texts(batches):
            found = [
                [
                    {"kind": KINDS[s.kind], "start": s.start, "end": s.end, "base": s.base, "score": score}
                    for s, score in spans_of(text, model)
                ]
                for text in texts
            ]
            yield pa.record_batch([part.column("doc_id"), pa.array(found, pa.list_(span))], schema=schema)

    kinds = "doc_id long, spans array<struct<kind: string, start: int, end: int, base: boolean, score: double>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, kinds)


def masked(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` with the kind in brackets for each span of their texts."""
    ship(docs.sparkSession)
    model = train(docs) if model is None else model

    def hidden(text: str) -> str:
        parts, done = [], 0
        for span, _ in spans_of(text, model):
            if span.start >= done:
                parts += [text[done : span.start], f"[{KINDS[span.kind]}]"]
            done = max(done, span.end)
        return "".join([*parts, text[done:]])

    def of(batches):
        for part in slices(batches):
            texts = [text if text is None else hidden(text) for text in part.column("text").to_pylist()]
            place = part.schema.get_field_index("text")
            yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return docs.mapInArrow(of, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: base counts and all spans of every document."""
    base = "filter(spans, s -> s.base)"

    def listed(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"

    counts = [f"cast(size(filter(spans, s -> s.base AND s.kind = '{kind}')) AS long) AS n_{kind}" for kind in KINDS]
    return find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet")).selectExpr(
        "doc_id", *counts, f"sha2({listed(base)}, 256) AS base_sha256", f"{listed('spans')} AS spans"
    )
