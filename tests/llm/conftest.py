from __future__ import annotations

import random

import pytest
from texts import prose

TOKENS = pytest.importorskip("public_tokenizers")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (id, text) pairs."""

    def build(*rows):
        data = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(data, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(11)
    passage = prose(rng, 60)
    base = prose(rng, 120)
    edited = base.replace("w1", "x1", 1)
    return [
        (1, base), (2, base), (3, edited), (4, None), (5, ""), (6, "   \n\t "), (7, "word"),
        (8, prose(rng, 30) + " " + passage + " " + prose(rng, 30)),
        (9, passage), (10, prose(rng, 40_000, 5000)), (2, base), (None, base), (None, None),
        (11, "été Ünïcode ñandú  two  spaces\nnew\n\nlines <|endoftext|> 'tis don't ² ª"),
        (12, prose(rng, 10) + " " + passage), (13, "\x00" * 120), (14, "\x00" * 120 + "a"),
    ]


@pytest.fixture(scope="session")
def odd(documents, odd_rows):
    """The odd rows with further columns whose names clash with those used inside."""
    from pyspark.sql import functions as F

    frame = documents(*odd_rows)
    for name in ("rep", "packed", "known", "places", "version", "row", "value", "bucket", "part"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame
