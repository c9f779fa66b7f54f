"""A bounded Bloom filter as a table of 64-bit words, for keys of any number.

One hash of a key chooses a word, another sets ``BITS`` bits in it.  There are never more than
``WORDS`` words, 16 bytes each or some 8 MB in all, so the table may be broadcast however many
keys it stands for.  A key that was put in is always found.  Of others it lets through one in
100,000 with a tenth as many keys as words, one in 2,000 with twice as many, one in 40 with eight
times as many; with far more keys all pass, which is no error.  Everything is a native expression.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 19
BITS = 5


def word_of(key: str, words: int = WORDS) -> str:
    """The word of a key; ``words`` is a power of two.

    It is never NULL, and Spark sees that: a null test would be pushed below the aggregate that
    counts the keys, which then could not share its shuffle.
    """
    return f"(xxhash64({key}) & {words - 1}L)"


def bits_of(key: str) -> str:
    """The bits of a key; six bits of its hash name each of them."""
    places = (f"cast(shiftrightunsigned(xxhash64({key}, 'bits'), {6 * n}) & 63 AS int)" for n in range(BITS))
    return " | ".join(f"shiftleft(1L, {place})" for place in places)


def condensed(keys: DataFrame, key: str, words: int = WORDS, *, also: Mapping[str, str] = {}) -> DataFrame:
    """The words that are not empty, counted together in partial aggregates.

    ``also`` names further aggregates of the keys of a word.
    """
    return keys.groupBy(F.expr(word_of(key, words)).alias("_word")).agg(
        F.expr(f"bit_or({bits_of(key)}) AS _bits"),
        *(F.expr(f"{sql} AS `{name}`") for name, sql in also.items()),
    )


def marked(rows: DataFrame, table: DataFrame, key: str, name: str, words: int = WORDS) -> DataFrame:
    """``rows`` beside their words, with a column that is false only where the key is surely not in."""
    found = rows.join(F.broadcast(table), F.expr(word_of(key, words)) == table["_word"], "left")
    return found.withColumn(
        name, F.expr(f"coalesce((_bits & ({bits_of(key)})) = ({bits_of(key)}), false)")
    ).drop("_word", "_bits")
