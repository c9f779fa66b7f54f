"""A blocked Bloom filter as a small table: 256-bit blocks in four 64-bit words.

One hash of a key chooses its block, another sets one bit in each word.  There are never
more than ``MAX_BLOCKS`` blocks, about 12 MB, so the table may be broadcast however many keys
it stands for; with very many keys it just lets more rows pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 18
KEYS_PER_BLOCK = 8
WORDS = ("w0", "w1", "w2", "w3")


def blocks_for(n_keys: int) -> int:
    return min(MAX_BLOCKS, 1 << max(0, (n_keys // KEYS_PER_BLOCK).bit_length()))


def block_of(key: str, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def _bit(key: str, word: int) -> Column:
    """The bit that a key has in a word of its block."""
    place = F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def condensed(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """One row for each block that is not empty."""
    words = [F.bit_or(_bit(key, i)).alias(word) for i, word in enumerate(WORDS)]
    return keys.groupBy(block_of(key, n_blocks).alias("block")).agg(*words)


def all_set(key: str) -> Column:
    """Whether all bits of the key are set in the words beside it."""
    bits = [F.col(word).bitwiseAND(_bit(key, i)) != 0 for i, word in enumerate(WORDS)]
    return F.coalesce(reduce(lambda a, b: a & b, bits), F.lit(False))


def possible(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be among ``keys``: all that are, and few others."""
    n_blocks = blocks_for(keys.count())
    table = F.broadcast(condensed(keys, key, n_blocks))
    found = rows.withColumn("block", block_of(key, n_blocks)).join(table, "block")
    return found.filter(all_set(key)).select(*rows.columns)
