"""Row fingerprints and the removal of ambiguous rows.

A fingerprint that occurs more than once is ambiguous: no copy of it is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credmill import schemas
from credmill.operators import membership
from credmill.schemas import KEY

# Keys with at least so many copies are dropped beside the filter of duplicate keys.  There is one
# for each word of the filter at most, 64 characters each, so some 60 MB whatever the number of keys.
HOT_COPIES = 250_000


def key_columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.KEY_COLUMNS)


def fingerprint() -> str:
    """SHA-256 of the key columns, NULLs skipped.

    It is never NULL.  Saying so with ``coalesce`` spares joins on the key a
    null test, which would compute every digest twice.
    """
    parts = ", ".join(f"cast({name} AS string)" for name in schemas.KEY_COLUMNS)
    return f"coalesce(sha2(concat_ws('{schemas.KEY_SEPARATOR}', {parts}), 256), '')"


def with_member_key(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"{fingerprint()} AS {KEY}")


def key_counts(keyed: DataFrame) -> DataFrame:
    """Rows per key.  Partial counts collapse a hot key before the shuffle."""
    return keyed.groupBy(KEY).agg(F.expr("count(1) AS member_count"))


def duplicate_keys(keyed: DataFrame) -> DataFrame:
    return key_counts(keyed).where("member_count > 1")


def duplicate_keys_sorted(keyed: DataFrame) -> DataFrame:
    return duplicate_keys(keyed).orderBy(F.desc("member_count"), KEY)


def member_lookup(keyed: DataFrame, key: str | Column) -> DataFrame:
    """All rows and columns of one key, given as text or as a scalar column."""
    return keyed.where(F.col(KEY) == (F.lit(key) if isinstance(key, str) else key))


def most_copied_key(keyed: DataFrame) -> DataFrame:
    """One row with the key that has most copies; the smallest key among ties."""
    return key_counts(keyed).selectExpr(
        f"min_by({KEY}, struct(-member_count, {KEY})) AS {KEY}"
    )


def _copied(per_key: DataFrame) -> DataFrame:
    """Keys with several rows, from all columns of ``per_key``.

    Where one use of an aggregate leaves out columns that another one needs, Spark shuffles for
    each of them.  The same number on both sides of the comparison names the columns.
    """
    others = [f"`{name}`" for name in per_key.columns if name not in (KEY, "member_count")]
    if not others:
        return per_key.where("member_count > 1")
    same = f"cast(hash({', '.join(others)}) AS bigint)"
    return per_key.where(f"member_count + {same} > 1 + {same}")


def exclude_duplicates(
    keyed: DataFrame,
    hot_copies: int = HOT_COPIES,
    *,
    partitions: int | None = None,
    per_key: DataFrame | None = None,
    words: int = membership.WORDS,
    derived: str | None = None,
) -> DataFrame:
    """Drop every row whose key occurs more than once.

    A bounded Bloom filter of the duplicate keys is broadcast.  Rows that miss it are unique
    and pass on in place: no shuffle, no sort.  The others, duplicates and few more, take an
    anti join without a hint, so Spark broadcasts the duplicate keys only when their estimated
    size allows it.  This reads the wide rows twice and shuffles hardly any of them.

    Each word of the filter also names its hottest key, if that has ``hot_copies``.  Rows of
    that key are dropped beside the filter, before any shuffle.

    With ``partitions`` the wide rows have to be laid out in so many partitions by key in any case.
    Then all but the hot ones take the join, which uses that layout.  The duplicate keys are laid out
    in the same way, and the join is an outer one: Spark would push an anti join below the layout of
    the wide rows and shuffle them for it, too.  ``derived`` is the key as SQL over the other columns;
    rows then take the shuffle without their key, which is worked out again behind it.

    ``per_key`` is ``rows_per_key`` of the same keys, for callers that need its numbers too;
    filter and join then share its shuffle.  It may lack the keys of a single row.
    """
    copied = _copied(key_counts(keyed) if per_key is None else per_key)
    hottest = f"max_by({KEY}, member_count) FILTER (WHERE member_count >= {int(hot_copies)})"
    table = membership.condensed(copied, KEY, words, also={"_hottest": hottest})
    marked = membership.marked(keyed, table, KEY, "_suspect", words)
    not_hot = f"_hottest IS NULL OR _hottest != {KEY}"
    if partitions:
        rows = marked.where(not_hot).drop("_suspect", "_hottest")
        if derived:
            spread = rows.drop(KEY).repartition(partitions, F.expr(derived))
            rows = spread.withColumn(KEY, F.expr(derived)).select(*keyed.columns)
        else:
            rows = rows.repartition(partitions, KEY)
        found = copied.repartition(partitions, KEY).select(KEY, F.lit(True).alias("_copied"))
        return rows.join(found, KEY, "left").where("_copied IS NULL").drop("_copied")
    clear = marked.where("NOT _suspect").drop("_suspect", "_hottest")
    suspects = marked.where("_suspect").where(not_hot).drop("_suspect", "_hottest")
    return clear.unionByName(suspects.join(copied, KEY, "left_anti"))


def rows_per_key(keyed: DataFrame) -> DataFrame:
    """One row per key with ``member_count`` and the maximum of every column.

    For a key with one row the maximum is the row itself.  This costs one scan
    and one shuffle and a hot key shrinks to one row per task, which makes it
    the way to de-duplicate numbers and dates.  Text would make Spark sort the
    rows, so wide rows are better off with ``exclude_duplicates``.
    """
    values = [F.expr(f"max(`{name}`) AS `{name}`") for name in keyed.columns if name != KEY]
    return keyed.groupBy(KEY).agg(F.expr("count(1) AS member_count"), *values)


def unique_values(keyed: DataFrame) -> DataFrame:
    """The rows ``exclude_duplicates`` keeps, for columns of numbers and dates."""
    return rows_per_key(keyed).where("member_count = 1").drop("member_count")
