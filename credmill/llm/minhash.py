"""Near duplicates by bottom-k sketches from one hash function.

A document is the set of its word shingles.  Its sketch is the k smallest hashes of
the set.  Documents with equal sets form a class, which goes on as one.

The k smallest hashes of the union of two sets are a random sample of it, so with a
Jaccard similarity of 0.8 about 0.8 k of them are in both sketches; that fewer than
``COMMON`` = 8 of 24 are has a chance below one in a million, which is the only way to
miss a link.  Sets that fit into their sketch are compared with certainty.  Hence the
inverted lists need not hold whole sketches: with the retained values of each sketch in
order of how many sketches have them, two sketches with c values in common share one
of the first s - c + 1 of their s values.  Only those are listed, and values that half
the corpus has are listed nowhere unless they are all that a sketch has.

Links are found in two steps, neither of which lists all pairs of a group:

1. Each class is compared with the smallest id of the lists it is on (the one met most
   often).  That settles groups of thousands of near copies in as many comparisons.
2. In each list the classes are found that may be linked to one of another component, by
   a 256-bit image of their sketches.  Only their full sets are brought together; there the
   pairs are estimated from the union of their sketches, and those that may reach
   the threshold are compared.  Lists are cut by the sizes of sets and then into blocks of bounded
   size; parts of one component are left out; of each block only links that join something
   new leave it.

All comparisons that make a link are exact, on the full sets of 64-bit shingle hashes.
Pairs inside a component need no comparison, so no link between components is lost.

Defined cases: a text without words or a NULL text has an empty set, links with nothing
and is its own component; a text with fewer words than a shingle has one shingle of all its
words; rows with one document id count as one document; rows with a NULL id are
returned with a NULL component and are kept; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from credmill.llm import words
from credmill.llm.arrow import raw_texts, slices
from credmill.llm.bloom import possible
from credmill.llm.components import connected
from credmill.llm.shipping import ship
from credmill.sources.scratch import shared_dir

SHINGLE_WORDS = 5
PERCENT = 80
SKETCH = 24
COMMON = 8
# Classes of a block at most, and shingles of their sets together, 8 bytes each.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending as signed integers."""
    of = words.split(texts, lower=True)
    hashes = of.hashes()
    runs = words.window_hashes(hashes, width).view(np.int64)
    sets = []
    for first, last in zip(of.doc_words[:-1].tolist(), of.doc_words[1:].tolist()):
        if last - first >= width:
            own = runs[first : last - width + 1]
        elif last > first:
            own = words.window_hashes(hashes[first:last], last - first).view(np.int64)
        else:
            own = runs[:0]
        sets.append(np.unique(own))
    return sets


def needed_common(n: int, sketch: int, common: int, percent: int) -> int:
    """Values that the sketch of a set of ``n`` has in common with that of any linked set."""
    if 100 * n <= percent * sketch:  # then a linked set fits into its sketch, too
        return -(-percent * n // 100)
    return min(common, n)


def union_common(one: frozenset, other: frozenset, both: frozenset, sketch: int) -> int:
    """How many of the smallest values of the union of two sketches are in both."""
    union = sorted(one | other)
    return len(both) if len(union) <= sketch else sum(value <= union[sketch - 1] for value in both)


def _bits(values: np.ndarray) -> bytes:
    """A bit for each value, by its last eight bits."""
    marked = np.zeros(256, bool)
    marked[values & 255] = True
    return np.packbits(marked).tobytes()


def _sketches(docs: DataFrame, width: int, sketch: int) -> DataFrame:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
            ("set_key", pa.binary()), ("sketch", pa.list_(pa.int64())), ("bits", pa.binary()),
        ]
    )

    def of(batches):
        for part in slices(batches):
            sets = shingle_sets(raw_texts(part.column("text")), width)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            short = [s[:sketch] for s in sets]
            columns = [[len(s) for s in sets], keys, short, [_bits(s) for s in short]]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]
            yield pa.record_batch([part.column("doc_id"), *arrays], schema=schema)

    kinds = "doc_id long, n_shingles long, set_key binary, sketch array<long>, bits binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, kinds)


def _full_sets(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """Whole sets of the chosen documents (column ``rep``), with their other columns."""
    extra = [field for field in chosen.schema if field.name != "rep"]
    schema = pa.schema(
        [("rep", pa.int64()), *((f.name, pa.int64()) for f in extra), ("shingles", pa.list_(pa.int64()))]
    )

    def of(batches):
        for part in slices(batches):
            sets = shingle_sets(raw_texts(part.column("text")), width)
            kept = [part.column(name) for name in schema.names[:-1]]
            yield pa.record_batch([*kept, pa.array(sets, schema[-1].type)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    # Most documents are not asked for; a Bloom filter spares them the shuffle.
    texts = possible(texts, chosen.select("rep").distinct(), "rep")
    joined = texts.join(chosen, "rep").select("rep", *(f.name for f in extra), "text")
    kinds = ", ".join(f"{name} long" for name in schema.names[:-1]) + ", shingles array<long>"
    return joined.mapInArrow(of, kinds)


def _similar(percent: int):
    """Exact test of the arrays ``one`` and ``other``."""
    common = F.size(F.array_intersect("one", "other"))
    union = F.size("one") + F.size("other") - common
    return 100 * common >= percent * union


def _listed(classes: DataFrame, sketch: int, common: int, percent: int) -> DataFrame:
    """Inverted lists: value, class, and size and smallest class of the list."""
    values = classes.select("rep", "n", F.explode("sketch").alias("value"))
    lists = (
        values.groupBy("value")
        .agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("hub"))
        .filter("size > 1")
    )
    fits = F.col("n") * 100 <= percent * sketch
    needed = F.when(fits, F.ceil(F.col("n") * percent / 100)).otherwise(F.least(F.lit(common), "n"))
    retained = F.least("n", F.lit(sketch))
    # Values on no other sketch come first in the order, but nobody is met there.
    return (
        values.join(lists, "value")
        .groupBy("rep", "n")
        .agg(F.array_sort(F.collect_list(F.struct("size", "value", "hub"))).alias("met"))
        .withColumn("room", (retained - needed + 1 - (retained - F.size("met"))).cast("int"))
        .filter("room > 0")
        .select("rep", "n", F.explode(F.slice("met", F.lit(1), F.col("room"))).alias("m"))
        .select("rep", "n", "m.value", "m.size", "m.hub")
    )


BLOCK_KEY = ("value", "grp", "low", "high")


def _band_ratio(percent: int) -> float:
    """A little more than the largest ratio of two linked sizes, so that rounding sets nobody apart."""
    return 100 / percent * (1 + 1e-6)


def _grouped(known: DataFrame, percent: int) -> DataFrame:
    """The rows of lists by groups of sizes in which classes of two components meet.

    Sets of one band of sizes, or of two neighbouring ones, may be linked; others differ too much.  So a
    group holds the classes of a list in one band, and those of the band below (``lower``), which are
    compared with the others only.  Columns: those of ``known``, ``grp``, ``lower`` and ``size``.
    """
    banded = known.withColumn("band", F.floor(F.log("n") / float(np.log(_band_ratio(percent)))))
    per_band = banded.groupBy("value", "band").agg(
        F.count(F.lit(1)).alias("c"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    bands = Window.partitionBy("value").orderBy("band")
    own = F.struct("band", "c", "x", "y")

    def meeting(other: str, step: int) -> tuple[Column, Column]:
        """Size of the group with a neighbouring band, NULL where only one component is in it, and
        whether there is such a band."""
        there = F.col(f"{other}.band") == F.col("band") + step
        low = F.when(there, F.least("x", f"{other}.x")).otherwise(F.col("x"))
        high = F.when(there, F.greatest("y", f"{other}.y")).otherwise(F.col("y"))
        return F.when(low < high, F.col("c") + F.when(there, F.col(f"{other}.c")).otherwise(0)), there

    size_own, _ = meeting("below", -1)
    size_up, there = meeting("above", 1)
    groups = F.array(
        F.struct(F.col("band").alias("grp"), F.lit(False).alias("lower"), size_own.alias("size")),
        F.struct((F.col("band") + 1).alias("grp"), F.lit(True).alias("lower"), F.when(there, size_up).alias("size")),
    )
    met = (
        per_band.withColumns({"below": F.lag(own).over(bands), "above": F.lead(own).over(bands)})
        .select("value", "band", F.filter(groups, lambda g: g["size"].isNotNull()).alias("groups"))
        .filter(F.size("groups") > 0)
    )
    placed = banded.drop("size").join(met, ["value", "band"]).withColumn("g", F.explode("groups"))
    return placed.select("*", "g.grp", "g.lower", "g.size").drop("band", "groups", "g")


def _meeting(listed: DataFrame, sketch: int, common: int, percent: int, block: int) -> DataFrame:
    """Who has to be compared where: blocks of lists, and the classes that may be linked to
    one of another component there.

    ``listed`` has value, group of the list and its size, class, number of shingles, component, bits
    and ``on``, all lists that the class is on, the largest first.
    Two sketches have no more values in common than bits, but for values that share a
    bit, which are counted in.
    """
    # A set of the group has fewer shingles than the upper end of its band; few long ones fill a block.
    fitting = F.floor(BLOCK_SHINGLES / F.pow(F.lit(_band_ratio(percent)), F.col("grp") + 1))
    classes = F.least(F.lit(block), F.greatest(F.lit(16), fitting))
    blocks = F.ceil(F.col("size") / classes).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    placed = listed.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    grouped = placed.groupBy(
        "value", "grp", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high")
    ).agg(F.collect_list(F.struct("rep", "n", "component", "own", "lower", "bits", "on")).alias("members"))
    schema = pa.schema([(name, pa.int64()) for name in (*BLOCK_KEY, "rep", "own", "lower")])

    def compare(batches):
        for batch in batches:
            found = []
            keys = zip(*(batch.column(name).to_pylist() for name in BLOCK_KEY))
            lists = batch.column("members")
            for at, key in enumerate(keys):
                meeting = _may_link(lists[at].as_py(), key, sketch, common, percent)
                found += [(*key, m["rep"], m["own"], int(m["lower"])) for m in meeting]
            if found:
                yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*found)], schema=schema)

    return grouped.mapInArrow(compare, ", ".join(f"{name} long" for name in schema.names))


def _may_link(members: list[dict], key: tuple, sketch: int, common: int, percent: int) -> list[dict]:
    value, apart = key[0], key[2] != key[3]
    members.sort(key=lambda m: m["n"])
    for m in members:
        m["lists"] = frozenset(m["on"])
        m["mask"] = int.from_bytes(m["bits"])
        m["hidden"] = min(m["n"], sketch) - m["mask"].bit_count()
        m["needed"] = needed_common(m["n"], sketch, common, percent)
    meeting = set()
    for at, one in enumerate(members):
        for place in range(at + 1, len(members)):
            other = members[place]
            if 100 * one["n"] < percent * other["n"]:
                break  # all further sets are larger still
            if one["component"] == other["component"] or (apart and one["own"] == other["own"]):
                continue
            if one["lower"] and other["lower"]:
                continue  # they meet in the group of their own band
            least = max(one["needed"], other["needed"]) - min(one["hidden"], other["hidden"])
            if (one["mask"] & other["mask"]).bit_count() < least:
                continue
            # Two classes meet in the largest list that both are on, and nowhere else.
            if next(v for v in one["on"] if v in other["lists"]) == value:
                meeting |= {at, place}
    return [members[at] for at in sorted(meeting)]


def _block_pairs(members: list[dict], key: tuple, sketch: int, common: int, percent: int):
    value, apart = key[0], key[2] != key[3]
    members.sort(key=lambda m: m["n"])
    for m in members:
        m["values"] = frozenset(m["sketch"])
        m["lists"] = frozenset(m["on"])
        m["needed"] = needed_common(m["n"], sketch, common, percent)
    for at, one in enumerate(members):
        for other in members[at + 1 :]:
            if 100 * one["n"] < percent * other["n"]:
                break  # all further sets are larger still
            if one["component"] == other["component"] or (apart and one["own"] == other["own"]):
                continue
            if one["lower"] and other["lower"]:
                continue  # they meet in the group of their own band
            both = one["values"] & other["values"]
            needed = max(one["needed"], other["needed"])
            if len(both) < needed:
                continue
            if next(v for v in one["on"] if v in other["lists"]) != value:
                continue
            if union_common(one["values"], other["values"], both, sketch) >= needed:
                yield one["rep"], other["rep"]


def _verified(meeting: DataFrame, known: DataFrame, sets: DataFrame, sketch: int, common: int, percent: int) -> DataFrame:
    """The pairs that are linked by their full sets, less those that others imply.

    ``known`` has size, component, sketch and lists of each class.  Sets travel once to each
    block that asks for them, and a block gives at most as many links as it has classes.
    """
    fields = ("rep", "n", "component", "own", "lower", "sketch", "on")
    gathered = (
        meeting.join(known, "rep")
        .join(sets, "rep")
        .groupBy(*BLOCK_KEY)
        .agg(F.collect_list(F.struct(*fields, "shingles")).alias("members"))
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches):
        for batch in batches:
            keys = zip(*(batch.column(name).to_pylist() for name in BLOCK_KEY))
            lists = batch.column("members")
            for at, key in enumerate(keys):
                held = lists[at].values
                columns = [held.field(name).to_pylist() for name in fields]
                members = [dict(zip(fields, values)) for values in zip(*columns)]
                raw = held.field("shingles")
                full = {m["rep"]: raw[i].values.to_numpy() for i, m in enumerate(members)}
                found = _linked(_block_pairs(members, key, sketch, common, percent), full, percent)
                if found:
                    yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*found)], schema=schema)

    return gathered.mapInArrow(verify, "a long, b long")


def _linked(pairs: Iterable[tuple[int, int]], sets: dict[int, np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of one block; a pair that earlier ones have joined is not compared again."""
    joined: dict[int, int] = {}

    def root(rep: int) -> int:
        while (above := joined.get(rep, rep)) != rep:
            rep = above
        return rep

    found = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x == y:
            continue
        one, other = sets[a], sets[b]
        common = len(np.intersect1d(one, other, assume_unique=True))
        if 100 * common >= percent * (len(one) + len(other) - common):
            joined[max(x, y)] = min(x, y)
            found.append((a, b))
    return found


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    sketch: int = SKETCH,
    common: int = COMMON,
    block: int = BLOCK,
) -> DataFrame:
    """One row for each row of ``docs``: id, set size, component and whether it is kept."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_dir(spark, "near-duplicates")

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = stored(_sketches(docs, shingle_words, sketch), "sketches")
    classes = stored(
        rows.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("bits").alias("bits")),
        "classes",
    )
    listed = stored(_listed(classes, sketch, common, percent), "lists")

    # Step 1: each class and the hub that it meets most often.
    hubs = (
        listed.filter("hub <> rep")
        .groupBy("rep", "hub")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("rep")
        .agg(F.max_by("hub", F.struct("times", -F.col("hub"))).alias("hub"))
    )
    short = classes.select("rep", "n", "sketch")
    near = (
        hubs.join(short, "rep")
        .join(short.select(*(F.col(c).alias("hub" if c == "rep" else f"hub_{c}") for c in short.columns)), "hub")
        .filter(F.size(F.array_intersect("sketch", "hub_sketch")) >= F.least(F.lit(common), "n", "hub_n"))
        .filter(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    )
    hubs = stored(near.select("rep", "hub"), "hubs")
    asked = hubs.unionAll(hubs.select(F.col("hub").alias("rep"), F.col("hub")).distinct())
    sets = stored(_full_sets(docs, asked, shingle_words), "sets")
    first = stored(
        sets.filter("rep <> hub")
        .withColumnRenamed("shingles", "one")
        .join(sets.filter("rep = hub").select("hub", F.col("shingles").alias("other")), "hub")
        .filter(_similar(percent))
        .select(F.col("rep").alias("a"), F.col("hub").alias("b")),
        "first-links",
    )

    # Step 2: what may be linked across the components so far.
    so_far = connected(first).select(F.col("node").alias("rep"), "component")
    known = listed.join(so_far, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    on = listed.groupBy("rep").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("size", "value")), asc=False), lambda m: m["value"]
        ).alias("on")
    )
    about = classes.select("rep", "bits").join(on, "rep")
    members = _grouped(known, percent).join(about, "rep")
    meeting = stored(_meeting(members, sketch, common, percent, block), "meeting")
    asked = meeting.select("rep").distinct()
    about = (
        short.join(on, "rep")
        .join(so_far, "rep", "left")
        .select("rep", "n", "sketch", "on", F.coalesce("component", "rep").alias("component"))
    )
    sets = _full_sets(docs, asked, shingle_words)
    second = stored(_verified(meeting, about.join(asked, "rep"), sets, sketch, common, percent), "second-links")
    parts = connected(first.unionAll(second)).select(F.col("node").alias("rep"), "component")
    of_class = (
        classes.select("set_key", "rep")
        .join(parts, "rep", "left")
        .select("set_key", F.coalesce("component", "rep").alias("component"))
    )
    named = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        rows.select("doc_id", "n_shingles", "set_key")
        .join(of_class, "set_key", "left")
        .select("doc_id", "n_shingles", named.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns.

    Rows of one id with different texts are documents of their own here.  Of a component the row with
    the smallest id stays; of such rows the one whose text has the smallest SHA-256 (a NULL text comes
    last), and of rows with equal texts the one whose JSON has the smallest hash.  Rows without an
    id all stay.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "first-rows")
    named = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"),
        F.col("text").isNull().alias("none"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("digest"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    )
    which = ["id", "none", "digest"]
    # Further texts of an id get numbers below all ids; they are stored, so a number never changes.
    texts = F.struct("none", "digest")
    several = named.groupBy("id").agg(F.min(texts).alias("first"), F.max(texts).alias("last")).filter("first <> last")
    least = named.agg(F.min("id").alias("least")).scalar()
    further = (
        named.select(*which).join(several.select("id", "first"), "id").filter(texts != F.col("first")).select(*which).distinct()
    )
    further.withColumn("number", least - 1 - F.monotonically_increasing_id()).write.parquet(f"{folder}/further")
    further = spark.read.parquet(f"{folder}/further")
    numbered = named.join(further, which, "left").withColumn("number", F.coalesce("number", "id"))
    found = near_duplicates(numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), **options)
    component = found.select(F.col("doc_id").alias("number"), "component_id").distinct()
    # Only numbers and digests meet their component; texts are shuffled once, for the rows that stay.
    winners = (
        numbered.select("number", *which)
        .join(component, "number")
        .groupBy("component_id")
        .agg(F.min(F.struct(*which)).alias("winner"))
        .select("winner.*")
    )
    kept = named.join(winners, which, "left_semi").groupBy(*which).agg(
        F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")
    )
    return kept.select("row.*").unionByName(docs.filter("doc_id IS NULL"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: components of all documents by their 2-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle_words=2)


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, words[pos] || ' ' || words[pos + 1] AS shingle
  FROM texts, unnest(range(1, len(words))) AS places(pos)
  UNION ALL
  SELECT doc_id, words[1] FROM texts WHERE len(words) = 1
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
), reach AS (
  SELECT a AS here, b AS there FROM links
  UNION SELECT b, a FROM links
  UNION SELECT r.here, l.there
  FROM reach r JOIN (SELECT a AS here, b AS there FROM links UNION ALL SELECT b, a FROM links) l
    ON r.there = l.here
), lowest AS (
  SELECT here AS doc_id, min(there) AS low FROM reach GROUP BY here
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id <= coalesce(low, doc_id) AS kept
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""
