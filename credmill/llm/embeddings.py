"""Near duplicates among embeddings by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned so that the directions of the largest
variance come first.  Of two vectors the leading products are summed first; what the
rest can still add is at most the product of the lengths of both remainders
(Cauchy-Schwarz), and a pair is dropped as soon as that cannot lift the cosine
to the threshold.  The few pairs left are computed in double precision from the vectors
as they were given.

Vectors that are close lie close on every axis.  So they are sorted into cells on the
first direction, as wide as two linked vectors can be apart, and cells are cut
into tiles by a hash; a tile meets the tiles of its own cell and of the next one only.
A cell of any size is any number of tiles, and a pair of tiles is one task's smallest
piece of work.  A vector stays a row of its own and goes once to each pair that its tile
is in.  The tiles of a larger table are larger, up to a limit, so that there are some pairs
for each task and a vector is not sent to more of them than that takes.

The rows of a pair come sorted: a task keeps the first tile and lets the second one pass,
and compares blocks of ``BLOCK_ROWS`` vectors.  For each pair of tiles the result is a
count of links for each vector and edges that span the components in its blocks, never
the links themselves.

Defined cases: NULL vectors, zero vectors and vectors with NULL or non-finite
components link with nothing, nor do vectors of different lengths with each other;
repeated rows are vectors of their own if their ids differ, and rows with one id
count as one vertex whose links add up; NULL ids keep their row with no component;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  makes pa.compute available
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from credmill.llm.arrow import give_back
from credmill.llm.components import connected
from credmill.llm.shipping import ship
from credmill.sources.scratch import shared_dir

THRESHOLD = 0.95
TILE_ROWS = 2048
TILE_GROWTH = 8  # so many times the rows, on larger tables
TILE_VALUES = 1 << 20  # components in a tile: long vectors make smaller ones
PAIRS = 4  # of tiles, for each task
BLOCK_ROWS = 1024  # of either tile, compared at once
BLOCK_VALUES = 1 << 20  # components gathered at once
STEPS = (16, 32)
SLACK = 1e-6  # for rounding in the bounds; the final cosine has none


def unit_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one and the places of those that can link, for equal lengths."""
    with np.errstate(over="ignore", invalid="ignore"):
        largest = np.abs(rows).max(axis=1, initial=0)
        good = np.isfinite(largest) & (largest > 0)
        rows = rows[good] / largest[good, None]
    return rows / np.sqrt((rows**2).sum(axis=1))[:, None], np.flatnonzero(good)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors and unit vectors of a batch that can link, for each length of vector."""
    ids, vectors = batch.column("vec_id").to_numpy(), batch.column("embedding")
    starts = vectors.offsets.to_numpy()[:-1]
    values = vectors.values.to_numpy(zero_copy_only=False)  # NULL is not a number
    lengths = pa.compute.fill_null(pa.compute.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == length)
        for low in range(0, len(at), max(1, BLOCK_VALUES // length)):
            some = at[low : low + max(1, BLOCK_VALUES // length)]
            rows = values[starts[some, None] + np.arange(length)]
            units, good = unit_rows(rows)
            yield length, ids[some[good]], rows[good], units


def directions(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vector the principal directions, the largest variance first.

    Sums of products are added up in Spark; the driver gets a matrix for each length.
    """
    schema = pa.schema([("length", pa.int32()), ("cell", pa.int32()), ("total", pa.float64())])

    def products(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, _, units in _by_length(batch):
                sums[length] = sums.get(length, 0) + units.T @ units
        for length, matrix in sums.items():
            cells = np.arange(length * length, dtype=np.int32)
            lengths = np.full(len(cells), length, np.int32)
            yield pa.record_batch([lengths, cells, matrix.reshape(-1)], schema=schema)

    added = vectors.mapInArrow(products, "length int, cell int, total double")
    rows = added.groupBy("length", "cell").agg(F.sum("total").alias("total")).collect()
    matrices: dict[int, np.ndarray] = {}
    for row in rows:
        matrices.setdefault(row.length, np.zeros(row.length**2))[row.cell] = row.total
    return {
        length: np.linalg.eigh(matrix.reshape(length, length))[1][:, ::-1].copy()
        for length, matrix in matrices.items()
    }


class Tile:
    """Vectors that are compared at once."""

    def __init__(self, ids: bytes, units: bytes, turn: np.ndarray):
        self.ids = np.frombuffer(ids, np.int64)
        self.units = np.frombuffer(units, np.float64).reshape(len(self.ids), -1)
        self.turned = self.units @ turn
        width = self.turned.shape[1]
        # Lengths of what is left after each step.
        self.suffix = {step: np.sqrt((self.turned[:, step:] ** 2).sum(axis=1)) for step in _steps(width)}
        self.links = np.zeros(len(self.ids), np.int64)


def _steps(width: int) -> list[int]:
    return [*(step for step in STEPS if step < width), width]


def linked_pairs(one: Tile, other: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked vectors in both tiles."""
    least = threshold - SLACK
    width = one.turned.shape[1]
    done, *steps = _steps(width)
    known = one.turned[:, :done] @ other.turned[:, :done].T
    a, b = np.nonzero(known >= least - np.outer(one.suffix[done], other.suffix[done]))
    partial = known[a, b]
    del known
    for step in steps:
        if not len(a):
            break
        keep = np.empty(len(a), bool)
        for part in _parts(len(a), step - done):
            x, y = a[part], b[part]
            partial[part] += np.einsum("ij,ij->i", one.turned[x, done:step], other.turned[y, done:step])
            keep[part] = partial[part] + one.suffix[step][x] * other.suffix[step][y] >= least
        a, b, partial, done = a[keep], b[keep], partial[keep], step
    keep = np.empty(len(a), bool)
    for part in _parts(len(a), width):
        keep[part] = np.einsum("ij,ij->i", one.units[a[part]], other.units[b[part]]) >= threshold
    return a[keep], b[keep]


def _parts(pairs: int, width: int) -> Iterator[slice]:
    """Places of as many pairs as are gathered at once, for ``width`` components of each."""
    size = max(1, BLOCK_VALUES // width)
    for low in range(0, pairs, size):
        yield slice(low, low + size)


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair, whether it is the first to reach its vertex in a local contraction.

    Labels sink along the pairs until they rest; a vertex then keeps one edge to its label.
    """
    labels = np.unique(np.concatenate([a, b]))
    x, y = np.searchsorted(labels, a), np.searchsorted(labels, b)
    lowest = np.arange(len(labels))
    while True:
        sunk = lowest.copy()
        np.minimum.at(sunk, x, lowest[y])
        np.minimum.at(sunk, y, lowest[x])
        sunk = sunk[sunk]
        if (sunk == lowest).all():
            return np.stack([labels, labels[lowest]])
        lowest = sunk


FOUND = pa.schema([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64())])


def _counts(tiles: Iterable[Tile]) -> Iterator[pa.RecordBatch]:
    for tile in tiles:
        some = np.flatnonzero(tile.links)
        if len(some):
            yield pa.record_batch([pa.array(["count"] * len(some)), tile.ids[some], tile.links[some]], schema=FOUND)


def _compared(one: Tile, other: Tile, threshold: float) -> Iterator[pa.RecordBatch]:
    """Spanning edges of the links between two blocks, which are counted in them."""
    a, b = linked_pairs(one, other, threshold)
    apart = one.ids[a] != other.ids[b]
    if one is other:
        apart &= a < b
    a, b = a[apart], b[apart]
    if len(a):
        one.links += np.bincount(a, minlength=len(one.ids))
        other.links += np.bincount(b, minlength=len(other.ids))
        nodes, lowest = spanning(one.ids[a], other.ids[b])
        far = nodes != lowest
        yield pa.record_batch([pa.array(["edge"] * int(far.sum())), nodes[far], lowest[far]], schema=FOUND)


def _blocks(batches: Iterable[pa.RecordBatch], turns: dict, kind: np.dtype) -> Iterator[tuple[tuple, bool, Tile]]:
    """The pair of tiles, whether it is its second tile, and up to ``BLOCK_ROWS`` vectors of it."""
    for batch in batches:
        keys = np.stack([batch.column(name).to_numpy() for name in ("length", "one", "other", "second")])
        ends = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, batch.num_rows)
        low = 0
        for end in ends.tolist():
            while low < end:
                high = min(end, low + BLOCK_ROWS)
                length, one, other, second = keys[:, low].tolist()
                vectors = b"".join(batch.column("vector").slice(low, high - low).to_pylist())
                units, _ = unit_rows(np.frombuffer(vectors, kind).reshape(high - low, length).astype(float))
                ids = batch.column("vec_id").slice(low, high - low).to_numpy()
                yield (length, one, other), bool(second), Tile(ids.tobytes(), units.tobytes(), turns[length])
                low = high


def links(
    batches: Iterable[pa.RecordBatch], turns: dict, threshold: float, kind: np.dtype
) -> Iterator[pa.RecordBatch]:
    """Counts of links and spanning edges of pairs of tiles, whose rows come one after the other."""
    pair, held = None, []
    for at, second, block in _blocks(batches, turns, kind):
        if at != pair:
            yield from _counts(held)
            pair, held = at, []
        if second:
            for one in held:
                yield from _compared(one, block, threshold)
            yield from _counts([block])
        else:
            held.append(block)
            if at[1] == at[2]:  # a tile with itself
                for one in held:
                    yield from _compared(one, block, threshold)
    yield from _counts(held)


def near_duplicates(vectors: DataFrame, *, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row for each vector: id, number of links, component and whether it is kept."""
    spark = vectors.sparkSession
    ship(spark)
    given = vectors.schema["embedding"].dataType
    # Numbers travel as they were given, four bytes of a float.
    kind = np.dtype("f4" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "f8")
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    folder = shared_dir(spark, "embedding-links")
    turns = directions(vectors.filter("vec_id IS NOT NULL"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK

    _write_points(vectors, turns, reach, kind, f"{folder}/points")
    placed = spark.read.parquet(f"{folder}/points")
    _write_links(dealt(placed, tile_rows), turns, threshold, kind, f"{folder}/links")
    found = spark.read.parquet(f"{folder}/links")

    counts = found.filter("kind = 'count'").groupBy(F.col("a").alias("vec_id")).agg(F.sum("b").alias("n_links"))
    parts = connected(found.filter("kind = 'edge'")).withColumnsRenamed({"node": "vec_id", "component": "component_id"})
    return (
        vectors.select("vec_id")
        .join(counts, "vec_id", "left")
        .join(parts, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )


def _write_points(vectors: DataFrame, turns: dict, reach: float, kind: np.dtype, path: str) -> None:
    """Vectors that can link, as bytes, and their cells."""
    points = pa.schema(
        [("length", pa.int32()), ("cell", pa.int32()), ("place", pa.int64()), ("vec_id", pa.int64()),
         ("vector", pa.binary())]
    )

    def place(batches):
        placed = 0  # tells rows of one id apart
        for batch in batches:
            for length, ids, rows, units in _by_length(batch):
                cells = np.floor(units @ turns[length][:, 0] / reach).astype(np.int32)
                places = np.arange(placed, placed + len(ids))
                placed += len(ids)
                made = [np.full(len(ids), length, np.int32), cells, places, ids, [row.tobytes() for row in rows.astype(kind)]]
                yield pa.record_batch([pa.array(r, f.type) for r, f in zip(made, points)], schema=points)
        give_back()

    kinds = "length int, cell int, place long, vec_id long, vector binary"
    vectors.filter("vec_id IS NOT NULL").mapInArrow(place, kinds).write.parquet(path)


def dealt(placed: DataFrame, tile_rows: int) -> DataFrame:
    """One row for each vector and pair of tiles (``one``, ``other``) that its tile is in.

    ``second`` is 1 if the vector's tile is the other one.
    """
    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = Window.partitionBy("length").orderBy("cell")
    # A length has no more cells than fit between -1 and 1, so the sizes are few.
    sizes = placed.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    after = F.coalesce(F.sum("n").over(cells.rangeBetween(1, 1)), F.lit(0))
    meetings = sizes.select((F.col("n") * (F.col("n") / 2 + after)).alias("pairs")).agg(F.sum("pairs").alias("pairs"))
    fitting = int(np.sqrt((meetings.first()["pairs"] or 0) / (PAIRS * tasks)))
    rows = min(max(tile_rows, fitting), TILE_GROWTH * tile_rows)

    limit = F.greatest(F.lit(1), F.least(F.lit(rows), F.floor(TILE_VALUES / F.col("length"))))
    sizes = sizes.select("length", "cell", F.ceil(F.col("n") / limit).cast("int").alias("tiles"))
    # Tiles are numbered along the cells, so those of the cells around have the numbers around.
    sizes = sizes.select(
        "length", "cell", "tiles",
        F.coalesce(F.sum("tiles").over(cells.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"),
        F.coalesce(F.sum("tiles").over(cells.rangeBetween(-1, -1)), F.lit(0)).alias("before"),
        F.coalesce(F.sum("tiles").over(cells.rangeBetween(1, 1)), F.lit(0)).alias("after"),
    )
    return (
        placed.join(F.broadcast(sizes), ["length", "cell"])
        .withColumn("tile", F.col("first") + F.pmod(F.xxhash64("vec_id", "place"), F.col("tiles")))
        .withColumn("met", F.explode(F.expr("sequence(first - before, first + tiles + after - 1)")))
        .select(
            "length", F.least("tile", "met").alias("one"), F.greatest("tile", "met").alias("other"),
            (F.col("met") < F.col("tile")).cast("long").alias("second"), "vec_id", "vector",
        )
    )


def _write_links(work: DataFrame, turns: dict, threshold: float, kind: np.dtype, path: str) -> None:
    """Counts of links and spanning edges of all pairs of tiles that may have links."""

    def compare(batches):
        yield from links(batches, turns, threshold, kind)
        give_back()

    width = work.sparkSession.conf.get("spark.sql.shuffle.partitions")
    work = work.repartition(int(width), "length", "one", "other")
    work = work.sortWithinPartitions("length", "one", "other", "second")
    work.mapInArrow(compare, "kind string, a long, b long").write.parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: links and components of all embeddings."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE list_count(embedding) = len(embedding) AND len(embedding) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE isfinite(list_cosine_similarity(a.v, b.v)) AND list_cosine_similarity(a.v, b.v) >= 0.95
), both_ways AS (
  SELECT a AS here, b AS there FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT here, there FROM both_ways
  UNION SELECT r.here, l.there FROM reach r JOIN both_ways l ON r.there = l.here
), lowest AS (
  SELECT here AS vec_id, min(there) AS low FROM reach GROUP BY here
), counts AS (
  SELECT here AS vec_id, count(*) AS n FROM both_ways GROUP BY here
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN lowest USING (vec_id)
"""
