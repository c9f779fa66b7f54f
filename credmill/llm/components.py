"""Connected components of links, by alternating star contractions in Spark.

Each round hangs every vertex on the smallest vertex it can see: first the larger
neighbours of each vertex, then the smaller ones.  Stars grow together in a number of
rounds that is logarithmic in the longest path.  No vertex needs its whole
neighbourhood in one task: all that is taken of it is the minimum, which is aggregated
before the shuffle.  Each round is written to the shared folder, which cuts the
lineage and lets a lost executor repeat one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credmill.sources.scratch import shared_dir


def connected(links: DataFrame) -> DataFrame:
    """Vertex and smallest vertex reachable (``node``, ``component``), for all that have links.

    ``links`` has the long columns ``a`` and ``b``; order and repetition do not matter.
    """
    spark = links.sparkSession
    folder = shared_dir(spark, "components")

    def stored(edges: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        edges.write.parquet(path)
        return spark.read.parquet(path)

    # Directed from the larger to the smaller vertex.
    down = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    edges = stored(down.filter("v <> u").distinct(), "links")
    before, turn = None, 0
    while True:
        # Large star: all larger neighbours of a vertex hang on its smallest neighbour.
        both = edges.select("v", "u").unionAll(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        smallest = both.groupBy("v").agg(F.min("u").alias("m"))
        smallest = smallest.select(F.col("v").alias("x"), F.least("v", "m").alias("m"))
        large = edges.join(smallest, edges["u"] == smallest["x"]).select("v", F.col("m").alias("u")).distinct()
        # Small star: all smaller neighbours of a vertex hang on the smallest of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        hung = large.join(least, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = hung.unionAll(least.select("v", F.col("m").alias("u"))).distinct()
        edges = stored(small, f"round-{turn}")
        # Stable once every vertex hangs on one other, and those hang on none.
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum("u").alias("s"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == before or not now["n"]:
            break
        before, turn = now, turn + 1
    centres = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionAll(centres)
