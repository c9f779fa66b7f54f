"""Tables that are replaced version by version."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from credmill import schemas
from credmill.sources import readers, versions, writers


def ids(spark, name):
    return sorted(row.id for row in readers.read_table(spark, name).collect())


def failing(spark):
    """Rows that fail in the last of four tasks, when the others have written theirs."""
    slow = "if(id < 90, id, raise_error(concat('broken ', id)))"
    return spark.range(0, 100, 1, 4).selectExpr(f"cast({slow} AS bigint) AS id")


def folders(path):
    return sorted(p.name for p in Path(path).iterdir())


@pytest.mark.parametrize("layout", ["plain", "buckets", "partitions"])
def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path, layout):
    name, path = f"kept_{layout}", str(tmp_path / layout)

    def write(df):
        if layout == "partitions":
            writers.write_partitioned(df.withColumn("third", F.expr("id % 3")), name, path, "third")
        else:
            writers.write_table(df, name, path, buckets=3 if layout == "buckets" else None, key="id")

    write(spark.range(5))
    before = folders(path)
    with pytest.raises(Exception, match="broken"):
        write(failing(spark))
    assert ids(spark, name) == [0, 1, 2, 3, 4]
    assert folders(path) == before
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    write(spark.range(7))
    assert ids(spark, name) == list(range(7))
    if layout == "partitions":
        assert spark.table(name).where("third = 1").count() == 2
    if layout == "buckets":
        assert "Num Buckets" in versions._described(spark, name)


def test_a_job_that_dies_before_the_switch(spark, tmp_path):
    """Nobody cleans up behind it; the table shows the old rows and the next write the new ones."""
    name, path = "killed", str(tmp_path / "t")
    writers.write_table(spark.range(5), name, path)
    spark.range(50).write.parquet(versions.new_version(path))
    assert ids(spark, name) == [0, 1, 2, 3, 4]
    for n in (2, 3):
        writers.write_table(spark.range(n), name, path)
        assert ids(spark, name) == list(range(n))
    assert len(folders(path)) == 2


def test_old_versions_are_dropped(spark, tmp_path):
    name, path = "dropped", str(tmp_path / "t")
    shown = [writers.write_table(spark.range(n), name, path) for n in range(1, 5)]
    assert folders(path) == [folder.rsplit("/", 1)[1] for folder in shown[-2:]]
    assert versions.location(spark, name).endswith(shown[-1])
    versions.drop_old_versions(spark, path, shown[-1], kept=0)
    assert folders(path) == [shown[-1].rsplit("/", 1)[1]]
    versions.drop_table(spark, name, path)
    assert folders(path) == [] and not spark.catalog.tableExists(name)


def test_readers_of_the_version_before_can_finish(spark, tmp_path):
    name, path = "read", str(tmp_path / "t")
    writers.write_table(spark.range(5), name, path)
    rows = readers.read_table(spark, name)
    rows.count()
    writers.write_table(spark.range(9), name, path)
    assert rows.count() == 5
    assert readers.read_table(spark, name).count() == 9


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    name, path = "doubled", str(tmp_path / "t")
    writers.write_table(spark.range(5), name, path)
    writers.write_table(readers.read_table(spark, name).selectExpr("id * 2 AS id"), name, path)
    assert ids(spark, name) == [0, 2, 4, 6, 8]


def test_another_layout_replaces_the_entry(spark, tmp_path):
    name, path = "relaid", str(tmp_path / "t")
    writers.write_table(spark.range(5), name, path)
    writers.write_table(spark.range(5).selectExpr("id", "id AS more"), name, path, buckets=2, key="id")
    assert readers.read_table(spark, name).columns == ["id", "more"]


def test_rebalanced_files_follow_bytes(spark, tmp_path):
    """One value holds most rows: its files are split, those of the small ones are put together."""
    names = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": "true",
    }
    before = {name: spark.conf.get(name) for name in names}
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") < 30_000, "hot").otherwise((F.col("id") % 40).cast("string")).alias("credit_grade"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        writers.write_parquet(df, str(tmp_path / "a"), rebalance=["credit_grade"])
        sizes = [path.stat().st_size for path in (tmp_path / "a").glob("*.parquet")]
        assert 5 <= len(sizes) and max(sizes) < 3 * sum(sizes) / len(sizes)
        assert readers.read_parquet(spark, str(tmp_path / "a")).count() == 40_000
        writers.write_graded(df, "balanced", str(tmp_path / "b"))
        files = {path.name: len(list(path.glob("*.parquet"))) for path in (tmp_path / "b").glob("v*/*=*")}
        assert files["credit_grade=hot"] > 2
        assert all(n == 1 for name, n in files.items() if not name.endswith("hot"))
        writers.write_parquet(df.limit(100), str(tmp_path / "c"), rebalance=(), find_by="payload")
        assert len(list((tmp_path / "c").glob("*.parquet"))) == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lookup_key_gets_a_bloom_filter(spark, tmp_path):
    """Parquet reads no row group whose filter lacks the key, although its bounds hold it."""
    import pyarrow.parquet

    df = spark.range(0, 20_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias(schemas.KEY))
    sizes = {}
    for name, find_by in (("with", schemas.KEY), ("without", None)):
        writers.write_parquet(df, str(tmp_path / name), find_by=find_by)
        (file,) = (tmp_path / name).glob("*.parquet")
        column = pyarrow.parquet.ParquetFile(file).metadata.row_group(0)
        sizes[name] = file.stat().st_size - sum(column.column(i).total_compressed_size for i in range(column.num_columns))
    assert sizes["with"] > sizes["without"] + 10_000
    assert readers.read_parquet(spark, str(tmp_path / "with")).where(F.col(schemas.KEY) == "x").count() == 0
