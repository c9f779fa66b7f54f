"""Sinks.  These functions run jobs.

No sink forces a single task: the number of output files follows the
partitions of the plan, or their bytes where the rows are rebalanced, and
``max_records_per_file`` bounds their size.  Tables live in versioned folders: a write that
fails leaves the rows of before in place (``sources.versions``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill import schemas
from credmill.sources import versions

# Keys are random digits: higher levels look for matches in them, in vain, and so take more space and time.
ZSTD_LEVEL = 1


def _writer(df: DataFrame, max_records_per_file: int | None, compression: str | None = None):
    writer = df.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        writer = writer.option("compression", compression)
        writer = writer.option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)
    return writer


def rebalanced(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows in partitions of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each.

    Small partitions are put together and large ones are split by the adaptive planner, once their
    sizes are known.  With ``by`` rows of equal values come together, and a value that holds much of
    the data takes as many partitions as its bytes need.
    """
    return df.hint("rebalance", *by)


def _findable(writer, key: str | None):
    """Parquet Bloom filters on a column, no larger than its values in a row group need."""
    if key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    return writer


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    max_records_per_file: int | None = None,
    rebalance: Sequence[str] | None = None,
    find_by: str | None = None,
) -> None:
    """Write Parquet files.

    By default there is a file for each partition of the plan.  ``rebalance`` lets file sizes
    follow bytes instead: rows are shuffled by the columns it names, or evenly if it names none.
    ``find_by`` adds Bloom filters on a column that rows are looked up by, for rows that are not
    sorted by it.
    """
    if rebalance is not None:
        df = rebalanced(df, rebalance)
    _findable(_writer(df, max_records_per_file), find_by).parquet(path)


def write_csv(
    df: DataFrame, path: str, *, max_records_per_file: int | None = None, **options
) -> None:
    """Write CSV with a header.  Blanks at the ends of a text are kept.

    Spark reads both NULL and empty text back as NULL, unless writer and reader
    share a ``nullValue`` other than empty text.
    """
    _writer(df, max_records_per_file).csv(
        path,
        header=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        **options,
    )


def write_table(
    df: DataFrame,
    name: str,
    path: str,
    *,
    fmt: str = "parquet",
    buckets: int | None = None,
    key: str = schemas.KEY,
    max_records_per_file: int | None = None,
    compression: str | None = None,
) -> str:
    """Write an external catalog table and return the folder of this version below ``path``.

    With ``buckets`` the table is bucketed and sorted on ``key``, so that later
    joins on it need no shuffle.  Keys are unique by then, so buckets are even.
    Where a bucket is one file and ``session.SETTINGS`` holds, they need no sort either;
    ``max_records_per_file`` gives that up.  ``compression`` defaults to that of the session.
    """

    def write(table: str, folder: str) -> None:
        writer = _writer(df, max_records_per_file, compression).format(fmt).option("path", folder)
        if buckets:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(table)

    return versions.replace_table(df.sparkSession, name, path, write)


def write_partitioned(
    df: DataFrame,
    name: str,
    path: str,
    by: str,
    *,
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
    compression: str | None = None,
) -> str:
    """Write an external table with one directory for each value of a column, in one pass."""

    def write(table: str, folder: str) -> None:
        writer = _writer(df, max_records_per_file, compression).format(fmt).option("path", folder)
        writer.partitionBy(by).saveAsTable(table)

    return versions.replace_table(df.sparkSession, name, path, write)


def write_graded(
    df: DataFrame,
    name: str,
    path: str,
    *,
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
    compression: str | None = None,
) -> str:
    """Write all grades in one pass, one directory per grade.

    The rows are rebalanced by grade: a grade has as many files as its bytes need, where every
    task of the plan would else write one file to each directory.
    """
    return write_partitioned(
        rebalanced(df, ["credit_grade"]), name, path, "credit_grade",
        fmt=fmt, max_records_per_file=max_records_per_file, compression=compression,
    )


def create_grade_views(
    spark: SparkSession,
    table: str,
    *,
    grades: Iterable[str] = schemas.GRADES,
    pattern: str = schemas.GRADE_VIEW,
    names: dict[str, str] | None = None,
) -> list[str]:
    """One catalog view per grade; reading it touches that grade's files only.

    ``names`` gives the view of each grade its name, else ``pattern`` does.
    """
    views = []
    for grade in grades:
        view = (names or {}).get(grade) or pattern.format(grade=grade)
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} AS "
            f"SELECT * FROM {table} WHERE credit_grade = '{grade}'"
        )
        views.append(view)
    return views


def read_grade(df: DataFrame, grade: str) -> DataFrame:
    """The rows of one grade; a partition filter on a table written by grade."""
    return df.where(F.col("credit_grade") == grade)


def register_view(df: DataFrame, name: str = schemas.DEDUPED_VIEW) -> None:
    df.createOrReplaceTempView(name)
