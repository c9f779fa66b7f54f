"""Scans.  All of them are lazy and leave pruning and pushdown to Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from credmill import schemas


def read_loans_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: str | None = schemas.LOAN_SCHEMA,
    corrupt_column: str | None = None,
    on_error: str = "null",
    source_column: str | None = None,
    **options,
) -> DataFrame:
    """Read a loan CSV with a header row.

    The declared schema is the default, because inference costs a further pass
    over the whole file.  Declared columns are found by name: the file may hold
    more columns, in any order.  ``schema=None`` infers the types instead.
    ``on_error`` says what becomes of fields that do not parse: ``"null"`` makes them
    NULL, ``"keep"`` also keeps their line in the string column ``corrupt_column``
    (``_corrupt_record`` by default), and ``"fail"`` ends the read.  ``source_column`` names a
    column for the path of the file that a row comes from.
    """
    if on_error not in ("null", "keep", "fail"):
        raise ValueError(f"on_error is null, keep or fail, not {on_error!r}")
    if on_error == "keep":
        corrupt_column = corrupt_column or "_corrupt_record"
    if on_error == "fail":
        options["mode"] = "FAILFAST"
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True, **options)
    declared = StructType.fromDDL(schema)
    if corrupt_column:
        declared = declared.add(corrupt_column, StringType())
    in_file = _schema_in_file_order(spark, path, declared, corrupt_column, options)
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    # enforceSchema=False makes Spark check the header of every file by name.
    wide = spark.read.schema(in_file).csv(path, header=True, enforceSchema=False, **options)
    source = [F.col("_metadata.file_path").alias(source_column)] if source_column else []
    return wide.select(*declared.names, *source)


def _schema_in_file_order(spark, path, declared, corrupt_column, options) -> StructType:
    """A CSV schema binds by position, so order the types by the header line."""
    header = spark.read.csv(path, header=True, **options).columns
    missing = set(declared.names) - set(header) - {corrupt_column}
    if missing:
        raise ValueError(f"{path} lacks the columns {sorted(missing)}")
    in_file = StructType(
        [
            declared[name] if name in declared.names else StructField(name, StringType())
            for name in header
        ]
    )
    return in_file.add(declared[corrupt_column]) if corrupt_column else in_file


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read Parquet with a declared schema, or with the one in the footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a table by its path, in any format the session has a source for."""
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_member(spark: SparkSession, name: str, key: str) -> DataFrame:
    """The rows of one key in a stored table.

    The key is a literal, so of a bucketed table one bucket is read, and within its sorted files
    the row groups and pages whose bounds hold the key.
    """
    return read_table(spark, name).where(F.col(schemas.KEY) == F.lit(key))
