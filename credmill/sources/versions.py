"""Tables in versioned folders: a write that fails leaves the rows of before in place.

A new version is written in full to a folder of its own, under a name of its own.  Only then is the
table switched to it, which changes the catalog and no file.  A table of the same layout takes the
new location in one step; another layout, or partitions that the catalog keeps with their
locations, replaces the entry.  Folders of versions before the last one are deleted after the
switch, so readers that began before it can finish.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_VERSION = re.compile(r"v\d{16}-[0-9a-f]{8}\Z")
KEPT_BEFORE = 1


def new_version(path: str) -> str:
    """A folder for a new version below ``path``; later versions sort behind earlier ones."""
    return f"{path.rstrip('/')}/v{time.time_ns() // 1000:016d}-{uuid.uuid4().hex[:8]}"


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {row.col_name: row.data_type for row in rows}


def location(spark: SparkSession, name: str) -> str:
    """The folder of the version that the table shows."""
    return _described(spark, name)["Location"]


_LAYOUT = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")


def _same_layout(spark: SparkSession, old: str, new: str) -> bool:
    before, after = _described(spark, old), _described(spark, new)
    if "# Partition Information" in before or "# Partition Information" in after:
        return False
    same = all(before.get(name) == after.get(name) for name in _LAYOUT)
    return same and spark.table(old).schema == spark.table(new).schema


def replace_table(spark: SparkSession, name: str, path: str, write: Callable[[str, str], None]) -> str:
    """Write a version of a table below ``path``, then let the table show it.

    ``write`` gets a table name and a folder and writes there.  The folder is returned.
    """
    folder, first = new_version(path), not spark.catalog.tableExists(name)
    stand_in = name if first else f"{name}__{uuid.uuid4().hex[:8]}"
    try:
        write(stand_in, folder)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {stand_in}")
        delete(spark, folder)
        raise
    if first:
        return folder
    if _same_layout(spark, name, stand_in):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"DROP TABLE {stand_in}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {stand_in} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    drop_old_versions(spark, path, folder)
    return folder


def _folder(spark: SparkSession, path: str):
    """File system and path of a folder on any storage that Spark writes to."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the version folders below ``path``, oldest first."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = (entry.getPath().getName() for entry in system.listStatus(folder))
    return sorted(name for name in names if _VERSION.match(name))


def delete(spark: SparkSession, path: str) -> None:
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def drop_old_versions(spark: SparkSession, path: str, shown: str, kept: int = KEPT_BEFORE) -> None:
    """Delete all versions that are older than the one shown, but for the last ``kept``."""
    older = [name for name in versions(spark, path) if name < shown.rsplit("/", 1)[1]]
    for name in older[: len(older) - kept] if kept else older:
        delete(spark, f"{path.rstrip('/')}/{name}")


def drop_table(spark: SparkSession, name: str, path: str) -> None:
    """Drop a table and all its versions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for version in versions(spark, path):
        delete(spark, f"{path.rstrip('/')}/{version}")
