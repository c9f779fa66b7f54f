"""A session with the settings the plans rely on."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: join strategy, partition sizes, skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes of code.  Generated code
    # above that is better run operator by operator than interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    # Buckets of one file are read in the order they were written in.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}

# Row counts of analyzed tables order the joins and choose their strategy.  Estimating them makes
# the planning of long plans slower, so sessions ask for it that join analyzed tables in many ways.
COST_BASED = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
}

# Spark deletes the shuffle files of a query when it ends, not when the driver next collects garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# For a scan that no join follows, Spark would put buckets together by the size of their files, the more of
# them the better they are compressed, and sort what a task then holds.
PACKED = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
# What holds while a job writes its tables.
WRITING = {FREED: "true", PACKED: "false"}
_WRITERS: dict[SparkSession, tuple[int, dict[str, str | None]]] = {}
_LOCK = threading.Lock()


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Queries of the session that begin within this leave no shuffle files, and read a bucket in a task.

    The settings of before come back when the last of several threads has left.
    """
    with _LOCK:
        users, before = _WRITERS.get(spark) or (0, {name: spark.conf.get(name, None) for name in WRITING})
        _WRITERS[spark] = users + 1, before
        for name, value in WRITING.items():
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _LOCK:
            users, before = _WRITERS.pop(spark)
            if users > 1:
                _WRITERS[spark] = users - 1, before
            else:
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def build_session(
    app: str,
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Build or get a session.

    On a cluster leave ``master`` to ``spark-submit``, and set the number of
    shuffle partitions so that one holds some 128 to 256 MB of the wide rows;
    the adaptive planner merges small ones but does not split at random.
    """
    builder = SparkSession.builder.appName(app)
    options = dict(SETTINGS)
    if master:
        options.update(
            {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
        )
        builder = builder.master(master)
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    options.update(settings or {})
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    return spark
