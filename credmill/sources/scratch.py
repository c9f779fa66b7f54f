"""A fresh directory for intermediate tables, on storage all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """Return a new path below the session's ``spark.checkpoint.dir``.

    A machine-local temporary directory is used only where the session names
    none and runs on one machine, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="credmill-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
