"""Gives Python workers the package when they cannot import it by themselves."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    target = Path(tempfile.mkdtemp(prefix="ship-")) / "credmill_package.zip"
    target.write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
