"""Makes the package importable for Python workers wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once a session (Spark's own file server; no shared folder needed)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="chronoweave-"), "chronoweave.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped[app] = path
