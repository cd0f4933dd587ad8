"""Sends this package to the executors' Python workers, for sessions that were started without it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package to the session's Python files, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        root = Path(__file__).resolve().parent
        if root.is_dir():  # else it already came in a zip file
            handle, path = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
            os.close(handle)
            with zipfile.ZipFile(path, "w") as z:
                for f in sorted(root.rglob("*.py")):
                    z.write(f, f.relative_to(root.parent))
            context.addPyFile(path)
        _SENT.add(context.applicationId)
    return spark
