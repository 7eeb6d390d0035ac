"""Making the package importable where Python workers run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the session's application, once.

    Workers that have the package on their path anyway load the same sources; others need no set-up.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
