"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import wayline


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, as ``--py-files`` would; once per application.

    The archive is staged beside the driver and handed out by Spark.
    """
    sc = spark.sparkContext
    name = f"wayline-{sc.applicationId}.zip"
    if any(path.endswith(name) for path in sc.listFiles):
        return
    root = Path(wayline.__file__).parent
    path = os.path.join(tempfile.mkdtemp(), name)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    sc.addPyFile(path)
