"""Makes the package importable in the Python workers where the way the driver was started does not."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package along with the application unless its folder is the working folder or on PYTHONPATH already."""
    root = str(Path(__file__).resolve().parents[2])
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _shipped or root in [os.path.realpath(p) for p in known if p]:
        return
    _shipped.add(app)
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="run-"), "cartwheel"), "zip", root, "cartwheel")
    spark.sparkContext.addPyFile(made)  # the driver serves the file to the executors
