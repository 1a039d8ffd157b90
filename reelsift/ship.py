"""Hands this package's modules to the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application once; Spark's file server spreads it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    if top.suffix == ".zip" or not top.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="reelsift-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/reelsift_modules.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, str(p.relative_to(top.parent)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
