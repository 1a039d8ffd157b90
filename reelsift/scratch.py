"""Where intermediate tables go: the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only where driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reelsift-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` and returns the stored table."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
