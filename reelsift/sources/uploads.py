"""Files that users hand in: staged under names of our own, decoded with one error a file."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path, PurePath

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.ship import ship

IMAGES = "name string, source_path string, frame_pos long, height int, width int, nChannels int, data binary, error string"


def stage(files: Iterable[tuple[str, bytes]], folder: str) -> list[tuple[str, str]]:
    """Writes (name, bytes) below a folder; gives (name, path).  Only the suffix of a name is used."""
    out = []
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, data in files:
        path = Path(folder) / f"{uuid.uuid4().hex}{(PurePath(name).suffix or '.mp4').lower()}"
        path.write_bytes(data)
        out.append((name, str(path)))
    return out


def decoded(spark: SparkSession, staged: list[tuple[str, str]], decode: Callable[[bytes], Iterable[np.ndarray]]) -> DataFrame:
    """Image rows of every staged (name, path); a file that can't be decoded is one row with its error.

    Spark lists no empty files, so what was staged leads.
    """
    ship(spark)
    named = spark.createDataFrame(staged, "name string, source_path string")
    content = spark.read.format("binaryFile").load([path for _, path in staged]) if staged else spark.createDataFrame([], "path string, content binary")
    content = content.select(F.regexp_replace("path", "^file:/+", "/").alias("source_path"), "content")
    files = named.join(content, "source_path", "left").select("name", "source_path", F.coalesce("content", F.lit(bytearray())).alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                try:
                    rows = [(r.name, r.source_path, i, *f.shape[:2], f.shape[2] if f.ndim == 3 else 1, np.ascontiguousarray(f).tobytes(), None) for i, f in enumerate(decode(bytes(r.content)))]
                    if not rows:
                        raise ValueError("no frames")
                except Exception as e:  # whatever a decoder of others raises belongs to this file alone
                    rows = [(r.name, r.source_path, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["name", "source_path", "frame_pos", "height", "width", "nChannels", "data", "error"])

    return files.mapInPandas(run, IMAGES)


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Image rows, and (name, source_path, error) of the files set aside."""
    return rows.filter("error is null").drop("error"), rows.filter("error is not null").select("name", "source_path", "error")
