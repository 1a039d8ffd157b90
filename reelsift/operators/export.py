"""Image-caption export of kept clips."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.functions import text
from reelsift.operators import measures
from reelsift.operators.review import numbered
from reelsift.ship import ship


def resolved(clips: DataFrame, files: DataFrame, folders: list[str]) -> DataFrame:
    """Adds ``found``: the first candidate path of a clip that a listing (path) holds.

    Absolute paths stand as they are; others are tried below each folder in order.
    """
    own = F.coalesce(*[text.filled(F.col(c)) for c in ("source_path", "clip_path", "video_path") if c in clips.columns])
    tries = F.when(F.startswith(own, F.lit("/")), F.array(own)).otherwise(F.array(*[F.concat(F.lit(f.rstrip("/") + "/"), own) for f in folders]))
    rows = clips.select("row_pos", F.posexplode_outer(tries).alias("__rank", "__path"))
    known = files.select(F.regexp_replace("path", "^file:/+", "/").alias("__path")).distinct()
    best = rows.join(known, "__path").groupBy("row_pos").agg(F.min_by("__path", "__rank").alias("found"))
    return clips.join(best, "row_pos", "left")


def listed(spark: SparkSession, clips: DataFrame) -> DataFrame:
    """(path) of the files in the folders that the clips' own paths name, one listing a folder."""
    own = F.coalesce(*[text.filled(F.col(c)) for c in ("source_path", "clip_path", "video_path") if c in clips.columns])
    folders = [r[0] for r in clips.select(F.regexp_extract(own, "^(.*)/[^/]*$", 1).alias("f")).filter("f <> ''").distinct().collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            found += [(f.getPath().toString(),) for f in fs.listStatus(path)]
    return spark.createDataFrame(found, "path string")


def selected(manifest: DataFrame, most: int | None = None) -> DataFrame:
    """Kept rows in order, then the first ``most`` of them."""
    out = manifest.filter(F.coalesce("keep", F.lit(True))).orderBy("row_pos")
    return out if most is None else out.limit(most)


def metadata(frames: DataFrame, prefix: str = "", with_motion: bool = True) -> DataFrame:
    """(file_name, text) of exported frames (clip_id, frame_pos, caption, motion_caption)."""
    rows = numbered(frames, "clip_id", "frame_pos", "__i")
    name = F.concat(F.lit("images/"), text.image_name(F.col("clip_id"), F.col("__i")))
    return rows.select(name.alias("file_name"), text.training_caption(F.col("caption"), F.col("motion_caption"), prefix, with_motion).alias("text"))


def counts(clips: DataFrame, frames_per_clip: int) -> DataFrame:
    """Counters of an export of clips with ``found``; source clips include the skipped."""
    there = F.col("found").isNotNull()
    return clips.agg((F.count_if(there) * frames_per_clip).alias("image_count"), F.count("*").alias("source_clip_count"), F.count_if(~there).alias("skipped_clip_count"))


def write_images(frames: DataFrame, folder: str, resolution: int, quality: int = 95) -> DataFrame:
    """Writes the middle squares of image rows as ``images/*.jpg`` below a folder that all executors share.

    Gives (clip_id, frame_pos, file_name) of what was written; a file is put in place
    whole, so that a task may run twice.
    """
    ship(frames.sparkSession)
    names = numbered(frames.select("clip_id", "frame_pos"), "clip_id", "frame_pos", "__i")
    names = names.select("clip_id", "frame_pos", F.concat(F.lit("images/"), text.image_name(F.col("clip_id"), F.col("__i"))).alias("file_name"))
    rows = measures.jpegs(frames, resolution, quality).join(names, ["clip_id", "frame_pos"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["file_name"], pdf["jpeg"]):
                target = Path(folder) / name
                target.parent.mkdir(parents=True, exist_ok=True)
                part = target.with_name(f".{uuid.uuid4().hex}")
                part.write_bytes(bytes(data))
                os.replace(part, target)
            yield pdf[["clip_id", "frame_pos", "file_name"]]

    return rows.select("clip_id", "frame_pos", "file_name", "jpeg").mapInPandas(run, "clip_id string, frame_pos long, file_name string")


def written_counts(clips: DataFrame, written: DataFrame) -> DataFrame:
    """Counters by what was written: clips without any image are skipped."""
    images = written.agg(F.count("*").alias("image_count"))
    done = written.select("clip_id").distinct().withColumn("done", F.lit(True))
    n = clips.join(done, "clip_id", "left").agg(F.count("*").alias("source_clip_count"), F.count_if(F.col("done").isNull()).alias("skipped_clip_count"))
    return images.crossJoin(n)  # one row each
