"""Folders of image files as clips: each folder is a clip, its images in name order are the frames."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelsift.functions import text
from reelsift.operators.measures import selected_frames
from reelsift.sources.manifest import list_videos

#: Of a session, a folder, frames a clip and a rate: files (clip_id, source_path), image rows, metadata.
Decoder = Callable[[SparkSession, str, int, float], tuple[DataFrame, DataFrame, DataFrame]]
#: Count of frames a clip that stands for all of them.
EVERY = 1 << 30


def duration(frame_count, fps):
    """Frames over rate; 0 without a rate."""
    return F.when(fps > 0, frame_count / fps).otherwise(0.0)


def image_folders(spark: SparkSession, folder: str, count: int, fps: float = 24.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decoder of image folders by Spark's image source; images that can't be read are left out.

    Gives (clip_id, source_path), ``count`` evenly spaced image rows a clip
    (clip_id, frame_pos, height, width, nChannels, data) and (clip_id, duration_sec,
    fps, width, height, frame_count); the size is that of the first frame.
    """
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(folder)
    path = F.regexp_replace(F.regexp_replace("image.origin", "^file:/+", "/"), "/[^/]*$", "")
    rows = images.select(path.alias("source_path"), "image.*").withColumn("clip_id", text.clip_id(F.col("source_path")))
    rows = rows.withColumn("frame_pos", (F.row_number().over(Window.partitionBy("clip_id").orderBy("origin")) - 1).cast("long"))
    first = lambda c: F.min_by(c, "frame_pos").alias(c)
    meta = rows.groupBy("clip_id", "source_path").agg(F.count("*").cast("int").alias("frame_count"), first("width"), first("height")).withColumn("fps", F.lit(float(fps)))
    meta = meta.withColumn("duration_sec", duration(F.col("frame_count"), F.col("fps")))
    kept = rows if count >= EVERY else selected_frames(rows, count) if count > 0 else rows.limit(0)
    return meta.select("clip_id", "source_path"), kept.select("clip_id", "frame_pos", "height", "width", "nChannels", "data"), meta.drop("source_path")


def of_videos(probe: Callable[[DataFrame, int], tuple[DataFrame, DataFrame]]) -> Decoder:
    """Decoder from a function that turns a listing (clip_id, source_path) of video files into image rows and metadata."""

    def decode(spark: SparkSession, folder: str, count: int, fps: float) -> tuple[DataFrame, DataFrame, DataFrame]:
        files = list_videos(spark, folder).select(text.clip_id(F.col("path")).alias("clip_id"), F.col("path").alias("source_path"))
        return files, *probe(files, count)

    return decode


def decoder(name: str | None) -> Decoder:
    """``module:function``, or the reader of image folders."""
    if not name:
        return image_folders
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)
