"""Manifest files: one JSON row a clip, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reelsift import fixed
from reelsift.schema import MANIFEST, REQUIRED


#: Rows of a file split that ``row_pos`` has room for, in bits, and splits whose places are broadcast.
SPLIT_BITS, MAX_SPLITS = 33, 100_000


def with_position(scan: DataFrame) -> DataFrame:
    """Adds ``row_pos`` to a file scan: grows with file name, then with the line's place in the file.

    Spark packs file splits into tasks by size, so a plain running number follows
    neither.  The place is the split's rank among all (file, first byte) above the
    running number within its task, which grows along a split.
    """
    split = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__byte")]
    splits = scan.select(*split).distinct()
    ranks = splits.select("__file", "__byte", (F.row_number().over(Window.orderBy("__file", "__byte")) - 1).cast("long").alias("__rank"))
    if splits.count() <= MAX_SPLITS:
        ranks = F.broadcast(ranks)
    rows = scan.select("*", *split, F.monotonically_increasing_id().alias("__n"))
    place = F.shiftleft("__rank", SPLIT_BITS).bitwiseOR(F.col("__n").bitwiseAND((1 << SPLIT_BITS) - 1))
    return rows.join(ranks, ["__file", "__byte"]).withColumn("row_pos", place).drop("__file", "__byte", "__n", "__rank")


def numbered(df: DataFrame) -> DataFrame:
    """Adds ``row_pos`` to an ordered table that is no file scan."""
    return df.withColumn("row_pos", F.monotonically_increasing_id())


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All rows, validated: a malformed row or a missing required value fails the read.

    Blank lines are skipped, unknown fields dropped, numbers in strings accepted.
    """
    loose = T.StructType([T.StructField(f.name, T.StringType() if f.dataType in (T.DoubleType(), T.IntegerType()) else f.dataType) for f in MANIFEST] + [T.StructField("_bad", T.StringType())])
    raw = spark.read.schema(loose).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.dataType in (T.DoubleType(), T.IntegerType()) else F.col(f.name) for f in MANIFEST]
    broken = F.col("_bad").isNotNull()
    for f in MANIFEST:
        if f.dataType in (T.DoubleType(), T.IntegerType()):
            broken = broken | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        if f.name in REQUIRED:
            broken = broken | F.col(f.name).isNull()
    # The check is a filter, which no later plan may leave out, whatever columns it uses.
    told = F.raise_error(F.concat(F.lit("invalid manifest row: "), F.coalesce("_bad", "clip_id", F.lit("?"))))
    sound = with_position(raw).filter(F.when(F.coalesce(broken, F.lit(False)), told.cast("boolean")).otherwise(F.lit(True)))
    out = sound.select(*cols, "row_pos")
    return out.withColumn("reject_reasons", F.coalesce("reject_reasons", F.array().cast("array<string>")))


def write_manifest(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Overwrites (or appends) JSON rows; nulls are written out."""
    cols = [c for c in MANIFEST.names if c in df.columns]
    df.select(*cols).write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_manifest(df: DataFrame, path: str) -> None:
    write_manifest(df, path, "append")


def to_json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*[c for c in MANIFEST.names if c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))


def to_csv_rows(df: DataFrame) -> DataFrame:
    """Arrays as text, for CSV writers."""
    return df.withColumn("reject_reasons", F.to_json("reject_reasons"))


def training_rows(rows: DataFrame, samples: int) -> DataFrame:
    """The first kept rows by row_pos; a missing keep counts as true; no row is an error."""
    keep = F.coalesce("keep", F.lit(True)) if "keep" in rows.columns else F.lit(True)
    out = rows.filter(keep).orderBy("row_pos").limit(samples)
    if out.isEmpty():
        raise ValueError("no training rows found in the manifest")
    return out


def synthetic_rows(spark: SparkSession, count: int) -> DataFrame:
    """Closed-form rows for smoke runs."""
    i = F.col("id")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    step = lambda base, m, k: F.lit(base) + (i % m) * F.lit(k)
    return spark.range(count).select(
        i.alias("row_pos"), F.format_string("synthetic_%05d", i).alias("clip_id"), F.lit(True).alias("keep"), step(4.0, 12, 0.5).alias("duration_sec"),
        F.lit(512).alias("width"), F.lit(512).alias("height"), F.lit(24).alias("fps"), step(80.0, 7, 8.0).alias("blur_score"), step(80.0, 90, 1.0).alias("brightness"),
        step(35.0, 20, 1.0).alias("contrast_score"), step(30.0, 35, 1.0).alias("colorfulness_score"), step(0.4, 9, 0.35).alias("motion_score"), step(1.0, 11, 0.45).alias("motion_p95_score"),
        step(0.55, 5, 0.08).alias("motion_stability_score"), step(4.5, 6, 0.35).alias("aesthetic_score"), F.lit(0.0).alias("ocr_text_area_ratio"),
        F.concat(F.lit("A "), pick(fixed.MOTIONS), F.lit(" video in a "), pick(fixed.SCENES), F.lit(" scene.")).alias("caption"),
    )


def normalised(df: DataFrame) -> DataFrame:
    """Adds the review columns a loose manifest may lack."""
    for name, value in (("keep", F.lit(False)), ("reject_reasons", F.array().cast("array<string>")), ("caption", F.lit("")), ("duplicate_of", F.lit(None).cast("string"))):
        if name not in df.columns:
            df = df.withColumn(name, value)
    return df


def is_video(path) -> F.Column:
    suffix = F.concat(F.lit("."), F.lower(F.element_at(F.split(path, r"\."), -1)))
    return F.coalesce(F.contains(path, F.lit(".")) & suffix.isin(*fixed.VIDEO_SUFFIXES), F.lit(False))


def list_videos(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modificationTime) of video files below a folder, in order; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")
    return files.filter(is_video(F.col("path"))).orderBy("path")
