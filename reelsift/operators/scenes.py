"""Scene boundaries from content scores, segments and cut commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelsift.schema import SceneSplitConfig


def cuts(scores: DataFrame, cfg: SceneSplitConfig = SceneSplitConfig()) -> DataFrame:
    """(video, cuts): frames whose score reaches the threshold and lie a scene's length after the last cut."""
    if cfg.detector != "content":
        raise ValueError(f"unsupported detector: {cfg.detector}")
    gap = cfg.min_scene_len_frames
    # Only frames that could be cuts are gathered; the rest leave a null, which isn't collected.
    ordered = scores.groupBy("video").agg(F.array_sort(F.collect_list(F.when(F.col("v") >= cfg.threshold, F.col("i").cast("bigint")))).alias("s"))
    fold = f"""aggregate(s, named_struct('last', cast({-gap} as bigint), 'cuts', cast(array() as array<bigint>)),
        (a, i) -> if(i - a.last >= {gap}, named_struct('last', i, 'cuts', array_append(a.cuts, i)), a), a -> a.cuts)"""
    return ordered.select("video", F.expr(fold).alias("cuts"))


def segments(cut_rows: DataFrame, lengths: DataFrame, cfg: SceneSplitConfig = SceneSplitConfig(), fps: float = 24.0) -> DataFrame:
    """Scenes of (video, cuts) and (video, frames): index, start and end seconds, duration, path."""
    rows = lengths.join(cut_rows, "video", "left")
    bounds = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), F.coalesce("cuts", F.array().cast("array<bigint>")))))
    out = rows.select("video", F.posexplode(bounds).alias("scene_index", "frame"), (F.col("frames") / fps).alias("length"))
    start = F.col("frame") / fps
    end = F.coalesce(F.lead(start).over(Window.partitionBy("video").orderBy("scene_index")), F.col("length"))
    out = out.withColumn("start_sec", start).withColumn("end_sec", end)
    stem = F.element_at(F.split(F.regexp_replace(F.col("video").cast("string"), r"\.[^./]*$", ""), "/"), -1)
    path = F.format_string(f"{cfg.output_dir}/%s/%s_scene_%04d.mp4", stem, stem, "scene_index")
    return out.select("video", "scene_index", "start_sec", "end_sec", F.greatest(F.lit(0.0), F.col("end_sec") - F.col("start_sec")).alias("duration_sec"), path.alias("clip_path"))


def cut_command(source: Column, output: Column, start: Column, end: Column, cfg: SceneSplitConfig = SceneSplitConfig()) -> Column:
    """Argument list of the transcoder for one scene."""
    w, h = cfg.output_width, cfg.output_height
    view = f"fps={cfg.output_fps},scale={w}:{h}:force_original_aspect_ratio=decrease,pad={w}:{h}:(ow-iw)/2:(oh-ih)/2,setsar=1"
    lit = lambda *a: [F.lit(str(x)) for x in a]
    length = F.greatest(F.lit(0.0), end - start)
    return F.array(*lit("ffmpeg", "-y", "-ss"), F.format_string("%.3f", start), F.lit("-i"), source, F.lit("-t"), F.format_string("%.3f", length), *lit("-vf", view, "-an", "-c:v", "libx264", "-preset", cfg.preset, "-crf", cfg.crf), output)
