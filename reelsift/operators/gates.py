"""Accept and reject gates as one ordered reason column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.text import caption_reasons
from reelsift.schema import QualityConfig


def _over(c: Column, limit: float) -> Column:
    return (c > limit) & ~F.isnan(c)


def quality_reasons(cfg: QualityConfig = QualityConfig()) -> Column:
    """Null scores never fire; NaN never exceeds."""
    c = F.col
    tests = [
        F.when(c("duration_sec") < cfg.min_duration_sec, "duration_too_short"),
        F.when(_over(c("duration_sec"), cfg.max_duration_sec), "duration_too_long"),
        F.when((c("width") < cfg.min_width) | (c("height") < cfg.min_height), "resolution_too_low"),
        F.when(c("blur_score") < cfg.min_blur_score, "too_blurry"),
        F.when(c("brightness_score") < cfg.min_brightness, "too_dark"),
        F.when(_over(c("brightness_score"), cfg.max_brightness), "too_bright"),
        F.when(_over(c("ocr_text_area_ratio"), cfg.max_ocr_text_area_ratio), "text_or_watermark_likely"),
    ]
    if cfg.min_aesthetic_score is not None:
        tests.append(F.when(c("aesthetic_score") < cfg.min_aesthetic_score, "aesthetic_score_too_low"))
    return F.array_compact(F.array(*tests))


def motion_reasons(cfg: QualityConfig = QualityConfig()) -> Column:
    """At most one reason; a null score is one."""
    m = F.col("motion_score")
    one = F.when(m.isNull(), "motion_unavailable").when(m < cfg.min_motion_score, "too_static").when(_over(m, cfg.max_motion_score), "motion_too_fast_or_unstable")
    return F.array_compact(F.array(one))


def gated(df: DataFrame, cfg: QualityConfig = QualityConfig(), caption: str | None = None) -> DataFrame:
    """Adds reject_reasons (quality, motion, then caption ones) and keep."""
    reasons = [quality_reasons(cfg), motion_reasons(cfg)] + ([caption_reasons(F.col(caption))] if caption else [])
    return df.withColumn("reject_reasons", F.concat(*reasons)).withColumn("keep", F.size("reject_reasons") == 0)
