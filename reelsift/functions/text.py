"""Caption and name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsift import fixed


def strip(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """Null where empty."""
    return F.when(c != "", c)


def sanitised(text: Column) -> Column:
    """Reasoning blocks and labels off; white space collapsed."""
    c = strip(F.regexp_replace(F.regexp_replace(text, fixed.THINK_BLOCK, ""), fixed.THINK_TAG, ""))
    c = F.when(F.rlike(c, F.lit(fixed.FINAL_CAPTION)), F.regexp_extract(c, fixed.FINAL_CAPTION, 1)).otherwise(c)
    c = F.regexp_replace(strip(c), fixed.CAPTION_PREFIX, "")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def incomplete(c: Column) -> Column:
    return ~F.rlike(c, F.lit(r"[.!?]$")) & F.rlike(c, F.lit(fixed.INCOMPLETE_END))


def caption_reasons(caption: Column) -> Column:
    """Ordered reasons; an empty caption gives that reason alone."""
    c = strip(caption)
    found = F.array_compact(
        F.array(
            F.when(F.rlike(c, F.lit(fixed.ANALYSIS_MARKER)), "caption_contains_reasoning"),
            F.when(F.rlike(c, F.lit(fixed.TEXT_ARTIFACT)), "caption_mentions_text_overlay"),
            F.when(incomplete(c), "caption_incomplete"),
        )
    )
    return F.when(F.coalesce(c, F.lit("")) == "", F.array(F.lit("caption_empty"))).otherwise(found)


def prompt(motion_caption: Column) -> Column:
    return F.concat(F.lit(fixed.PROMPT_HEAD), F.coalesce(filled(motion_caption), F.lit(fixed.NO_MOTION)), F.lit(fixed.PROMPT_TAIL))


def openai_messages(motion_caption: Column, urls: Column) -> Column:
    """Chat messages with low-detail images, as JSON; ``urls`` is an array of data URLs."""
    text = F.to_json(F.struct(F.lit("text").alias("type"), prompt(motion_caption).alias("text")))
    images = F.transform(urls, lambda u: F.to_json(F.struct(F.lit("image_url").alias("type"), F.struct(u.alias("url"), F.lit("low").alias("detail")).alias("image_url"))))
    return F.concat(F.lit('[{"role":"user","content":['), F.array_join(F.concat(F.array(text), images), ","), F.lit("]}]"))


def vlm_messages(motion_caption: Column, n_frames: Column, family: str) -> Column:
    """Messages of a local model's family, as JSON."""
    p = prompt(motion_caption)
    family = family.lower()
    if family in ("qwen", "qwen2-vl", "qwen2_5-vl"):
        parts = F.concat(F.array_repeat(F.lit('{"type":"image"}'), n_frames), F.array(F.to_json(F.struct(F.lit("text").alias("type"), p.alias("text")))))
        return F.concat(F.lit('[{"role":"user","content":['), F.array_join(parts, ","), F.lit("]}]"))
    if family in ("llava", "llava-next", "llava_onevision"):
        p = F.concat(F.array_join(F.array_repeat(F.lit("<image>"), n_frames), "\n"), F.lit("\n"), p)
    return F.to_json(F.array(F.struct(F.lit("user").alias("role"), p.alias("content"))))


def motion_sentence(score: Column) -> Column:
    return F.when(score < 0.5, fixed.MOTION_STATIC).when(score < 5.0, fixed.MOTION_MODERATE).when(score.isNotNull(), fixed.MOTION_FAST)


def plain_caption(mean_pixel: Column, motion_caption: Column) -> Column:
    """Caption of brightness and motion; a null mean stands for no frames."""
    light = F.when(mean_pixel < 70, "dark").when(mean_pixel > 180, "bright").otherwise("normally lit")
    motion = F.coalesce(filled(motion_caption), F.lit(fixed.NO_MOTION_ESTIMATE))
    return F.when(mean_pixel.isNull(), fixed.NO_FRAMES).otherwise(F.concat(F.lit("A "), light, F.lit(" video clip; "), motion, F.lit(".")))


def training_caption(caption: Column, motion_caption: Column, prefix: str = "", with_motion: bool = True) -> Column:
    parts = [F.lit(prefix.strip() or None).cast("string"), filled(strip(F.coalesce(filled(caption), F.lit(fixed.DEFAULT_TRAINING_CAPTION))))]
    if with_motion:
        parts.append(filled(strip(F.coalesce(motion_caption, F.lit("")))))
    return F.array_join(F.array_compact(F.array(*parts)), " ")


def safe_name(value: Column) -> Column:
    name = F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}_-]", "_")
    return F.coalesce(filled(F.regexp_replace(name, "^_+|_+$", "")), F.lit("clip"))


def image_name(value: Column, index: Column) -> Column:
    return F.format_string("%s_%03d.jpg", safe_name(value), index)


def data_url(jpeg: Column) -> Column:
    return F.concat(F.lit("data:image/jpeg;base64,"), F.base64(jpeg))


def clip_id(path: Column) -> Column:
    return F.substring(F.sha1(path.cast("binary")), 1, 16)


def caption_words(caption: Column, most: int = 32) -> Column:
    words = F.filter(F.split(F.translate(F.lower(caption), ".,", "  "), r"(?U)\s+"), lambda w: w != "")
    return F.slice(words, 1, most)


def caption_tokens(caption: Column, vocab: int = 4096, most: int = 32) -> Column:
    """Stable token ids of the first words, padded with 0; a null caption is empty."""
    ids = F.transform(caption_words(F.coalesce(caption, F.lit("")), most), lambda w: F.pmod(F.xxhash64(w), F.lit(vocab)).cast("int"))
    return F.slice(F.concat(ids, F.array_repeat(F.lit(0), most)), 1, most)
