"""Per-clip measures from frames: quality, motion, aesthetic and text area."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelsift import fixed
from reelsift.functions import image, jpeg
from reelsift.functions.hashing import let
from reelsift.ship import ship

QUALITY = ("blur", "brightness", "contrast", "colorfulness", "text_area")


def clip_quality(frames: DataFrame) -> DataFrame:
    """Exact medians over a clip's frames; a clip without frames has nulls."""
    return frames.groupBy("clip_id").agg(*[F.median(c).alias(f"{c}_score") for c in QUALITY if c in frames.columns])


def motion_metrics(magnitudes: DataFrame) -> DataFrame:
    """Median, 95th percentile and stability of a clip's (clip_id, magnitude); nulls are no magnitudes."""
    m = F.col("magnitude").cast("float").cast("double")
    out = magnitudes.groupBy("clip_id").agg(F.median(m).alias("motion_score"), F.percentile(m, 0.95).alias("motion_p95_score"), F.stddev_pop(m).alias("s"))
    return out.select("clip_id", "motion_score", "motion_p95_score", (1 / (1 + F.col("s") / F.greatest("motion_score", F.lit(1e-6)))).alias("motion_stability_score"))


def paired_difference(frames: DataFrame) -> DataFrame:
    """(clip_id, frame_pos, magnitude): mean absolute difference to the frame before, in grey levels."""
    w = Window.partitionBy("clip_id").orderBy("frame_pos")
    diff = F.zip_with("gray", F.lag("gray").over(w), lambda x, y: F.abs(x - y))
    return frames.select("clip_id", "frame_pos", image.mean_of(diff).alias("magnitude"))


def heuristic_aesthetic(blur: Column, brightness: Column, color: Column) -> Column:
    light = F.greatest(F.lit(0.0), 1 - F.abs(brightness - 128) / 128)
    return 10 * (0.45 * light + 0.35 * F.least(F.lit(1.0), blur / 500) + 0.20 * F.least(F.lit(1.0), color / 80))


def _dot(v: Column, weights: list[float]) -> Column:
    return F.aggregate(F.zip_with(v, F.array(*[F.lit(float(x)) for x in weights]), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)


def _unit(v: Column) -> Column:
    norm = F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-6))
    return let(norm, lambda n: F.transform(v, lambda x: x / n))


def linear_head(frames: DataFrame, weights: list[float], bias: float) -> DataFrame:
    """(clip_id, aesthetic_score): lower median of the head over unit embeddings ``d``, within 0 and 10."""
    score = _dot(_unit(F.col("d")), weights) + bias
    out = frames.select("clip_id", score.alias("s")).groupBy("clip_id").agg(F.expr("percentile_disc(0.5) within group (order by s)").alias("s"))
    return out.select("clip_id", F.greatest(F.lit(0.0), F.least(F.lit(10.0), "s")).alias("aesthetic_score"))


def two_prompts(frames: DataFrame, good: list[float], bad: list[float], scale: float = 100.0) -> DataFrame:
    """(clip_id, aesthetic_score): ten times the lower median of the softmax share of the first prompt."""
    a, b = _dot(_unit(F.col("d")), good), _dot(_unit(F.col("d")), bad)
    p = 1 / (1 + F.exp(scale * (b - a)))
    out = frames.select("clip_id", p.alias("p")).groupBy("clip_id").agg(F.expr("percentile_disc(0.5) within group (order by p)").alias("p"))
    return out.select("clip_id", (10 * F.col("p")).alias("aesthetic_score"))


def box_ratio(boxes: DataFrame, key: str, least_conf: float) -> DataFrame:
    """Summed areas of confident boxes over the frame, overlap counted twice, at most 1."""
    area = F.greatest(F.lit(0.0), F.col("x_max") - F.col("x_min")) * F.greatest(F.lit(0.0), F.col("y_max") - F.col("y_min"))
    sure = F.when(F.col("conf").try_cast("double") >= least_conf, area).otherwise(0.0)
    return boxes.groupBy(key).agg(F.least(F.lit(1.0), F.sum(sure) / F.max("frame_area")).alias("text_ratio"))


def selected_frames(frames: DataFrame, k: int) -> DataFrame:
    """k evenly spaced frames of each clip, by position."""
    w = Window.partitionBy("clip_id")
    ranked = frames.withColumn("__n", F.count("*").over(w).cast("int")).withColumn("__i", (F.row_number().over(w.orderBy("frame_pos")) - 1).cast("int"))
    return ranked.filter(F.array_contains(image.evenly_spaced(F.col("__n"), k), F.col("__i"))).drop("__n", "__i")


Decoder = Callable[[bytes], np.ndarray]


def measured(frames: DataFrame, decode: Decoder | None = None) -> DataFrame:
    """Kernels over image rows (clip_id, frame_pos, height, width, nChannels, data), Arrow batch by batch.

    ``decode`` turns ``data`` into a BGR array; without it data are raw samples.
    """
    ship(frames.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                f = decode(bytes(r.data)) if decode else image.of_samples(bytes(r.data), r.height, r.width, r.nChannels)
                rows.append((r.clip_id, r.frame_pos, *image.frame_metrics(f).values(), image.frame_hash(f), float(f.mean())))
            yield pd.DataFrame(rows, columns=["clip_id", "frame_pos", *QUALITY, "frame_hash", "mean_pixel"])

    kinds = ", ".join(f"{c} double" for c in QUALITY)
    return frames.select("clip_id", "frame_pos", "height", "width", "nChannels", "data").mapInPandas(run, f"clip_id string, frame_pos long, {kinds}, frame_hash string, mean_pixel double")


def flow(frames: DataFrame) -> DataFrame:
    """(clip_id, magnitude) of consecutive image rows, by block displacement."""
    ship(frames.sparkSession)
    w = Window.partitionBy("clip_id").orderBy("frame_pos")
    pairs = frames.withColumn("before", F.lag("data").over(w)).filter("before is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shape = lambda r, d: image.of_samples(bytes(d), r.height, r.width, r.nChannels)
            yield pd.DataFrame([(r.clip_id, image.block_motion(shape(r, r.before), shape(r, r.data))) for r in pdf.itertuples(index=False)], columns=["clip_id", "magnitude"])

    return pairs.select("clip_id", "height", "width", "nChannels", "before", "data").mapInPandas(run, "clip_id string, magnitude double")


def _frame(r) -> np.ndarray:
    return image.of_samples(bytes(r.data), r.height, r.width, r.nChannels)


def _each(frames: DataFrame, value: Callable[[np.ndarray], object], name: str, kind: str) -> DataFrame:
    """(clip_id, frame_pos, ``name``) of one kernel over image rows."""
    ship(frames.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(r.clip_id, r.frame_pos, value(_frame(r))) for r in pdf.itertuples(index=False)]
            yield pd.DataFrame(out, columns=["clip_id", "frame_pos", name])

    return frames.select("clip_id", "frame_pos", "height", "width", "nChannels", "data").mapInPandas(run, f"clip_id string, frame_pos long, {name} {kind}")


def hashed(frames: DataFrame, size: int = 8) -> DataFrame:
    """(clip_id, frame_pos, frame_hash) of ``size * size`` bits."""
    if size < 2:
        raise ValueError("hash size must be at least 2")
    return _each(frames, lambda f: image.frame_hash(f, size), "frame_hash", "string")


def squared(frames: DataFrame, resolution: int) -> DataFrame:
    """(clip_id, frame_pos, data): the middle square of each frame, resized by area."""
    return _each(frames, lambda f: image.centre_square(f, resolution).tobytes(), "data", "binary")


def jpegs(frames: DataFrame, resolution: int | None = None, quality: int = 85) -> DataFrame:
    """(clip_id, frame_pos, jpeg) of frames, or of their middle squares."""
    return _each(frames, lambda f: jpeg.encode(f if resolution is None else image.centre_square(f, resolution), quality), "jpeg", "binary")


def signatures(frames: DataFrame) -> DataFrame:
    """(clip_id, signature): SHA-1 over shapes and channel means of a clip's frames in order."""
    parts = _each(frames, image.signature_part, "part", "binary")
    ordered = F.array_sort(F.collect_list(F.struct("frame_pos", "part")))
    return parts.groupBy("clip_id").agg(ordered.alias("parts")).select("clip_id", F.sha1(F.aggregate("parts", F.lit(bytearray()), lambda a, x: F.concat(a, x["part"]))).alias("signature"))


def content_scores(frames: DataFrame) -> DataFrame:
    """(video, i, v) of image rows: change of colour against the frame before, 0 for the first.

    A frame of another size than the one before has no score.
    """
    ship(frames.sparkSession)
    w = Window.partitionBy("clip_id").orderBy("frame_pos")
    same = (F.lag("height").over(w) == F.col("height")) & (F.lag("width").over(w) == F.col("width")) & (F.lag("nChannels").over(w) == F.col("nChannels"))
    pairs = frames.select("clip_id", "frame_pos", "height", "width", "nChannels", "data", F.when(same, F.lag("data").over(w)).alias("before"), F.row_number().over(w).alias("place"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                old = None if r.before is None else image.of_samples(bytes(r.before), r.height, r.width, r.nChannels)
                out.append((r.clip_id, r.frame_pos, 0.0 if r.place == 1 else None if old is None else image.content_change(old, _frame(r))))
            yield pd.DataFrame(out, columns=["video", "i", "v"]).astype({"v": "float64"})

    return pairs.mapInPandas(run, "video string, i long, v double")


def head_weights(path: str, variant: str) -> tuple[list[float], float]:
    """Weights and bias of a linear head stored as JSON or NumPy archive, checked against the variant's size.

    Names may stand below ``state_dict`` and carry a ``linear.`` or ``model.`` prefix.
    """
    if variant not in fixed.HEAD_SIZES:
        raise ValueError(f"unknown head variant: {variant}; one of {', '.join(sorted(fixed.HEAD_SIZES))}")
    if path.endswith(".npz"):
        with np.load(path) as z:
            state = {k: z[k] for k in z.files}
    else:
        state = json.loads(Path(path).read_text(encoding="utf-8"))
        state = state.get("state_dict", state) if isinstance(state, dict) else state
    if not isinstance(state, dict):
        raise ValueError("a head holds named weights")
    state = {k.removeprefix("linear.").removeprefix("model."): v for k, v in state.items()}
    weight, bias = (np.asarray(state[k], np.float64).ravel() if k in state else None for k in ("weight", "bias"))
    if weight is None or bias is None or len(weight) != fixed.HEAD_SIZES[variant] or len(bias) != 1:
        raise ValueError(f"the head isn't one of {fixed.HEAD_SIZES[variant]} weights and a bias")
    return weight.tolist(), float(bias[0])


SCORERS = ("none", "heuristic", "clip", "laion", "laion-aesthetic")
DETECTORS = ("none", "proxy", "easyocr", "tesseract")


def aesthetic_scorer(provider: str, **args) -> Callable[[DataFrame], DataFrame] | None:
    """A function of frames by provider name; unknown names are an error."""
    name = provider.lower()
    if name == "none":
        return None
    if name == "heuristic":
        return lambda f: f.groupBy("clip_id").agg(F.median(heuristic_aesthetic(F.col("blur"), F.col("brightness"), F.col("colorfulness"))).alias("aesthetic_score"))
    if name in ("laion", "laion-aesthetic"):
        if "weights" not in args:
            args["weights"], args["bias"] = head_weights(args["head_path"], args.get("head_variant", "vit_b_32"))
        return lambda f: linear_head(f, args["weights"], args.get("bias", 0.0))
    if name == "clip":
        return lambda f: two_prompts(f, args["good"], args["bad"], args.get("scale", 100.0))
    raise ValueError(f"unknown aesthetic provider: {provider}")


def text_detector(provider: str, least_conf: float | None = None) -> Callable[[DataFrame], DataFrame] | None:
    """None keeps the edge proxy; the others sum boxes, with confidences of 0-1 or 0-100."""
    name = provider.lower()
    if name in ("none", "proxy"):
        return None
    if name in ("easyocr", "tesseract"):
        limit = least_conf if least_conf is not None else 0.35 if name == "easyocr" else 35.0
        return lambda boxes: box_ratio(boxes, "clip_id", limit)
    raise ValueError(f"unknown text provider: {provider}")
