"""Training rows, contrastive loss and dry estimates."""

from __future__ import annotations

import math
import shlex
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift import fixed
from reelsift.functions.hashing import let


def features(columns: list[str], size: int = 16) -> Column:
    """Normalised values with defaults, padded or cut to ``size``."""
    value = lambda c, d: F.coalesce(F.col(c).try_cast("double"), F.lit(d)) if c in columns else F.lit(d)
    parts = [value(c, d) / F.lit(k) for c, d, k in fixed.FEATURES]
    keep = F.coalesce("keep", F.lit(False)) if "keep" in columns else F.lit(True)
    parts.append(keep.cast("double"))
    return F.array(*(parts + [F.lit(0.0)] * size)[:size])


def contrastive_loss(batches: DataFrame, scale: float) -> DataFrame:
    """(batch, loss) of paired unit vectors (batch, i, video, text): mean of both directions' cross entropy.

    A batch's members meet its other members only; batches are small by contract.
    """
    unit = lambda v: let(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, y: a + y * y)), lambda n: F.transform(v, lambda x: x / n))
    rows = batches.select("batch", "i", unit(F.col("video")).alias("v"), unit(F.col("text")).alias("t"))
    whole = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("i", "v", "t"))).alias("m"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) * scale
    lse = lambda v: let(v, lambda xs: let(F.array_max(xs), lambda top: F.log(F.aggregate(xs, F.lit(0.0), lambda s, x: s + F.exp(x - top))) + top))
    each = whole.select("batch", "m", F.explode("m").alias("r"))
    row = F.transform("m", lambda o: dot(F.col("r.v"), o["t"]))
    col = F.transform("m", lambda o: dot(o["v"], F.col("r.t")))
    loss = each.select("batch", (lse(row) - dot(F.col("r.v"), F.col("r.t"))).alias("a"), (lse(col) - dot(F.col("r.v"), F.col("r.t"))).alias("b"))
    return loss.groupBy("batch").agg(((F.avg("a") + F.avg("b")) / 2).alias("loss"))


def inference_estimates(spark: SparkSession, scenarios=fixed.SCENARIOS) -> DataFrame:
    """Deterministic estimates of seconds and memory by scenario."""
    df = spark.createDataFrame(list(scenarios), "name string, steps int, attention boolean, vae boolean, compiled boolean")
    on = lambda c, k: F.when(F.col(c), F.lit(k)).otherwise(F.lit(1.0))
    seconds = F.lit(30.0) * (F.col("steps") / 30.0) * on("attention", 1.08) * on("vae", 1.04) * on("compiled", 0.88)
    notes = F.array_join(F.array_compact(F.array(F.when(F.col("attention"), fixed.NOTE_ATTENTION), F.when(F.col("vae"), fixed.NOTE_VAE), F.when(F.col("compiled"), fixed.NOTE_COMPILE))), "; ")
    vram = F.lit(6000.0) * on("attention", 0.82) * on("vae", 0.88)
    return df.select("name", F.bround(seconds, 4).alias("seconds"), F.bround(vram, 2).alias("peak_vram_mb"), F.when(notes == "", fixed.NOTE_BASE).otherwise(notes).alias("notes"))


def training_estimate(samples: int = 512, batch_size: int = 32, epochs: int = 1) -> dict[str, float]:
    steps = max(1, math.ceil(samples / max(1, batch_size)) * epochs)
    return {"samples": samples, "batch_size": batch_size, "epochs": epochs, "steps": steps, "seconds": steps * 0.035, "samples_per_second": samples / (steps * 0.035)}


@dataclass(frozen=True)
class LoraCommand:
    train_data_dir: str = "outputs/diffusion_lora_dataset"
    output_dir: str = "outputs/diffusion_lora"
    model: str = "runwayml/stable-diffusion-v1-5"
    script: str = "scripts/train_text_to_image_lora.py"
    resolution: int = 512
    batch_size: int = 1
    accumulation: int = 4
    steps: int = 120
    learning_rate: float = 1e-4
    precision: str = "fp16"
    rank: int = 8
    seed: int = 13

    def arguments(self) -> list[str]:
        options = {
            "pretrained_model_name_or_path": self.model, "train_data_dir": self.train_data_dir, "resolution": self.resolution, "center_crop": None, "random_flip": None,
            "train_batch_size": self.batch_size, "gradient_accumulation_steps": self.accumulation, "max_train_steps": self.steps, "learning_rate": self.learning_rate,
            "lr_scheduler": "constant", "lr_warmup_steps": 0, "rank": self.rank, "mixed_precision": self.precision, "seed": self.seed, "output_dir": self.output_dir,
        }
        return ["accelerate", "launch", self.script, *(f"--{k}" if v is None else f"--{k}={v}" for k, v in options.items())]

    def shell(self) -> str:
        return shlex.join(self.arguments())
