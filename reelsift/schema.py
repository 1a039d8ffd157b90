"""Manifest schema and configuration."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

_D, _S, _I = T.DoubleType(), T.StringType(), T.IntegerType()
REQUIRED = ("clip_id", "source_path", "duration_sec", "fps", "width", "height", "frame_count", "keep")
MANIFEST = T.StructType(
    [
        T.StructField(name, kind, name not in REQUIRED)
        for name, kind in (
            ("clip_id", _S), ("source_path", _S), ("duration_sec", _D), ("fps", _D), ("width", _I), ("height", _I), ("frame_count", _I),
            ("blur_score", _D), ("brightness_score", _D), ("contrast_score", _D), ("colorfulness_score", _D), ("motion_score", _D),
            ("motion_p95_score", _D), ("motion_stability_score", _D), ("ocr_text_area_ratio", _D), ("aesthetic_score", _D),
            ("perceptual_hash", _S), ("duplicate_of", _S), ("caption", _S), ("motion_caption", _S), ("keep", T.BooleanType()), ("reject_reasons", T.ArrayType(_S)),
        )
    ]
)


@dataclass(frozen=True)
class QualityConfig:
    min_duration_sec: float = 1.0
    max_duration_sec: float = 20.0
    min_width: int = 256
    min_height: int = 256
    min_blur_score: float = 40.0
    min_brightness: float = 20.0
    max_brightness: float = 235.0
    max_ocr_text_area_ratio: float = 0.08
    min_motion_score: float = 0.2
    max_motion_score: float = 50.0
    min_aesthetic_score: float | None = None


@dataclass(frozen=True)
class PipelineConfig:
    sample_frames: int = 8
    output_manifest: str = "outputs/manifest.jsonl"


@dataclass(frozen=True)
class SceneSplitConfig:
    detector: str = "content"
    threshold: float = 27.0
    min_scene_len_frames: int = 15
    output_dir: str = "data/clips"
    output_fps: int = 24
    output_width: int = 512
    output_height: int = 512
    crf: int = 18
    preset: str = "medium"


@dataclass(frozen=True)
class AppConfig:
    pipeline: PipelineConfig = field(default_factory=PipelineConfig)
    quality: QualityConfig = field(default_factory=QualityConfig)
    scene_split: SceneSplitConfig = field(default_factory=SceneSplitConfig)
    captioning: dict[str, Any] = field(default_factory=dict)
    ocr: dict[str, Any] = field(default_factory=dict)
    aesthetic: dict[str, Any] = field(default_factory=dict)
    ray: dict[str, Any] = field(default_factory=dict)


def config_from(tree: dict[str, Any] | None) -> AppConfig:
    """Defaults overlaid with a nested mapping; unknown keys are ignored, numbers are coerced."""

    def build(cls, values):
        out = {}
        for f in dataclasses.fields(cls):
            if f.name not in (values or {}):
                continue
            v = values[f.name]
            kind = {"float": float, "int": int, "str": str, "float | None": lambda x: None if x is None else float(x)}.get(f.type)
            sub = {"pipeline": PipelineConfig, "quality": QualityConfig, "scene_split": SceneSplitConfig}.get(f.name)
            out[f.name] = build(sub, v) if sub else kind(v) if kind else dict(v or {})
        return cls(**out)

    return build(AppConfig, tree)


def load_config(path: str | None) -> AppConfig:
    """YAML (or JSON) file to a configuration; no path gives the defaults."""
    if path is None:
        return AppConfig()
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml

        tree = yaml.safe_load(text)
    except ImportError:
        import json

        tree = json.loads(text or "null")
    return config_from(tree)
