"""Commands over manifests and folders: ``python -m reelsift.cli COMMAND ...``."""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift import fixed, scratch
from reelsift.functions import text
from reelsift.operators import captioning, dedupe, export, gates, measures, report, scenes, training, two_tower
from reelsift.schema import AppConfig, load_config
from reelsift.sources import frames, manifest


def process_folder(spark: SparkSession, folder: str, cfg: AppConfig, decode: frames.Decoder = frames.image_folders, transport: captioning.Transport | None = None, boxes: DataFrame | None = None) -> DataFrame:
    """Manifest rows of a folder of clips.

    ``decode`` reads the clips (``sources.frames``).  Scorer, text detector and
    captioner are those that the configuration names: detectors take ready ``boxes``
    by clip, remote captioners a ``transport``.  Frames are read once, and measured
    once.
    """
    files, images, meta = decode(spark, folder, cfg.pipeline.sample_frames, 24.0)
    base = scratch.folder(spark, "process")
    files, meta = scratch.cut(files, f"{base}/files"), scratch.cut(meta, f"{base}/meta")
    images = scratch.cut(images, f"{base}/images")
    m = scratch.cut(measures.measured(images), f"{base}/measured")
    clip = measures.clip_quality(m).withColumnRenamed("text_area_score", "ocr_text_area_ratio")
    parts = [measures.motion_metrics(measures.flow(images)), dedupe.clip_hash(m.select("clip_id", F.conv("frame_hash", 16, -10).cast("long").alias("h"))), m.groupBy("clip_id").agg(F.avg("mean_pixel").alias("mean_pixel"))]
    detector = measures.text_detector(str(cfg.ocr.get("provider", "proxy")), cfg.ocr.get("min_confidence"))
    if detector is not None and boxes is not None:
        clip = clip.drop("ocr_text_area_ratio")
        parts.append(detector(boxes).withColumnRenamed("text_ratio", "ocr_text_area_ratio"))
    provider = str(cfg.aesthetic.get("provider", "none"))
    if provider.lower() == "heuristic":  # the others score embeddings, which an embedding model must give
        parts.append(measures.aesthetic_scorer(provider)(m))
    out = files.join(meta, "clip_id")
    for part in (clip, *parts):
        out = out.join(part, "clip_id", "left")
    if "aesthetic_score" not in out.columns:
        out = out.withColumn("aesthetic_score", F.lit(None).cast("double"))
    out = out.withColumn("motion_caption", text.motion_sentence(F.col("motion_score")))
    name = str(cfg.captioning.get("provider", "heuristic")).lower()
    if name != "heuristic":
        most = int(cfg.captioning.get("max_keyframes", 4))
        if name in fixed.REMOTE and transport is None:
            transport, most = captioning.chat(cfg.captioning)
        elif name == "groq":
            most = min(most, fixed.REMOTE[name][-1])
        out = out.join(captioning.key_frame_urls(images, most), "clip_id", "left")
        urls = F.coalesce("urls", F.array().cast("array<string>"))
        asked = text.openai_messages(F.col("motion_caption"), urls) if name in fixed.REMOTE else text.vlm_messages(F.col("motion_caption"), F.size(urls), str(cfg.captioning.get("model_family", "qwen2-vl")))
        out = out.withColumn("messages", asked)
    out = captioning.captioned(out, name, transport).drop("messages")
    return manifest.numbered(gates.gated(out, cfg.quality, "caption").orderBy("source_path"))


def _session() -> SparkSession:
    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def summarize(spark: SparkSession, path: str, out: str) -> dict:
    row = report.summary_with_reasons(manifest.read_manifest(spark, path)).first().asDict()
    report.write_text(out, report.markdown(row))
    return row


def dedupe_manifest(spark: SparkSession, path: str, out: str, threshold: int = 6) -> DataFrame:
    marked = dedupe.mark_duplicates(manifest.read_manifest(spark, path), threshold)
    manifest.write_manifest(marked.orderBy("row_pos"), out)
    return marked


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="reelsift")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str, **options):
        c = sub.add_parser(name)
        for x in positional:
            c.add_argument(x)
        for k, v in options.items():
            flag = f"--{k.replace('_', '-')}"
            c.add_argument(flag, action="store_true") if v is False else c.add_argument(flag, default=v, type=type(v) if v is not None else str)
        return c

    command("process-video", "path", decoder="", output="outputs/manifest", config=None)
    command("process-folder", "path", decoder="", output="outputs/manifest", config=None)
    command("split-scenes", "path", decoder="", scores=False, config=None, output="outputs/scenes", dry_run=False)
    command("dedupe-manifest", "path", output="outputs/manifest_deduped", threshold=6)
    command("summarize-manifest", "path", output="outputs/dataset_summary.md")
    command("benchmark-folder", "path", decoder="", output="outputs/pipeline_benchmark.json", config=None)
    command("benchmark-inference", output="outputs/inference_benchmark.json", markdown_output="outputs/inference_benchmark.md")
    command("benchmark-training", output="outputs/training_benchmark.json", markdown_output="outputs/training_benchmark.md", samples=512, batch_size=32, epochs=1, manifest="", real=False)
    command("prepare-diffusion-lora-data", "path", output_dir="outputs/diffusion_lora_dataset", report="outputs/diffusion_lora_plan.md", json_report="outputs/diffusion_lora_dataset.json", frames_per_clip=1, max_clips=0, allow_missing=False, caption_prefix="", frames="", decoder="", resolution=512, steps=120, batch_size=1, rank=8)
    a = p.parse_args(argv)
    spark = _session()
    if a.command in ("process-video", "process-folder", "benchmark-folder"):
        began = time.time()
        rows = scratch.cut(process_folder(spark, a.path, load_config(a.config), frames.decoder(a.decoder)), f"{scratch.folder(spark, 'rows')}/rows")
        if a.command == "benchmark-folder":
            report.write_json(a.output, [r.asDict() for r in report.throughput(rows, time.time() - began).collect()])
        else:
            manifest.append_manifest(rows, a.output)
    elif a.command == "split-scenes":
        cfg = load_config(a.config).scene_split
        if a.scores:  # ready scores (video, i, v)
            s = spark.read.schema("video string, i long, v double").json(a.path)
        else:  # every frame of a folder of clips
            files, images, _ = frames.decoder(a.decoder)(spark, a.path, frames.EVERY, 24.0)
            named = files.select(F.col("clip_id").alias("video"), "source_path")
            s = measures.content_scores(images).join(named, "video").select(F.col("source_path").alias("video"), "i", "v")
        s = scratch.cut(s, f"{scratch.folder(spark, 'scenes')}/scores")
        seg = scenes.segments(scenes.cuts(s, cfg), s.groupBy("video").agg((F.max("i") + 1).alias("frames")), cfg)
        seg = seg.withColumn("command", scenes.cut_command(F.col("video"), F.col("clip_path"), F.col("start_sec"), F.col("end_sec"), cfg))
        seg.show(truncate=False) if a.dry_run else seg.write.mode("overwrite").json(a.output)
    elif a.command == "dedupe-manifest":
        out = dedupe_manifest(spark, a.path, a.output, a.threshold)
        print(out.agg(F.count("*").alias("clips"), F.count("duplicate_of").alias("duplicates")).first().asDict())
    elif a.command == "summarize-manifest":
        print(summarize(spark, a.path, a.output))
    elif a.command == "benchmark-inference":
        rows = [r.asDict() for r in training.inference_estimates(spark).collect()]
        report.write_json(a.output, rows)
        report.write_text(a.markdown_output, report.table_markdown("Inference Benchmark", rows))
    elif a.command == "benchmark-training":
        row = training.training_estimate(a.samples, a.batch_size, a.epochs)
        if a.real:
            kept = manifest.training_rows(manifest.read_manifest(spark, a.manifest), a.samples) if a.manifest else manifest.synthetic_rows(spark, a.samples)
            row, _ = two_tower.train(kept, two_tower.TwoTowerConfig(a.samples, a.batch_size, a.epochs))
        report.write_json(a.output, row)
        report.write_text(a.markdown_output, report.table_markdown("Training Benchmark", [row]))
    else:
        clips = export.selected(manifest.read_manifest(spark, a.path), a.max_clips or None)
        clips = scratch.cut(export.resolved(clips, export.listed(spark, clips), [os.path.dirname(os.path.abspath(a.path)), os.getcwd()]), f"{scratch.folder(spark, 'export')}/clips")
        n = export.counts(clips, a.frames_per_clip).first().asDict()
        if n["skipped_clip_count"] and not a.allow_missing:
            raise SystemExit(f"{n['skipped_clip_count']} clips have no source file; --allow-missing leaves them out")
        there = clips.filter("found is not null")
        if a.frames:  # the folder whose clips the manifest names: images are written, and counted as written
            files, images, _ = frames.decoder(a.decoder)(spark, a.frames, a.frames_per_clip, 24.0)
            named = files.withColumnsRenamed({"clip_id": "file", "source_path": "found"}).join(there.select("clip_id", "found"), "found").select("file", "clip_id")
            images = images.withColumnRenamed("clip_id", "file").join(named, "file")
            names = scratch.cut(export.write_images(images, a.output_dir, a.resolution), f"{scratch.folder(spark, 'written')}/files")
            n = export.written_counts(clips, names).first().asDict()
            names = names.join(there.select("clip_id", "caption", "motion_caption"), "clip_id")
        else:
            names = there.select("clip_id", F.explode(F.sequence(F.lit(0), F.lit(a.frames_per_clip - 1))).alias("frame_pos"), "caption", "motion_caption")
        export.metadata(names, a.caption_prefix).write.mode("overwrite").json(f"{a.output_dir}/metadata")
        plan = training.LoraCommand(train_data_dir=a.output_dir, resolution=a.resolution, steps=a.steps, batch_size=a.batch_size, rank=a.rank)
        report.write_json(a.json_report, {"output_dir": a.output_dir, **n})
        report.write_text(a.report, f"# LoRA Plan\n\n```\n{plan.shell()}\n```\n")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
