import itertools
import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsift import cli, fixed, schema
from reelsift.functions import hashing, image, jpeg, text
from reelsift.operators import captioning, dedupe, export, gates, measures, report, review, scenes, training, two_tower
from reelsift.schema import AppConfig, QualityConfig, SceneSplitConfig, config_from
from reelsift.sources import fixtures, frames, manifest, uploads
from reelsift.streaming import append


def one(spark, column, **values):
    row = [tuple(values.values())] if values else [(1,)]
    names = list(values) or ["x"]
    kinds = ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'int'}" for n, v in zip(names, row[0])) if values else "x int"
    return spark.createDataFrame(row, kinds).select(column.alias("v")).first()[0]


def base_row(i, **more):
    return {"clip_id": f"c{i}", "source_path": f"/v/{i}.mp4", "duration_sec": 2.0, "fps": 24.0, "width": 512, "height": 512, "frame_count": 48, "keep": True, "reject_reasons": []} | more


def write_rows(path, rows):
    path.write_text("\n\n".join(json.dumps(r) for r in rows) + "\n")
    return str(path)


def test_manifest_round_trip_and_strictness(spark, tmp_path):
    p = write_rows(tmp_path / "m.jsonl", [base_row(0), base_row(1, fps="25", extra=1)])
    df = manifest.read_manifest(spark, p)
    assert [(r.clip_id, r.fps) for r in df.orderBy("row_pos").collect()] == [("c0", 24.0), ("c1", 25.0)]
    out = str(tmp_path / "out")
    manifest.write_manifest(df, out)
    manifest.append_manifest(df, out)
    assert manifest.read_manifest(spark, out).count() == 4
    assert '"caption":null' in next(iter((tmp_path / "out").glob("part-*"))).read_text()
    for broken in ({k: v for k, v in base_row(2).items() if k != "keep"}, base_row(2, width="wide")):
        bad = write_rows(tmp_path / "bad.jsonl", [base_row(0), broken])
        with pytest.raises(Exception, match="invalid manifest row"):
            manifest.read_manifest(spark, bad).collect()


def test_gates_order_nulls_and_nan(spark):
    rows = [(0.5, 100, 512, 1.0, 10.0, 0.5, 3.0, None), (5.0, 512, 512, None, None, None, None, 1.0), (5.0, 512, 512, 50.0, float("nan"), 0.01, 6.0, 60.0)]
    df = spark.createDataFrame(rows, "duration_sec double, width int, height int, blur_score double, brightness_score double, ocr_text_area_ratio double, aesthetic_score double, motion_score double")
    got = [r.reject_reasons for r in gates.gated(df, QualityConfig(min_aesthetic_score=5.0)).collect()]
    assert got[0] == ["duration_too_short", "resolution_too_low", "too_blurry", "too_dark", "text_or_watermark_likely", "aesthetic_score_too_low", "motion_unavailable"]
    assert got[1] == [] and got[2] == ["motion_too_fast_or_unstable"]


def test_captions(spark):
    said = "<think>plan\nmore</think> Final caption: A  red\ncar."
    assert one(spark, text.sanitised(F.col("t")), t=said) == "A red car."
    reasons = lambda t: one(spark, text.caption_reasons(F.col("t")), t=t)
    assert reasons("The user wants a logo") == ["caption_contains_reasoning", "caption_mentions_text_overlay"]
    assert reasons("A public event scene with") == ["caption_incomplete"]
    assert reasons(None) == ["caption_empty"] and reasons(" \t ") == ["caption_empty"]
    assert "Motion estimate: unknown motion." in one(spark, text.prompt(F.col("t")), t="")
    assert one(spark, text.plain_caption(F.lit(20.0), F.lit(None))) == "A dark video clip; motion not estimated."
    assert one(spark, text.safe_name(F.col("t")), t="__ My Clip!.MP4 ") == "my_clip__mp4"
    assert one(spark, text.training_caption(F.col("t"), F.lit(" pans. "), " photo "), t="") == "photo A curated video frame. pans."
    assert len(one(spark, text.caption_tokens(F.col("t")), t="A b. c, a")) == 32


def test_hashes_and_distance(spark):
    frame = np.zeros((32, 32, 3), np.uint8)
    frame[:, 16:] = 255
    assert image.frame_hash(frame) == "0f" * 8 and image.frame_hash(frame) == image.frame_hash(frame)
    assert one(spark, hashing.distance(F.lit("0" * 16), F.lit("0" * 15 + "3"))) == 2
    with pytest.raises(Exception, match="hash lengths differ"):
        one(spark, hashing.distance(F.lit("00"), F.lit("000")))
    with pytest.raises(ValueError):
        image.frame_hash(frame, 1)


def leaders(hashes, threshold):
    anchors, pairs = [], []
    for i, h in enumerate(hashes):
        near = [((h ^ hashes[a]).bit_count(), a) for a in anchors if (h ^ hashes[a]).bit_count() <= threshold]
        if near:
            d, a = min(near)
            pairs.append((i, a, d))
        else:
            anchors.append(i)
    return pairs


@pytest.mark.parametrize("threshold", [0, 6, 9, 20])
def test_leader_clustering_matches_the_sequential_scan(spark, threshold):
    rng = random.Random(threshold)
    centres = [rng.getrandbits(64) for _ in range(6)]
    hashes = [rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 8))) for _ in range(80)]
    rows = [(i, f"c{i}", f"{h:016x}") for i, h in enumerate(hashes)] + [(80, "none", None)]
    df = spark.createDataFrame(rows, "row_pos long, clip_id string, perceptual_hash string")
    got = sorted((r.row_pos, int(r.duplicate_of[1:]), r.distance) for r in dedupe.duplicate_pairs(df, threshold).collect())
    assert got == leaders(hashes, threshold)


def test_mark_duplicates(spark):
    rows = [(0, "a", "0" * 16, True, []), (1, "b", "0" * 15 + "3", True, ["x"]), (2, "c", "f" * 16, True, [])]
    df = spark.createDataFrame(rows, "row_pos long, clip_id string, perceptual_hash string, keep boolean, reject_reasons array<string>")
    got = {r.clip_id: (r.keep, r.duplicate_of, r.reject_reasons) for r in dedupe.mark_duplicates(df, 2).collect()}
    assert got == {"a": (True, None, []), "b": (False, "a", ["x", "near_duplicate"]), "c": (True, None, [])}


def test_kernels(spark):
    flat = np.full((32, 32, 3), 128, np.uint8)
    split = flat.copy()
    split[:, :16], split[:, 16:] = 0, 255
    a, b = image.frame_metrics(flat), image.frame_metrics(split)
    assert a["blur"] == a["contrast"] == a["text_area"] == 0 and a["brightness"] == 128
    assert b["blur"] > 0 and b["contrast"] == 127.5 and 0 < b["text_area"] < 0.2
    red = np.zeros((8, 8, 3), np.uint8)
    red[..., 2] = 255
    assert image.colourfulness(red) > image.colourfulness(flat)
    moved = [np.zeros((64, 64, 3), np.uint8) for _ in range(3)]
    for k, f in enumerate(moved):
        f[20:40, 6 * k + 8 : 6 * k + 28] = 255
    rows = [("m", i, 64, 64, 3, bytearray(f.tobytes())) for i, f in enumerate(moved)]
    frames = spark.createDataFrame(rows, "clip_id string, frame_pos long, height int, width int, nChannels int, data binary")
    m = measures.motion_metrics(measures.flow(frames)).first()
    assert m.motion_p95_score >= m.motion_score and 0 <= m.motion_stability_score <= 1
    q = measures.clip_quality(measures.measured(frames)).first()
    assert q.brightness_score > 0 and q.text_area_score > 0
    assert measures.motion_metrics(measures.flow(frames.filter("frame_pos = 0"))).count() == 0


def test_selection_matches_linspace(spark):
    cases = [(n, k) for n in (0, 1, 5, 6, 9, 123, 500) for k in (1, 3, 8, 15)]
    df = spark.createDataFrame([(n,) for n in sorted({n for n, _ in cases})], "n int")
    for k in (1, 3, 8, 15):
        for r in df.select("n", image.evenly_spaced(F.col("n"), k).alias("i")).collect():
            want = list(range(r.n)) if r.n <= k else np.linspace(0, r.n - 1, num=k, dtype=int).tolist()
            assert r.i == want, (r.n, k)
    with pytest.raises(ValueError):
        image.evenly_spaced(F.lit(3), 0)


def test_box_ratio(spark):
    rows = [(1, "0.9", 0.0, 0.0, 20.0, 10.0, 1e4), (1, "0.1", 0.0, 0.0, 50.0, 50.0, 1e4), (1, "bad", 0.0, 0.0, 50.0, 50.0, 1e4)]
    df = spark.createDataFrame(rows, "clip_id int, conf string, x_min double, y_min double, x_max double, y_max double, frame_area double")
    assert measures.box_ratio(df, "clip_id", 0.35).first().text_ratio == 0.02
    for bad in (lambda: measures.text_detector("x"), lambda: measures.aesthetic_scorer("x"), lambda: captioning.captioned(df, "x")):
        with pytest.raises(ValueError):
            bad()


def test_report(spark):
    rows = [("a", True, None, []), ("b", False, None, ["too_blurry"]), ("c", False, "a", ["near_duplicate"])]
    df = spark.createDataFrame(rows, "clip_id string, keep boolean, duplicate_of string, reject_reasons array<string>").withColumn("motion_score", F.lit(1.5))
    s = report.summary_with_reasons(df).first().asDict()
    assert (s["total_clips"], s["accepted_clips"], s["rejected_clips"], s["duplicate_clips"]) == (3, 1, 2, 1) and abs(s["acceptance_rate"] - 1 / 3) < 1e-12
    assert s["reject_reasons"] == {"near_duplicate": 1, "too_blurry": 1}
    page = report.markdown(s)
    assert "| Acceptance rate | 33.3% |" in page and "| Average motion score | 1.50 |" in page and "| `too_blurry` | 1 |" in page and "n/a" in page
    assert report.summary(df.filter("false")).first().acceptance_rate == 0.0
    assert report.throughput(df.limit(2), 30.0).first().clips_per_minute == 4.0


def test_review_and_export(spark):
    df = spark.createDataFrame([(i, f"c{i}", i % 2 == 0, None if i == 3 else f"cap {i}", ["r"] if i % 2 else []) for i in range(5)], "row_pos long, clip_id string, keep boolean, caption string, reject_reasons array<string>")
    df = df.withColumn("source_path", F.concat(F.lit("v/"), "clip_id", F.lit(".mp4")))
    assert [r.clip_id for r in review.filtered(df, search="NONE").collect()] == ["c3"]
    assert review.filtered(df, keep=False, reasons=["r", "q"]).count() == 2
    assert [r.row_pos for r in review.page(df, 9, 2).collect()] == [4]
    files = spark.createDataFrame([("file:/base/v/c0.mp4",), ("file:///base/v/c4.mp4",)], "path string")
    got = export.counts(export.resolved(export.selected(df, 2), files, ["/x", "/base"]), 3).first()
    assert (got.image_count, got.source_clip_count, got.skipped_clip_count) == (3, 2, 1)
    assert review.upload_verdict(spark.createDataFrame([(60 * 1024 * 1024,)], "size long")).first().verdict == "file_too_large"


def test_caption_queries_read_whole_texts(spark, tmp_path):
    from reelsift.plans.registry import QUERIES

    filler = "calm fields under a pale sky. " * 400
    said = {7: filler + "<think>hid\nden</think> A visible\t\u3000logo, none\n of it known.", 15: filler + "Final  caption:\n A red  car.", 23: filler, 31: None, 12: filler + "Dense caption: Provided frames " + filler}
    spark.createDataFrame(list(said.items()), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k,) for k in said], "o_orderkey long").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))

    def brute(k):
        if said[k] is None:
            return None
        t = f"Clip {k} shows {said[k]} here." + (" A public event scene with" if k % 8 == 4 else "")
        t = re.sub(fixed.THINK_TAG, "", re.sub(fixed.THINK_BLOCK, "", t)).strip()
        found = re.search(fixed.FINAL_CAPTION, t)
        return " ".join(re.sub(fixed.CAPTION_PREFIX, "", (found[1] if found else t).strip()).split())

    run = lambda name: {r[0]: r for r in QUERIES[name](spark, str(tmp_path)).collect()}
    got = run("caption_sanitize")
    assert {k: r.caption for k, r in got.items()} == {k: brute(k) for k in said} and len(got[23].caption) > len(filler) and got[15].caption == "A red car. here."
    reasons = {k: r.reasons for k, r in run("caption_reasons").items()}
    assert reasons == {7: "caption_mentions_text_overlay", 15: "", 23: "", 31: "caption_empty", 12: "caption_contains_reasoning,caption_incomplete"}
    assert {k for k, r in run("caption_incomplete").items() if r.incomplete} == {12}
    assert all(brute(k) in r.caption for k, r in run("training_caption").items() if brute(k))
    ids = {r.row_pos: r.clip_id for r in fixtures.manifest(spark, str(tmp_path)).collect()}
    assert all(run("gate_all_keep")[ids[k]].reasons.endswith(x) for k, x in reasons.items())
    assert set(run("review_search")) == {ids[7], ids[31]}


def test_scenes_and_commands(spark):
    rows = [("v.mp4", i, 30.0 if i in (5, 20, 25, 40) else 1.0) for i in range(60)]
    s = spark.createDataFrame(rows, "video string, i long, v double")
    cuts = scenes.cuts(s)
    assert cuts.first().cuts == [5, 20, 40]
    seg = scenes.segments(cuts, s.groupBy("video").agg(F.count("*").alias("frames"))).orderBy("scene_index").collect()
    assert len(seg) == 4 and seg[1].clip_path == "data/clips/v/v_scene_0001.mp4" and seg[3].end_sec == 2.5
    whole = scenes.segments(cuts.filter("false"), s.groupBy("video").agg(F.count("*").alias("frames"))).collect()
    assert [(w.start_sec, w.end_sec) for w in whole] == [(0.0, 2.5)]
    args = one(spark, scenes.cut_command(F.lit("a b"), F.lit("o"), F.lit(1.0), F.lit(3.5), SceneSplitConfig(output_fps=12, output_width=320, output_height=240, crf=20)))
    assert args[3] == "1.000" and args[7] == "2.500" and "20" in args and "fps=12" in args[9]
    with pytest.raises(ValueError):
        scenes.cuts(s, SceneSplitConfig(detector="other"))
    assert "'scripts/my train.py'" in training.LoraCommand(script="scripts/my train.py", rank=4).shell()


def test_estimates_and_config(spark):
    assert training.training_estimate(128, 32, 2)["steps"] == 8
    got = {r.name: (r.seconds, r.peak_vram_mb) for r in training.inference_estimates(spark).collect()}
    assert got["memory_sliced_30_steps"] == (33.696, 4329.6) and got["compile_8_steps"] == (7.04, 6000.0)
    assert len(one(spark, training.features(["x"]))) == 16
    assert config_from(None) == AppConfig()
    assert config_from({"quality": {"min_width": "64", "odd": 1}}).quality.min_width == 64
    with pytest.raises(ValueError):
        manifest.training_rows(manifest.synthetic_rows(spark, 3).filter("false"), 5)
    assert len(fixed.SCENARIOS) == 4


def test_stream_appends_gated_rows(spark, tmp_path):
    from reelsift.streaming import append

    (tmp_path / "in").mkdir()
    write_rows(tmp_path / "in/a.json", [base_row(0, motion_score=1.0, perceptual_hash="0" * 16), base_row(1, motion_score=1.0, perceptual_hash="0" * 15 + "1")])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    append.start(spark, str(tmp_path / "in"), out, ck, threshold=2).awaitTermination()
    write_rows(tmp_path / "in/b.json", [base_row(2, motion_score=1.0, perceptual_hash="0" * 15 + "3"), base_row(3)])
    append.start(spark, str(tmp_path / "in"), out, ck, threshold=2).awaitTermination()
    got = {r.clip_id: (r.keep, r.duplicate_of, r.reject_reasons) for r in manifest.read_manifest(spark, out).collect()}
    assert got["c0"][0] and got["c1"] == (False, "c0", ["near_duplicate"]) and got["c2"] == (False, "c0", ["near_duplicate"]) and got["c3"][2] == ["motion_unavailable"]


def test_entry_and_sql_agree_on_names():
    import __spark_entry__

    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and "manifest_summary" in q


def test_commands(spark, tmp_path):
    from reelsift import cli

    rows = [base_row(0, perceptual_hash="0" * 16), base_row(1, perceptual_hash="0" * 15 + "1"), base_row(2, keep=False, reject_reasons=["too_dark"])]
    p = write_rows(tmp_path / "m.jsonl", rows)
    cli.dedupe_manifest(spark, p, str(tmp_path / "d"), 2)
    got = cli.summarize(spark, str(tmp_path / "d"), str(tmp_path / "s.md"))
    assert (got["total_clips"], got["accepted_clips"], got["duplicate_clips"]) == (3, 1, 1) and "near_duplicate" in (tmp_path / "s.md").read_text()

    def probe(files, n):
        f = np.zeros((64, 64, 3), np.uint8)
        f[10:30, 10:30] = 255
        raw = files.select("clip_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("frame_pos"))
        images = raw.select("clip_id", F.col("frame_pos").cast("long"), F.lit(64).alias("height"), F.lit(64).alias("width"), F.lit(3).alias("nChannels"), F.lit(bytearray(f.tobytes())).alias("data"))
        meta = files.select("clip_id", F.lit(2.0).alias("duration_sec"), F.lit(24.0).alias("fps"), F.lit(512).alias("width"), F.lit(512).alias("height"), F.lit(48).alias("frame_count"))
        return images, meta

    (tmp_path / "v/deep").mkdir(parents=True)
    for name in ("v/b.MP4", "v/deep/a.webm", "v/no.txt"):
        (tmp_path / name).write_bytes(b"x")
    out = cli.process_folder(spark, str(tmp_path / "v"), AppConfig(), frames.of_videos(probe)).collect()
    assert len(out) == 2 and all(r.reject_reasons == ["too_static"] and len(r.perceptual_hash) == 16 for r in out)


def test_manifest_order_follows_files_and_lines(spark, tmp_path):
    row = lambda k: json.dumps({"clip_id": f"c{k}", "source_path": f"/v/{k}.mp4", "duration_sec": 2.0, "width": 512, "height": 512, "fps": 24.0, "frame_count": 48, "keep": True, "reject_reasons": []})
    sizes, k = (1, 50, 3, 400, 2), 0
    for i, n in enumerate(sizes):
        (tmp_path / f"part-{i}.json").write_text("\n".join(row(k + j) for j in range(n)) + "\n")
        k += n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = manifest.read_manifest(spark, str(tmp_path)).orderBy("row_pos").select("clip_id", "row_pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.clip_id for r in rows] == [f"c{j}" for j in range(k)] and len({r.row_pos for r in rows}) == k


def test_broken_manifests_fail_whatever_is_read(spark, tmp_path):
    good = {"clip_id": "a", "source_path": "/v/a.mp4", "duration_sec": 2.0, "width": 512, "height": 512, "fps": 24.0, "frame_count": 48, "keep": True}
    for k, bad in enumerate(('{"keep": true}', "rubbish", json.dumps(good | {"width": "wide"}))):
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps(good) + "\n\n" + bad + "\n")
        m = manifest.read_manifest(spark, str(path))
        for use in (report.summary(m), m.select(F.count("*")), m.select("keep")):
            with pytest.raises(Exception, match="invalid manifest row"):
                use.collect()


@pytest.mark.parametrize(("threshold", "bands"), [(0, 1), (3, 1), (6, 2), (6, 3), (6, 4), (7, 5), (18, 5), (18, 8)])
def test_close_pairs_are_whole_with_any_banding(spark, threshold, bands):
    rng = random.Random(threshold * 10 + bands)
    base = [rng.getrandbits(64) for _ in range(12)]
    hs = {x for b in base for x in [b, *(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, threshold + 2))) for _ in range(6))]}
    hs = [(h - (1 << 64) if h >> 63 else h, i) for i, h in enumerate(sorted(hs))]
    if math.comb(64 // bands, threshold // bands // 2 + threshold // bands % 2) > 5000:
        return
    got = {(r.u, r.v, r.distance) for r in dedupe.close_pairs(spark.createDataFrame(hs, "h long, pos long"), threshold, bands).collect()}
    mask = (1 << 64) - 1
    want = {(i, j, d) for a, i in hs for b, j in hs if i < j and (d := ((a ^ b) & mask).bit_count()) <= threshold}
    assert got == want


def test_banding_follows_the_number_of_hashes():
    assert [dedupe.banding(n, 6)[0] for n in (10**5, 10**6, 10**7)] == [4, 3, 2]


def test_image_folder_to_manifest(spark, tmp_path):
    import struct
    import zlib

    def png(path, value, w=300, h=280):
        rows = b"".join(b"\0" + bytes((value + 7 * x + 3 * y) % 256 for x in range(w) for _ in range(3)) for y in range(h))
        chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
        path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))

    for clip, n in (("one", 30), ("two", 1)):
        (tmp_path / "in" / clip).mkdir(parents=True)
        for i in range(n):
            png(tmp_path / "in" / clip / f"{i:03d}.png", 40 + i)
    cfg = schema.config_from({"aesthetic": {"provider": "heuristic"}, "quality": {"min_aesthetic_score": 9.9}})
    rows = cli.process_folder(spark, str(tmp_path / "in"), cfg).orderBy("row_pos").collect()
    one, two = rows
    assert one.source_path.endswith("/one") and (one.frame_count, one.width, one.height, one.duration_sec) == (30, 300, 280, 1.25)
    assert one.blur_score > 0 and one.motion_score is not None and len(one.perceptual_hash) == 16 and "aesthetic_score_too_low" in one.reject_reasons
    assert two.motion_score is None and {"motion_unavailable", "duration_too_short"} <= set(two.reject_reasons) and two.caption
    cli.main(["process-folder", str(tmp_path / "in"), "--output", str(tmp_path / "m")])
    assert manifest.read_manifest(spark, str(tmp_path / "m")).count() == 2
    relaxed = review.relaxed(manifest.read_manifest(spark, str(tmp_path / "m"))).withColumn("source_path", F.concat("source_path", F.lit("/000.png")))
    absent = relaxed.limit(1).withColumns({"clip_id": F.lit("gone"), "source_path": F.lit("/nowhere/x.mp4")})
    manifest.write_manifest(relaxed.unionByName(absent), str(tmp_path / "r"))
    out = ["prepare-diffusion-lora-data", str(tmp_path / "r"), "--output-dir", str(tmp_path / "d"), "--report", str(tmp_path / "p.md"), "--json-report", str(tmp_path / "p.json"), "--frames-per-clip", "2"]
    with pytest.raises(SystemExit, match="no source file"):
        cli.main(out)
    cli.main([*out, "--allow-missing"])
    got = json.loads((tmp_path / "p.json").read_text())
    assert (got["image_count"], got["source_clip_count"], got["skipped_clip_count"]) == (4, 3, 1) and spark.read.json(str(tmp_path / "d" / "metadata")).count() == 4


def test_stream_replay_and_anchors(spark, tmp_path):
    row = lambda k, h: json.dumps({"clip_id": k, "source_path": "/v", "duration_sec": 5.0, "width": 512, "height": 512, "fps": 24.0, "frame_count": 48, "perceptual_hash": h, "motion_score": 2.0})
    (tmp_path / "in").mkdir()
    batches = ([row("a", "00000000000000ff"), row("b", "ffff000000000000")], [row("c", "00000000000000fe"), row("d", "0f0f0f0f0f0f0f0f")], [row("e", "0f0f0f0f0f0f0f0e"), row("f", "00000000000000fc")])
    for k, lines in enumerate(batches):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(lines))
        append.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), threshold=4).awaitTermination()
    got = {r.clip_id: r.duplicate_of for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert got == {"a": None, "b": None, "c": "a", "d": None, "e": "d", "f": "a"}


def grads(loss, p, name, at, step=1e-5):
    out = []
    for sign in (1, -1):
        q = {k: v.copy() for k, v in p.items()}
        q[name][at] += sign * step
        out.append(loss(q))
    return (out[0] - out[1]) / (2 * step)


def test_two_towers_learn_and_have_true_gradients(spark):
    cfg = two_tower.TwoTowerConfig(samples=24, batch_size=8, epochs=12, feature_dim=16, vocab_size=64, tokens=6, hidden_dim=10, embedding_dim=5, learning_rate=0.02)
    rng = np.random.default_rng(1)
    x, t, p = rng.random((7, 16)), rng.integers(0, 64, (7, 6)), two_tower.parameters(cfg)
    _, g = two_tower.loss(p, x, t)
    for name, at in (("w1", (3, 2)), ("b1", 4), ("w2", (1, 3)), ("b2", 0), ("words", (int(t[0, 0]), 5)), ("gain", 2), ("shift", 3), ("w3", (2, 2)), ("b3", 1), ("scale", 0)):
        assert abs(grads(lambda q: two_tower.loss(q, x, t)[0], p, name, at) - g[name][at]) < 1e-6, name
    rows = manifest.synthetic_rows(spark, 30)
    report, q = two_tower.train(rows, cfg)
    fx, ft = two_tower.inputs(rows, cfg)
    assert (report["samples"], report["steps"]) == (24, 36)
    assert two_tower.loss(q, fx[:8], ft[:8])[0] < two_tower.loss(two_tower.parameters(cfg), fx[:8], ft[:8])[0]


def test_jpeg_is_read_back(spark, tmp_path):
    y, x = np.mgrid[:70, :93]
    frames_ = {"colour": np.stack([x * 2 % 230, y * 3 % 230, x + y], -1), "grey": np.sin(x / 5.0) * 100 + 128, "noise": np.random.default_rng(0).integers(0, 256, (9, 40, 3)), "dot": np.full((1, 1, 3), 200), "flat": np.zeros((16, 16, 3))}
    frames_ = {k: v.astype(np.uint8) for k, v in frames_.items()}
    (tmp_path / "j").mkdir()
    for k, v in frames_.items():
        (tmp_path / "j" / f"{k}.jpg").write_bytes(jpeg.encode(v, 95))
    got = {r.image.origin.rsplit("/", 1)[1][:-4]: r.image for r in spark.read.format("image").load(str(tmp_path / "j")).collect()}
    for k, v in frames_.items():
        back = image.of_samples(bytes(got[k].data), got[k].height, got[k].width, got[k].nChannels)
        assert back.shape == v.shape and np.abs(back.astype(int) - v).mean() < (4 if k == "noise" else 1.5), k


def test_hues_and_content_scores(spark):
    import colorsys

    px = np.random.default_rng(3).integers(0, 256, (20, 20, 3)).astype(np.uint8)
    for (b, g, r), (h, s, v) in zip(px.reshape(-1, 3).tolist(), image.hsv(px).reshape(-1, 3).tolist()):
        a = colorsys.rgb_to_hsv(r / 255, g / 255, b / 255)
        assert abs(a[0] * 180 - h) % 180 <= 0.51 or abs(a[0] * 180 - h) > 179.4
        assert abs(a[1] * 255 - s) <= 0.51 and max(b, g, r) == v
    red, blue = np.zeros((4, 4, 3), np.uint8), np.zeros((4, 4, 3), np.uint8)
    red[..., 2], blue[..., 0] = 255, 255
    rows = [("a", i, 4, 4, 3, bytearray(f.tobytes())) for i, f in enumerate([red, red, blue, blue])] + [("a", 4, 2, 2, 1, bytearray(4))]
    df = spark.createDataFrame(rows, "clip_id string, frame_pos long, height int, width int, nChannels int, data binary")
    assert [r.v for r in measures.content_scores(df).orderBy("i").collect()] == [0.0, 0.0, 40.0, 0.0, None]
    cfg = SceneSplitConfig(threshold=30.0, min_scene_len_frames=2)
    assert scenes.cuts(measures.content_scores(df), cfg).first().cuts == [2]
    assert measures.signatures(df).first().signature == image.frame_signature([red, red, blue, blue, np.zeros((2, 2), np.uint8)])
    assert measures.measured(df).count() == 5


def test_head_weights(tmp_path):
    path = str(tmp_path / "h.npz")
    np.savez(path, **{"linear.weight": np.arange(512.0)[None], "linear.bias": np.array([2.0])})
    w, b = measures.head_weights(path, "vit_b_32")
    assert len(w) == 512 and w[3] == 3.0 and b == 2.0
    (tmp_path / "h.json").write_text(json.dumps({"state_dict": {"weight": [0.0] * 768, "bias": [1.0]}}))
    assert measures.head_weights(str(tmp_path / "h.json"), "vit_l_14")[1] == 1.0
    for variant in ("vit_b_32", "other"):
        with pytest.raises(ValueError):
            measures.head_weights(str(tmp_path / "h.json"), variant)


def test_remote_captions(spark, tmp_path, monkeypatch):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen, reply = [], {"choices": [{"message": {"content": "Caption: A red car."}}]}

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            bad = self.path == "/bad"
            self.send_response(500 if bad else 200)
            self.end_headers()
            self.wfile.write(b"broken" if bad else json.dumps({} if self.path == "/odd" else reply).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    (tmp_path / "s.json").write_text('{"GROQ_API_KEY": "k"}')
    monkeypatch.delenv("GROQ_API_KEY", raising=False)
    with pytest.raises(ValueError, match="GROQ_API_KEY"):
        captioning.chat({"provider": "groq"})
    sent, most = captioning.chat({"provider": "groq", "base_url": f"{base}/ok", "max_keyframes": 9}, str(tmp_path / "s.json"))
    assert most == 3
    clips = spark.createDataFrame([("a", '[{"role":"user","content":"hi"}]')], "clip_id string, messages string")
    assert captioning.captioned(clips, "groq", sent).first().caption == "A red car."
    assert seen[0][0] == "Bearer k" and seen[0][1]["temperature"] == 0.2 and seen[0][1]["max_completion_tokens"] == 220
    for path, told in (("bad", "500 broken"), ("odd", "unexpected answer")):
        with pytest.raises(RuntimeError, match=told):
            captioning.chat({"provider": "openai", "api_key": "x", "base_url": f"{base}/{path}"})[0]("[]")
    server.shutdown()

    class Short:
        def batch(self, messages):
            return ["one"]

    assert captioning.answers(Short(), ["m"]) == ["one"]
    with pytest.raises(ValueError, match="another number"):
        captioning.answers(Short(), ["m", "n"])


def test_uploads_fail_one_by_one(spark, tmp_path):
    def decode(data):
        side = data[0]
        return [np.frombuffer(data[1:], np.uint8).reshape(side, side)]

    staged = uploads.stage([("a.MOV", bytes([2, 1, 2, 3, 4])), ("bad", b"\x03xx"), ("../c.mp4", b"")], str(tmp_path / "up"))
    assert [p.rsplit(".", 1)[1] for _, p in staged] == ["mov", "mp4", "mp4"] and all(p.startswith(str(tmp_path / "up")) for _, p in staged)
    good, bad = uploads.split(uploads.decoded(spark, staged, decode))
    assert [(r.source_path, r.height, bytes(r.data)) for r in good.collect()] == [(staged[0][1], 2, bytes([1, 2, 3, 4]))]
    assert {r.name for r in bad.collect()} == {"bad", "../c.mp4"} and uploads.decoded(spark, [], decode).isEmpty()


def test_scenes_and_images_from_folders(spark, tmp_path):
    for clip, n in (("one", 6), ("two", 1)):
        (tmp_path / "in" / clip).mkdir(parents=True)
        for i in range(n):
            f = np.zeros((20, 30, 3), np.uint8)
            f[..., 0 if i < 3 else 2] = 250
            (tmp_path / "in" / clip / f"{i}.jpg").write_bytes(jpeg.encode(f, 95))
    (tmp_path / "c.json").write_text('{"scene_split": {"min_scene_len_frames": 2}}')
    cli.main(["split-scenes", str(tmp_path / "in"), "--config", str(tmp_path / "c.json"), "--output", str(tmp_path / "s")])
    got = spark.read.json(str(tmp_path / "s")).orderBy("video", "scene_index").collect()
    assert [(r.video.rsplit("/", 1)[1], r.start_sec, r.end_sec) for r in got] == [("one", 0.0, 0.125), ("one", 0.125, 0.25), ("two", 0.0, 1 / 24)]
    rows = [base_row(i, source_path=str(tmp_path / "in" / name)) for i, name in enumerate(("one", "two"))]
    (tmp_path / "in" / "three").mkdir()  # there, but without frames
    p = write_rows(tmp_path / "m.jsonl", [*rows, base_row(2, source_path=str(tmp_path / "in" / "three"))])
    cli.main(["prepare-diffusion-lora-data", p, "--frames", str(tmp_path / "in"), "--frames-per-clip", "2", "--resolution", "16", "--output-dir", str(tmp_path / "d"), "--report", str(tmp_path / "p.md"), "--json-report", str(tmp_path / "p.json")])
    report_ = json.loads((tmp_path / "p.json").read_text())
    assert (report_["image_count"], report_["source_clip_count"], report_["skipped_clip_count"]) == (3, 3, 1)
    named = {r.file_name for r in spark.read.json(str(tmp_path / "d" / "metadata")).collect()}
    assert named == {f"images/{p.name}" for p in (tmp_path / "d" / "images").iterdir()} == {"images/c0_000.jpg", "images/c0_001.jpg", "images/c1_000.jpg"}
    assert {r.image.width for r in spark.read.format("image").load(str(tmp_path / "d" / "images")).collect()} == {16}
    cli.main(["benchmark-training", "--real", "--samples", "40", "--output", str(tmp_path / "t.json"), "--markdown-output", str(tmp_path / "t.md")])
    assert json.loads((tmp_path / "t.json").read_text())["final_loss"] > 0


def test_many_bits_compare_directly(spark, tmp_path):
    """Near copies of many bits, in more blocks and rounds than one: the pairs and leaders of brute force, without a join that outgrows them."""
    assert dedupe.banding(100_000, 18)[1] < 2e8 and dedupe.banding(100_000, 6)[0] > 0
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(40)]
    hashes = [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 14))) for c in centres for _ in range(12)]
    rng.shuffle(hashes)
    hashes += hashes[:30] + [0, 2**64 - 1]
    signed = [h - (1 << 64) if h >> 63 else h for h in hashes]
    firsts = {h: i for i, h in reversed(list(enumerate(signed)))}
    want = sorted((min(i, j), max(i, j), d) for (g, i), (h, j) in itertools.combinations(firsts.items(), 2) if (d := ((g ^ h) & (2**64 - 1)).bit_count()) <= 18)
    table = spark.createDataFrame(list(firsts.items()), "h long, pos long")
    for block in (70, 10_000):
        assert sorted(map(tuple, dedupe.compared(table, 18, len(firsts), block).collect())) == want
    for bands in (None, 4):
        assert sorted(map(tuple, dedupe.close_pairs(table, 18, bands).collect())) == want
    df = spark.createDataFrame([(i, f"c{i}", f"{h:016x}") for i, h in enumerate(hashes)], "row_pos long, clip_id string, perceptual_hash string")
    run = lambda t: sorted((r.row_pos, int(r.duplicate_of[1:]), r.distance) for r in dedupe.duplicate_pairs(df, t).collect())
    assert run(18) == leaders(hashes, 18)
    near = sorted(map(tuple, dedupe.near_anchors(table, 18, str(tmp_path / "a"), scanned=16).collect()))
    assert near == sorted(map(tuple, dedupe._joined_anchors(table, 18, str(tmp_path / "b"), 4).collect()))
    assert dedupe.duplicate_pairs(df.filter("false"), 18).isEmpty() and dedupe.close_pairs(table.filter("false"), 18).isEmpty()


def test_hamming_pairs_with_copies(spark, tmp_path, monkeypatch):
    """All pairs of rows, copies among them, from direct comparison."""
    from reelsift.plans.registry import HASH_LIMIT, QUERIES

    direct, calls = dedupe.compared, []
    monkeypatch.setattr(dedupe, "compared", lambda *a: calls.append(a) or direct(*a, block=40))
    rng = random.Random(9)
    base = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in base[i % 5]]) for i in range(110)]
    rows += [(110 + i, v) for i, (_, v) in enumerate(rows[:10])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    hashes = {int(r.clip_id): int(r.perceptual_hash, 16) for r in QUERIES["frame_hash"](spark, str(tmp_path)).collect()}
    want = sorted((i, j, d) for i, j in itertools.combinations(sorted(hashes), 2) if (d := (hashes[i] ^ hashes[j]).bit_count()) <= HASH_LIMIT)
    assert sorted(map(tuple, QUERIES["hamming_pairs"](spark, str(tmp_path)).collect())) == want and calls


def test_marks_need_no_pairs_of_near_copies(spark, monkeypatch):
    """Marks of many near copies come from comparing rows with anchors alone."""
    monkeypatch.setattr(dedupe, "close_pairs", lambda *a: pytest.fail("all pairs of near copies are listed"))
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(3)]
    hashes = [rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 12))) for _ in range(150)]
    rows = [(i, f"c{i}", f"{h:016x}", True, []) for i, h in enumerate(hashes)] + [(150, "none", None, True, []), (151, "bad", "", True, [])]
    df = spark.createDataFrame(rows, "row_pos long, clip_id string, perceptual_hash string, keep boolean, reject_reasons array<string>")
    got = {r.clip_id: r.duplicate_of for r in dedupe.mark_duplicates(df, 18).collect() if not r.keep}
    assert got == {f"c{i}": f"c{a}" for i, a, _ in leaders(hashes, 18)}


def test_marks_sort_once_in_a_task(spark, monkeypatch):
    """Each duplicate meets its nearest earlier anchor alone, and no aggregate stands in one task with a join's sorts."""
    written, cut = {}, dedupe.cut
    monkeypatch.setattr(dedupe, "cut", lambda df, path: written.setdefault(path.rsplit("/", 1)[1], cut(df, path)))
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(3)]
    hashes = [rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(6, 16))) for _ in range(200)]
    hashes += rng.sample(hashes, 100)  # copies, which later anchors may be closer to
    rows = [(i, f"c{i}", f"{h:016x}", True, []) for i, h in enumerate(hashes)]
    df = spark.createDataFrame(rows, "row_pos long, clip_id string, perceptual_hash string, keep boolean, reject_reasons array<string>")
    marked, want = dedupe.mark_duplicates(df, 18), {f"c{i}": f"c{a}" for i, a, _ in leaders(hashes, 18)}
    assert {r.clip_id: r.duplicate_of for r in marked.collect() if not r.keep} == want
    assert written["found"].count() == len(want)
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
