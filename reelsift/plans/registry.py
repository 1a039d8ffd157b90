"""Named queries over the test tables, each with SQL that computes the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift import fixed, scratch
from reelsift.functions import hashing, image, text
from reelsift.operators import captioning, dedupe, export, gates, measures, report, review, scenes, training
from reelsift.schema import QualityConfig
from reelsift.sources import fixtures, manifest

CFG = QualityConfig(min_aesthetic_score=4.0)
HASH_LIMIT = 18
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_BODIES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            _BODIES[f.__name__] = sql
        return f

    return add


def _clips(spark, sf):
    return gates.gated(fixtures.manifest(spark, sf), CFG)


def _joined(df, *cols):
    return df.select(*cols, F.array_join("reject_reasons", ",").alias("reasons"))


_R = "list_filter([case when duration_sec<1 then 'duration_too_short' end, case when duration_sec>20 then 'duration_too_long' end, case when width<256 or height<256 then 'resolution_too_low' end, case when blur_score<40 then 'too_blurry' end, case when brightness_score<20 then 'too_dark' end, case when brightness_score>235 then 'too_bright' end, case when ocr_text_area_ratio>0.08 then 'text_or_watermark_likely' end, case when aesthetic_score<4 then 'aesthetic_score_too_low' end{more}], lambda x: x is not null)"
_M = "case when motion_score is null then 'motion_unavailable' when motion_score<0.2 then 'too_static' when motion_score>50 then 'motion_too_fast_or_unstable' end"
_CLIPS = f"m as ({fixtures.MANIFEST_SQL}), g as (select *, {_R.format(more=', ' + _M)} r from m), c as (select *, len(r) = 0 keep from g)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_S1 = _STRIP.format(f"regexp_replace(regexp_replace(raw_text, {_q(fixed.THINK_BLOCK)}, '', 'g'), {_q(fixed.THINK_TAG)}, '', 'g')")
_CAPS = f"""x as ({fixtures.CAPTIONS_SQL}), x1 as (select row_pos, {_S1} a from x),
x2 as (select row_pos, {_STRIP.format(f"case when regexp_matches(a, {_q(fixed.FINAL_CAPTION)}) then regexp_extract(a, {_q(fixed.FINAL_CAPTION)}, 1) else a end")} a from x1),
x3 as (select row_pos, {_STRIP.format(f"regexp_replace(regexp_replace(a, {_q(fixed.CAPTION_PREFIX)}, ''), '\\s+', ' ', 'g')")} caption from x2),
cap as (select row_pos, caption, case when coalesce(caption, '') = '' then ['caption_empty'] else list_filter([case when regexp_matches(caption, {_q(fixed.ANALYSIS_MARKER)}) then 'caption_contains_reasoning' end,
 case when regexp_matches(caption, {_q(fixed.TEXT_ARTIFACT)}) then 'caption_mentions_text_overlay' end,
 case when not regexp_matches(caption, '[.!?]$') and regexp_matches(caption, {_q(fixed.INCOMPLETE_END)}) then 'caption_incomplete' end], lambda x: x is not null) end cr from x3)"""
_FRAMES = f"f as ({fixtures.FRAMES_DUCK})"


# --- gates and summaries ---------------------------------------------------------


@query(f"with m as ({fixtures.MANIFEST_SQL}) select clip_id, array_to_string({_R.format(more='')}, ',') reasons from m")
def gate_quality_reasons(spark, sf):
    return fixtures.manifest(spark, sf).select("clip_id", F.array_join(gates.quality_reasons(CFG), ",").alias("reasons"))


@query(f"with m as ({fixtures.MANIFEST_SQL}) select clip_id, coalesce({_M}, '') reasons from m")
def gate_motion_reasons(spark, sf):
    return fixtures.manifest(spark, sf).select("clip_id", F.array_join(gates.motion_reasons(CFG), ",").alias("reasons"))


@query(f"with {_CLIPS}, {_CAPS} select clip_id, array_to_string(list_concat(r, coalesce(cr, ['caption_empty'])), ',') reasons, len(list_concat(r, coalesce(cr, ['caption_empty']))) = 0 keep from c left join cap using (row_pos)")
def gate_all_keep(spark, sf):
    caps = fixtures.captions(spark, sf).select("row_pos", text.sanitised(F.col("raw_text")).alias("caption"))
    rows = fixtures.manifest(spark, sf).join(caps, "row_pos", "left")
    return _joined(gates.gated(rows, CFG, "caption"), "clip_id", "keep")


@query(f"with {_CLIPS} select count(*) total_clips, count(*) filter (keep) accepted_clips, count(*) filter (not keep) rejected_clips, cast(0 as bigint) duplicate_clips, round(coalesce(count(*) filter (keep) / nullif(count(*), 0), 0), 6) acceptance_rate, round(avg(aesthetic_score), 6) average_aesthetic_score, round(avg(motion_score), 6) average_motion_score, round(avg(contrast_score), 6) average_contrast_score, round(avg(colorfulness_score), 6) average_colorfulness_score from c")
def manifest_summary(spark, sf):
    out = report.summary(_clips(spark, sf))
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])


@query(f"with {_CLIPS} select reason, count(*) n from (select unnest(r) reason from c) group by reason order by reason")
def reason_histogram(spark, sf):
    return report.reason_counts(_clips(spark, sf)).orderBy("reason")


@query(f"with {_CLIPS} select reason, count(*) n from (select unnest(r) reason from c) group by reason order by n desc, reason")
def reason_histogram_desc(spark, sf):
    return report.reason_counts(_clips(spark, sf)).orderBy(F.desc("n"), "reason")


@query(f"with {_CLIPS} select distinct reason from (select unnest(r) reason from c)")
def reason_distinct(spark, sf):
    return report.reason_counts(_clips(spark, sf)).select("reason").orderBy("reason")


@query(f"with {_CLIPS} select reason, count(*) n from (select unnest(r) reason from c where not keep) group by reason")
def rejected_reason_counts(spark, sf):
    return report.reason_counts(_clips(spark, sf), rejected_only=True)


@query(f"with {_CLIPS} select 'single' as mode, 30e0 as seconds, count(*) clips, count(*) filter (keep) accepted, count(*) filter (not keep) rejected, round(count(*) * (60e0 / 30e0), 6) clips_per_minute from c")
def throughput_summary(spark, sf):
    return report.throughput(_clips(spark, sf), 30.0).withColumn("clips_per_minute", F.round("clips_per_minute", 6))


@query(f"with {_CLIPS} select count(*) clips, count(*) filter (keep) accepted, count(*) filter (not keep) rejected, cast(0 as bigint) duplicates, round(100e0 * count(*) filter (keep) / count(*), 6) yield_percent from c")
def review_kpis(spark, sf):
    return review.kpis(_clips(spark, sf).withColumn("duplicate_of", F.lit(None).cast("string"))).withColumn("yield_percent", F.round("yield_percent", 6))


@query(f"with {_CLIPS} select clip_id, row_pos from c where keep order by row_pos limit 100")
def accepted_head_limit(spark, sf):
    return export.selected(_clips(spark, sf), 100).select("clip_id", "row_pos")


@query(f"with {_CLIPS} select clip_id, array_to_string(r, ',') reasons from c where not keep and list_has_any(r, ['too_blurry', 'too_dark'])")
def review_filter_reason(spark, sf):
    return _joined(review.filtered(_clips(spark, sf), keep=False, reasons=["too_blurry", "too_dark"]), "clip_id")


@query(f"with {_CLIPS}, {_CAPS} select clip_id from c left join cap using (row_pos) where contains(lower(source_path), 'none') or contains(lower(coalesce(caption, 'none')), 'none')")
def review_search(spark, sf):
    caps = fixtures.captions(spark, sf).select("row_pos", text.sanitised(F.col("raw_text")).alias("caption"))
    return review.filtered(_clips(spark, sf).join(caps, "row_pos", "left"), search="none").select("clip_id")


@query(f"with {_CLIPS} select clip_id, row_pos from c order by row_pos limit 24 offset 72")
def review_page(spark, sf):
    return review.page(_clips(spark, sf), 3, 24).select("clip_id", "row_pos")


@query(f"with {_CLIPS} select row_pos x, 'blur_score' score, blur_score as value from c union all select row_pos, 'motion_score', motion_score from c")
def score_long(spark, sf):
    return review.score_series(_clips(spark, sf), ["blur_score", "motion_score", "absent_score"])


@query(f"with {_CLIPS} select clip_id, true keep, keep original_keep, array_to_string(r, ',') original_reasons from c")
def relax_manifest(spark, sf):
    return review.relaxed(_clips(spark, sf)).select("clip_id", "keep", "original_keep", F.array_join("original_reject_reasons", ",").alias("original_reasons"))


@query(f"with {_CLIPS} select clip_id, width||'x'||height as size, array_to_string(r, ', ') reasons from c")
def review_cards(spark, sf):
    return review.cards(_clips(spark, sf)).select("clip_id", "size", "reasons")


@query(f"with f as ({fixtures.FILES_SQL}), s as (select count(*) n_files, cast(max(size) as bigint) largest, cast(sum(size) as bigint) total from f) select *, case when n_files > 10 then 'too_many_files' when largest / 1048576e0 > 50 then 'file_too_large' when total / 1048576e0 > 250 then 'batch_too_large' end verdict from s")
def upload_limits(spark, sf):
    return review.upload_verdict(fixtures.files(spark, sf))


@query("with f as (select page_id, 'u'||page_id||case page_id%4 when 0 then '.MP4' when 1 then '.webm' when 2 then '.txt' else '.mkv' end p from pages) select p as path from f where lower(regexp_extract(p, '\\.[^.]*$')) in ('.mp4', '.mov', '.avi', '.mkv', '.webm')")
def video_listing(spark, sf):
    ext = F.element_at(F.array(*map(F.lit, (".MP4", ".webm", ".txt", ".mkv"))), (F.col("page_id") % 4 + 1).cast("int"))
    rows = spark.read.parquet(f"{sf}/pages.parquet").select(F.concat(F.lit("u"), F.col("page_id").cast("string"), ext).alias("path"))
    return rows.filter(manifest.is_video(F.col("path"))).orderBy("path")


@query("select o_orderkey k, substr(sha1('/data/'||cast(o_orderkey as varchar)||'.mp4'), 1, 16) clip_id from orders")
def stable_clip_id(spark, sf):
    path = F.concat(F.lit("/data/"), F.col("o_orderkey").cast("string"), F.lit(".mp4"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), text.clip_id(path).alias("clip_id"))


@query(f"with {_CLIPS} select * from (select clip_id, round(duration_sec, 6) duration_sec, fps, keep, array_to_string(r, ',') reasons from c)")
def manifest_roundtrip(spark, sf):
    path = scratch.folder(spark, "roundtrip")
    manifest.write_manifest(_clips(spark, sf), path)
    return _joined(manifest.read_manifest(spark, path).withColumn("duration_sec", F.round("duration_sec", 6)), "clip_id", "duration_sec", "fps", "keep")


# --- captions ----------------------------------------------------------------------


@query(f"with {_CAPS} select row_pos, caption from cap")
def caption_sanitize(spark, sf):
    return fixtures.captions(spark, sf).select("row_pos", text.sanitised(F.col("raw_text")).alias("caption"))


@query(f"with {_CAPS} select row_pos, array_to_string(cr, ',') reasons from cap")
def caption_reasons(spark, sf):
    rows = fixtures.captions(spark, sf).select("row_pos", text.sanitised(F.col("raw_text")).alias("c"))
    return rows.select("row_pos", F.array_join(text.caption_reasons(F.col("c")), ",").alias("reasons"))


@query(f"with {_CAPS} select row_pos, coalesce(not regexp_matches(caption, '[.!?]$') and regexp_matches(caption, {_q(fixed.INCOMPLETE_END)}), false) incomplete from cap")
def caption_incomplete(spark, sf):
    rows = fixtures.captions(spark, sf).select("row_pos", text.sanitised(F.col("raw_text")).alias("c"))
    return rows.select("row_pos", F.coalesce(text.incomplete(F.col("c")), F.lit(False)).alias("incomplete"))


_SENTENCE = f"case when motion_score < 0.5 then {_q(fixed.MOTION_STATIC)} when motion_score < 5 then {_q(fixed.MOTION_MODERATE)} when motion_score is not null then {_q(fixed.MOTION_FAST)} end"
_PROMPT = f"concat({_q(fixed.PROMPT_HEAD)}, coalesce({_SENTENCE}, {_q(fixed.NO_MOTION)}), {_q(fixed.PROMPT_TAIL)})"


@query(f"with m as ({fixtures.MANIFEST_SQL}) select clip_id, {_PROMPT} prompt from m")
def caption_prompt(spark, sf):
    return fixtures.manifest(spark, sf).select("clip_id", text.prompt(text.motion_sentence(F.col("motion_score"))).alias("prompt"))


@query(f"with m as ({fixtures.MANIFEST_SQL}) select clip_id, {_SENTENCE} motion_caption from m")
def motion_caption(spark, sf):
    return fixtures.manifest(spark, sf).select("clip_id", text.motion_sentence(F.col("motion_score")).alias("motion_caption"))


@query(f"with m as ({fixtures.MANIFEST_SQL}) select clip_id, case when brightness_score is null then {_q(fixed.NO_FRAMES)} else 'A '||case when brightness_score < 70 then 'dark' when brightness_score > 180 then 'bright' else 'normally lit' end||' video clip; '||coalesce({_SENTENCE}, {_q(fixed.NO_MOTION_ESTIMATE)})||'.' end caption from m")
def caption_heuristic(spark, sf):
    rows = fixtures.manifest(spark, sf).select("clip_id", F.col("brightness_score").alias("mean_pixel"), text.motion_sentence(F.col("motion_score")).alias("motion_caption"))
    return captioning.captioned(rows).select("clip_id", "caption")


@query(f"""with m as ({fixtures.MANIFEST_SQL}) select clip_id, '[{{"role":"user","content":[{{"type":"text","text":'||to_json({_PROMPT})||'}},{{"type":"image_url","image_url":{{"url":'||to_json('data:image/jpeg;base64,'||to_base64(encode(clip_id)))||',"detail":"low"}}}}]}}]' messages from m""")
def caption_messages_openai(spark, sf):
    rows = fixtures.manifest(spark, sf)
    urls = F.array(text.data_url(F.encode("clip_id", "utf-8")))
    return rows.select("clip_id", text.openai_messages(text.motion_sentence(F.col("motion_score")), urls).alias("messages"))


@query(f"""with m as ({fixtures.MANIFEST_SQL}) select clip_id, '[{{"role":"user","content":[{{"type":"image"}},{{"type":"image"}},{{"type":"text","text":'||to_json({_PROMPT})||'}}]}}]' qwen, '[{{"role":"user","content":'||to_json('<image>'||chr(10)||'<image>'||chr(10)||{_PROMPT})||'}}]' llava, '[{{"role":"user","content":'||to_json({_PROMPT})||'}}]' plain from m""")
def caption_messages_local(spark, sf):
    m = text.motion_sentence(F.col("motion_score"))
    rows = fixtures.manifest(spark, sf)
    return rows.select("clip_id", *[text.vlm_messages(m, F.lit(2), fam).alias(n) for fam, n in (("qwen2-vl", "qwen"), ("llava", "llava"), ("other", "plain"))])


def _cache(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("clip_id"), F.concat(F.lit("cached "), F.col("quality").cast("string")).alias("caption"))


@query("select doc_id clip_id, 'cached '||quality caption from documents join labels using (doc_id)")
def caption_cache_hits(spark, sf):
    clips = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("clip_id"))
    return captioning.cache_hits(clips, _cache(spark, sf))


@query("select doc_id clip_id from documents where doc_id not in (select doc_id from labels)")
def caption_cache_misses(spark, sf):
    clips = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("clip_id"))
    return captioning.cache_misses(clips, _cache(spark, sf))


@query(f"with {_CAPS} select row_pos, 'photo '||coalesce(nullif(caption, ''), {_q(fixed.DEFAULT_TRAINING_CAPTION)})||case when row_pos%2 = 0 then ' Slow pan.' else '' end caption from cap")
def training_caption(spark, sf):
    rows = fixtures.captions(spark, sf).select("row_pos", text.sanitised(F.col("raw_text")).alias("c"))
    motion = F.when(F.col("row_pos") % 2 == 0, " Slow pan. ")
    return rows.select("row_pos", text.training_caption(F.col("c"), motion, " photo ").alias("caption"))


@query(r"with n as (select doc_id, '  '||source||'/'||lang||'.'||doc_id||'!' v from documents) select doc_id, coalesce(nullif(regexp_replace(regexp_replace(lower(v), '[^\p{L}\p{N}_-]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'clip') safe, coalesce(nullif(regexp_replace(regexp_replace(lower(v), '[^\p{L}\p{N}_-]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'clip')||'_'||printf('%03d', doc_id%7)||'.jpg' file_name from n")
def safe_name(spark, sf):
    v = F.concat(F.lit("  "), "source", F.lit("/"), "lang", F.lit("."), F.col("doc_id").cast("string"), F.lit("!"))
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", text.safe_name(v).alias("safe"), text.image_name(v, F.col("doc_id") % 7).alias("file_name"))


@query(r"select doc_id, least(32, len(list_filter(regexp_split_to_array(translate(lower(text), '.,', '  '), '\s+'), lambda x: x <> ''))) n_tokens from documents")
def caption_token_counts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", F.size(text.caption_words(F.col("text"))).cast("long").alias("n_tokens"))


# --- hashes and duplicates --------------------------------------------------------------

_MED = "list_median(list_transform(embedding, lambda x: cast(x as double)))"
_BITS = f"list_transform(list_transform(embedding, lambda x: cast(x as double)), lambda x: case when x >= {_MED} then '1' else '0' end)"
_HASHED = f"b as materialized (select vec_id, array_to_string({_BITS}, '') bits from embeddings)"


def _hashes(spark, sf):
    v = F.transform("embedding", lambda x: x.cast("double"))
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("row_pos"), F.col("vec_id").cast("string").alias("clip_id"), hashing.hex_of(hashing.bits(v)).alias("perceptual_hash"))


@query(f"with {_HASHED} select cast(vec_id as varchar) clip_id, array_to_string(list_transform(range(16), lambda i: printf('%x', list_sum(list_transform(range(4), lambda j: cast(substr(bits, i * 4 + j + 1, 1) as int) * (8 >> j)))::int)), '') perceptual_hash from b")
def frame_hash(spark, sf):
    return _hashes(spark, sf).select("clip_id", "perceptual_hash")


@query(f"""with {_FRAMES}, e as (select clip_id, unnest(range(64)) i, unnest(list_transform(d, lambda x: case when x >= list_median(d) then 1 else 0 end)) bit from f),
 v as (select clip_id, i, case when sum(bit) * 2 >= count(*) then 1 else 0 end b from e group by all)
 select clip_id, string_agg(h, '' order by k) perceptual_hash from (select clip_id, i // 4 k, printf('%x', cast(sum(b * (8 >> (i % 4))) as int)) h from v group by all) group by clip_id""")
def clip_hash_majority(spark, sf):
    frames = fixtures.frames(spark, sf).select("clip_id", F.conv(hashing.bits(F.col("d")), 2, -10).cast("long").alias("h"))
    return dedupe.clip_hash(frames)


@query(f"with {_HASHED}, h as (select vec_id, cast(bits as bit) h from b) select x.vec_id u, y.vec_id v, cast(bit_count(xor(x.h, y.h)) as int) distance from h x join h y on x.vec_id < y.vec_id and bit_count(xor(x.h, y.h)) <= {HASH_LIMIT}")
def hamming_pairs(spark, sf):
    base = scratch.folder(spark, "hamming")
    rows = scratch.cut(_hashes(spark, sf).select("row_pos", hashing.as_long(F.col("perceptual_hash")).alias("h")), f"{base}/rows")
    firsts = scratch.cut(rows.groupBy("h").agg(F.min("row_pos").alias("pos")), f"{base}/firsts")
    close = dedupe.close_pairs(firsts, HASH_LIMIT)
    heads = rows.join(firsts, "h").select("row_pos", "pos")
    a, b = heads.withColumnsRenamed({"row_pos": "x", "pos": "u"}), heads.withColumnsRenamed({"row_pos": "y", "pos": "v"})
    far = close.join(a, "u").join(b, "v").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"), "distance")
    same = a.join(b, F.col("u") == F.col("v")).filter("x < y").select(F.col("x").alias("u"), F.col("y").alias("v"), F.lit(0).alias("distance"))
    return far.union(same)


_LEADERS = f"""with recursive {_HASHED}, h as (select vec_id, cast(bits as bit) h, row_number() over (order by vec_id) i from b),
 s as (select cast(0 as bigint) i, cast([] as bigint[]) ids, cast([] as bit[]) hs
  union all select h.i, case when a then list_append(ids, vec_id) else ids end, case when a then list_append(hs, h.h) else hs end
  from (select s.ids, s.hs, n.i, n.h, n.vec_id, len(list_filter(s.hs, lambda x: bit_count(xor(x, n.h)) <= {HASH_LIMIT})) = 0 a from s join h n on n.i = s.i + 1) h),
 anchors as (select unnest(ids) id from (select ids from s order by i desc limit 1)),
 n as (select h.vec_id, a.vec_id anchor, bit_count(xor(h.h, a.h)) dist from h join h a on a.vec_id < h.vec_id and bit_count(xor(h.h, a.h)) <= {HASH_LIMIT} join anchors on anchors.id = a.vec_id),
 p as (select vec_id, arg_min(anchor, dist * 1000000000 + anchor) of, min(dist) dist from n where vec_id not in (select id from anchors) group by vec_id)"""


@query(_LEADERS + " select cast(vec_id as varchar) clip_id, cast(of as varchar) duplicate_of, cast(dist as int) distance from p")
def dup_pairs(spark, sf):
    return dedupe.duplicate_pairs(_hashes(spark, sf), HASH_LIMIT).select("clip_id", "duplicate_of", "distance")


@query(_LEADERS + " select cast(h.vec_id as varchar) clip_id, cast(of as varchar) duplicate_of, of is null keep, case when of is null then '' else 'near_duplicate' end reasons from h left join p on p.vec_id = h.vec_id")
def mark_duplicates(spark, sf):
    rows = _hashes(spark, sf).withColumns({"keep": F.lit(True), "reject_reasons": F.array().cast("array<string>")})
    return _joined(dedupe.mark_duplicates(rows, HASH_LIMIT), "clip_id", "duplicate_of", "keep")


# --- frames -------------------------------------------------------------------------------

_AT = lambda y, x: f"gray[{(abs(y) if y < 8 else 14 - y) * 8 + (abs(x) if x < 8 else 14 - x) + 1}]"
_LAP = "[" + ", ".join(f"{_AT(y - 1, x)} + {_AT(y + 1, x)} + {_AT(y, x - 1)} + {_AT(y, x + 1)} - 4 * {_AT(y, x)}" for y in range(8) for x in range(8)) + "]"
_STATS = f"k as (select clip_id, frame_pos, gray, list_aggregate({_LAP}, 'var_pop') blur, list_avg(gray) brightness, list_stddev_pop(gray) contrast from f)"


def _stats(spark, sf):
    g = F.transform("gray", lambda x: x.cast("double"))
    return fixtures.frames(spark, sf).withColumn("gray", g).select("clip_id", "frame_pos", "gray", image.blur_of(F.col("gray"), 8).alias("blur"), image.mean_of(F.col("gray")).alias("brightness"), image.spread_of(F.col("gray")).alias("contrast"))


def _rounded(df, *keep, places=6):
    return df.select(*keep, *[F.round(c, places).alias(c) for c in df.columns if c not in keep])


@query(f"with {_FRAMES}, {_STATS} select clip_id, frame_pos, round(blur, 6) blur, round(brightness, 6) brightness, round(contrast, 6) contrast from k")
def frame_stats(spark, sf):
    return _rounded(_stats(spark, sf).drop("gray"), "clip_id", "frame_pos", places=6)


@query(f"with {_FRAMES}, {_STATS} select clip_id, round(median(blur), 4) blur_score, round(median(brightness), 4) brightness_score, round(median(contrast), 4) contrast_score from k group by clip_id")
def clip_quality_median(spark, sf):
    return _rounded(measures.clip_quality(_stats(spark, sf)), "clip_id", places=4)


@query(f"""with {_FRAMES}, p as (select clip_id, frame_pos, list_avg(list_transform(list_zip(gray, lag(gray) over (partition by clip_id order by frame_pos)), lambda z: abs(z[1] - z[2]))) m from f),
 q as (select clip_id, cast(cast(m as float) as double) m from p where frame_pos > 0), s as (select clip_id, median(m) motion_score, quantile_cont(m, 0.95) motion_p95_score, 1 / (1 + stddev_pop(m) / greatest(median(m), 1e-6)) motion_stability_score from q group by clip_id)
 select clip_id, round(motion_score, 5) motion_score, round(motion_p95_score, 5) motion_p95_score, round(motion_stability_score, 5) motion_stability_score, {_SENTENCE} motion_caption from s""")
def clip_motion_metrics(spark, sf):
    frames = fixtures.frames(spark, sf).withColumn("gray", F.transform("gray", lambda x: x.cast("double")))
    out = measures.motion_metrics(measures.paired_difference(frames))
    return _rounded(out, "clip_id", places=5).withColumn("motion_caption", text.motion_sentence(F.col("motion_score")))


@query(f"with {_FRAMES}, w as (select clip_id, frame_pos, row_number() over (partition by clip_id order by frame_pos) - 1 i, count(*) over (partition by clip_id) n from f) select clip_id, frame_pos from w where n <= 6 or list_contains(list_transform(range(6), lambda j: case when j = 5 then n - 1 else cast(floor(j * ((n - 1) / 5e0)) as bigint) end), i)")
def keyframe_select(spark, sf):
    return measures.selected_frames(fixtures.frames(spark, sf), 6).select("clip_id", "frame_pos")


@query(f"with {_FRAMES}, {_STATS} select clip_id, round(median(10 * (0.45 * greatest(0, 1 - abs(brightness - 128) / 128) + 0.35 * least(1, blur / 500) + 0.2 * least(1, contrast / 80))), 6) aesthetic_score from k group by clip_id")
def aesthetic_heuristic(spark, sf):
    rows = _stats(spark, sf).withColumn("colorfulness", F.col("contrast"))
    return _rounded(measures.aesthetic_scorer("heuristic")(rows), "clip_id")


_W = [((i * 37) % 19 - 9) / 10 for i in range(64)]
_W2 = [((i * 23) % 17 - 8) / 40 for i in range(64)]
_UNIT = "list_transform(d, lambda x: x / greatest(sqrt(list_sum(list_transform(d, lambda y: y * y))), 1e-6))"
_DOT = lambda w: f"list_sum(list_transform(list_zip({_UNIT}, {[float(x) for x in w]}), lambda z: z[1] * z[2]))"


@query(f"with {_FRAMES}, s as (select clip_id, {_DOT(_W)} + 5 s from f) select clip_id, round(greatest(0, least(10, quantile_disc(s, 0.5))), 6) aesthetic_score from s group by clip_id")
def aesthetic_linear_head(spark, sf):
    return _rounded(measures.aesthetic_scorer("laion", weights=_W, bias=5.0)(fixtures.frames(spark, sf)), "clip_id")


@query(f"with {_FRAMES}, s as (select clip_id, 1 / (1 + exp(10e0 * ({_DOT(_W2)} - {_DOT(_W)}))) p from f) select clip_id, round(10 * quantile_disc(p, 0.5), 6) aesthetic_score from s group by clip_id")
def aesthetic_softmax(spark, sf):
    return _rounded(measures.aesthetic_scorer("clip", good=_W, bad=_W2, scale=10.0)(fixtures.frames(spark, sf)), "clip_id")


_AREA = "greatest(0, x_max - x_min) * greatest(0, y_max - y_min)"


@query(f"with b as ({fixtures.BOXES_SQL}) select clip_no, round(least(1, sum(case when conf >= 0.35 then {_AREA} else 0 end) / max(frame_area)), 6) text_ratio from b group by clip_no")
def ocr_bbox_ratio(spark, sf):
    return _rounded(measures.box_ratio(fixtures.boxes(spark, sf), "clip_no", 0.35), "clip_no")


@query(f"with b as ({fixtures.BOXES_SQL}), w as (select *, case when box_id%9 = 0 then 'bad' else cast(conf * 100 as varchar) end c, clip_no%5 frame from b where word <> 'view'), r as (select clip_no, frame, least(1, sum(case when try_cast(c as double) >= 35 then {_AREA} else 0 end) / max(frame_area)) r from w group by all) select clip_no%10 clip, round(median(r), 6) text_ratio from r group by all")
def ocr_word_ratio(spark, sf):
    b = fixtures.boxes(spark, sf).filter("word <> 'view'").withColumn("conf", F.when(F.col("box_id") % 9 == 0, "bad").otherwise((F.col("conf") * 100).cast("string")))
    per_frame = measures.box_ratio(b, "clip_no", 35.0)
    return per_frame.groupBy((F.col("clip_no") % 10).alias("clip")).agg(F.round(F.median("text_ratio"), 6).alias("text_ratio"))


# --- scenes, training, export ---------------------------------------------------------------

_CUTS = f"""with recursive s as ({fixtures.SCORES_SQL}), n as (select video, max(i) + 1 frames from s group by video),
 k as (select video, i, row_number() over (partition by video order by i) j from s where v >= 60),
 w as (select video, cast(0 as bigint) j, cast(-15 as bigint) last, cast([] as bigint[]) cuts from n
  union all select k.video, k.j, case when k.i - w.last >= 15 then k.i else w.last end, case when k.i - w.last >= 15 then list_append(w.cuts, k.i) else w.cuts end from w join k on k.video = w.video and k.j = w.j + 1),
 c as (select video, arg_max(cuts, j) cuts from w group by video)"""


def _cut_rows(spark, sf):
    from reelsift.schema import SceneSplitConfig

    s = fixtures.scores(spark, sf)
    return s.groupBy("video").agg(F.count("*").alias("frames")), scenes.cuts(s, SceneSplitConfig(threshold=60.0))


@query(_CUTS + " select video, array_to_string(cuts, ',') cuts from c")
def scene_cuts(spark, sf):
    return _cut_rows(spark, sf)[1].select("video", F.array_join(F.transform("cuts", lambda x: x.cast("string")), ",").alias("cuts"))


_SEGMENTS = _CUTS + """, b as (select video, frames, list_sort(list_distinct(list_prepend(cast(0 as bigint), cuts))) x from c join n using (video)),
 g as (select video, unnest(range(len(x))) scene_index, unnest(x) / 24e0 start_sec, unnest(list_append(x[2:], frames)) / 24e0 end_sec from b)"""


@query(_SEGMENTS + " select video, cast(scene_index as int) scene_index, round(start_sec, 6) start_sec, round(end_sec, 6) end_sec, round(greatest(0, end_sec - start_sec), 6) duration_sec, printf('data/clips/%s/%s_scene_%04d.mp4', video::varchar, video::varchar, scene_index) clip_path from g")
def scene_segments(spark, sf):
    frames, cuts = _cut_rows(spark, sf)
    return _rounded(scenes.segments(cuts, frames), "video", "scene_index", "clip_path")


@query("select o_orderkey k, printf('ffmpeg -y -ss %.3f -i in.mp4 -t %.3f -vf fps=24,scale=512:512:force_original_aspect_ratio=decrease,pad=512:512:(ow-iw)/2:(oh-ih)/2,setsar=1 -an -c:v libx264 -preset medium -crf 18 out.mp4', (o_orderkey%100) / 4e0, greatest(0, (o_orderkey%37) / 2e0 - (o_orderkey%100) / 4e0)) command from orders")
def ffmpeg_args(spark, sf):
    k = F.col("o_orderkey")
    c = scenes.cut_command(F.lit("in.mp4"), F.lit("out.mp4"), (k % 100) / 4.0, (k % 37) / 2.0)
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("k"), F.array_join(c, " ").alias("command"))


_FEATURES = ", ".join(f"coalesce({c}, {d!r}) / {k!r}" if c not in ("brightness", "motion_p95_score", "motion_stability_score") else f"{d!r} / {k!r}" for c, d, k in fixed.FEATURES)


@query(f"with {_CLIPS} select clip_id, array_to_string(list_transform([{_FEATURES}, case when keep then 1 else 0 end, 0, 0], lambda x: printf('%.9f', x::double)), ',') features from c")
def training_features(spark, sf):
    rows = _clips(spark, sf)
    f = F.transform(training.features(rows.columns), lambda x: F.format_string("%.9f", x))
    return rows.select("clip_id", F.array_join(f, ",").alias("features"))


@query("select printf('synthetic_%05d', i) clip_id, 4 + (i%12) * 0.5e0 duration_sec, round(0.4e0 + (i%9) * 0.35e0, 6) motion_score, 80 + (i%90) * 1e0 brightness, 'A '||['static', 'smooth camera pan', 'fast handheld motion', 'subject walking'][i%4 + 1]||' video in a '||['street', 'gym', 'studio', 'car interior'][i%4 + 1]||' scene.' caption from range(512) t(i)")
def synthetic_rows(spark, sf):
    return manifest.synthetic_rows(spark, 512).select("clip_id", "duration_sec", F.round("motion_score", 6).alias("motion_score"), "brightness", "caption")


@query(f"with {_CLIPS} select clip_id, row_pos from c where keep order by row_pos limit 256")
def training_scan(spark, sf):
    return manifest.training_rows(_clips(spark, sf), 256).select("clip_id", "row_pos")


@query("""with u as (select vec_id // 16 batch, vec_id i, list_transform(embedding, lambda x: cast(x as double)) v, list_reverse(list_transform(embedding, lambda x: cast(x as double))) t from embeddings),
 n as (select batch, i, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) v, list_transform(t, lambda x: x / sqrt(list_sum(list_transform(t, lambda y: y * y)))) t from u),
 l as (select a.batch, a.i x, b.i y, 10e0 * list_dot_product(a.v, b.t) z from n a join n b using (batch)),
 r as (select batch, x i, ln(sum(exp(z))) - sum(case when x = y then z end) e from l group by all), k as (select batch, y i, ln(sum(exp(z))) - sum(case when x = y then z end) e from l group by all)
 select batch, round((avg(r.e) + avg(k.e)) / 2, 6) loss from r join k using (batch, i) group by batch""")
def contrastive_loss(spark, sf):
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.floor(F.col("vec_id") / 16).alias("batch"), F.col("vec_id").alias("i"), v.alias("video"), F.reverse(v).alias("text"))
    return _rounded(training.contrastive_loss(rows, 10.0), "batch")


@query("select * from (values ('baseline_30_steps', 30e0, 6000e0, 'dry-run baseline estimate'), ('fast_8_steps', 8e0, 6000e0, 'dry-run baseline estimate'), ('memory_sliced_30_steps', 33.696e0, 4329.6e0, 'attention slicing lowers VRAM with small latency overhead; VAE slicing lowers decode memory'), ('compile_8_steps', 7.04e0, 6000e0, 'torch.compile estimate after warmup')) t(name, seconds, peak_vram_mb, notes)")
def inference_dry_run(spark, sf):
    return training.inference_estimates(spark)


@query("select cast(128 as bigint) samples, cast(32 as bigint) batch_size, cast(2 as bigint) epochs, cast(8 as bigint) steps, 0.28e0 as seconds, round(128 / 0.28e0, 6) samples_per_second")
def training_dry_run(spark, sf):
    e = training.training_estimate(128, 32, 2)
    return spark.createDataFrame([(e["samples"], e["batch_size"], e["epochs"], e["steps"], round(e["seconds"], 6), round(e["samples_per_second"], 6))], "samples long, batch_size long, epochs long, steps long, seconds double, samples_per_second double")


@query(f"with {_CLIPS} select cast(count(*) filter (row_pos%3 <> 0) * 2 as bigint) image_count, count(*) source_clip_count, count(*) filter (row_pos%3 = 0) skipped_clip_count from (select * from c where keep order by row_pos limit 500)")
def export_counts(spark, sf):
    clips = export.selected(_clips(spark, sf), 500)
    files = fixtures.manifest(spark, sf).filter("row_pos % 3 <> 0").select(F.col("source_path").alias("path"))
    return export.counts(export.resolved(clips, files, ["."]), 2)


@query(f"with {_FRAMES}, w as (select clip_id, frame_pos, row_number() over (partition by clip_id order by frame_pos) - 1 i from f) select 'images/'||clip_id||'_'||printf('%03d', i)||'.jpg' file_name, 'A curated video frame.' \"text\" from w")
def export_metadata(spark, sf):
    frames = fixtures.frames(spark, sf).select("clip_id", "frame_pos", F.lit(None).cast("string").alias("caption"), F.lit("").alias("motion_caption"))
    return export.metadata(frames)


# --- pixel kernels over image rows --------------------------------------------------------

_B, _G, _RED = ([f"gray[{3 * i + c + 1}]" for i in range(16)] for c in range(3))
_LIST = lambda items: "[" + ", ".join(items) + "]"
_LUMA = _LIST([f"floor(0.114 * {b} + 0.587 * {g} + 0.299 * {r} + 0.5)" for b, g, r in zip(_B, _G, _RED)])
_RG = _LIST([f"abs({r} - {g})" for g, r in zip(_G, _RED)])
_YB = _LIST([f"abs(0.5 * ({r} + {g}) - {b})" for b, g, r in zip(_B, _G, _RED)])


@query(f"""with {_FRAMES}, v as (select clip_id, frame_pos, gray[1:48] px, {_LUMA} y, {_RG} rg, {_YB} yb from f)
 select clip_id, frame_pos, round(list_avg(y), 6) brightness, round(list_stddev_pop(y), 6) contrast, round(list_avg(px), 6) mean_pixel,
 round(sqrt(list_var_pop(rg) + list_var_pop(yb)) + 0.3 * sqrt(list_avg(rg) * list_avg(rg) + list_avg(yb) * list_avg(yb)), 4) colorfulness from v""")
def image_metrics(spark, sf):
    m = measures.measured(fixtures.image_rows(spark, sf, 4, 4, 3)).withColumn("colorfulness", F.round("colorfulness", 4))
    return _rounded(m.select("clip_id", "frame_pos", "brightness", "contrast", "mean_pixel", "colorfulness"), "clip_id", "frame_pos")


@query(f"with {_FRAMES}, v as (select clip_id, avg(list_avg(gray[1:48])) m from f group by clip_id) select clip_id, round(m, 6) mean_pixel from v")
def clip_mean_pixel(spark, sf):
    m = measures.measured(fixtures.image_rows(spark, sf, 4, 4, 3))
    return m.groupBy("clip_id").agg(F.round(F.avg("mean_pixel"), 6).alias("mean_pixel"))


_CELL = lambda at: f"floor(({' + '.join(f'gray[{i + 1}]' for i in at)}) / 4 + 0.5)"
_SMALL = _LIST([_CELL([y * 8 + x for y in (2 * i, 2 * i + 1) for x in (2 * j, 2 * j + 1)]) for i in range(4) for j in range(4)])


@query(f"""with {_FRAMES}, v as (select clip_id, frame_pos, {_SMALL} p from f), b as (select clip_id, frame_pos, list_transform(p, lambda x: case when x >= list_median(p) then 1 else 0 end) b from v)
 select clip_id, frame_pos, {' || '.join(f"printf('%x', 8 * b[{4 * i + 1}] + 4 * b[{4 * i + 2}] + 2 * b[{4 * i + 3}] + b[{4 * i + 4}])" for i in range(4))} frame_hash from b""")
def frame_hash_resized(spark, sf):
    return measures.hashed(fixtures.image_rows(spark, sf, 8, 8, 1), 4)


_MIDDLE = " || ".join(f"printf('%02X', cast({_CELL([y * 16 + 6 + x for y in (2 * i, 2 * i + 1) for x in (2 * j, 2 * j + 1)])} as int))" for i in range(2) for j in range(2))


@query(f"with {_FRAMES} select clip_id, frame_pos, {_MIDDLE} pixels from f")
def centre_square(spark, sf):
    return measures.squared(fixtures.image_rows(spark, sf, 4, 16, 1), 2).select("clip_id", "frame_pos", F.hex("data").alias("pixels"))


@query()
def text_area_proxy(spark, sf):
    return measures.measured(fixtures.image_rows(spark, sf, 8, 8, 1)).select("clip_id", "frame_pos", "text_area")


@query()
def frame_data_urls(spark, sf):
    return captioning.key_frame_urls(fixtures.image_rows(spark, sf, 4, 4, 3), 4).select("clip_id", F.size("urls").alias("n"), F.sha1(F.array_join("urls", " ")).alias("urls_sha1"))


@query()
def frame_signature(spark, sf):
    return measures.signatures(fixtures.image_rows(spark, sf, 4, 4, 3))


@query()
def content_scores(spark, sf):
    return measures.content_scores(fixtures.image_rows(spark, sf, 4, 4, 3))


# --- manifest files and rows -----------------------------------------------------------------


@query(f"with {_CLIPS} select clip_id, count(*) n from (select * from c union all select * from c where keep) group by clip_id")
def manifest_append(spark, sf):
    path = scratch.folder(spark, "appended")
    manifest.write_manifest(_clips(spark, sf), path)
    manifest.append_manifest(_clips(spark, sf).filter("keep"), path)
    return manifest.read_manifest(spark, path).groupBy("clip_id").agg(F.count("*").alias("n"))


@query(f"with {_CLIPS} select clip_id, blur_score, keep from c")
def manifest_json_lines(spark, sf):
    lines = manifest.to_json_lines(_clips(spark, sf))
    return lines.select(F.from_json("value", "clip_id string, blur_score double, keep boolean").alias("r")).select("r.*")


@query(f"with {_CLIPS} select clip_id, width, cast(to_json(r) as varchar) reject_reasons from c")
def manifest_csv(spark, sf):
    path = f"{scratch.folder(spark, 'csv')}/rows"
    manifest.to_csv_rows(_clips(spark, sf)).select("clip_id", "width", "reject_reasons").write.option("header", True).option("escape", '"').csv(path)
    return spark.read.option("header", True).option("escape", '"').schema("clip_id string, width int, reject_reasons string").csv(path)


@query()
def caption_token_ids(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", F.array_join(F.transform(text.caption_tokens(F.col("text")), lambda x: x.cast("string")), " ").alias("ids"))


@query(f"select {_q(training.LoraCommand(output_dir='out put').shell())} as command")
def lora_command(spark, sf):
    return spark.createDataFrame([(training.LoraCommand(output_dir="out put").shell(),)], "command string")


ORACLES.update(_BODIES)
