"""Views that present the star-schema test tables as clips, captions, boxes and frames.

The SQL runs alike in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MANIFEST_SQL = """select k as row_pos, substr(sha1(sp),1,16) clip_id, sp source_path, dur duration_sec, 24e0 fps,
 case when k%11=0 then 128 else 512 end width, case when k%13=0 then 240 else 512 end height, cast(floor(dur*24) as int) frame_count,
 case when k%17=0 then null else ((k*37)%3000)/10e0 end blur_score, case when k%19=0 then null else ((k*53)%256)*1e0 end brightness_score,
 ((k*29)%1280)/10e0 contrast_score, ((k*31)%1000)/10e0 colorfulness_score, case when k%23=0 then null else ((k*41)%600)/10e0 end motion_score,
 ((k*43)%120)/1000e0 ocr_text_area_ratio, case when k%29=0 then null else ((k*47)%1000)/100e0 end aesthetic_score
from (select o_orderkey k, '/data/clips/clip_'||lpad(cast(o_orderkey as string),8,'0')||'.mp4' sp, (o_orderkey%250)/10e0 dur from orders) t"""
CAPTIONS_SQL = """select doc_id row_pos, case doc_id%8 when 0 then '<think>plan'||chr(10)||'steps</think> Final caption: '||body
 when 1 then 'Frame Analysis: Frame 1 has a car. Final dense caption: '||body when 2 then body||' It has a visible watermark here.'
 when 3 then 'The user wants a dense caption for this. '||body when 4 then body||' A public event scene with'
 when 5 then '   '||chr(9)||chr(10) when 6 then null else body end raw_text
from (select doc_id, 'Clip '||cast(doc_id as string)||' shows '||text||' here.' body from documents) t"""
BOXES_SQL = """select event_id box_id, user_id clip_no, event_type word, (event_id%100)/100e0 conf, (event_id*7)%80*1e0 x_min, (event_id*11)%80*1e0 y_min,
 (event_id*7)%80*1e0+(event_id%20) x_max, (event_id*11)%80*1e0+(event_id%15) y_max, 1e4 frame_area from events"""
FILES_SQL = "select page_id, 'u'||cast(page_id as string)||'.mp4' name, length(html)*1000 size from pages"
SCORES_SQL = "select user_id video, row_number() over (partition by user_id order by event_id) - 1 i, value v from events"
FRAMES_SPARK = "select concat('clip_', label) clip_id, row_number() over (partition by label order by vec_id) - 1 frame_pos, vec_id, transform(embedding, x -> floor((cast(x as double)+1)*127.5)) gray, transform(embedding, x -> cast(x as double)) d from embeddings"
FRAMES_DUCK = "select concat('clip_', label) clip_id, row_number() over (partition by label order by vec_id) - 1 frame_pos, vec_id, list_transform(embedding, lambda x: floor((cast(x as double)+1)*127.5)) gray, list_transform(embedding, lambda x: cast(x as double)) d from embeddings"

_TABLES = {"orders": MANIFEST_SQL, "documents": CAPTIONS_SQL}


def _view(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace(f"from {table}", "from {t}"), t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "orders", MANIFEST_SQL)


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "documents", CAPTIONS_SQL)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", BOXES_SQL)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "pages", FILES_SQL)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", SCORES_SQL)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "embeddings", FRAMES_SPARK)


def image_rows(spark: SparkSession, sf_dir: str, height: int, width: int, channels: int) -> DataFrame:
    """The first samples of each frame's grey values as image rows (clip_id, frame_pos, height, width, nChannels, data)."""
    samples = f"unhex(array_join(transform(slice(gray, 1, {height * width * channels}), x -> lpad(hex(cast(x as int)), 2, '0')), ''))"
    return frames(spark, sf_dir).selectExpr("clip_id", "frame_pos", f"{height} height", f"{width} width", f"{channels} nChannels", f"{samples} data")
