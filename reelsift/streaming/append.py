"""New manifest files as a stream: gates row by row, batches appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelsift import scratch
from reelsift.operators.dedupe import duplicate_pairs
from reelsift.operators.gates import gated
from reelsift.schema import MANIFEST, QualityConfig
from reelsift.sources.manifest import write_manifest


def stream_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(MANIFEST).json(folder)


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, cfg: QualityConfig = QualityConfig(), threshold: int | None = None):
    """Gates what lands in ``folder`` and writes it to ``out``, a folder a batch.

    A batch that is replayed overwrites its own folders, so nothing is appended
    twice.  With a threshold each batch is also compared with the anchors of earlier
    batches, which are kept as small tables (batch, row_pos, clip_id, hash); since
    duplicates never anchor, earlier rows keep their verdicts.
    """
    anchors = f"{checkpoint.rstrip('/')}/anchors"
    kinds = "row_pos long, clip_id string, perceptual_hash string"

    def earlier(number: int) -> DataFrame:
        """Anchors of the batches before, in their order and before all new rows."""
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(anchors)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return spark.createDataFrame([], kinds)
        old = spark.read.schema(kinds + ", batch int").parquet(anchors).filter(F.col("batch") < number)
        place = F.row_number().over(Window.partitionBy("batch").orderBy("row_pos")).cast("long")
        before = F.shiftleft(F.col("batch").cast("long"), 32) + place  # below 2^62 for any batch
        return old.select((before - F.lit(1 << 63 >> 1)).alias("row_pos"), "clip_id", "perceptual_hash")

    def sink(batch: DataFrame, number: int) -> None:
        new = gated(batch.drop("reject_reasons", "keep"), cfg)
        if threshold is not None:
            new = scratch.cut(new.withColumn("row_pos", F.monotonically_increasing_id()), f"{scratch.folder(spark, 'stream')}/batch")
            rows = new.select("row_pos", "clip_id", "perceptual_hash")
            hits = duplicate_pairs(earlier(number).unionByName(rows), threshold).filter("row_pos >= 0").select("row_pos", F.col("duplicate_of").alias("__of"))
            new = new.join(hits, "row_pos", "left").withColumn("duplicate_of", F.col("__of"))
            hit = F.col("__of").isNotNull()
            new = new.withColumn("keep", F.col("keep") & ~hit).withColumn("reject_reasons", F.when(hit, F.array_append("reject_reasons", "near_duplicate")).otherwise(F.col("reject_reasons")))
            new = scratch.cut(new, f"{scratch.folder(spark, 'stream')}/judged")
            new.filter("duplicate_of is null and perceptual_hash is not null").select("row_pos", "clip_id", "perceptual_hash").write.mode("overwrite").parquet(f"{anchors}/batch={number}")
        write_manifest(new, f"{out.rstrip('/')}/batch={number:010d}")

    return stream_manifest(spark, folder).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
