"""Shared pieces: scratch tables in the cluster's shared folder, word hashing,
connected components.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``; executors may
be lost at any time after that without recomputing earlier phases.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.ship import ship

#: Most rows and bytes of an Arrow batch handed to Python; a row of more bytes makes a batch of its own.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20


def tune(spark: SparkSession) -> None:
    """Hands our modules to executors and sets this session's bounds of Arrow batches."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reelsift-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Scratch:
    """Tables of one run of one operator, each written once and read again."""

    #: Seconds between two collections of the driver's garbage, on which Spark frees shuffle files.
    GARBAGE_S = 4.0
    _last = 0.0

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        self.written = 0
        tune(spark)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` and returns the stored table; frees its shuffle files."""
        path = f"{self.base}/{name}-{self.written}"
        self.written += 1
        df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        out = self.spark.read.schema(df.schema).parquet(path)
        del df
        if time.monotonic() - Scratch._last > self.GARBAGE_S:
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            Scratch._last = time.monotonic()
        return out

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            if path := self.paths.pop(name, None):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out_column(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """True where crc32 of the id's decimal text leaves no remainder."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


class WordHash(dict):
    """64-bit hash of a word (bytes), remembered up to a bounded number of words."""

    LIMIT = 200_000

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word, self.seed)
        self[word] = h
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def raw_words(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` as UTF-8; ``bytes.split`` cuts at just those six."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z lowered (``bytes.lower`` touches ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit multiply-xorshift hash."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes; empty when too short."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = words[:n].copy()
    for i in range(1, k):
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(31)
        acc += words[i : i + n]
    return mix64(acc)


#: Most 64-bit words of the bitmap below; its broadcast stays within some 20 MB.
BITMAP_WORDS = 1 << 20


def maybe_in(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` may be among the written one-column table ``ids``.

    A bitmap of hashed ids, of at most ``BITMAP_WORDS`` words whatever the input, is
    summed on the executors and broadcast, so that most other rows never reach a
    shuffle.  It only thins out: an exact join on the same column has to follow,
    and a full bitmap merely lets more rows through.
    """
    (key,) = ids.columns
    n, words = ids.count(), 1024
    while words < min(BITMAP_WORDS, n):
        words *= 2
    word = lambda c: F.pmod(F.xxhash64(c), F.lit(words))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(F.xxhash64(c), 32), F.lit(64)).cast("int"))
    bitmap = ids.select(word(key).alias("__w"), bit(key).alias("__b")).groupBy("__w").agg(F.bit_or("__b").alias("__b"))
    return rows.join(F.broadcast(bitmap), (word(column) == F.col("__w")) & (F.col("__b").bitwiseAND(bit(column)) != 0), "left_semi")


def connected_components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """(id, comp) for the ends of ``links`` (a, b): comp is the smallest id reachable.

    Minimum labels go over each link to its end and to that end's own label, so that
    whole classes join at once, and labels of labels are taken: rounds grow with the
    logarithm of a class's size.  Every round is a written table, the driver sees
    one flag a round.  No links give an empty table.  A hub
    or a giant component makes one join key hot: nothing above those joins relies
    on their partitioning, so adaptive execution splits such a key's rows.
    """
    edges = scratch.cut(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-edges")
    labels = scratch.cut(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), f"{name}-labels0")
    turn = 0
    while True:
        told = edges.join(labels.withColumnsRenamed({"id": "b", "comp": "c"}), "b").join(labels.withColumnsRenamed({"id": "a", "comp": "own"}), "a")
        near = told.select(F.explode(F.array_distinct(F.array("a", "own"))).alias("id"), "c").groupBy("id").agg(F.min("c").alias("m"))
        step = labels.join(near, "id").select("id", F.least("comp", "m").alias("next"), F.col("comp").alias("old"))
        jump = labels.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        new = step.join(jump, "next").select("id", F.least("next", "far").alias("comp"), (F.least("next", "far") < F.col("old")).alias("moved"))
        turn += 1
        new = scratch.cut(new, f"{name}-labels{turn}")
        if turn > 1:
            scratch.drop(f"{name}-labels{turn - 1}")
        if new.filter("moved").isEmpty():
            return new.select("id", "comp")
        labels = new.select("id", "comp")
