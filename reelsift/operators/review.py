"""Review queries: filters, pages, distributions, uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def filtered(df: DataFrame, keep: bool | None = None, reasons: list[str] | None = None, search: str = "") -> DataFrame:
    """Kept or rejected rows, any of the reasons, a literal part of path or caption.

    Nulls read as the word none in searches.
    """
    if keep is not None:
        df = df.filter(F.coalesce("keep", F.lit(False)) == keep)
    if reasons:
        df = df.filter(F.arrays_overlap("reject_reasons", F.array(*map(F.lit, reasons))))
    if search:
        hit = F.lit(False)
        for c in ("source_path", "caption"):
            if c in df.columns:
                hit = hit | F.contains(F.lower(F.coalesce(F.col(c), F.lit("none"))), F.lit(search.lower()))
        df = df.filter(hit)
    return df


def page(df: DataFrame, number: int, size: int, order: str = "row_pos") -> DataFrame:
    """Rows [number * size, (number + 1) * size) in order; numbers past the end give the last page."""
    last = max((df.count() - 1) // size, 0)
    return df.orderBy(order).offset(min(number, last) * size).limit(size)


def score_series(df: DataFrame, scores: list[str]) -> DataFrame:
    """(x, score, value): present scores by row order, long form."""
    some = [s for s in scores if s in df.columns]
    stack = ", ".join(f"'{s}', `{s}`" for s in some)
    pos = df.select("row_pos", *some)
    return pos.selectExpr("row_pos as x", f"stack({len(some)}, {stack}) as (score, value)")


def kpis(df: DataFrame) -> DataFrame:
    n, kept = F.count("*"), F.count_if(F.coalesce(F.col("keep"), F.lit(False)))
    return df.agg(n.alias("clips"), kept.alias("accepted"), (n - kept).alias("rejected"), F.count("duplicate_of").alias("duplicates"), F.coalesce(100 * F.try_divide(kept, n), F.lit(0.0)).alias("yield_percent"))


def relaxed(df: DataFrame) -> DataFrame:
    """Keeps every row; the verdict before is saved beside."""
    return df.withColumns({"original_keep": F.col("keep"), "original_reject_reasons": F.col("reject_reasons")}).withColumns({"keep": F.lit(True), "reject_reasons": F.array().cast("array<string>")})


def upload_verdict(files: DataFrame, most: int = 10, single_mb: float = 50.0, total_mb: float = 250.0) -> DataFrame:
    """First failing limit of a batch of files (size), or null."""
    mb = 1024.0 * 1024.0
    size = F.coalesce(F.col("size"), F.lit(0))
    out = files.agg(F.count("*").alias("n_files"), F.coalesce(F.max(size), F.lit(0)).cast("long").alias("largest"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("total"))
    return out.withColumn("verdict", F.when(F.col("n_files") > most, "too_many_files").when(F.col("largest") / mb > single_mb, "file_too_large").when(F.col("total") / mb > total_mb, "batch_too_large"))


def cards(df: DataFrame) -> DataFrame:
    """What a gallery card shows."""
    return df.select("clip_id", "source_path", F.concat_ws("x", "width", "height").alias("size"), "duration_sec", "fps", *[c for c in df.columns if c.endswith("_score")], "keep", F.array_join("reject_reasons", ", ").alias("reasons"))


def numbered(df: DataFrame, partition: str, order: str, name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(partition).orderBy(order)) - 1)
