"""Summaries of a manifest, and their files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEANS = ("aesthetic", "motion", "motion_p95", "motion_stability", "contrast", "colorfulness")


def summary(df: DataFrame) -> DataFrame:
    """One row: counts, acceptance rate (0 when empty) and means that skip nulls."""
    n, kept = F.count("*"), F.count_if(F.col("keep"))
    means = [F.avg(f"{m}_score").alias(f"average_{m}_score") for m in MEANS if f"{m}_score" in df.columns]
    dup = F.count("duplicate_of") if "duplicate_of" in df.columns else F.lit(0).cast("long")
    return df.agg(n.alias("total_clips"), kept.alias("accepted_clips"), (n - kept).alias("rejected_clips"), dup.alias("duplicate_clips"), F.coalesce(F.try_divide(kept, n), F.lit(0.0)).alias("acceptance_rate"), *means)


def reason_counts(df: DataFrame, rejected_only: bool = False) -> DataFrame:
    rows = df.filter(~F.col("keep")) if rejected_only else df
    return rows.select(F.explode("reject_reasons").alias("reason")).filter("reason <> ''").groupBy("reason").agg(F.count("*").alias("n"))


def summary_with_reasons(df: DataFrame) -> DataFrame:
    """The summary with a reason-to-count map, sorted by reason."""
    reasons = reason_counts(df).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("reject_reasons"))
    return summary(df).join(F.broadcast(reasons), F.lit(True), "left")


def throughput(df: DataFrame, seconds: float, mode: str = "single") -> DataFrame:
    n, kept = F.count("*"), F.count_if(F.col("keep"))
    rate = n * F.lit(60.0 / seconds) if seconds > 0 else F.lit(0.0)
    return df.agg(F.lit(mode).alias("mode"), F.lit(float(seconds)).alias("seconds"), n.alias("clips"), kept.alias("accepted"), (n - kept).alias("rejected"), rate.cast("double").alias("clips_per_minute"))


def markdown(row: dict) -> str:
    """The summary row as a Markdown page."""
    show = lambda v: "n/a" if v is None else f"{v:.2f}"
    cells = [("Total clips", row["total_clips"]), ("Accepted clips", row["accepted_clips"]), ("Rejected clips", row["rejected_clips"]), ("Acceptance rate", f"{row['acceptance_rate']:.1%}"), ("Near-duplicate clips", row["duplicate_clips"])]
    cells += [(f"Average {m.replace('_', ' ')} score", show(row.get(f"average_{m}_score"))) for m in MEANS]
    page = ["# Dataset Summary", "", "| Metric | Value |", "| --- | ---: |", *(f"| {k} | {v} |" for k, v in cells), "", "## Reject Reasons", ""]
    reasons = row.get("reject_reasons") or {}
    page += ["| Reason | Count |", "| --- | ---: |", *(f"| `{k}` | {reasons[k]} |" for k in sorted(reasons))] if reasons else ["No rejected clips."]
    return "\n".join(page) + "\n"


def table_markdown(title: str, rows: list[dict]) -> str:
    """Rows of one shape as a Markdown table."""
    names = list(rows[0]) if rows else []
    show = lambda v: "n/a" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)
    body = ["| " + " | ".join(show(r[n]) for n in names) + " |" for r in rows]
    return "\n".join([f"# {title}", "", "| " + " | ".join(names) + " |", "| " + " | ".join("---" for _ in names) + " |", *body]) + "\n"


def write_text(path: str, text: str) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text, encoding="utf-8")


def write_json(path: str, value) -> None:
    write_text(path, json.dumps(value, indent=2, sort_keys=True, default=str) + "\n")
