"""Quality rules whose cutoffs carry a risk guarantee.

Rules compare ratios of a document (symbols, repeated lines, repeated words, long
and short words) with cutoffs of its stratum, its language.  A third of the labelled
documents (by a hash of the id) designs a path of rule sets from lenient to strict:
step k lets every rule reject at most the k-th share of ``PATH`` of the third's good
documents.  The other two thirds are the holdout.  There each step is tested as one
whole, all of its rules together: it holds while the exact binomial chance of so
few good documents rejected, were their true share ``ALPHA``, stays below the
stratum's level.  Steps are tested in order and the first failure ends the path, so
that needs no correction; across strata ``LEVEL`` is divided by their number
(Bonferroni).  With probability 1 - ``LEVEL`` no stratum's rules, taken together,
reject more than ``ALPHA`` of its good documents.  Of the steps that hold the one
that best parts bad from good in the design third is taken, if any does.  A stratum
needs about log(LEVEL / strata) / log(1 - ALPHA) good holdout labels (437 for four
strata) before any step can hold; with fewer, its base rule stands alone.

Edge cases: null text has no words and fails; a language without labels, and a
null one, has no cutoffs beyond the base rule; rows with null or repeated ids give
one row each; a label counts once an id (0 if any says 0); a document at a cutoff
stays; very long texts are read whole; an empty table or no labels give base
verdicts alone; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.common import Scratch, WordHash, raw_words, read_table, rolling

RUN = 5
SYMBOLS = "#*$%&|<>"
BINS = 100
#: Share of good documents of a stratum that all its rules together may reject, and the error level of all tests together.
ALPHA, LEVEL = 0.01, 0.05
#: Shares of the design third's good documents that each rule may reject, step by step.
PATH = (0.0, 0.0005, 0.001, 0.002, 0.004)
#: Weight of a good document's rejection against a bad one's when a cutoff is chosen.
CARE = 20.0
_GAPS = str.maketrans("", "", " \t\n\x0b\x0c\r")

#: Bin of each rule, larger is worse; from the counts below.
RULES = {
    "symbols": "cast(least(99, floor(100D * n_symbols / greatest(n_words, 1))) as int)",
    "dup_lines": "cast(least(99, floor(100D * n_dup_lines / greatest(n_lines, 1))) as int)",
    "repeats": "cast(least(99, floor(100D * n_repeat_words / greatest(n_words, 1))) as int)",
    "long_words": "cast(least(99, floor(4D * word_chars / greatest(n_words, 1))) as int)",
    "short_words": "cast(greatest(0, 99 - floor(8D * word_chars / greatest(n_words, 1))) as int)",
}


def counts(text: str | None, hashes: WordHash) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words."""
    text = text or ""
    words = raw_words(text)
    n_lines = n_dup = 0
    seen: set[str] = set()
    for line in text.split("\n"):
        if raw_words(line):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    repeat = 0
    if len(words) >= RUN:
        g = rolling(hashes.array(words), RUN)
        _, at, n = np.unique(g, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(n[at] > 1)
        edge = np.zeros(len(words) + 1, np.int64)
        edge[twice] += 1
        edge[twice + RUN] -= 1
        repeat = int((np.cumsum(edge[:-1]) > 0).sum())
    return len(words), len(text.translate(_GAPS)), sum(map(text.count, SYMBOLS)), n_lines, n_dup, repeat


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHash()
    for b in batches:
        rows = np.array([counts(t, hashes) for t in b.column("text").to_pylist()], np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "lang": b.column("lang")} | {c: pa.array(rows[:, i]) for i, c in enumerate(COUNTS)})


def tail(n: int, k: int, p: float) -> float:
    """P(Binomial(n, p) <= k)."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    return min(1.0, sum(map(math.exp, logs)))


Steps = list[dict[str, int]]


def path(table: list[tuple[str, str, int, int, int]]) -> dict[str, Steps]:
    """By stratum, the cutoffs (rule to the largest bin that stays) of each step, from design rows (stratum, rule, bin, quality, count)."""
    out: dict[str, Steps] = {}
    for stratum in sorted({r[0] for r in table}):
        good = {r: [0] * BINS for r in RULES}
        for s, rule, bin_, quality, n in table:
            if s == stratum and quality:
                good[rule][bin_] += n
        steps = []
        for share in PATH:
            cuts = {}
            for rule, g in good.items():
                beyond, cut = 0, BINS - 1
                while cut > 0 and beyond + g[cut] <= share * sum(g):
                    beyond += g[cut]
                    cut -= 1
                if cut < BINS - 1 and sum(g):
                    cuts[rule] = cut
            steps.append(cuts)
        out[stratum] = steps
    return out


def rejected(cuts: dict[str, int], bin_of: dict[str, Column]) -> Column:
    bad = F.lit(False)
    for rule, cut in sorted(cuts.items()):
        bad = bad | (bin_of[rule] > cut)
    return bad


def certified(good: int, lost: list[int], strata: int, alpha: float = ALPHA, level: float = LEVEL) -> int:
    """How many leading steps hold for a stratum whose holdout has ``good`` documents, of which step k rejects ``lost[k]``."""
    for k, n in enumerate(lost):
        if tail(good, n, alpha) > level / strata:
            return k
    return len(lost)


def choose(steps: dict[str, Steps], tests: dict[str, tuple[int, list[int]]], design: dict[str, list[tuple[int, int]]], sizes: dict[str, tuple[int, int]], alpha: float = ALPHA, level: float = LEVEL) -> dict[str, dict[str, int]]:
    """The cutoffs taken by stratum.

    tests: good holdout documents and those each step rejects; design: good and bad
    ones of the design third that each step rejects; sizes: good and bad in it.
    """
    out = {}
    for stratum, some in steps.items():
        good, lost = tests.get(stratum, (0, [0] * len(some)))
        best: tuple[float, dict[str, int]] = (0.0, {})
        for k in range(certified(good, lost, len(steps), alpha, level)):
            (g, b), (n, m) = design[stratum][k], sizes[stratum]
            gain = b / max(m, 1) - CARE * g / max(n, 1)
            if gain > best[0] + 1e-12:
                best = (gain, some[k])
        if best[1]:
            out[stratum] = best[1]
    return out


def cutoffs(held: DataFrame, alpha: float = ALPHA, level: float = LEVEL) -> dict[str, dict[str, int]]:
    """From labelled rows (lang, quality, design boolean, a bin by rule); the driver sees sums by stratum, rule, bin and step."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("bin")) for r in RULES])
    table = held.filter("design").select("lang", "quality", F.explode(pairs).alias("x")).groupBy("lang", "x.rule", "x.bin", "quality").count().collect()
    steps = path([(r["lang"], r["rule"], r["bin"], r["quality"], r["count"]) for r in table])
    if not steps:
        return {}
    bin_of = {r: F.col(r) for r in RULES}
    first = F.lit(len(PATH))  # the step that rejects a row first; later ones do as well
    for stratum, some in steps.items():
        for k in reversed(range(len(PATH))):
            if k == 0 or some[k] != some[k - 1]:
                first = F.when((F.col("lang") == stratum) & rejected(some[k], bin_of), F.lit(k)).otherwise(first)
    seen = held.select("lang", "design", "quality", first.alias("first")).groupBy("lang", "design", "quality", "first").count().collect()

    def of(stratum: str, design: bool, quality: int) -> tuple[int, list[int]]:
        mine = [(r["first"], r["count"]) for r in seen if (r["lang"], r["design"], r["quality"]) == (stratum, design, quality)]
        return sum(n for _, n in mine), [sum(n for f, n in mine if f <= k) for k in range(len(PATH))]

    good, bad = {s: of(s, True, 1) for s in steps}, {s: of(s, True, 0) for s in steps}
    tests = {s: of(s, False, 1) for s in steps}
    return choose(steps, tests, {s: list(zip(good[s][1], bad[s][1])) for s in steps}, {s: (good[s][0], bad[s][0]) for s in steps}, alpha, level)


def judged(spark: SparkSession, docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, level: float = LEVEL) -> DataFrame:
    """Counts, base_failed and kept of every row of docs (doc_id, text, lang)."""
    t = Scratch(spark, "quality")
    kinds = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS)
    rows = docs.select("doc_id", "lang", "text").mapInArrow(_count, kinds)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = t.cut(rows.withColumn("base_failed", base), "counts")
    one = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    third = F.crc32(F.concat(F.lit("design:"), F.col("doc_id").cast("string")).cast("binary")) % 3 == 0
    bin_of = {r: F.expr(e) for r, e in RULES.items()}
    held = rows.filter("lang is not null and not base_failed").join(one, "doc_id")
    held = t.cut(held.select("lang", "quality", third.alias("design"), *[c.alias(r) for r, c in bin_of.items()]), "held")
    bad = F.lit(False)
    for lang, cuts in sorted(cutoffs(held, alpha, level).items()):
        bad = bad | (F.coalesce(F.col("lang") == lang, F.lit(False)) & rejected(cuts, bin_of))
    return rows.withColumn("kept", ~F.col("base_failed") & ~bad)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
