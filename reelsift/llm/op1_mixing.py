"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic.  Token counts of the
cells are raked until source, language and topic totals meet their targets: given
shares of the tokens (``targets``), or tempered shares of the tokens at hand for the
dimensions that have none.  Raking ends when no total is off by more than ``CLOSE``
of its target, or after ``ROUNDS``; ``residuals`` tells what is left.  Then documents
are drawn without replacement with probabilities that are proportional to a cell's
raked over its present tokens, cut at 1, and calibrated so that the expected tokens
meet the budget.  A document's draw is a fixed function of its id.

Cells are summed before any shuffle.  Up to ``MAX_CELLS`` of them are raked on
the driver and broadcast to the rows, more of them by the same steps on DataFrames.

Topics are classes of form that the text itself shows: tabular, symbolic, legal,
note, article, book.  Edge cases: null source or language is the value '(none)';
null text has no words and is a note; rows without words have weight 0 and are
always drawn, as they cost nothing; repeated and tied ids share their draw; a value
without a given target has target 0, a target without documents is left out and
the others are scaled; very long texts are counted whole; an empty table gives an
empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.common import Scratch, read_table

DIMS = ("source", "lang", "topic")
#: Exponents that temper the token shares of each dimension into targets.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
ROUNDS = 12
#: Largest difference of a total from its target, over the target, at which raking ends.
CLOSE = 1e-13
#: Share of all tokens to draw.
BUDGET = 0.6
MAX_CELLS = 200_000
WORD = "[^\\x20\\x09-\\x0D]+"


Targets = dict[str, dict[str, float]]


def features(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """docs' kept columns with ``cell``: a struct of source, lang, topic and tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    signs = F.length(text) - F.length(F.translate(text, "#*$%&<>", ""))
    told = F.struct(
        F.coalesce("source", F.lit("(none)")).alias("source"), F.coalesce("lang", F.lit("(none)")).alias("lang"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        bars.alias("bars"), signs.alias("signs"), F.contains(F.lower(text), F.lit("license")).alias("legal"),
    )
    n = F.col("told.tokens")
    topic = (
        F.when(F.col("told.bars") * 5 > n, "tabular")
        .when(F.col("told.signs") * 2 > n, "symbolic")
        .when(F.col("told.legal"), "legal")
        .when(n < 100, "note")
        .when(n < 2000, "article")
        .otherwise("book")
    )
    rows = docs.select(F.struct(*keep).alias("kept"), told.alias("told"))
    return rows.select("kept", F.struct(F.col("told.source").alias("source"), F.col("told.lang").alias("lang"), topic.alias("topic"), n.alias("tokens")).alias("cell"))


def tempered(tokens: np.ndarray, at: np.ndarray, power: float) -> np.ndarray:
    """Target tokens of each value: shares to the given power, over the same total."""
    sums = np.bincount(at, tokens)
    share = np.where(sums > 0, sums, 0) ** power
    return share / share.sum() * tokens.sum() if share.sum() else share


def goals_of(cells: list[tuple], targets: Targets | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """By dimension, each cell's value as a number and the target tokens of the values."""
    t = np.array([float(c[3]) for c in cells])
    out = []
    for i, d in enumerate(DIMS if cells else ()):
        names, at = np.unique([c[i] for c in cells], return_inverse=True)
        if targets and d in targets:
            share = np.array([max(0.0, float(targets[d].get(str(x), 0.0))) for x in names]) * (np.bincount(at, t) > 0)
            if not share.sum():
                raise ValueError(f"no target of {d} has documents")
            out.append((at, share / share.sum() * t.sum()))
        else:
            out.append((at, tempered(t, at, TEMPER[d])))
    return out


def rake(cells: list[tuple], rounds: int = ROUNDS, targets: Targets | None = None) -> np.ndarray:
    """Raked tokens of cells (source, lang, topic, tokens)."""
    w = np.array([float(c[3]) for c in cells])
    goals = goals_of(cells, targets)
    for _ in range(rounds):
        worst = 0.0
        for at, goal in goals:
            now = np.bincount(at, w)
            factor = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
            worst = max(worst, float(np.abs(factor[now > 0] - 1).max(initial=0.0)))
            w = w * factor[at]
        if worst <= CLOSE:
            break
    return w


def residuals(cells: list[tuple], w: np.ndarray, targets: Targets | None = None) -> dict[str, float]:
    """By dimension, the largest difference of a raked total from its target, over all tokens."""
    total = max(sum(float(c[3]) for c in cells), 1.0)
    return {d: float(np.abs(np.bincount(at, w) - goal).max() / total) for d, (at, goal) in zip(DIMS, goals_of(cells, targets))}


def calibrated(t: np.ndarray, w: np.ndarray, budget: float) -> np.ndarray:
    """Probabilities min(1, c * w / t) with sum(t * p) equal to budget * sum(t)."""
    rate = np.divide(w, t, out=np.zeros_like(w), where=t > 0)
    order = np.argsort(-rate, kind="stable")
    goal = budget * t.sum()
    capped = np.concatenate([[0], np.cumsum(t[order])])[:-1]
    left = w.sum() - np.concatenate([[0], np.cumsum(w[order])])[:-1]
    c = np.divide(goal - capped, left, out=np.zeros_like(left), where=left > 1e-9)
    fits = c * rate[order] <= 1 + 1e-12
    scale = c[fits][0] if fits.any() else 0.0
    return np.where(t > 0, np.minimum(1.0, scale * rate), 1.0)


def rake_frame(scratch: Scratch, cells: DataFrame, rounds: int, targets: Targets | None = None) -> DataFrame:
    """The same raking where the cells are too many for the driver; a written table a round."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    cells = cells.withColumn("w", F.col("tokens").cast("double"))
    goals = {}
    for d in DIMS:
        if targets and d in targets:
            given = scratch.spark.createDataFrame([(k, max(0.0, float(v))) for k, v in targets[d].items()], f"{d} string, goal double")
            share = cells.groupBy(d).agg(F.sum("tokens").alias("n")).join(given, d, "left").select(d, F.when(F.col("n") > 0, F.coalesce("goal", F.lit(0.0))).otherwise(0.0).alias("share"))
        else:
            share = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(TEMPER[d])).alias("share"))
        whole = share.agg(F.sum("share")).first()[0] or 1.0
        goals[d] = scratch.cut(share.select(d, (F.col("share") / whole * float(total)).alias("goal")), f"goal-{d}")
    for k in range(rounds):
        for d in DIMS:
            now = cells.groupBy(d).agg(F.sum("w").alias("now")).join(goals[d], d).select(d, F.when(F.col("now") > 0, F.col("goal") / F.col("now")).otherwise(0.0).alias("f"))
            cells = cells.join(now, d).withColumn("w", F.col("w") * F.col("f")).select(*DIMS, "tokens", "w")
        cells = scratch.cut(cells, f"cells{k}")
    return cells


def scale_of_frame(cells: DataFrame, goal: float, parts: int = 64) -> float:
    """The factor c of ``calibrated`` for a table of cells, by cutting an interval into parts; each cut is one aggregation."""

    def drawn(cs: list[float]) -> list[float]:
        row = cells.agg(*[F.sum(F.least(F.col("tokens").cast("double"), F.lit(c) * F.col("w"))) for c in cs]).first()
        return [x or 0.0 for x in row]

    powers = [2.0**k for k in range(-20, 41)]
    enough = [c for c, x in zip(powers, drawn(powers)) if x >= goal * (1 - 1e-12)]
    hi = enough[0] if enough else powers[-1]
    lo = hi / 2 if enough and hi > powers[0] else 0.0
    for _ in range(8):
        cs = [lo + (hi - lo) * k / parts for k in range(1, parts + 1)]
        k = next((k for k, x in enumerate(drawn(cs[:-1])) if x >= goal), parts - 1)
        lo, hi = lo + (hi - lo) * k / parts, cs[k]
    return hi


def cell_table(spark: SparkSession, scratch: Scratch, rows: DataFrame, budget: float = BUDGET, rounds: int = ROUNDS, max_cells: int = MAX_CELLS, targets: Targets | None = None) -> DataFrame:
    """(source, lang, topic, weight, probability) of every cell of feature rows."""
    cells = rows.groupBy(*(F.col(f"cell.{d}").alias(d) for d in DIMS)).agg(F.sum("cell.tokens").alias("tokens"))
    cells = scratch.cut(cells, "cells")
    if cells.count() > max_cells:
        raked = rake_frame(scratch, cells, rounds, targets)
        goal = budget * (cells.agg(F.sum("tokens")).first()[0] or 0)
        c = scale_of_frame(raked, goal)
        rate = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0)
        return raked.select(*DIMS, rate.alias("weight"), F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(c) * rate)).otherwise(1.0).alias("probability"))
    got = [tuple(r) for r in cells.orderBy(*DIMS).collect()]
    t = np.array([float(r[3]) for r in got])
    w = rake(got, rounds, targets)
    p = calibrated(t, w, budget) if got else t
    rate = np.divide(w, t, out=np.zeros_like(w), where=t > 0)
    out = [(*r[:3], float(a), float(b)) for r, a, b in zip(got, rate, p)]
    return F.broadcast(spark.createDataFrame(out, "source string, lang string, topic string, weight double, probability double"))


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":mix"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def weighted(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Feature rows (kept, cell) with weight and probability."""
    same = [F.col(f"cell.{d}") == F.col(f"of.{d}") for d in DIMS]
    return rows.join(cells.select(F.struct(*DIMS).alias("of"), "weight", "probability"), same, "left").drop("of")


def mixed(spark: SparkSession, docs: DataFrame, targets: Targets | None = None, budget: float = BUDGET) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability, sampled) of every row of docs."""
    scratch = Scratch(spark, "mixing")
    rows = scratch.cut(features(docs, "doc_id"), "features")
    out = weighted(rows, cell_table(spark, scratch, rows, budget, targets=targets))
    names = [F.col(f"cell.{d}").alias(d) for d in DIMS]
    sampled = draw(F.col("kept.doc_id")) < F.col("probability")
    return out.select("kept.doc_id", *names, F.col("cell.tokens").alias("n_tokens"), F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), sampled.alias("sampled"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, read_table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the drawn rows stay, whole.

    Cells are broadcast to the rows, so texts aren't shuffled; a row travels as one
    struct, so extra columns of any name come through as they are.
    """
    scratch = Scratch(spark, "mixing-stage")
    cells = cell_table(spark, scratch, features(docs, "doc_id"))
    out = weighted(features(docs, *[F.col(f"`{c}`") for c in docs.columns]), cells)
    return out.filter(draw(F.col("kept.doc_id")) < F.col("probability")).select(*[F.col("kept")[c].alias(c) for c in docs.columns])


def _sql() -> str:
    text = "coalesce(text, '')"
    parts = [f"""d0 as (select doc_id, coalesce(source, '(none)') source, coalesce(lang, '(none)') lang, {text} t,
        cast(len(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')) as bigint) n from documents)""",
        """d as (select doc_id, source, lang, n, case
        when 5 * (length(t) - length(replace(t, '|', ''))) > n then 'tabular'
        when 2 * (length(t) - length(translate(t, '#*$%&<>', ''))) > n then 'symbolic'
        when contains(lower(t), 'license') then 'legal' when n < 100 then 'note' when n < 2000 then 'article' else 'book' end topic from d0)""",
        "c as (select source, lang, topic, cast(sum(n) as double) t from d group by all)"]
    for d, p in TEMPER.items():
        parts.append(f"g_{d} as materialized (select {d}, s ** {p} / sum(s ** {p}) over () * sum(s) over () goal from (select {d}, sum(t) s from c group by all))")
    joins = " ".join(f"join g_{d} using ({d})" for d in DIMS)
    parts.append(f"w0 as materialized (select source, lang, topic, t, t w, {', '.join(f'g_{d}.goal goal_{d}' for d in DIMS)} from c {joins})")
    k = 0
    for _ in range(ROUNDS):
        for d in DIMS:
            parts.append(f"w{k + 1} as materialized (select * exclude (w), case when sum(w) over x > 0 then w * goal_{d} / sum(w) over x else 0 end w from w{k} window x as (partition by {d}))")
            k += 1
    parts.append(f"""r as materialized (select *, case when t > 0 then w / t else 0 end rate from w{k})""")
    parts.append(f"""o as (select *, {BUDGET} * sum(t) over () - coalesce(sum(t) over before, 0) room, sum(w) over () - coalesce(sum(w) over before, 0) rest,
        row_number() over (order by rate desc, source, lang, topic) i from r window before as (order by rate desc, source, lang, topic rows between unbounded preceding and 1 preceding))""")
    parts.append("s as (select coalesce(arg_min(room / rest, i), 0) c from o where rest > 1e-9 and room / rest * rate <= 1 + 1e-12)")
    parts.append("p as (select source, lang, topic, rate, case when t > 0 then least(1, s.c * rate) else 1 end prob from r, s)")
    parts.append("""u as (select *, md5(coalesce(cast(doc_id as varchar), '') || ':mix') h from d)""")
    digit = "list_sum(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', substr(h, i, 1)) - 1) * (16 ** (8 - i))))"
    return "with " + ", ".join(parts) + f""" select doc_id, source, lang, topic, n n_tokens, round(rate, 6) weight, round(prob, 6) probability, {digit} / 4294967296e0 < prob sampled
        from u join p using (source, lang, topic)"""


ORACLE_SQL = _sql()
