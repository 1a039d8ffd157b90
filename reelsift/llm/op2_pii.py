"""Personal data by weak supervision, in DataFrame and SQL functions only.

Base spans come from four fixed patterns and always stay.  Looser patterns offer
further candidates.  Every candidate gets votes of five labelers (shape, gazetteer,
context, boundary, filler digits; 1 personal, -1 not, 0 abstains).  Spark counts
the vote patterns, of which there is a bounded number; expectation-maximisation
over those counts estimates each labeler's reliability, and a logistic span
classifier is trained on the posteriors.  It is applied as one Column expression
to the candidates that aren't base spans.

Offsets are code points, end exclusive.  Edge cases: null text counts as empty,
with no spans; every input row gives one row, repeated or null ids included; spans
that start together stand in the order of their kinds; an empty table gives an
empty result; extra columns are ignored, whatever their names.  Patterns use
possessive repeats and look-behinds where these can't change a match, so that
long texts need neither deep stacks nor quadratic rescans.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.common import Scratch, read_table

BASE = ("email", "ip", "card", "phone")
MORE = ("phone_local", "national_id", "name", "secret")
KINDS = BASE + MORE
#: Pattern and the text without which it can't match.
PATTERNS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "."),
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])", ""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "phone_local": (r"(?<![0-9+(.-])(?<![0-9][\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?!\.?[0-9]|[\x20-][0-9])", ""),
    "national_id": (r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])", "-"),
    "name": (r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Sr|Sra|Don)\.?\x20\p{Lu}\p{Ll}{2,20}\x20\p{Lu}\p{Ll}{2,20}\b", ""),
    "secret": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+", ""),
}
#: Fixed word lists of the labelers.
TOP_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us|ca|ch|at|it|nl|be|pt|mx|ar|br|au|jp|cn|in|ru|pl|se|no|dk|fi"
DIAL_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
FIRST_NAMES = "Anna|Maria|Marie|John|Jean|Juan|Hans|Peter|Pierre|Pedro|Paul|Pablo|James|Mary|Robert|Michael|Thomas|David|Daniel|Sarah|Laura|Julia|Carlos|Jose|Luis|Carmen|Sophie|Camille|Claire|Klaus|Stefan|Sabine|Petra|Susan|Linda|William|Richard|Elena|Lucia"
NEAR_WORDS = r"(?i)(?:e-?mail|mail|contact|write|kontakt|correo|courriel|phone|call|tel|fon|mobile|handy|t[eé]l[eé]fono|t[eé]l[eé]phone|fax|card|karte|carte|tarjeta|visa|address|adresse|direcci[oó]n|host|server|login|ssn|social|name|token|key|secret|passwor[dt]|pwd|bearer|contrase[nñ]a)\W{0,12}$"
KEY_HEADS = "AKIA|ASIA|AIza|gh[pousr]_|sk-|xox[abp]-|eyJ"
FAR_WORDS = r"(?i)(?:version|release|isbn|issn|page|seite|chapter|kapitel|section|figure|table|order|invoice|item|total|sum|ratio|doi)\W{0,6}$"
VOTES = ("shape", "gazetteer", "context", "edge", "filler")


def _raw(p: str) -> str:
    return "r'" + p + "'"


def _found(kind: str) -> str:
    """SQL for the array of (kind, s, e, m) of one pattern in the column ``t``."""
    pattern, needs = PATTERNS[kind]
    all_of = f"regexp_extract_all(t, {_raw(pattern)}, 0)"
    none = "cast(array() as array<struct<kind:string,s:int,e:int,m:string>>)"
    fold = f"""aggregate(
        zip_with(slice(split(t, {_raw(pattern)}, -1), 1, size({all_of})), {all_of}, (p, m) -> struct(length(p) as gap, m as m)),
        struct(0 as at, {none} as got),
        (acc, x) -> struct(acc.at + x.gap + length(x.m) as at,
            array_append(acc.got, struct('{kind}' as kind, acc.at + x.gap as s, acc.at + x.gap + length(x.m) as e, x.m as m)) as got),
        acc -> acc.got)"""
    when = f"contains(t, '{needs}') and " if needs else ""
    return f"case when {when} rlike(t, {_raw(pattern)}) then {fold} else {none} end"


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_IP_PART = r"forall(split(x.m, r'\.'), p -> rlike(p, r'^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$'))"
VALID = f"""case x.kind
    when 'email' then true
    when 'ip' then {_IP_PART}
    when 'card' then luhn_check({_DIGITS})
    when 'phone' then length({_DIGITS}) between 9 and 15
    else true end"""
_BEFORE = "substring(t, greatest(x.s - 29, 1), least(x.s, 30))"
_AFTER = "substring(t, x.e + 1, 1)"
_VOTE = {
    "shape": r"""case x.kind
        when 'email' then if(rlike(x.m, r'^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@'), 1, -1)
        when 'ip' then if(rlike(x.m, r'(?:^|\.)0[0-9]'), -1, 1)
        when 'card' then if(rlike(x.m, r'^[0-9]{13,19}$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}$'), 1, 0)
        when 'phone' then if(rlike(x.m, r'^\+[0-9]{1,3}[ -]?\(?[0-9]'), 1, 0)
        when 'secret' then if(rlike(x.m, r'^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})$') or (rlike(x.m, '[a-z]') and rlike(x.m, '[A-Z]')), 1, -1)
        when 'name' then 0 else 1 end""",
    "gazetteer": rf"""case x.kind
        when 'email' then if(rlike(x.m, r'\.(?:{TOP_DOMAINS})$'), 1, 0)
        when 'ip' then if(rlike(x.m, r'^(?:0|127|255)\.'), -1, 1)
        when 'card' then if(rlike(x.m, r'^(?:4|5[1-5]|2[2-7]|3[47]|6)'), 1, 0)
        when 'phone' then if(rlike(x.m, r'^\+(?:{DIAL_CODES})'), 1, -1)
        when 'phone_local' then if(rlike(x.m, r'^\(?[2-9]'), 1, -1)
        when 'national_id' then if(rlike(x.m, r'^(?:000|666|9)|-00-|-0000$'), -1, 1)
        when 'secret' then if(rlike(x.m, r'^(?:{KEY_HEADS})'), 1, 0)
        else if(rlike(x.m, r'\b(?:{FIRST_NAMES})\b'), 1, -1) end""",
    "context": f"case when rlike({_BEFORE}, {_raw(NEAR_WORDS)}) then 1 when rlike({_BEFORE}, {_raw(FAR_WORDS)}) then -1 else 0 end",
    "edge": rf"if(rlike({_BEFORE}, r'[\p{{L}}\p{{N}}_]$') or rlike({_AFTER}, r'^[\p{{L}}\p{{N}}_]'), -1, 1)",
    "filler": rf"if(rlike({_DIGITS}, r'^(?:([0-9])\1+|0*1234567[0-9]*|9876543[0-9]*)$') or rlike(x.m, r'(?i)^(?:test|user|name|no-?reply)@'), -1, 0)",
}


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """docs (t, keep...) with ``c``: array of (kind, s, e, base, votes..., long), failing base matches dropped."""
    found = "concat(" + ", ".join(_found(k) for k in KINDS) + ")"
    votes = ", ".join(f"cast({_VOTE[v]} as int) as {v}" for v in VOTES)
    base = f"x.kind in ({', '.join(repr(k) for k in BASE)})"
    told = f"struct(x.kind as kind, x.s as s, x.e as e, {base} as base, {votes}, cast(x.e - x.s >= 16 as int) as wide)"
    out = docs.withColumn("f", F.expr(found)).withColumn("f", F.expr(f"filter(f, x -> {VALID})"))
    return out.withColumn("c", F.expr(f"transform(f, x -> {told})")).select(*keep, "c")


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 60) -> tuple[list[float], dict[str, list[float]]]:
    """Posterior of each vote pattern and, by labeler, P(1 | yes), P(1 | no) among its votes.

    Starts from the smoothed majority; abstentions carry no evidence.
    """
    m = len(VOTES)
    post = [1 / (1 + math.exp(-1.5 * sum(v))) for v, _ in patterns]
    rates: dict[str, list[float]] = {}
    for _ in range(rounds):
        yes = [[1.0, 1.0] for _ in range(m)]
        no = [[1.0, 1.0] for _ in range(m)]
        prior, total = 1.0, 2.0
        for (v, n), p in zip(patterns, post):
            prior += n * p
            total += n
            for j, x in enumerate(v):
                if x:
                    yes[j][x > 0] += n * p
                    no[j][x > 0] += n * (1 - p)
        a = [y[1] / sum(y) for y in yes]
        b = [x[1] / sum(x) for x in no]
        b = [min(bj, aj) for aj, bj in zip(a, b)]  # no labeler may turn round: a vote for yes never speaks against it
        rates = {k: [aj, bj] for k, aj, bj in zip(VOTES, a, b)}
        odds0 = math.log(prior / max(total - prior, 1e-9))
        post = []
        for v, _ in patterns:
            s = odds0
            for j, x in enumerate(v):
                if x > 0:
                    s += math.log(a[j] / b[j])
                elif x < 0:
                    s += math.log((1 - a[j]) / (1 - b[j]))
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, s)))))
    return post, rates


def train(rows: list[tuple[str, tuple[int, ...], int, float]], steps: int = 300) -> dict[str, float]:
    """Logistic weights over bias, kind, votes and width from (kind, votes, wide, count)."""
    names = ["bias", *KINDS, *VOTES, "wide"]
    if not rows:
        return dict.fromkeys(names, 0.0)
    post, _ = expectation_maximisation([(v, n) for _, v, _, n in rows])
    x = np.array([[1, *(k == kind for k in KINDS), *v, wide] for kind, v, wide, _ in rows], float)
    n = np.array([r[3] for r in rows], float)
    weight, y, w = n / n.sum(), np.array(post), np.zeros(len(names))
    for _ in range(steps):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-4 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(names))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return dict(zip(names, w.tolist()))


def fit(cands: DataFrame) -> dict[str, float]:
    """Counts vote patterns over all rows (at most kinds * 3**5 * 2 of them) and trains."""
    votes = [f"x.{v}" for v in VOTES]
    seen = cands.select(F.explode("c").alias("x")).groupBy("x.kind", *votes, "x.wide").count().orderBy("kind", *VOTES, "wide").collect()
    return train([(r["kind"], tuple(r[v] for v in VOTES), r["wide"], float(r["count"])) for r in seen])


def accepted(weights: dict[str, float]) -> Column:
    """The spans that stay: base ones, and others the classifier takes; in order."""
    kind = "case x.kind " + " ".join(f"when '{k}' then {weights[k]!r}D" for k in KINDS) + " end"
    score = f"({weights['bias']!r}D + {kind} + {weights['wide']!r}D * x.wide + " + " + ".join(f"{weights[v]!r}D * x.{v}" for v in VOTES) + ")"
    rank = "case x.kind " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS)) + " end"
    return F.expr(f"array_sort(transform(filter(c, x -> x.base or {score} > 0), x -> struct(x.s as s, {rank} as k, x.e as e, x.kind as kind, x.base as base)))")


_JOINED = "array_join(transform({}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"


def found(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more) of every row of docs (doc_id, text)."""
    scratch = Scratch(spark, "pii")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    cands = scratch.cut(candidates(docs, "doc_id"), "candidates")
    out = cands.select("doc_id", accepted(fit(cands)).alias("a"))
    base = "filter(a, x -> x.base)"
    counts = [F.expr(f"cast(size(filter(a, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    more = F.expr("cast(size(filter(a, x -> not x.base)) as bigint)").alias("n_more")
    return out.select("doc_id", *counts, F.sha2(F.expr(_JOINED.format(base)), 256).alias("base_sha256"), F.expr(_JOINED.format("a")).alias("spans"), more)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, read_table(spark, sf_dir, "documents"))


def redacted() -> Column:
    """``t`` with the spans ``a`` replaced by their kind in brackets; overlaps join."""
    return F.expr("""aggregate(a, struct(0 as at, '' as out),
        (acc, x) -> case
            when x.s >= acc.at then struct(x.e as at, concat(acc.out, substring(t, acc.at + 1, x.s - acc.at), '[', upper(x.kind), ']') as out)
            else struct(greatest(acc.at, x.e) as at, acc.out as out) end,
        acc -> concat(acc.out, substring(t, acc.at + 1)))""")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row stays, its spans masked and n_chars counted anew; null texts stay null.

    A row travels as one struct, so extra columns of any name come through as they are.
    """
    scratch = Scratch(spark, "pii-stage")
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("text", F.lit("")).alias("t"))
    cands = scratch.cut(candidates(base, "row", "t"), "candidates")
    out = cands.withColumn("a", accepted(fit(cands.select("c"))))
    text = F.when(F.col("row.text").isNull() | (F.size("a") == 0), F.col("row.text")).otherwise(redacted())
    new = out.select("row", text.alias("text"))
    kept = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return new.select(*(kept.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
