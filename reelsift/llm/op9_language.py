"""Language identification with interpolated Kneser-Ney character models.

Every language gets an order-4 model over 16-bit character units.  Counts of all
training documents are summed by Spark; the tables are hash arrays in sorted
order, probed by binary search.  Beyond ``MAX_GRAMS`` the same model is fitted and
looked up as tables, by joins; no count is left out either way.  A document goes
to the language of the lowest cross-entropy per character; it is *rejected* when
even that one lies above a limit: the entropy that a stated share of the labelled
documents of that language and like length exceeds, measured on training documents
kept out of the counts.

Edge cases: null text or text without a letter (``str.isalpha``; digits, other
numerals and marks alone aren't letters) gives ``und``, score 0, rejected; a null id
is never held out but is not learned from either; repeated ids are judged row by
row; very long texts are scored whole, in pieces; without any training row every
document is ``und``; equal entropies go to the first language by name; an empty
table gives an empty result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.llm.common import Scratch, held_out_column, mix64, read_table, tune

ORDER = 4
#: Characters scored or counted at once.
CHUNK = 1_000_000
#: Most 4-grams that go to the driver; beyond it the model stays in tables.
MAX_GRAMS = 2_000_000
#: Sharpness of the reported score.
SHARPNESS = 10.0
#: Share of a language's own documents that its limit may reject, by length.
REJECT = 0.001
#: Least characters of each class of length, and the calibration rows that a class needs for a limit of its own.
LENGTHS, LEAST = (0, 24, 64, 192, 768), 1000
#: Bits a character that the limit of a class with fewer rows lies above all that was seen.
SLACK = 1.0
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def clean(text: str | None) -> str:
    """Lower case, runs of anything but letters as one blank; '' without a letter."""
    if not text:
        return ""
    out = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if out and not out.replace(" ", "").isalpha():  # numerals that are no decimal digits
        out = " ".join("".join(c if c.isalpha() else " " for c in out).split())
    return out


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of cleaned texts and the end of each text's grams.

    Each text is framed by three blanks before and one after; only positions of
    the text itself and its closing blank are predicted.
    """
    frame = "   " + "    ".join(texts) + " "
    u = np.frombuffer(frame.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint64)
    packed = (u[:-3] << np.uint64(48)) | (u[1:-2] << np.uint64(32)) | (u[2:-1] << np.uint64(16)) | u[3:]
    sizes = np.array([len(t.encode("utf-16-le", "surrogatepass")) // 2 + 1 for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes + 3)[:-1]])
    keep = np.ones(len(packed), bool)
    for lag in range(3):
        gap = starts[1:] - 3 + lag
        keep[gap] = False
    return packed[keep], np.cumsum(sizes)


def chunks(texts: list[str]) -> Iterator[list[str]]:
    batch, size = [], 0
    for t in texts:
        batch.append(t)
        size += len(t)
        if size >= CHUNK:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, n), summed within the batch."""
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), dtype=object)
        texts = b.column("text").to_pylist()
        for lang in dict.fromkeys(langs):
            mine = [c for c in (clean(texts[i]) for i in np.flatnonzero(langs == lang)) if c]
            for part in chunks(mine):
                g, n = np.unique(grams(part)[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(g), pa.string()), "gram": pa.array(g.view(np.int64)), "n": pa.array(n.astype(np.int64))})


@dataclass
class HashTable:
    """Values by hashed key, in the hashes' order."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> HashTable:
        h = mix64(keys)
        order = np.argsort(h)
        return cls(h[order], values[order].astype(np.float32))

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        out = np.full(len(keys), default, np.float32)
        if len(self.keys):
            h = mix64(keys)
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            found = self.keys[at] == h
            out[found] = self.values[at[found]]
        return out


@dataclass
class KneserNey:
    """One language: full probabilities by order and the back-off weight of each context."""

    probs: list[HashTable] = field(default_factory=list)
    weights: list[HashTable] = field(default_factory=list)
    floor: float = 1e-6

    @classmethod
    def fit(cls, gram: np.ndarray, count: np.ndarray) -> KneserNey:
        """From distinct packed 4-grams and their counts."""
        tables: list[tuple[np.ndarray, np.ndarray]] = [(gram, count.astype(np.float64))]
        for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct characters to the left
            mask = np.uint64((1 << (16 * k)) - 1)
            tables.append(np.unique(tables[-1][0] & mask, return_counts=True))
        tables.reverse()
        model, lower = cls(), None
        model.floor = 1.0 / (len(tables[0][0]) + 1)
        for k, (g, c) in enumerate(tables, start=1):
            c = c.astype(np.float64)
            ones, twos = (c == 1).sum(), (c == 2).sum()
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            ctx, at = np.unique(g >> np.uint64(16), return_inverse=True)
            total = np.bincount(at, c)
            weight = d * np.bincount(at) / total
            below = np.full(len(g), model.floor) if lower is None else lower(g & np.uint64((1 << (16 * (k - 1))) - 1))
            p = np.maximum(c - d, 0) / total[at] + weight[at] * below
            model.probs.append(HashTable.build(g, p))
            model.weights.append(HashTable.build(ctx, weight))
            lower = model.probs[-1].get if k == ORDER else (lambda x, t=model.probs[-1]: t.get(x, 0.0))
        return model

    def log_prob(self, gram: np.ndarray) -> np.ndarray:
        """log2 p(last character | three before) of packed 4-grams."""
        p = np.full(len(gram), self.floor, np.float32)
        for k in range(1, ORDER + 1):
            g = gram & np.uint64((1 << (16 * k)) - 1) if k < ORDER else gram
            backed = self.weights[k - 1].get(g >> np.uint64(16), 1.0) * p
            seen = self.probs[k - 1].get(g, -1.0)
            p = np.where(seen > 0, seen, backed)
        return np.log2(p)


@dataclass
class LanguageModel:
    langs: list[str]
    models: list[KneserNey]
    limits: dict[tuple[str, int], float] = field(default_factory=dict)

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits a character of cleaned, non-empty texts under each language."""
        out = []
        for part in chunks(texts):
            g, ends = grams(part)
            at, distinct = pd.factorize(g.view(np.int64))
            table = np.stack([m.log_prob(distinct.view(np.uint64)) for m in self.models], axis=1)
            starts = np.concatenate([[0], ends[:-1]])
            cols = [np.add.reduceat(table[:, j][at].astype(np.float64), starts) for j in range(len(self.models))]
            out.append(-np.stack(cols, axis=1) / (ends - starts)[:, None])
        return np.concatenate(out) if out else np.empty((0, len(self.models)))

    def score(self, df: DataFrame) -> DataFrame:
        return score_frame(df.sparkSession.sparkContext.broadcast(self), df)


def suffix(gram: Column, k: int) -> Column:
    """The last k units of packed grams."""
    return gram.bitwiseAND(F.lit((1 << (16 * k)) - 1)) if k < ORDER else gram


def context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 16)


def document_grams(df: DataFrame) -> DataFrame:
    """(columns but text, grams, ns): each text's distinct 4-grams and their counts."""
    keep = [c for c in df.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(grams([c])[0], return_counts=True) if c else (np.empty(0, np.uint64), np.empty(0, np.int64)) for c in map(clean, b.column("text").to_pylist())]
            new = {"grams": pa.array([g.view(np.int64) for g, _ in found], pa.list_(pa.int64())), "ns": pa.array([n for _, n in found], pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict({c: b.column(c) for c in keep} | new)

    longs = T.ArrayType(T.LongType())
    return df.mapInArrow(run, T.StructType([df.schema[c] for c in keep]).add("grams", longs).add("ns", longs))


@dataclass
class StoredModel:
    """The same model as written tables, for more 4-grams than the driver takes.

    ``probs[k - 1]`` is (i, g, p) and ``weights[k - 1]`` (i, ctx, w) of order k; i is
    the language's place in ``langs``.  No key of a join among them has more rows
    than there are character units.
    """

    scratch: Scratch
    langs: list[str]
    floors: list[float]
    probs: list[DataFrame]
    weights: list[DataFrame]
    limits: dict[tuple[str, int], float] = field(default_factory=dict)

    @classmethod
    def fit(cls, scratch: Scratch, counts: DataFrame) -> StoredModel:
        """KneserNey.fit of every language on (lang, gram, n)."""
        spark = scratch.spark
        langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
        places = spark.createDataFrame(list(enumerate(langs)), "i int, lang string")
        tables = [counts.join(F.broadcast(places), "lang").select("i", F.col("gram").alias("g"), F.col("n").cast("double").alias("c"))]
        for k in range(ORDER - 1, 0, -1):
            tables.append(scratch.cut(tables[-1].groupBy("i", suffix(F.col("g"), k).alias("g")).agg(F.count("*").cast("double").alias("c")), f"order{k}"))
        tables.reverse()
        model = cls(scratch, langs, [], [], [])
        for k, t in enumerate(tables, start=1):
            sizes = sorted(t.groupBy("i").agg(F.count("*").alias("all"), F.count_if(F.col("c") == 1).alias("ones"), F.count_if(F.col("c") == 2).alias("twos")).collect())
            if k == 1:
                model.floors = [1.0 / (r["all"] + 1) for r in sizes]
            rows = [(r["i"], r["ones"] / (r["ones"] + 2 * r["twos"]) if r["ones"] and r["twos"] else 0.5, model.floors[r["i"]]) for r in sizes]
            t = t.join(F.broadcast(spark.createDataFrame(rows, "i int, d double, floor double")), "i").withColumn("ctx", context(F.col("g")))
            sums = t.groupBy("i", "ctx").agg(F.sum("c").alias("total"), (F.first("d") * F.count("*") / F.sum("c")).alias("w"))
            sums = scratch.cut(sums, f"weights{k}")
            below = F.col("floor")
            t = t.join(sums, ["i", "ctx"])
            if k > 1:
                low = model.probs[-1].select("i", F.col("g").alias("low"), F.col("p").cast("double").alias("below"))
                t, below = t.withColumn("low", suffix(F.col("g"), k - 1)).join(low, ["i", "low"]), F.col("below")
            p = F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("w") * below
            model.probs.append(scratch.cut(t.select("i", "g", p.cast("float").alias("p")), f"probs{k}"))
            model.weights.append(sums.select("i", "ctx", F.col("w").cast("float").alias("w")))
            if k < ORDER:
                scratch.drop(f"order{k}")
        return model

    def log_probs(self, needed: DataFrame) -> DataFrame:
        """(gram, lps): log2 p(last character | three before) by language, of distinct packed 4-grams."""
        wanted = [needed.select(F.col("gram").alias("g"))]
        for k in range(ORDER - 1, 0, -1):
            wanted.append(wanted[-1].select(suffix(F.col("g"), k).alias("g")).distinct())
        wanted.reverse()
        places = self.scratch.spark.createDataFrame(list(enumerate(self.floors)), "i int, floor double")
        q = None
        for k, t in enumerate(wanted, start=1):
            t = t.crossJoin(F.broadcast(places)).withColumn("ctx", context(F.col("g")))
            t = t.join(self.weights[k - 1], ["i", "ctx"], "left").join(self.probs[k - 1], ["i", "g"], "left")
            below = F.col("floor").cast("float")
            if q is not None:
                t, below = t.withColumn("low", suffix(F.col("g"), k - 1)).join(q.select("i", F.col("g").alias("low"), F.col("q").alias("below")), ["i", "low"]), F.col("below")
            backed = F.coalesce(F.col("w"), F.lit(1.0).cast("float")) * below
            q = self.scratch.cut(t.select("i", "g", F.when(F.col("p") > 0, F.col("p")).otherwise(backed).alias("q")), f"backed{k}")
        pairs = F.array_sort(F.collect_list(F.struct("i", F.log2("q").cast("float").alias("lp"))))
        return q.groupBy(F.col("g").alias("gram")).agg(F.transform(pairs, lambda x: x["lp"]).alias("lps"))

    def score(self, df: DataFrame) -> DataFrame:
        """As score_frame, by joins: each document's counts with its grams' table."""
        keep = [c for c in df.columns if c != "text"]
        rows = self.scratch.cut(document_grams(df.withColumn("__row", F.monotonically_increasing_id())), "rows")
        each = rows.select("__row", F.explode(F.arrays_zip("grams", "ns")).alias("x")).select("__row", F.col("x.grams").alias("gram"), F.col("x.ns").alias("n"))
        lps = self.log_probs(each.select("gram").distinct())
        bits = F.array(*[-F.sum(F.col("n") * F.col("lps")[i].cast("double")) / F.sum("n") for i in range(len(self.langs))])
        sums = each.join(lps, "gram").groupBy("__row").agg(bits.alias("h"), F.sum("n").alias("letters"))
        low = F.array_min("h")
        total = F.aggregate("h", F.lit(0.0), lambda a, x: a + F.pow(F.lit(2.0), -SHARPNESS * (x - low)))
        second = F.array_sort("h")[1] if len(self.langs) > 1 else low + 1.0
        pred = F.element_at(F.array(*map(F.lit, self.langs)), F.array_position("h", low).cast("int"))
        sums = sums.select("__row", pred.alias("lang_pred"), (1.0 / total).alias("score"), low.alias("cross_entropy"), second.alias("runner_up"), "letters")
        out = rows.select("__row", *keep).join(sums, "__row", "left")
        return out.select(*keep, F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), F.coalesce("score", F.lit(0.0)).alias("score"), "cross_entropy", "runner_up", F.coalesce("letters", F.lit(0).cast("long")).alias("letters"))


def fit(spark: SparkSession, scratch: Scratch, rows: DataFrame, max_grams: int | None = None) -> LanguageModel | StoredModel:
    """Learns from rows (text, lang) without nulls; counts cover all of them."""
    counts = rows.select("lang", "text").mapInArrow(count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = scratch.cut(counts, "grams")
    if counts.count() > (MAX_GRAMS if max_grams is None else max_grams):
        model = StoredModel.fit(scratch, counts)
        scratch.drop("grams")
        return model
    pdf = counts.toPandas()
    scratch.drop("grams")
    langs = sorted(pdf["lang"].unique())
    models = []
    for lang in langs:
        mine = pdf[pdf["lang"] == lang]
        models.append(KneserNey.fit(mine["gram"].to_numpy(np.int64).view(np.uint64), mine["n"].to_numpy()))
    return LanguageModel(langs, models)


def _scored(model_box, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, list[int]]:
    model: LanguageModel = model_box.value
    cleaned = [clean(t) for t in texts]
    some = [i for i, c in enumerate(cleaned) if c]
    pred, score, best = ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
    second = np.full(len(texts), np.nan)
    if some and model.langs:
        h = model.entropies([cleaned[i] for i in some])
        at = h.argmin(1)
        low = h.min(1)
        score[some] = 1.0 / np.exp2(-SHARPNESS * (h - low[:, None])).sum(1)
        best[some] = low
        second[some] = np.sort(h, 1)[:, 1] if h.shape[1] > 1 else low + 1.0
        for i, a in zip(some, at):
            pred[i] = model.langs[a]
    return pred, score, best, second, [len(c.encode("utf-16-le", "surrogatepass")) // 2 + 1 if c else 0 for c in cleaned]


def score_frame(model_box, df: DataFrame) -> DataFrame:
    """Adds lang_pred, score, cross_entropy, runner_up, letters (characters scored) to (row columns..., text), dropping text."""
    keep = [c for c in df.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score, best, second, letters = _scored(model_box, b.column("text").to_pylist())
            cols = {c: b.column(c) for c in keep}
            yield pa.RecordBatch.from_pydict(cols | {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score), "cross_entropy": pa.array(best, from_pandas=True), "runner_up": pa.array(second, from_pandas=True), "letters": pa.array(letters, pa.int64())})

    out = T.StructType([df.schema[c] for c in keep])
    for name, kind in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("cross_entropy", T.DoubleType()), ("runner_up", T.DoubleType()), ("letters", T.LongType())):
        out = out.add(name, kind)
    return df.mapInArrow(run, out)


def length_class(letters: Column) -> Column:
    out = F.lit(0)
    for k, least in enumerate(LENGTHS):
        out = F.when(letters >= least, F.lit(k)).otherwise(out)
    return out


def calibrate(model: LanguageModel | StoredModel, rows: DataFrame, rate: float = REJECT, least: int = LEAST) -> None:
    """Sets the limits from labelled rows that the counts haven't seen: by language and length class.

    A class with ``least`` rows takes the entropy that a share of ``rate`` of its
    right-language documents exceeds.  One with fewer can't show so small a share;
    its limit lies ``SLACK`` above all that the language's rows have.
    """
    if not model.langs:
        return
    out = model.score(rows.select("lang", "text")).filter("lang = lang_pred").withColumn("k", length_class(F.col("letters")))
    found = out.groupBy("lang", "k").agg(F.count("*").alias("n"), F.percentile_approx("cross_entropy", F.lit(1.0 - rate), F.lit(10_000)).alias("q"), F.max("cross_entropy").alias("top")).collect()
    for lang in {r["lang"] for r in found}:
        mine = {r["k"]: r for r in found if r["lang"] == lang}
        top = max(r["top"] for r in mine.values()) + SLACK
        for k in range(len(LENGTHS)):
            model.limits[lang, k] = mine[k]["q"] if k in mine and mine[k]["n"] >= least else top


def judged(spark: SparkSession, docs: DataFrame, *keep: Column | str) -> DataFrame:
    """Kept columns of docs with held_out, lang_pred, score, cross_entropy, rejected of every row."""
    tune(spark)
    scratch = Scratch(spark, "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    labelled = docs.filter("text is not null and lang is not null and doc_id is not null").select("doc_id", "lang", "text")
    model = fit(spark, scratch, labelled.filter(fold > 1))
    calibrate(model, labelled.filter(fold == 1))
    rows = docs.select(*keep, held_out_column().alias("held_out"), "text")
    out = model.score(rows)
    limit = F.lit(None).cast("double")
    for (lang, k), v in sorted(model.limits.items()):
        limit = F.when((F.col("lang_pred") == lang) & (length_class(F.col("letters")) == k), F.lit(float(v))).otherwise(limit)
    rejected = (F.col("lang_pred") == "und") | F.coalesce(F.col("cross_entropy") > limit, F.lit(False))
    return out.withColumn("rejected", rejected).drop("runner_up", "letters")


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, cross_entropy, rejected) of every row of docs."""
    return judged(spark, docs, "doc_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, read_table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose language is unknown or rejected go; ``lang`` of the others becomes the predicted one.

    Each row travels through the scorer as one struct and is judged by itself, so
    there is no join: repeated and null ids, and columns of any name, do no harm.
    Null and letterless texts go; an empty table stays empty.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = judged(spark, docs, row).filter("not rejected")
    return out.select(*[(F.col("lang_pred") if c == "lang" else F.col("row")[c]).alias(c) for c in docs.columns])
