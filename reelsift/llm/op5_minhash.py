"""Near-duplicate classes by HyperMinHash.

1. Every text becomes its set of hashed 5-word shingles and one sketch: shingles
   fall into buckets, and a bucket keeps of its smallest hash only the number of
   leading zeros and some mantissa bits.
2. Empty buckets are filled by a fixed probing order (for banding alone) and the
   registers are cut into bands; a shared band makes a candidate.
3. Texts with equal word sequences are one node, of the smallest id.
4. Within a band's bucket each row meets one hub instead of every other row; rows
   outside the bucket's largest class then meet the rest of it in blocks, inside one
   Python function that keeps only pairs whose collision-corrected estimate is close.
5. Pairs that remain are confirmed on the full sets of both texts.

Edge cases: null or blank text has an empty set and is linked with nothing;
fewer words than five make one shingle; rows with a null id are never linked,
have a null component and are kept; repeated ids count as one document, each row
is returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.common import Scratch, WordHash, connected_components, lower_words, maybe_in, mix64, read_table, rolling

SHINGLE = 5
REGISTERS = 480
BAND_ROWS = 8
BANDS = REGISTERS // BAND_ROWS
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
#: Registers' standard error at 0.85 is 0.016; candidates may miss the limit by five of them.
SLACK = 0.08
#: Rows of one bucket compared in one block.
BLOCK = 512
HUB_ROUNDS = 2


def shingles(words: list[bytes], hashes: WordHash) -> np.ndarray:
    """Distinct hashed shingles of lower-cased words, sorted."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=5)], np.uint64)
    return np.unique(rolling(hashes.array(words), SHINGLE))


def registers(sh: np.ndarray) -> np.ndarray:
    """uint16 registers: leading zeros of the bucket's smallest hash, then mantissa bits."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if not len(sh):
        return out
    h = mix64(sh + np.uint64(0x632BE59BD9B4E019))
    bucket = ((h >> np.uint64(40)) * np.uint64(REGISTERS)) >> np.uint64(24)
    low = np.full(REGISTERS, np.uint64(1) << np.uint64(40), np.uint64)
    np.minimum.at(low, bucket.astype(np.int64), h & np.uint64((1 << 40) - 1))
    some = low < (np.uint64(1) << np.uint64(40))
    v = np.maximum(low[some], 1).astype(np.float64)  # 40 bits are exact in a double
    frac, exp = np.frexp(v)  # v = frac * 2**exp, 0.5 <= frac < 1
    zeros = 40 - exp
    mantissa = ((frac * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out[some] = (zeros.astype(np.int64) << MANTISSA) | mantissa
    return out


@lru_cache(1)
def probes() -> tuple[np.ndarray, np.ndarray]:
    """For each register the order in which it looks for a filled one, and each one's rank in it."""
    rng = np.random.default_rng(20240501)
    order = np.argsort(rng.random((REGISTERS, REGISTERS)), axis=1).astype(np.int16)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(REGISTERS, dtype=np.int16)[None, :].repeat(REGISTERS, 0), 1)
    return order, rank


def filled(regs: np.ndarray) -> np.ndarray:
    """Registers with every empty one taken from the first filled one in its probing order."""
    order, rank = probes()
    full = np.flatnonzero(regs != EMPTY)
    todo = np.flatnonzero(regs == EMPTY)
    if not len(full) or not len(todo):
        return regs
    out = regs.copy()
    if len(full) < 64:
        out[todo] = regs[full[rank[np.ix_(todo, full)].argmin(1)]]
        return out
    step = 0
    while len(todo):
        got = regs[order[todo, step]]
        hit = got != EMPTY
        out[todo[hit]] = got[hit]
        todo = todo[~hit]
        step += 1
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key a band of a filled sketch."""
    parts = filled(regs).view(np.uint64).reshape(BANDS, BAND_ROWS // 4)
    acc = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(parts.shape[1]):
        acc = mix64(acc ^ parts[:, j])
    return acc


def estimate(a: np.ndarray, b: np.ndarray, na, nb) -> np.ndarray:
    """Jaccard estimates of rows of registers, less the expected chance collisions.

    Two unrelated minima of n/k and m/k hashes share zeros and mantissa with
    probability near 0.7213 * 2**-t * nm / (n + m)**2.
    """
    used = (a != EMPTY) | (b != EMPTY)
    same = ((a == b) & used).sum(-1)
    used = np.maximum(used.sum(-1), 1)
    na, nb = np.asarray(na, float), np.asarray(nb, float)
    chance = 0.7213 / (1 << MANTISSA) * na * nb / np.maximum(na + nb, 1) ** 2
    return np.clip((same / used - chance) / (1 - chance), 0, 1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHash()
    for b in batches:
        key, kid, n, regs = [], [], [], []
        for text in b.column("text").to_pylist():
            words = lower_words(text)
            sh = shingles(words, hashes)
            key.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
            kid.append(int.from_bytes(key[-1][:8], "little", signed=True) if words else None)
            n.append(len(sh))
            regs.append(registers(sh).tobytes() if words else None)
        yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "key": pa.array(key, pa.binary()), "kid": pa.array(kid, pa.int64()), "n": pa.array(n, pa.int64()), "regs": pa.array(regs, pa.binary())})


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("kid").to_numpy(zero_copy_only=False)
        if len(ids):
            keys = np.concatenate([band_keys(np.frombuffer(r, np.uint16)) for r in b.column("regs").to_pylist()])
            yield pa.RecordBatch.from_pydict({"band": pa.array(keys.view(np.int64)), "kid": pa.array(np.repeat(ids, BANDS))})


def _close(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ra = np.frombuffer(b"".join(b.column("ra").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            rb = np.frombuffer(b"".join(b.column("rb").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            est = estimate(ra, rb, b.column("na").to_numpy(zero_copy_only=False), b.column("nb").to_numpy(zero_copy_only=False))
            ok = est >= threshold
            yield pa.RecordBatch.from_pydict({"a": b.column("a").filter(pa.array(ok)), "b": b.column("b").filter(pa.array(ok)), "est": pa.array(est[ok])})

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        last: tuple[int, np.ndarray] | None = None
        for b in batches:
            ok, inter = [], []
            for i, ta, tb in zip(b.column("a").to_pylist(), b.column("ta").to_pylist(), b.column("tb").to_pylist()):
                if last is None or last[0] != i:
                    last = (i, shingles(lower_words(ta), hashes))
                x, y = last[1], shingles(lower_words(tb), hashes)
                both = len(np.intersect1d(x, y, assume_unique=True))
                inter.append(both)
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_pydict({"a": b.column("a"), "b": b.column("b"), "ok": pa.array(ok, pa.bool_())})

    return run


def _within_bucket(threshold: float):
    """Pairs of different components inside runs of one (band, block pair), each at its first shared band only."""

    def pairs(ids, comps, sides, regs, n, keys, band):
        left = np.flatnonzero(sides != 1)  # 0: first block, 1: second block, 2: both
        right = np.flatnonzero(sides != 0)
        for i in left:
            js = right[(comps[right] != comps[i]) & (ids[right] > ids[i] if sides[i] == 2 else True)]
            if not len(js):
                continue
            est = estimate(regs[i][None], regs[js], n[i], n[js])
            js, est = js[est >= threshold], est[est >= threshold]
            if len(js):
                first = keys[js][np.arange(len(js)), (keys[js] == keys[i][None]).argmax(1)]
                for j, e in zip(js[first == band], est[first == band]):
                    yield min(ids[i], ids[j]), max(ids[i], ids[j]), e

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        now = None

        def flush():
            if len(held) < 2:
                return
            regs = np.frombuffer(b"".join(x[4] for x in held), np.uint16).reshape(-1, REGISTERS)
            keys = np.stack([band_keys(r) for r in regs]).view(np.int64)
            yield from pairs(np.array([x[0] for x in held]), np.array([x[1] for x in held]), np.array([x[2] for x in held]), regs, np.array([x[3] for x in held]), keys, now[0])

        def rows():
            nonlocal now, held
            for b in batches:
                for band, block, i, comp, side, n, r in zip(*(b.column(c).to_pylist() for c in ("band", "block", "id", "comp", "side", "n", "regs"))):
                    if (band, block) != now:
                        yield from flush()
                        held, now = [], (band, block)
                    held.append((i, comp, side, n, r))
            yield from flush()

        out: list = []
        for p in rows():
            out.append(p)
            if len(out) >= 20_000:
                a, b, e = zip(*out)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "est": pa.array(e, pa.float64())})
                out = []
        if out:
            a, b, e = zip(*out)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "est": pa.array(e, pa.float64())})

    return run


class NearDuplicates:
    """One run over (doc_id, text)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, percent: int = 85):
        self.spark, self.percent = spark, percent
        self.near = percent / 100 - SLACK
        self.t = Scratch(spark, "minhash")
        self.docs = docs.select("doc_id", "text")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose estimate is near or over the limit, with it."""
        side = self.reps.select("id", "n", "regs")
        with_a = pairs.join(side.withColumnsRenamed({"id": "a", "n": "na", "regs": "ra"}), "a")
        with_b = with_a.join(side.withColumnsRenamed({"id": "b", "n": "nb", "regs": "rb"}), "b")
        return with_b.filter(100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")).mapInArrow(_close(self.near), "a long, b long, est double")

    def confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of the written pairs that the full sets confirm, written."""
        ends = self.t.cut(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), f"{name}-ends")
        texts = maybe_in(self.docs, "doc_id", ends).join(ends, "doc_id").groupBy("doc_id").agg(F.first("text").alias("text"))
        texts = self.t.cut(texts, f"{name}-texts")
        both = pairs.select("a", "b").join(texts.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b").join(texts.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a")
        out = self.t.cut(both.select("a", "b", "ta", "tb").mapInArrow(_confirm(self.percent), "a long, b long, ok boolean").filter("ok").select("a", "b"), f"{name}-links")
        self.t.drop(f"{name}-texts")
        return out

    def with_components(self, rows: DataFrame, comps: DataFrame | None) -> DataFrame:
        if comps is None:
            return rows.withColumn("comp", F.col("id"))
        return rows.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))

    def run(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept) of every row."""
        t = self.t
        sketches = t.cut(self.docs.mapInArrow(_sketch, "doc_id long, key binary, kid long, n long, regs binary"), "sketches")
        whole = sketches.filter("key is not null and doc_id is not null")
        bands = t.cut(whole.select("kid", "regs").mapInArrow(_bands, "band long, kid long"), "bands")
        shared = bands.groupBy("band").agg(F.min("kid").alias("lo"), F.max("kid").alias("hi")).filter("lo < hi").select("band")
        live = t.cut(bands.join(shared, "band").distinct(), "live")
        t.drop("bands")
        kids = t.cut(live.select("kid").distinct(), "kids")
        # One node a word sequence: kid is a short hash, so that equal ones of different keys stay apart here.
        nodes = maybe_in(whole, "kid", kids).join(kids, "kid").groupBy("kid", "key").agg(F.min(F.struct("doc_id", "n", "regs")).alias("r"))
        self.reps = t.cut(nodes.select("kid", F.col("r.doc_id").alias("id"), "r.n", "r.regs"), "nodes")
        live = live.join(self.reps.select("kid", "id"), "kid").select("band", "id")
        sizes = live.groupBy("band").agg(F.count("*").alias("size"))
        weights = live.join(sizes, "band").groupBy("id").agg(F.sum("size").alias("weight"))
        live = t.cut(live.join(weights, "id").select("band", "id", "weight"), "weighted")

        no_link = t.cut(live.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0), "no-link")
        comps, links, tried = None, no_link, None
        for turn in range(HUB_ROUNDS):
            rows = self.with_components(live, comps)
            rank = F.struct(F.col("weight").alias("w"), (-F.col("id")).alias("i"), F.col("comp").alias("c"))
            if turn == 0:  # the row that shares most bands with others
                hubs = rows.groupBy("band").agg(F.max(rank).alias("h"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            else:  # the row of the smallest class
                hubs = rows.groupBy("band").agg(F.min(F.struct(F.col("comp").alias("c"), F.col("weight").alias("w"), (-F.col("id")).alias("i"))).alias("h"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            hubs = hubs.filter("lo < hi").select("band", (-F.col("h.i")).alias("hub"), F.col("h.c").alias("hub_comp"))
            pairs = rows.join(hubs, "band").filter("comp <> hub_comp").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            near = t.cut(self.estimated(pairs), f"near{turn}")
            if near.isEmpty():
                break
            tried = near.select("a", "b") if tried is None else tried.union(near.select("a", "b"))
            new = self.confirmed(near, f"hub{turn}")
            links = links.union(new)
            comps = connected_components(t, links, f"comps{turn}")

        comps = self.rest(live, links, comps)
        firsts = whole.groupBy("key").agg(F.min("doc_id").alias("id"))
        classes = t.cut(self.with_components(firsts, comps).select("key", "comp"), "classes")
        rows = sketches.select("doc_id", "key", F.col("n").alias("n_shingles"))
        # A written side and nothing above that needs the partitioning: a text with many copies can be split.
        out = rows.filter("key is not null").join(classes, "key", "left").unionByName(rows.filter("key is null").withColumn("comp", F.lit(None).cast("long")))
        return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

    def rest(self, live: DataFrame, links: DataFrame, comps: DataFrame | None) -> DataFrame | None:
        """Meets every pair of a bucket that hubs left in different components.

        Such a pair has a row outside the bucket's largest component.  Blocks of the
        largest one meet blocks of the others, and blocks of the others each other, so
        that rows of the largest are copied once a block of outsiders, not once a block.
        """
        t = self.t
        rows = self.with_components(live.select("band", "id"), comps)
        parts = rows.groupBy("band", "comp").agg(F.count("*").alias("size"))
        mixed = parts.groupBy("band").agg(F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("size")).filter("top.size < size")
        blocks = lambda n: F.ceil(n / BLOCK)
        mixed = mixed.select("band", F.col("top.comp").alias("largest"), blocks(F.col("top.size")).alias("inside"), blocks(F.col("size") - F.col("top.size")).alias("outside"))
        rows = rows.join(mixed, "band").withColumn("main", F.col("comp") == F.col("largest"))
        rows = rows.withColumn("mine", F.pmod(F.xxhash64("id"), F.when(F.col("main"), F.col("inside")).otherwise(F.col("outside"))))
        each = lambda n, f: F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), f)
        cell = lambda kind, x, y, side: F.struct((F.lit(kind << 61) + x * F.lit(1 << 30) + y).alias("block"), side.cast("int").alias("side"))
        mine = F.col("mine")
        of_main = each("outside", lambda k: cell(0, mine, k, F.lit(0)))
        to_main = each("inside", lambda k: cell(0, k, mine, F.lit(1)))
        apart = each("outside", lambda k: cell(1, F.least(mine, k), F.greatest(mine, k), F.when(mine == k, 2).when(mine < k, 0).otherwise(1)))
        rows = rows.withColumn("cell", F.explode(F.when(F.col("main"), of_main).otherwise(F.concat(to_main, apart))))
        rows = rows.select("band", "cell.block", "id", "comp", "cell.side")
        rows = rows.join(self.reps.select("id", "n", "regs"), "id")
        near = rows.repartition("band", "block").sortWithinPartitions("band", "block").select("band", "block", "id", "comp", "side", "n", "regs").mapInArrow(_within_bucket(self.near), "a long, b long, est double")
        near = t.cut(near, "rest-near")
        if near.isEmpty():
            return comps
        met = None
        for turn in ("best", "all"):
            todo = near.withColumn("ca", F.col("a")).withColumn("cb", F.col("b"))
            if comps is not None:
                here = comps.withColumnsRenamed({"id": "a", "comp": "ca"})
                there = comps.withColumnsRenamed({"id": "b", "comp": "cb"})
                todo = near.join(here, "a", "left").join(there, "b", "left").withColumn("ca", F.coalesce("ca", "a")).withColumn("cb", F.coalesce("cb", "b")).filter("ca <> cb")
            if turn == "best":  # for each two components their closest pair first
                todo = todo.groupBy(F.least("ca", "cb"), F.greatest("ca", "cb")).agg(F.max(F.struct("est", "a", "b")).alias("p")).select("p.a", "p.b")
            todo = todo.select("a", "b")
            if met is not None:  # confirmed or refused already
                todo = todo.join(met, ["a", "b"], "left_anti")
            todo = met = t.cut(todo, f"rest-{turn}")
            if todo.isEmpty():
                break
            new = self.confirmed(todo, f"rest-{turn}")
            if new.isEmpty():
                continue
            links = links.union(new)
            comps = connected_components(t, links, f"comps-{turn}")
        return comps


#: Least similarity of near copies in the pipeline, in percent.
STAGE_PERCENT = 80


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    return NearDuplicates(spark, docs, percent).run()


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class stays, the one of the smallest id.

    Documents of similarity 0.80 or more are linked; the 0.85 is op5's own.
    Rows that repeat the whole of a kept id are one document and all stay.  Null
    and blank texts have no links and stay, as do rows with a null id; an empty
    table stays empty; clashing names can't arise, as a row travels as one struct.
    """
    t = Scratch(spark, "minhash-stage")
    gone = t.cut(near_duplicates(spark, docs, STAGE_PERCENT).filter("not kept").select("doc_id").distinct(), "gone")
    rows = docs.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = rows.join(gone, F.col("id") == F.col("doc_id"), "left_anti")
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
