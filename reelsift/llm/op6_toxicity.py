"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Words enter as a learned word vector, the mean of learned vectors of their
character 3- to 5-grams (with word ends), and the class log-odds of word and grams.
Forward and backward gated recurrent units read windows of 24 words that start
every 16 words and at the end, attention pools their states, and a document
scores as its most toxic window does, on a scale fitted to the training
documents.  Training runs in numpy on a bounded sample of labelled documents, of
which every window may teach; scoring covers every window of every text.

Edge cases: null text or text without a word scores the training share of toxic
documents, cut at 0.49; a null id is not held out and not learned from; repeated
ids give one row each, and learn by their smallest text; an id labelled both ways
counts as toxic; very long texts are scored whole, some windows at a time; of tied
windows the first teaches; without toxic or without clean labels every score is 0;
an empty table gives an empty result; extra columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.common import held_out_column, mix64, read_table, tune

WINDOW, STRIDE = 24, 16
HIDDEN, ATTENTION, EMBED = 8, 8, 4
BUCKETS, ODDS_BUCKETS = 1 << 15, 1 << 18
GRAM_SIZES = (3, 4, 5)
#: Most clean and toxic labelled documents to learn from, those of the smallest id hashes.
SAMPLE = (2500, 1000)
#: Most bytes of their texts together; a text that doesn't fit what is left of them is passed over whole.
SAMPLE_BYTES = 48 << 20
EPOCHS, BATCH, RATE = 10, 256, 0.01
#: Epochs after which all windows of all training documents are scored anew to choose those that teach.
RESCORE = (0, 2, 5, 9)
#: Words a worker remembers.
WORDS = 150_000
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_FIXED = 3  # log-odds of the word, largest and mean log-odds of its grams
DIM = _FIXED + 2 * EMBED


def tokens(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams of ``^word$`` and the word each belongs to."""
    data = np.frombuffer(b"\x01" + b"\x02\x01".join(words) + b"\x02", np.uint8)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) + 2 for w in words])
    hashes, owners = [], []
    for k in GRAM_SIZES:
        n = len(data) - k + 1
        if n <= 0:
            continue
        acc = np.full(n, k, np.uint64)
        for i in range(k):
            acc = acc * np.uint64(257) + data[i : i + n]
        ok = owner[:n] == owner[k - 1 :]
        hashes.append(mix64(acc[ok]))
        owners.append(owner[:n][ok])
    return np.concatenate(hashes), np.concatenate(owners)


@dataclass
class Odds:
    word: np.ndarray
    gram: np.ndarray

    @classmethod
    def fit(cls, docs: list[list[bytes]], toxic: np.ndarray) -> Odds:
        """Smoothed class log-odds of hashed words and grams by documents that hold them."""
        tables = []
        for kind in ("word", "gram"):
            n = np.zeros((2, ODDS_BUCKETS))
            for words, y in zip(docs, toxic):
                if words:
                    h = word_hashes(words) if kind == "word" else word_grams(words)[0]
                    n[int(y), np.unique(h % np.uint64(ODDS_BUCKETS)).astype(np.int64)] += 1
            size = np.array([(toxic == 0).sum(), (toxic == 1).sum()])[:, None]
            p = (n + 0.5) / (size + 1.0)
            trust = np.minimum(1.0, n.sum(0) / 4.0)
            tables.append((np.clip(np.log(p[1] / p[0]), -4, 4) * trust).astype(np.float32))
        return cls(*tables)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, forward and backward passes; directions are stacked on the first axis."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        r = lambda *s, k=0.3: (rng.standard_normal(s) * k).astype(np.float32)
        self.p = {
            "word": r(BUCKETS, EMBED, k=0.02), "gram": r(BUCKETS, EMBED, k=0.02),
            "wx": r(2, DIM, 3 * HIDDEN), "bx": np.zeros((2, 1, 3 * HIDDEN), np.float32), "u": r(2, HIDDEN, 3 * HIDDEN),
            "wa": r(2 * HIDDEN, ATTENTION), "ba": np.zeros(ATTENTION, np.float32), "va": r(ATTENTION), "w": r(2 * HIDDEN), "b": np.zeros(1, np.float32),
        }

    def states(self, xp: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """(2, N, T, HIDDEN) states in reading order from projected inputs (2, N, T, 3 * HIDDEN)."""
        two, n, t, _ = xp.shape
        h = np.zeros((two, n, HIDDEN), np.float32)
        out = np.empty((two, n, t, HIDDEN), np.float32)
        u = self.p["u"]
        for i in range(t):
            x = xp[:, :, i]
            hu = np.matmul(h, u)
            zr = _sigmoid(x[..., : 2 * HIDDEN] + hu[..., : 2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            c = np.tanh(x[..., 2 * HIDDEN :] + r * hu[..., 2 * HIDDEN :])
            new = c + z * (h - c)
            if mask is not None:
                m = mask[:, :, i, None]
                new = np.where(m, new, h)
            if keep is not None:
                keep.append((h, hu, z, r, c))
            h = new
            out[:, :, i] = h
        return out

    @staticmethod
    def both(xp: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Turns the second direction round."""
        xp = np.stack([xp[0], xp[1][:, ::-1]])
        return xp, None if mask is None else np.stack([mask, mask[:, ::-1]])

    def pooled(self, s: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, tuple]:
        h = np.concatenate([s[0], s[1][:, ::-1]], axis=-1)
        a = np.tanh(h @ self.p["wa"] + self.p["ba"])
        e = a @ self.p["va"]
        if mask is not None:
            e = np.where(mask, e, -1e9)
        w = np.exp(e - e.max(1, keepdims=True))
        w /= w.sum(1, keepdims=True)
        v = np.einsum("nt,nth->nh", w, h)
        return v @ self.p["w"] + self.p["b"][0], (h, a, w, v)

    def logits(self, xp: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        xp, m = self.both(xp, mask)
        return self.pooled(self.states(xp, m), mask)[0]

    def grads(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weighted log loss over parameters, and over the inputs x (N, T, DIM)."""
        p = self.p
        xp, m = self.both(np.matmul(x.reshape(1, -1, DIM), p["wx"]).reshape(2, *x.shape[:2], 3 * HIDDEN) + p["bx"][:, None], mask)
        keep: list = []
        s = self.states(xp, m, keep)
        logit, (h, a, w, v) = self.pooled(s, mask)
        d = (weight * (_sigmoid(logit) - y)).astype(np.float32)
        g = {"w": v.T @ d, "b": d.sum(keepdims=True)}
        dv = d[:, None] * p["w"]
        dw = np.einsum("nth,nh->nt", h, dv)
        de = w * (dw - (w * dw).sum(1, keepdims=True))
        dh = w[..., None] * dv[:, None]
        g["va"] = np.einsum("nt,nta->a", de, a)
        da = de[..., None] * p["va"] * (1 - a * a)
        g["wa"] = np.einsum("nth,nta->ha", h, da)
        g["ba"] = da.sum((0, 1))
        dh = dh + da @ p["wa"].T
        ds = np.stack([dh[..., :HIDDEN], dh[..., HIDDEN:][:, ::-1]])
        dxp = np.zeros_like(xp)
        g["u"] = np.zeros_like(p["u"])
        back = np.zeros_like(ds[:, :, 0])
        ut = p["u"].transpose(0, 2, 1)
        for i in range(x.shape[1] - 1, -1, -1):
            h0, hu, z, r, c = keep[i]
            mi = m[:, :, i, None]
            d_new = ds[:, :, i] + back
            pass_on = np.where(mi, 0, d_new)
            d_new = np.where(mi, d_new, 0)
            dc = d_new * (1 - z) * (1 - c * c)
            dz = d_new * (h0 - c) * z * (1 - z)
            dr = dc * hu[..., 2 * HIDDEN :] * r * (1 - r)
            dhu = np.concatenate([dz, dr, dc * r], axis=-1)
            dxp[:, :, i] = np.concatenate([dz, dr, dc], axis=-1)
            g["u"] += np.matmul(h0.transpose(0, 2, 1), dhu)
            back = d_new * z + np.matmul(dhu, ut) + pass_on
        dxp[1] = dxp[1][:, ::-1].copy()
        flat = dxp.reshape(2, -1, 3 * HIDDEN)
        g["bx"] = flat.sum(1, keepdims=True)
        g["wx"] = np.matmul(x.reshape(-1, DIM).T[None], flat)
        return g, np.matmul(flat, p["wx"].transpose(0, 2, 1)).sum(0).reshape(x.shape)


class Inputs:
    """Rows of word inputs, by first sight; row 0 is padding."""

    def __init__(self, odds: Odds):
        self.odds = odds
        self.at: dict[bytes, int] = {}
        self.fresh: list[bytes] = []

    def index(self, words: list[bytes]) -> np.ndarray:
        at, fresh, out = self.at, self.fresh, np.empty(len(words), np.int64)
        for i, w in enumerate(words):
            if (k := at.get(w)) is None:
                k = at[w] = len(at) + 1
                fresh.append(w)
            out[i] = k
        return out

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words not taken yet: fixed features, word bucket, gram buckets and their owners."""
        words, self.fresh = self.fresh, []
        h = word_hashes(words)
        grams, owner = word_grams(words)
        lo = self.odds.gram[(grams % np.uint64(ODDS_BUCKETS)).astype(np.int64)]
        top = np.full(len(words), -4.0, np.float32)
        np.maximum.at(top, owner, lo)
        mean = np.bincount(owner, lo, len(words)) / np.bincount(owner, minlength=len(words))
        fixed = np.stack([self.odds.word[(h % np.uint64(ODDS_BUCKETS)).astype(np.int64)], top, mean], axis=1).astype(np.float32)
        return fixed, (h >> np.uint64(20)).astype(np.int64) % BUCKETS, ((grams >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int32), owner


def windows(n: int) -> np.ndarray:
    """Starts of the windows of n words: one at least, the last one flush with the end."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    s = np.arange(0, n - WINDOW, STRIDE)
    return np.append(s, n - WINDOW)


def window_rows(rows: np.ndarray) -> np.ndarray:
    """(windows, WINDOW) word rows of a document, 0 where it is shorter."""
    if len(rows) < WINDOW:
        rows = np.concatenate([rows, np.zeros(WINDOW - len(rows), np.int64)])
    return rows[windows(len(rows))[:, None] + np.arange(WINDOW)[None]]


@dataclass
class Model:
    odds: Odds
    net: Network
    slope: float
    shift: float
    prior: float


def _word_inputs(net: Network, part) -> np.ndarray:
    fixed, wb, gb, owner = part
    n = np.bincount(owner, minlength=len(fixed))[:, None]
    grams = np.stack([np.bincount(owner, net.p["gram"][gb, j], len(fixed)) for j in range(EMBED)], axis=1) / n
    return np.concatenate([fixed, net.p["word"][wb], grams], axis=1).astype(np.float32)


def _all_logits(net: Network, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    proj = np.matmul(x[None], net.p["wx"]) + net.p["bx"]
    out = np.empty(len(rows), np.float32)
    for a in range(0, len(rows), 2048):
        r = rows[a : a + 2048]
        mask = r > 0
        out[a : a + 2048] = net.logits(proj[:, r], None if mask.all() else mask)
    return out


def train(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Multiple-instance training: a toxic document teaches by its most toxic window, a clean one by its two most toxic."""
    docs = [tokens(t) for t in texts]
    keep = [i for i, d in enumerate(docs) if d]
    docs, toxic = [docs[i] for i in keep], toxic[keep]
    odds = Odds.fit(docs, toxic)
    inputs, net, rng = Inputs(odds), Network(seed), np.random.default_rng(seed)
    each = [window_rows(inputs.index(d)) for d in docs]
    rows = np.concatenate(each)
    heads = np.cumsum([0, *(len(r) for r in each)])[:-1]
    del each
    part = inputs.take()
    fixed, wb, gb, owner = part
    moments: dict = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    pad = lambda x: np.concatenate([np.zeros((1, DIM), np.float32), x])
    ends = np.append(heads[1:], len(rows))
    top, lone = np.concatenate([[0], fixed[:, :2].max(1)]), np.concatenate([[0], fixed[:, 0]])  # until the network is trained, by log-odds
    score = np.concatenate([top[r].max(1) + 0.1 * lone[r].sum(1) for r in np.array_split(rows, max(1, len(rows) // 4096))])
    gram_order = np.argsort(owner, kind="stable")
    gram_start = np.searchsorted(owner[gram_order], np.arange(len(fixed) + 1))
    for epoch in range(epochs):
        chosen, y = [], []
        for a, b, t in zip(heads, ends, toxic):
            best = a + np.argsort(-score[a:b], kind="stable")[: 1 if t else 2]
            chosen += best.tolist()
            y += [float(t)] * len(best)
        chosen, y = np.array(chosen), np.array(y, np.float32)
        balance = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
        order = rng.permutation(len(chosen))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            r = rows[chosen[pick]]
            used = np.unique(r[r > 0]) - 1
            spot = np.zeros(len(fixed) + 1, np.int64)
            spot[used + 1] = np.arange(1, len(used) + 1)
            which = np.concatenate([gram_order[gram_start[k] : gram_start[k + 1]] for k in used])
            mine = np.repeat(np.arange(len(used)), gram_start[used + 1] - gram_start[used])
            x = pad(_word_inputs(net, (fixed[used], wb[used], gb[which], mine)))
            g, dx = net.grads(x[spot[r]], r > 0, y[pick], (balance[pick] / len(pick)).astype(np.float32))
            flat, where = dx.reshape(-1, DIM), spot[r].ravel()
            dwords = np.stack([np.bincount(where, flat[:, j], len(used) + 1) for j in range(_FIXED, DIM)], axis=1)[1:].astype(np.float32)
            g["word"], g["gram"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["gram"])
            np.add.at(g["word"], wb[used], dwords[:, :EMBED])
            share = np.bincount(mine, minlength=len(used))[:, None]
            np.add.at(g["gram"], gb[which], (dwords[:, EMBED:] / share)[mine])
            step += 1
            for k, grad in g.items():
                m, v = moments[k]
                m += 0.1 * (grad - m)
                v += 0.002 * (grad * grad - v)
                net.p[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.998**step)) + 1e-6)
        if epoch in RESCORE or epoch == epochs - 1:
            score = _all_logits(net, pad(_word_inputs(net, part)), rows)
    best = np.maximum.reduceat(score, heads).astype(float)
    slope, shift = 1.0, 0.0
    w = np.where(toxic == 1, 0.5 / toxic.sum(), 0.5 / (1 - toxic).sum())
    for _ in range(50):  # the scale of document scores, by Newton steps
        x = np.stack([best, np.ones_like(best)], axis=1)
        p = _sigmoid(slope * best + shift)
        grad = x.T @ (w * (p - toxic)) + 1e-3 * np.array([slope - 1, shift])
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        slope, shift = np.array([slope, shift]) - np.linalg.solve(hess, grad)
    return Model(odds, net, float(slope), float(shift), min(0.49, float(toxic.mean())))


class Scorer:
    def __init__(self, model: Model):
        self.m = model
        self._reset()

    def _reset(self) -> None:
        self.inputs = Inputs(self.m.odds)
        self.proj = np.zeros((2, 1, 3 * HIDDEN), np.float32) + self.m.net.p["bx"]
        self.n = 1

    def _grow(self) -> None:
        if not self.inputs.fresh:
            return
        x = _word_inputs(self.m.net, self.inputs.take())
        new = np.matmul(x[None], self.m.net.p["wx"]) + self.m.net.p["bx"]
        need = self.n + new.shape[1]
        if need > self.proj.shape[1]:
            self.proj = np.concatenate([self.proj, np.zeros((2, need, 3 * HIDDEN), np.float32)], axis=1)
        self.proj[:, self.n : need] = new
        self.n = need

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.m.prior)
        group, size = [], 0
        for i, t in enumerate(texts):
            words = tokens(t)
            if words:
                group.append((i, words))
                size += len(words)
            if size > 60_000:
                self._run(group, out)
                group, size = [], 0
        if group:
            self._run(group, out)
        return out

    def _run(self, group: list, out: np.ndarray) -> None:
        if len(self.inputs.at) > WORDS:
            self._reset()
        rows = [window_rows(self.inputs.index(w)) for _, w in group]
        self._grow()
        heads = np.cumsum([0, *(len(r) for r in rows)])[:-1]
        rows = np.concatenate(rows)
        logit = np.empty(len(rows), np.float32)
        full = rows[:, -1] > 0
        for part in (np.flatnonzero(full), np.flatnonzero(~full)):
            for a in range(0, len(part), 1024):
                r = rows[part[a : a + 1024]]
                logit[part[a : a + 1024]] = self.m.net.logits(self.proj[:, r], None if r.all() else r > 0)
        best = np.maximum.reduceat(logit, heads)
        out[[i for i, _ in group]] = _sigmoid(self.m.slope * best.astype(float) + self.m.shift)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Model | None:
    """From docs (doc_id, text) and labels (doc_id, toxic): at most ``sample`` documents of each class and ``most_bytes`` of text.

    The ids are chosen first, by a hash; only the texts of the sample reach the driver.
    """
    known = docs.groupBy("doc_id").agg(F.min(F.octet_length("text")).alias("size")).join(labels, "doc_id")
    ids = []
    for y in (0, 1):
        left = most_bytes // 2
        for r in known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample[y]).select("doc_id", "size").collect():
            if r["size"] <= left:
                left -= r["size"]
                ids.append((r["doc_id"], y))
    if len({y for _, y in ids}) < 2:
        return None
    chosen = F.broadcast(spark.createDataFrame(ids, "doc_id long, toxic int"))
    rows = docs.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.octet_length("text"), "text")).alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows]))


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs."""
    tune(spark)
    one = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = fit(spark, docs.select("doc_id", "text").filter(~held_out_column() & F.col("text").isNotNull()), one)
    box = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(box.value) if box.value else None
        for b in batches:
            texts = b.column("text").to_pylist()
            s = scorer.scores(texts) if scorer else np.zeros(len(texts))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": pa.array(s)})

    out = docs.select("doc_id", held_out_column().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
