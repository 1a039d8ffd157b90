"""Removal of repeated passages with prefix-partitioned subtrees of sampled suffixes.

A window is 50 consecutive words.  Its words are removed when the same word
sequence also starts in a document of a smaller id.

1. Documents with equal word sequences are told by a digest; only the one of the
   smallest id goes on, the others lose everything (or nothing, below 50 words).
2. A window stands at the suffix that starts at its anchor, the 8-word run of the
   smallest hash inside it (equal windows have equal anchors).  Suffixes are dealt
   into groups by that prefix; groups of a single document can't hold a repeat and
   are dropped after a summed count.
3. A group within the memory bound becomes one subtree: the suffixes inside it are
   ranked by prefix doubling down to depth 50, where classes of several suffixes
   are the deep internal nodes; each node's smallest document keeps its words.
   In a larger group the prefix grows to all 50 words of a window: then each group
   is one node, told by 128 bits, and its smallest document is an aggregate that
   Spark combines before the shuffle.
4. Covered words of each document are joined and cut from its text.

No join here is followed by a step that relies on its partitioning, and both sides
of each are written tables or plain projections, so that adaptive execution splits
the rows of a hot text or passage.

Edge cases: null text has no words; fewer than 50 words have no window; rows with
a null id neither lose nor take words; repeated ids are equal, not smaller, and
are told apart by their text; of windows tied between several documents the
smallest id's stays; very long texts are read whole, their runs in pieces; an
empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.common import Scratch, WordHash, maybe_in, raw_words, read_table, rolling

WINDOW = 50
ANCHOR = 8
#: Words of one group that a subtree may hold; larger groups take full-depth prefixes.
GROUP_WORDS = 200_000
#: Most full-depth nodes that are broadcast to their rows, some 12 MB; more of them are joined.
MAX_NODES = 500_000
#: Words ranked at once by a task (whole groups).
TASK_WORDS = 500_000


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size, m = 1, v
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(v) - width + 1], m[width - size :]) if size < width else m


def runs_of(h: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix key, first and last start of each run of windows with one key."""
    if len(h) < window:
        e = np.empty(0, np.int64)
        return e, e, e
    g = rolling(h, anchor)
    v = ((g >> np.uint64(32)) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
    key = g[(sliding_min(v, window - anchor + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)].view(np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    last = np.append(first[1:], len(key)) - 1
    return key[first], first, last


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def short(sha: str) -> int:
    """The first 63 bits of a digest; with the id it names a text."""
    return int(sha[:16], 16) >> 1


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHash()
    for b in batches:
        n, sha, tag, keys, lo, hi = [], [], [], [], [], []
        for text in b.column("text").to_pylist():
            words = raw_words(text)
            n.append(len(words))
            sha.append(digest(words))
            tag.append(short(sha[-1]))
            k, s, e = runs_of(hashes.array(words)) if len(words) >= WINDOW else ((), (), ())
            keys.append(k)
            lo.append(s)
            hi.append(e)
        big = pa.list_(pa.int64())
        yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_words": pa.array(n, pa.int64()), "sha": pa.array(sha, pa.string()), "tag": pa.array(tag, pa.int64()), "key": pa.array(keys, big), "lo": pa.array(lo, big), "hi": pa.array(hi, big)})


_SEGMENT = "key long, more long, doc long, tag long, lo long, hi long, deep boolean, words array<long>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run's words, or each window's full-depth key where its group is too large."""
    hashes, others = WordHash(), WordHash(seed=1)
    cols = ("key", "more", "doc", "tag", "lo", "hi", "deep", "words")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=cols)

    for b in batches:
        out, size = [], 0
        for doc, tag, text, runs in zip(*(b.column(c).to_pylist() for c in ("doc", "tag", "text", "runs"))):
            words = raw_words(text)
            if short(digest(words)) != tag:
                continue  # another text of a repeated id
            h = hashes.array(words)
            if any(r["deep"] for r in runs):
                full, more = (rolling(x, WINDOW).view(np.int64) for x in (h, others.array(words)))
            signed = h.view(np.int64)
            for r in runs:
                lo, hi = r["lo"], r["hi"]
                if r["deep"]:
                    out += [(k, m, doc, tag, i, i, True, None) for i, k, m in zip(range(lo, hi + 1), full[lo : hi + 1].tolist(), more[lo : hi + 1].tolist())]
                    size += 10 * (hi + 1 - lo)
                else:
                    out.append((r["key"], 0, doc, tag, lo, hi, False, signed[lo : hi + WINDOW]))
                    size += hi + WINDOW - lo
                if size > 300_000:
                    yield batch(out)
                    out, size = [], 0
        if out:
            yield batch(out)


def deep_nodes(words: np.ndarray, starts: np.ndarray, docs: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """For each suffix start, the smallest document under its node at ``depth``."""
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    size = 1
    while size * 2 <= depth:
        rank = np.unique(rank[:-size] * np.int64(len(words) + 1) + rank[size:], return_inverse=True)[1].astype(np.int64)
        size *= 2
    at = rank[starts]
    if size < depth:
        at = at * np.int64(len(words) + 1) + rank[starts + (depth - size)]
    node = np.unique(at, return_inverse=True)[1]
    low = np.full(node.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, node, docs)
    return low[node]


def covered(doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, count: np.ndarray, words: np.ndarray, sizes: np.ndarray):
    """(doc, tag, from, to) of the words that whole groups of segments lose."""
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    seg = np.repeat(np.arange(len(doc)), count)
    inner = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
    lost = deep_nodes(words, heads[seg] + inner, doc[seg]) < doc[seg]
    seg, inner = seg[lost], inner[lost]
    if not len(seg):
        return None
    new = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (inner[1:] != inner[:-1] + 1)]))
    end = np.append(new[1:], len(seg)) - 1
    s = seg[new]
    return doc[s], tag[s], lo[s] + inner[new], lo[s] + inner[end] + WINDOW


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order of their keys to covered words; groups are never split."""
    held: list[tuple] = []
    size = 0

    def flush(rows):
        key, doc, tag, lo, hi, words, sizes = (np.concatenate(x) for x in zip(*rows))
        got = covered(doc, tag, lo, hi - lo + 1, words, sizes)
        if got is not None:
            return pa.RecordBatch.from_pydict(dict(zip(("doc", "tag", "lo", "hi"), map(pa.array, got))))
        return None

    for b in batches:
        if not b.num_rows:
            continue
        words = b.column("words")
        offsets = words.offsets.to_numpy()
        flat = words.values.to_numpy()[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        row = [b.column(c).to_numpy() for c in ("key", "doc", "tag", "lo", "hi")]
        if held and size + len(flat) >= TASK_WORDS and row[0][0] == held[-1][0][-1] and row[0][-1] == row[0][0]:
            held.append((*row, flat, np.diff(offsets)))  # one key all through
            size += len(flat)
            continue
        held.append((*row, flat, np.diff(offsets)))
        size += len(flat)
        if size >= TASK_WORDS:
            key = row[0]
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if cut == 0 and (len(held) == 1 or held[-2][0][-1] == key[-1]):
                continue
            last = held.pop()
            done = held + ([(*(c[:cut] for c in last[:5]), last[5][: offsets[cut]], last[6][:cut])] if cut else [])
            if (out := flush(done)) is not None:
                yield out
            held = [(*(c[cut:] for c in last[:5]), last[5][offsets[cut] :], last[6][cut:])]
            size = len(held[0][5])
    if held and (out := flush(held)) is not None:
        yield out


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        removed, kept = [], []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            words = raw_words(text)
            gone = np.zeros(len(words) + 1, np.int64)
            for s in spans:
                gone[s["lo"]] += 1
                gone[s["hi"]] -= 1
            stays = np.cumsum(gone[:-1]) == 0
            removed.append(int(len(words) - stays.sum()))
            kept.append(digest([w for w, k in zip(words, stays.tolist()) if k]))
        yield pa.RecordBatch.from_pydict({"doc": b.column("doc"), "tag": b.column("tag"), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(kept, pa.string())})


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    t = Scratch(spark, "substring")
    docs = docs.select("doc_id", "text")
    rows = t.cut(docs.mapInArrow(_prefixes, "doc_id long, n_words long, sha string, tag long, key array<long>, lo array<long>, hi array<long>"), "prefixes")
    whole = rows.filter(f"n_words >= {WINDOW} and doc_id is not null")
    firsts = t.cut(whole.groupBy("sha").agg(F.min("doc_id").alias("first")), "firsts")
    own = whole.join(firsts, "sha").filter("doc_id = first")  # rows that repeat an id and its text do no harm below
    runs = t.cut(own.select(F.col("doc_id").alias("doc"), "tag", F.explode(F.arrays_zip("key", "lo", "hi")).alias("r")).select("doc", "tag", "r.*"), "runs")
    shared = runs.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.sum(F.col("hi") - F.col("lo") + WINDOW).alias("size")).filter("a < b")
    shared = t.cut(shared.select("key", (F.col("size") > GROUP_WORDS).alias("deep")), "shared")
    live = runs.join(shared, "key").groupBy("doc", "tag").agg(F.collect_set(F.struct("key", "lo", "hi", "deep")).alias("runs"))
    live = t.cut(live, "live")
    t.drop("runs", "shared")
    ids = t.cut(live.select("doc").distinct(), "ids")
    texts = maybe_in(docs.withColumnRenamed("doc_id", "doc"), "doc", ids)
    flagged = t.cut(live.join(texts, "doc").select("doc", "tag", "text", "runs"), "flagged")
    segments = t.cut(flagged.mapInArrow(_segments, _SEGMENT), "segments")

    trees = segments.filter("not deep").select("key", "doc", "tag", "lo", "hi", "words").repartition("key").sortWithinPartitions("key").mapInArrow(_subtrees, "doc long, tag long, lo long, hi long")
    deep = segments.filter("deep").select("key", "more", "doc", "tag", "lo")
    nodes = t.cut(deep.groupBy("key", "more").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("key", "more", "low"), "nodes")
    if nodes.count() <= MAX_NODES:  # 24 bytes each
        nodes = F.broadcast(nodes)
    deep = deep.join(nodes, ["key", "more"]).filter("doc > low").select("doc", "tag", "lo", (F.col("lo") + WINDOW).alias("hi"))
    spans = t.cut(trees.union(deep), "spans")
    t.drop("segments")
    spans = spans.groupBy("doc", "tag").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    spans = t.cut(spans, "lost-spans")
    ids = t.cut(spans.select("doc").distinct(), "lost-ids")
    texts = maybe_in(flagged.select("doc", "tag", "text"), "doc", ids).join(spans, ["doc", "tag"])
    lost = t.cut(texts.mapInArrow(_without, "doc long, tag long, n_removed long, kept_sha256 string").dropDuplicates(["doc", "tag"]), "lost")
    t.drop("flagged", "spans")

    out = rows.select("doc_id", "n_words", "sha", "tag").join(firsts, "sha", "left").join(lost.withColumnRenamed("doc", "doc_id"), ["doc_id", "tag"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return out.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(digest([]))).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, read_table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 48)) i from d where len(w) >= 50),
k as (select doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) h from p),
m as (select h, min(doc_id) low from k group by h),
g as (select doc_id, list(i order by i) s from k join m using (h) where doc_id > low group by doc_id),
c as (select doc_id, list_distinct(flatten(list_transform(s, lambda i: range(i, i + 50)))) gone from g),
r as (select d.doc_id, w, case when gone is null then w else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: not list_contains(gone, x[2])), lambda x: x[1]) end kept
      from d left join c using (doc_id))
select doc_id, cast(len(w) as bigint) n_words, cast(len(w) - len(kept) as bigint) n_removed, sha256(array_to_string(kept, ' ')) kept_sha256 from r
"""
