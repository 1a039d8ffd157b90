"""Offset-preserving SentencePiece encoding and decoding.

Text is normalised by longest prefixes of the model's compiled character map (a
double-array trie); every normalised byte remembers its source offset.  The text
is cut before each run of word marks, which no piece of the vocabulary crosses,
so byte-pair merging may run run by run: the runs that some texts hold and that
aren't remembered are merged together, one merge of each run a step, in arrays.
Each piece is projected to a span of source bytes.

Edge cases: null text counts as empty; empty text encodes to the end id alone; very
long texts and runs are encoded whole (long runs with a heap); equal scores merge
leftmost first; repeated and null ids give one row each; an empty table gives an
empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from reelsift.llm.common import read_table, tune

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Runs remembered by a worker, the longest of them that are merged in arrays, and texts taken together.
LIMIT = 300_000
SHORT = 40
TOGETHER = 200
#: Symbols of characters that are no piece begin here.
BEYOND = 1 << 24


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class CharacterMap:
    """A compiled map: u32 trie size, double array, zero-ended replacement strings."""

    def __init__(self, blob: bytes):
        self.units, self.strings = [], b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key at ``at``."""
        units, found = self.units, None
        node = self._offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.strings.index(b"\0", found[1])
        return found[0], self.strings[found[1] : end]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


def compile_map(rules: dict[bytes, bytes]) -> bytes:
    """The blob of a small set of rules (keys without zero bytes)."""
    strings, values = b"", {}
    for k, v in sorted(rules.items()):
        values[k] = len(strings)
        strings += v + b"\0"
    units: dict[int, int] = {0: 0}
    taken, bases = {0}, set()

    def place(node: int, prefix: bytes, keys: list[bytes]) -> None:
        heads: dict[int, list[bytes]] = {}
        for k in keys:
            heads.setdefault(k[len(prefix)] if len(k) > len(prefix) else 0, []).append(k)
        base = 1
        while base in bases or any((base ^ c) in taken for c in heads):  # no two nodes share a base, or labels would mix
            base += 1
        bases.add(base)
        taken.update(base ^ c for c in heads)
        units[node] |= (node ^ base) << 10
        for c, ks in heads.items():
            if c == 0:
                units[node] |= 1 << 8
                units[base] = values[prefix] | 0x80000000
            else:
                units[base ^ c] = c
        for c, ks in heads.items():
            if c:
                place(base ^ c, prefix + bytes([c]), ks)

    if rules:
        place(0, b"", sorted(rules))
    size = -(-(max(units) + 256) // 256) * 256  # whole kilobytes
    return struct.pack(f"<I{size}I", size * 4, *(units.get(i, 0) for i in range(size))) + strings


@dataclass
class Model:
    """What encoding needs of a model file."""

    pieces: list[str]
    kinds: list[int]
    scores: list[float]
    charmap: bytes
    dummy_prefix: bool
    squeeze: bool
    unk: int = 0
    end: int = 2
    ids: dict[str, int] = field(default_factory=dict)
    digest: str = ""

    @classmethod
    def load(cls, path: str) -> Model:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            blob = f.read()
        proto.ParseFromString(blob)
        norm, spec = proto.normalizer_spec, proto.trainer_spec
        if spec.model_type != 2 or spec.treat_whitespace_as_suffix or not norm.escape_whitespaces:
            raise ValueError("only byte-pair models with marks before words are supported")
        p = proto.pieces
        kinds = [x.type for x in p]
        out = cls([x.piece for x in p], kinds, [x.score for x in p], norm.precompiled_charsmap, norm.add_dummy_prefix, norm.remove_extra_whitespaces, kinds.index(UNKNOWN))
        out.digest = hashlib.sha256(blob).hexdigest()
        out.end = next((i for i, x in enumerate(p) if x.piece == "</s>" and x.type == CONTROL), out.unk)
        if any(MARK in x.piece.lstrip(MARK) for x in p if x.type == NORMAL) or any(k == USER for k in kinds):
            raise ValueError("a piece crosses a word mark or is user-defined")
        out.ids = {x.piece: i for i, x in enumerate(p) if x.type == NORMAL}
        return out


class Merges:
    """Which two symbols merge into which piece, in a hash table of packed pairs."""

    def __init__(self, model: Model):
        scores = sorted({model.scores[i] for i in model.ids.values()}, reverse=True)
        place = {x: r for r, x in enumerate(scores)}
        self.never = len(scores)
        self.symbol = np.arange(0x110000, dtype=np.int64) + BEYOND  # of a character
        for p, i in model.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        of = lambda part: model.ids.get(part) if len(part) > 1 else int(self.symbol[ord(part)])
        found = [(x << 32 | y, place[model.scores[i]], i) for p, i in model.ids.items() for k in range(1, len(p)) if (x := of(p[:k])) is not None and (y := of(p[k:])) is not None]
        self.rank_of = {i: place[model.scores[i]] for i in model.ids.values()}
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, self.never, np.int32)
        self.into = np.zeros(1 << bits, np.int64)
        self.probes = 1
        for key, rank, i in found:
            at, n = self._home(np.array([key]))[0], 1
            while self.keys[at] >= 0:
                at, n = (at + 1) & self.last, n + 1
            self.keys[at], self.rank[at], self.into[at] = key, rank, i
            self.probes = max(self.probes, n)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``never`` without a merge) and merged symbol of each pair."""
        key = left << 32 | right
        at = self._home(key)
        hit = self.keys[at] == key
        rank, into = np.where(hit, self.rank[at], self.never), self.into[at]
        todo = np.flatnonzero(~hit & (self.keys[at] >= 0))
        for _ in range(1, self.probes):
            if not len(todo):
                break
            at = (self._home(key[todo]) if _ == 1 else at) + 1 & self.last
            got = self.keys[at]
            hit = got == key[todo]
            rank[todo[hit]], into[todo[hit]] = self.rank[at[hit]], self.into[at[hit]]
            more = ~hit & (got >= 0)
            todo, at = todo[more], at[more]
        return rank, into

    def runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all runs after their merges, and how many each run has: best rank first, leftmost of equal ones."""
        size = np.fromiter(map(len, runs), np.int64, len(runs))
        chars = self.symbol[np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.uint32)]
        wide = int(size.max()) + 1
        inside = np.arange(wide) < size[:, None]
        sym = np.full((len(runs), wide), -1, np.int64)
        sym[inside] = chars
        rank = np.full((len(runs), wide), self.never, np.int32)
        into = np.zeros((len(runs), wide), np.int64)
        pair = inside[:, 1:]
        rank[:, :-1][pair], into[:, :-1][pair] = self.look(sym[:, :-1][pair], sym[:, 1:][pair])
        done_sym, done_size = np.full_like(sym, -1), size.copy()
        live = np.arange(len(runs))
        cols = np.arange(wide - 1)
        while len(live):
            best = rank.argmin(1)
            rows = np.arange(len(live))
            go = rank[rows, best] < self.never
            if not go.all():
                end = ~go
                done_sym[live[end], : sym.shape[1]] = sym[end]
                done_size[live[end]] = size[end]
                live, sym, rank, into, size, best = live[go], sym[go], rank[go], into[go], size[go], best[go]
                if not len(live):
                    break
                rows = np.arange(len(live))
            merged = into[rows, best]
            gone = cols[: sym.shape[1] - 1] > best[:, None]  # what stands right of the pair moves left
            for x in (sym, rank, into):
                x[:, :-1] = np.where(gone, x[:, 1:], x[:, :-1])
            sym[:, -1], rank[:, -1] = -1, self.never
            sym[rows, best] = merged
            size -= 1
            keep = int(size.max()) + 1
            sym, rank, into = sym[:, :keep], rank[:, :keep], into[:, :keep]
            rank[rows, best] = self.never  # anew: the pair that begins and the one that ends here
            some = np.flatnonzero(best < size - 1)
            at = best[some]
            rank[some, at], into[some, at] = self.look(sym[some, at], sym[some, at + 1])
            some = np.flatnonzero(best > 0)
            at = best[some] - 1
            rank[some, at], into[some, at] = self.look(sym[some, at], sym[some, at + 1])
        return done_sym[np.arange(wide) < done_size[:, None]], done_size

    def long(self, run: str) -> list[int]:
        """The same of one run of any length, with a heap."""
        sym: list[int] = self.symbol[np.frombuffer(run.encode("utf-32-le", "surrogatepass"), np.uint32)].tolist()
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int, int]] = []

        def offer(some: list[int]) -> None:
            left = np.array([sym[a] for a in some], np.int64)
            right = np.array([sym[nxt[a]] for a in some], np.int64)
            for a, r, i in zip(some, *(x.tolist() for x in self.look(left, right))):
                if r < self.never:
                    heapq.heappush(heap, (r, a, nxt[a], sym[a], sym[nxt[a]], i))

        offer(list(range(n - 1)))
        while heap:
            _, a, b, x, y, i = heapq.heappop(heap)
            if sym[a] != x or sym[b] != y or nxt[a] != b:
                continue
            sym[a], sym[b] = i, -1
            nxt[a] = nxt[b]
            fresh = []
            if nxt[b] < n:
                prv[nxt[b]] = a
                fresh.append(a)
            if prv[a] >= 0:
                fresh.append(prv[a])
            if fresh:
                offer(fresh)
        return [x for x in sym if x >= 0]


class Codec:
    """Encoder and decoder of one model; remembers runs up to a bound."""

    _RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, model: Model):
        self.m = model
        self.map = CharacterMap(model.charmap)
        self.bytes_ = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.values = {i: b for b, i in self.bytes_.items()}
        self.texts = ["" if k == CONTROL else " ⁇ " if k == UNKNOWN else p.replace(MARK, " ") for p, k in zip(model.pieces, model.kinds)]
        self.sizes = np.array([1 if k == BYTE else len(p.encode("utf-8", "surrogatepass")) for p, k in zip(model.pieces, model.kinds)], np.int64)
        self.said = [str(i) for i in range(len(model.pieces))]
        self.merges = Merges(model)
        self._forget()

    def _forget(self) -> None:
        """Runs by their place; ``flat`` has their ids from ``starts[k]`` to ``starts[k + 1]``, ``spread`` these ids' bytes."""
        self.known: dict[str, int] = {}
        self.flat, self.spread = np.empty(0, np.int32), np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, runs: list[str]) -> None:
        if len(self.known) + len(runs) > LIMIT:
            self._forget()
        parts, counts, at = [self.flat], [], len(self.flat)
        runs = sorted(runs, key=len)
        k = 0
        while k < len(runs):  # runs of like length share an array
            if len(runs[k]) > SHORT:
                sym = np.array(self.merges.long(runs[k]), np.int64)
                size, end = np.array([len(sym)]), k + 1
            else:
                end = k
                while end < len(runs) and end < k + 20_000 and len(runs[end]) <= min(SHORT, len(runs[k]) + 4):
                    end += 1
                sym, size = self.merges.runs(runs[k:end])
            parts.append(sym)
            counts.append(size)
            k = end
        ids, counts = np.concatenate(parts[1:]) if parts[1:] else np.empty(0, np.int64), np.concatenate(counts) if counts else np.empty(0, np.int64)
        ids, spread, counts = self._with_bytes(ids, counts)
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.spread = np.concatenate([self.spread, spread.astype(np.int32)])
        self.starts = np.concatenate([self.starts, at + np.cumsum(counts)])
        self.known.update(zip(runs, range(len(self.known), len(self.known) + len(runs))))

    def _with_bytes(self, sym: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their normalised bytes and how many each run has, where symbols that are no piece fall back to bytes or the unknown id."""
        odd = np.flatnonzero(sym >= BEYOND)
        if not len(odd):
            return sym, self.sizes[sym], counts
        run = np.repeat(np.arange(len(counts)), counts)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[odd] - BEYOND).tolist()]
        times = np.ones(len(sym), np.int64)
        if self.bytes_:
            times[odd] = [len(r) for r in raw]
        ids = np.repeat(sym, times)
        heads = np.cumsum(times) - times
        spread = self.sizes[np.where(ids < BEYOND, ids, 0)]
        for k, r in zip(heads[odd].tolist(), raw):
            if self.bytes_:
                ids[k : k + len(r)], spread[k : k + len(r)] = [self.bytes_[b] for b in r], 1
            else:
                ids[k], spread[k] = self.m.unk, len(r)
        return ids, spread, np.bincount(np.repeat(run, times), minlength=len(counts))

    def batch(self, texts: list[str | None], end: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        """Of each text its ids, their (n, 2) spans of source bytes (the end id's is empty), and the ids as text."""
        norms = [self.normalised(t or "") for t in texts]
        runs = [self._RUNS.findall(n) for n, _ in norms]
        every = set().union(*runs)
        if len(self.known) + len(every) > LIMIT:
            self._forget()
        if fresh := every - self.known.keys():
            self._learn(list(fresh))
        for (_, align), mine in zip(norms, runs):
            at = np.fromiter(map(self.known.__getitem__, mine), np.int64, len(mine))
            head, size = self.starts[at], self.starts[at + 1] - self.starts[at]
            spot = np.arange(int(size.sum())) + np.repeat(head - (np.cumsum(size) - size), size)
            ids, cuts = self.flat[spot], np.concatenate([[0], np.cumsum(self.spread[spot], dtype=np.int64)])
            bounds = align[cuts]
            if cuts[-1] != len(align) - 1:
                raise ValueError("pieces don't cover the normalised text")
            spans = np.stack([bounds[:-1], bounds[1:]], axis=1)
            if end:
                ids = np.append(ids, np.int32(self.m.end))
                spans = np.concatenate([spans, np.full((1, 2), align[-1])])
            yield ids, spans, " ".join(map(self.said.__getitem__, ids.tolist()))

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the source offset."""
        data = text.encode("utf-8", "surrogatepass")
        mark = MARK.encode()
        if not data:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.m.squeeze:
            src = np.frombuffer(data, np.uint8)
            size = np.where(src == 0x20, 3, 1)
            align = np.append(np.repeat(np.arange(len(src)), size), len(src))
            norm = text.replace(" ", MARK)
            if self.m.dummy_prefix:
                norm, align = MARK + norm, np.concatenate([np.zeros(3, np.int64), align])
            return norm, align
        out, align, at = bytearray(), [], 0
        steps = []
        while at < len(data):
            hit = self.map.longest(data, at) if self.map.units else None
            if hit is None:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = (size, data[at : at + size])
            steps.append((at, hit[1]))
            at += hit[0]
        if self.m.squeeze:
            kept, blank = [], True
            for a, s in steps:
                while blank and s.startswith(b" "):
                    s = s[1:]
                if s:
                    kept.append((a, s))
                    blank = s.endswith(b" ")
            while kept and kept[-1][1].endswith(b" "):
                a, s = kept.pop()
                if s := s.rstrip(b" "):
                    kept.append((a, s))
            steps = kept
        if not steps:
            return "", np.zeros(1, np.int64)
        if self.m.dummy_prefix:
            out += mark
            align += [steps[0][0]] * 3
        for a, s in steps:
            s = s.replace(b" ", mark)
            out += s
            align += [a] * len(s)
        return out.decode("utf-8", "surrogatepass"), np.array([*align, len(data)], np.int64)

    def encode(self, text: str | None, end: bool = True) -> tuple[list[int], np.ndarray, str]:
        """``batch`` of one text, its ids as a list."""
        ids, spans, said = next(self.batch([text], end))
        return ids.tolist(), spans, said

    def decode(self, ids: list[int]) -> str:
        values = self.values
        if values.keys().isdisjoint(ids):
            parts = [self.texts[i] for i in ids]
        else:
            parts, held = [], bytearray()
            for i in ids:
                if i in values:
                    held.append(values[i])
                    continue
                if held:
                    parts.append(self._utf8(bytes(held)))
                    held.clear()
                parts.append(self.texts[i])
            if held:
                parts.append(self._utf8(bytes(held)))
        out = "".join(parts)
        if (self.m.dummy_prefix or self.m.squeeze) and out.startswith(" ") and (first := next((i for i in ids if self.texts[i] or i in values), None)) is not None and self.m.pieces[first].startswith(MARK):
            out = out[1:]
        return out

    @staticmethod
    def _utf8(raw: bytes) -> str:
        """Decoded bytes; each byte that starts no valid sequence becomes U+FFFD."""
        try:
            return raw.decode()
        except UnicodeDecodeError:
            out, at = [], 0
            while at < len(raw):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(raw[at : at + n].decode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            return "".join(out)


#: A worker's codecs by the digest of their model file.
_codecs: dict[str, Codec] = {}


def tokenised(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256) of every row."""
    tune(spark)
    box = spark.sparkContext.broadcast(Model.load(path or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = box.value
        if model.digest not in _codecs:
            _codecs[model.digest] = Codec(model)
        codec = _codecs[model.digest]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in batches:
            n, a, d, s = [], [], [], []
            texts = b.column("text").to_pylist()
            for ids, spans, said in chain.from_iterable(codec.batch(texts[i : i + TOGETHER]) for i in range(0, len(texts), TOGETHER)):
                n.append(len(ids))
                a.append(sha(said.encode()))
                d.append(sha(codec.decode(ids.tolist()).encode("utf-8", "surrogatepass")))
                s.append(sha(spans.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(d, pa.string()), "spans_sha256": pa.array(s, pa.string())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(spark, read_table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: digests of every row's tokens."""
    return tokenised(spark, docs)
