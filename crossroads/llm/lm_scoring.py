"""An n-gram language model in an Elias-Fano trie, trained and queried on Spark.

Training goes level by level over all training texts. Level 1 has the words, numbered by the order
of their 64-bit hashes. A node of level k is the number of its parent, the (k-1)-gram before it, and
its last word; within a shard, which holds a range of parents, parent and word are one rising number,
kept in Elias-Fano code. The places where shards begin are the monotone pointers: place in the
sequence is node number is parent number of the next level. Only n-grams whose two (k-1)-grams are
nodes can reach the least count, so only those are counted at level k. Tasks count in bounded tables
and send sums; a node is counted once for each task, not once for each occurrence.

Probabilities are interpolated with absolute discounting: P(w | context) = max(c - D, 0) / c(context)
+ g(context) * P(w | shorter context), where g is what the nodes of the context leave over, so pruned
n-grams lose nothing to the model; the shortest is (c + 0.5) / (N + 0.5 (V + 1)). The quotient
and g are kept in two bytes, rounded down in the logarithm, so that sums stay at or below 1; the range of
32 powers of ten is beyond any count.

Levels are files in the shared folder, mapped into the scoring tasks; memory holds the pages that
are looked at. A query numbers the words of a slice of texts, then finds for all tokens at once the
child of the node before it, relative to that context.

Tokens: texts lower-cased (A-Z), words ``[^\\x20\\x09-\\x0D]+``, then one end token, which is also the
context of the first word. Defined cases: a null or empty text is the end token alone; a null doc_id
is a training document; without training texts every probability is that of the formula with N = V =
0; repeated rows train and score each for itself; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from crossroads.llm.elias_fano import EliasFano, encode
from crossroads.llm.exchange import bucket_of
from crossroads.llm.frames import map_texts, partitions, text_slices
from crossroads.llm.hashing import prefix_sums, span_hash, words
from crossroads.llm.shared_files import mapped_file, write_file
from crossroads.session import new_table_path

ORDER = 3
#: Least count of a node from level 2 on where the caller names none; the query keeps all (1).
MIN_COUNT = 2
DISCOUNT = 0.75
FOLDS, HELD_OUT = 5, 1
#: Entries that a task counts before it sends them.
HELD = 3 << 20
#: Steps of the logarithms (base 10) of quotients and of left-over weights, both kept in two bytes.
Q_STEP, G_STEP = 0.0005, 0.0005
#: What each two-byte code stands for.
_Q_VALUES, _G_VALUES = 10.0 ** (-Q_STEP * np.arange(1 << 16)), 10.0 ** (-G_STEP * np.arange(1 << 16))
_END = np.uint64(0x5E0FF5E0FF5E0FF5)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a slice, an end token after each text, and the number of tokens of each text."""
    text = part.column("text").fill_null("").cast(pa.large_string())
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    lowered = _LOWER[np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]]
    starts = ends[:-1] - ends[0]
    # Texts that are empty share their start with the next: words belong to the last of those.
    at, to, doc = words(lowered, starts)
    h = span_hash(prefix_sums(lowered), at, to)
    n = np.bincount(doc, minlength=len(text)) + 1
    out = np.full(int(n.sum()), _END, np.uint64)
    out[np.arange(len(h)) + doc] = h
    return out, n


def _packed(values: np.ndarray) -> bytes:
    """Rising numbers as differences, byte planes apart, compressed."""
    steps = np.diff(values, prepend=values[:1] * 0).astype("<u8")
    return pa.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(planes.T.copy().view("<u8").ravel(), dtype=np.uint64)


@dataclass
class Level:
    """Where the shards of a level begin: parents of each shard (from, to) and the number of its first node."""

    parents: list[tuple[int, int]] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    nodes: int = 0


@dataclass
class Model:
    folder: str
    words: int = 0
    tokens: int = 0
    shards: int = 0
    levels: list[Level] = field(default_factory=list)

    def key(self) -> str:
        return json.dumps([self.folder, self.words, self.tokens, self.shards, [[lv.parents, lv.first, lv.nodes] for lv in self.levels]])


def _file(level: int, shard: int) -> str:
    return f"level-{level}-{shard:05d}.bin"


def _save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    head = json.dumps([[k, a.dtype.str, len(a)] for k, a in arrays.items()]).encode() + b"\n"
    head = head[:-1].ljust(-(-len(head) // 8) * 8 - 1) + b"\n"

    def fill(out):
        out.write(head)
        for a in arrays.values():
            out.write(a.tobytes())
            out.write(b"\0" * (-a.nbytes % 8))

    write_file(folder, name, fill)


def _open(folder: str, name: str) -> dict[str, np.ndarray]:
    raw = np.asarray(mapped_file(folder, name))
    size = 256
    while not (stop := np.flatnonzero(raw[:size] == 10)).size:
        size *= 2
    at = int(stop[0]) + 1
    out = {}
    for k, kind, n in json.loads(raw[:at].tobytes()):
        size = np.dtype(kind).itemsize * n
        out[k] = raw[at:at + size].view(kind)
        at += size + -size % 8
    return out


class Reader:
    """A model's files, mapped by this worker."""

    def __init__(self, model: Model):
        self.model = model
        self.open: dict[tuple[int, int], tuple[dict, EliasFano]] = {}

    def shard(self, level: int, number: int) -> tuple[dict, EliasFano]:
        if (level, number) not in self.open:
            arrays = _open(self.model.folder, _file(level, number))
            self.open[level, number] = arrays, EliasFano(arrays)
        return self.open[level, number]

    def number_words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number (-1: unknown) and training count of each token."""
        m = self.model
        distinct, inverse = np.unique(hashes, return_inverse=True)
        number, count = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        of = bucket_of(distinct, m.shards).astype(np.int64) if m.levels else np.zeros(0, np.int64)
        for s, i, j in _runs(of):
            if m.levels[0].parents[s] is None:
                continue
            arrays, code = self.shard(1, s)
            at = code.find(distinct[i:j] - np.uint64(_bucket_start(s, m.shards)))
            hit = at >= 0
            number[i:j][hit] = m.levels[0].first[s] + at[hit]
            count[i:j][hit] = arrays["counts"][at[hit]]
        return number[inverse], count[inverse]

    def weights(self, level: int, parents: np.ndarray) -> np.ndarray:
        """The left-over weight of each parent; parents rise."""
        starts = np.array([p[0] for p in self.model.levels[level - 1].parents], np.int64)
        out = np.empty(len(parents))
        for s, i, j in _parts(parents, starts):
            out[i:j] = _G_VALUES[self.shard(level, s)[0]["g"][parents[i:j] - starts[s]]]
        return out

    def children(self, level: int, parent: np.ndarray, word: np.ndarray, values: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Node of each (parent, word) at a level, -1 if none; its quotient (0 if none); the parent's left-over weight."""
        level_, width = self.model.levels[level - 1], np.uint64(self.model.words)
        starts = np.array([p[0] for p in level_.parents], np.uint64) * width
        ok = (parent >= 0) & (word >= 0)
        if (all_ok := bool(ok.all())):
            ok = slice(None)
        # Each pair is looked up once, in rising order; parent and word of a level are one number of 64 bits.
        distinct, inverse = np.unique(parent[ok].astype(np.uint64) * width + word[ok].astype(np.uint64), return_inverse=True)
        found, quotient = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct))
        for s, i, j in _parts(distinct, starts):
            arrays, code = self.shard(level, s)
            at = code.find(distinct[i:j] - starts[s])
            hit = np.flatnonzero(at >= 0)
            at = at[hit]
            found[i + hit] = level_.first[s] + at
            if values:
                quotient[i + hit] = _Q_VALUES[arrays["q"][at]]
        node, q, g = np.full(len(parent), -1, np.int64), np.zeros(len(parent)), np.ones(len(parent))
        node[ok] = found[inverse]
        if values:
            q[ok] = quotient[inverse]
            g[ok] = self.weights(level, (distinct // width).astype(np.int64))[inverse]
            if not all_ok and len(rest := np.flatnonzero((parent >= 0) & ~ok)):
                distinct, inverse = np.unique(parent[rest], return_inverse=True)
                g[rest] = self.weights(level, distinct)[inverse]
        return node, q, g

    def node_counts(self, level: int, low: int, high: int) -> np.ndarray:
        """Training counts of the nodes from ``low`` on and below ``high``."""
        level_, parts = self.model.levels[level - 1], []
        for s, first in enumerate(level_.first):
            last = level_.first[s + 1] if s + 1 < len(level_.first) else level_.nodes
            if first < high and low < last and level_.parents[s] is not None:
                parts.append(self.shard(level, s)[0]["counts"][max(0, low - first):high - first])
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def nodes(self, hashes: np.ndarray, n: np.ndarray, upto: int, values: bool = True) -> Iterator[tuple]:
        """(level, node of the n-gram that ends at each token or -1, quotient, weight) of levels 2 to ``upto``."""
        number, count = self.number_words(hashes)
        yield 1, number, count, None
        first = np.cumsum(n) - n
        before = np.empty_like(number)
        before[1:] = number[:-1]
        # The end token of the text before is the context of a first word; the model has it if it has any text.
        if len(number):
            before[first] = number[first + n - 1]
        word, parent = number, before
        for level in range(2, upto + 1):
            node, q, g = self.children(level, parent, word, values)
            yield level, node, q, g
            parent = np.full(len(node), -1, np.int64)
            parent[1:] = node[:-1]
            parent[first] = -1


def _runs(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)] if len(of) else np.zeros(1, int)
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(of[i]), i, j


def _parts(rising: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of the shards that rising numbers fall in."""
    cuts = [0, *np.searchsorted(rising, starts[1:]).tolist(), len(rising)]
    for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
        if i < j:
            yield s, i, j


def _bucket_start(s: int, n: int) -> int:
    """The least hash of a bucket: ``bucket_of`` takes the upper half of the hash."""
    return -(-(s << 32) // n) << 32


@lru_cache(maxsize=2)
def _reader(key: str) -> Reader:
    folder, n_words, tokens, shards, levels = json.loads(key)
    return Reader(Model(folder, n_words, tokens, shards, [Level([p and tuple(p) for p in lv[0]], lv[1], lv[2]) for lv in levels]))


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sum of the counts of each."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[at], np.add.reduceat(counts[order], at, dtype=np.int64)


def _counted(docs: DataFrame, keys_of, bucket) -> DataFrame:
    """(bucket, keys, counts) with sums of the task: ``keys_of`` gives the keys of a slice, ``bucket`` those of sorted keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _sums(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))

        def send() -> Iterator[pa.RecordBatch]:
            keys, counts = merged()
            held.clear()
            for b, i, j in _runs(bucket(keys)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([b], pa.int32()), pa.array([j - i], pa.int64()), pa.array([_packed(keys[i:j])], pa.binary()),
                    pa.array([pa.compress(counts[i:j].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)], pa.binary()),
                ], ["bucket", "n", "keys", "counts"])

        for batch in batches:
            for part in text_slices(batch):
                held.append(np.unique(keys_of(part), return_counts=True))
                if sum(len(k) for k, _ in held) > HELD:
                    held[:] = [merged()]
                    if len(held[0][0]) > HELD // 2:
                        yield from send()
        if held:
            yield from send()

    return docs.select("text").mapInArrow(run, "bucket int, n long, keys binary, counts binary")


def _summed(group: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    rows = group.to_pylist()
    keys = np.concatenate([_unpacked(r["keys"], r["n"]) for r in rows])
    parts = [np.frombuffer(pa.decompress(r["counts"], 8 * r["n"], "zstd", asbytes=True), np.uint8) for r in rows]
    counts = np.concatenate([p.reshape(8, -1).T.copy().view("<u8").ravel() for p in parts])
    return rows[0]["bucket"], *_sums(keys, counts)


def _written(counted: DataFrame, save, shards: int) -> dict[int, tuple[int, int]]:
    """Every bucket's file is written by ``save``; (nodes, tokens) of each, one row for each shard."""

    def run(group: pa.Table) -> pa.Table:
        bucket, keys, counts = _summed(group)
        nodes, tokens = save(bucket, keys, counts)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "nodes": pa.array([nodes], pa.int64()), "tokens": pa.array([tokens], pa.int64())})

    rows = counted.groupBy("bucket").applyInArrow(run, "bucket int, nodes long, tokens long").collect()
    return {r["bucket"]: (r["nodes"], r["tokens"]) for r in rows}


def _log_code(x: np.ndarray, step: float) -> np.ndarray:
    return np.clip(np.ceil(-np.log10(np.maximum(x, 1e-30)) / step - 1e-9), 0, np.iinfo(np.uint16).max).astype(np.uint16)


def _small(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _train_words(docs: DataFrame, model: Model) -> None:
    n, folder = model.shards, model.folder

    def save(shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple[int, int]:
        start = _bucket_start(shard, n)
        arrays = encode(keys - np.uint64(start), _bucket_start(shard + 1, n) - start) | {"counts": _small(counts)}
        _save(folder, _file(1, shard), arrays)
        return len(keys), int(counts.sum())

    found = _written(_counted(docs, lambda part: _tokens(part)[0], lambda keys: bucket_of(keys, n).astype(np.int64)), save, n)
    level = Level()
    for s in range(n):
        level.parents.append((0, 1) if s in found else None)
        level.first.append(level.nodes)
        level.nodes += found.get(s, (0, 0))[0]
        model.tokens += found.get(s, (0, 0))[1]
    model.words = level.nodes
    model.levels.append(level)


def _train_level(docs: DataFrame, model: Model, level: int, least: int) -> None:
    """Counts the n-grams of a level by shards of parents and writes the nodes that reach ``least``."""
    above, width, folder, key = model.levels[-1].nodes, model.words, model.folder, model.key()
    per = max(1, -(-above // model.shards))
    ranges = [(a, min(above, a + per)) for a in range(0, above, per)] or [(0, 0)]
    # A key is (parent within its shard, word); the shard itself goes into the bits above.
    span = per * width
    if span * len(ranges) >= 1 << 64:
        raise ValueError("too few shards for this vocabulary: raise spark.sql.shuffle.partitions")

    def keys_of(part: pa.RecordBatch) -> np.ndarray:
        hashes, n = _tokens(part)
        found = list(_reader(key).nodes(hashes, n, level - 1, values=False))
        number, node = found[0][1], found[-1][1]
        first = np.cumsum(n) - n
        parent = np.empty_like(node)
        parent[1:] = node[:-1]
        if level == 2:
            parent[first] = number[first + n - 1]
            ok = np.arange(len(number))
        else:
            parent[first] = -1
            ok = np.flatnonzero((parent >= 0) & (node >= 0))
        return parent[ok].astype(np.uint64) * np.uint64(width) + number[ok].astype(np.uint64)

    def save(shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple[int, int]:
        low, high = ranges[shard]
        keep = counts >= least
        keys, counts = keys[keep] - np.uint64(low * width), counts[keep]
        parent = (keys // np.uint64(width)).astype(np.int64)
        total = _reader(key).node_counts(level - 1, low, high).astype(float)
        q = (counts - DISCOUNT) / total[parent]
        left = 1 - np.bincount(parent, weights=q, minlength=high - low)
        arrays = encode(keys, (high - low) * width) | {
            "q": _log_code(q, Q_STEP), "g": _log_code(left, G_STEP), "counts": _small(counts)}
        _save(folder, _file(level, shard), arrays)
        return len(keys), int(counts.sum())

    found = _written(_counted(docs, keys_of, lambda keys: (keys // np.uint64(span)).astype(np.int64)), save, len(ranges))
    made = Level()
    for s, (low, high) in enumerate(ranges):
        if s not in found:  # no n-gram starts here: all weight is left over
            _save(folder, _file(level, s), encode(np.zeros(0, np.uint64), 1) | {
                "q": np.zeros(0, np.uint16), "g": np.zeros(max(1, high - low), np.uint16), "counts": np.zeros(0, np.uint8)})
        made.parents.append((low, high))
        made.first.append(made.nodes)
        made.nodes += found.get(s, (0, 0))[0]
    model.levels.append(made)


def train(docs: DataFrame, order: int = ORDER, folder: str | None = None, least: int = MIN_COUNT) -> Model:
    """A model of all texts of ``docs``, in the shared folder."""
    spark = docs.sparkSession
    model = Model(folder or new_table_path(spark, "ngrams"), shards=max(1, partitions(spark)))
    _train_words(docs, model)
    for level in range(2, order + 1):
        if model.levels[-1].nodes:
            _train_level(docs, model, level, least)
    return model


def token_probabilities(reader: Reader, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: tokens of each text; of each token whether it is known, its base probability and the model's."""
    m = reader.model
    hashes, n = _tokens(part)
    base = p = known = None
    for level, _, q, g in reader.nodes(hashes, n, len(m.levels)):
        if level == 1:
            known = q > 0
            base = p = (q + 0.5) / (m.tokens + 0.5 * (m.words + 1))
        else:
            p = q + g * p
    return n, known, base, p


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    key = model.key()

    def run(part: pa.RecordBatch) -> dict:
        reader = _reader(key)
        n, known, base, p = token_probabilities(reader, part)
        first = np.cumsum(n) - n
        return {
            "held_out": part.column("held_out"), "n_tokens": n, "n_known": np.add.reduceat(known, first, dtype=np.int64),
            "train_tokens": np.full(len(n), reader.model.tokens), "base_score": np.add.reduceat(np.log10(base), first),
            "score": np.add.reduceat(np.log10(p), first),
        }

    fields = [
        StructField("held_out", BooleanType()), *(StructField(k, LongType()) for k in ("n_tokens", "n_known", "train_tokens")),
        StructField("base_score", DoubleType()), StructField("score", DoubleType()),
    ]
    return map_texts(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), run, fields, ("doc_id", "text", "held_out"))


def scores(docs: DataFrame, order: int = ORDER, least: int = MIN_COUNT) -> DataFrame:
    """Trains on the documents of all folds but the held-out one and scores every document."""
    return score(docs, train(docs.filter(~held_out(F.col("doc_id"))), order, least=least))
