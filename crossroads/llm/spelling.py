"""Spelling variants by a trie of letter-group counts.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased. Each word has a
vector: how many of its letters fall in each of ``GROUPS`` letter groups. Two words that differ by one
inserted, deleted or replaced letter have vectors with at most one surplus and one deficit of one. Words
are arranged in a trie by successive counts; a depth-first search runs two tries against each other,
level by level, and spends that budget; the words of the leaves it reaches are compared letter by letter.

On the cluster the first ``levels`` of the trie are a join key: a word is sent to its own key and to the
keys one surplus, and at most one deficit, away, so each pair of keys meets in one place. What a key
gathers is cut into tiles of at most about ``TILE`` words on the one side and ``ASKING`` on the other,
whatever its size; every asking word meets every tile of its key. A word has at most about 120 near words
for each of its letters, so counts by word are never uneven.

Defined cases: a null text has no words; a null doc_id is an empty string for ``change``; repeated rows
count each time; words with a count above 15 in a group share the count 15 there; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossroads.llm.frames import stored, text_slices

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
TILE = 1 << 15
ASKING = 1 << 17
#: Distinct words a task holds before it hands its counts on.
HELD = 1 << 18
#: Candidate pairs compared, or trie nodes expanded, at once.
AT_ONCE = 1 << 18
MOST_LEVELS = 4
TOP = 15
#: Words up to this length are compared as rows of a matrix, longer ones one by one.
WIDTH = 32

# fixed value: letters from frequent to rare, dealt to the groups in turn
LETTERS = "etaoinshrdlcumwfgypbvkjxqz"
GROUPS = 12
_RUN = re.compile(rb"[a-z\xc0-\xff]+")

Change = Callable[[object, bytes], bytes]


def group_of() -> np.ndarray:
    """The group of each code point below 256."""
    out = np.zeros(256, np.int64)
    for i, letter in enumerate(LETTERS):
        out[ord(letter)] = i % GROUPS
    out[0xC0:] = np.arange(0x100 - 0xC0) % GROUPS
    return out


def runs(text: str | None) -> list[bytes]:
    """The lower-cased runs of a text, one byte for each letter; what is beyond U+00FF is no letter."""
    return _RUN.findall(text.encode("latin-1", "replace").lower()) if text else []


def typos(doc_id: object, run: bytes) -> bytes:
    """The run, or the run without one letter where 31 divides the crc32 of '<doc_id>:<run>' in UTF-8."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run.decode('latin-1')}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, change: Change | None = None) -> DataFrame:
    """(word, n) of the words that have enough letters and occur often enough, over whole texts.

    ``change`` may alter a run by its document, before lengths and counts are taken; it may shorten only.
    Counts are combined inside each task before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in text_slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    for word, n in Counter(runs(text)).items():
                        if len(word) >= least_length:
                            if change:
                                word = change(doc_id, word)
                                if len(word) < least_length:
                                    continue
                            held[word] = held.get(word, 0) + n
                    if len(held) > HELD:
                        yield told()
                        held.clear()
        yield told()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _counts(word: Column, levels: int) -> list[Column]:
    """The first counts of a word's vector, as columns."""
    of, out = group_of(), []
    for g in range(levels):
        own = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100)) if of[c] == g]
        others = F.translate(word, "".join(own), "")
        out.append(F.least(F.length(word) - F.length(others), F.lit(TOP)))
    return out


def _steps(levels: int) -> list[list[int]]:
    """Differences of keys whose words may be near, the first difference a surplus: none, one surplus, one surplus before one deficit."""
    out = [[0] * levels]
    for i in range(levels):
        for j in (None, *range(i + 1, levels)):
            step = [0] * levels
            step[i] = 1
            if j is not None:
                step[j] = -1
            out.append(step)
    return out


def _tiles(words: DataFrame, levels: int, tile: int, asking: int) -> DataFrame:
    """(key, tile, asks, word, n): the words of a key in tiles, and with each tile the words that are searched in it."""
    keyed = words.select("word", "n", *[c.alias(f"c{i}") for i, c in enumerate(_counts(F.col("word"), levels))])
    key = lambda step: F.concat_ws(".", *[F.col(f"c{i}") + s for i, s in enumerate(step)])
    asked = keyed.select("word", "n", F.explode(F.array(*[key(s) for s in _steps(levels)])).alias("key"), F.lit(True).alias("asks"))
    homes = keyed.select("word", "n", key([0] * levels).alias("key"), F.lit(False).alias("asks"))
    both = homes.unionByName(asked)
    # One row for each key: at most 17 ** MOST_LEVELS, whatever the number of words.
    sizes = both.groupBy("key").agg(
        F.ceil(F.count_if(~F.col("asks")) / tile).alias("tiles"), F.ceil(F.count_if("asks") / asking).alias("shares"),
    ).filter("tiles > 0")
    h = F.xxhash64("word")
    at = F.when(F.col("asks"), F.expr("sequence(0L, tiles - 1)")).otherwise(F.array(F.pmod(h, F.col("tiles"))))
    share = F.when(F.col("asks"), F.array(F.pmod(h, F.col("shares")))).otherwise(F.expr("sequence(0L, shares - 1)"))
    placed = both.join(F.broadcast(sizes), "key")
    return placed.select("key", "word", "n", "asks", F.explode(at).alias("tile"), share.alias("s")).select(
        "key", "tile", F.explode("s").alias("share"), "asks", "word", "n")


def near(words: DataFrame, tile: int = TILE, asking: int = ASKING) -> DataFrame:
    """(word, n_near, best_n, best): for words (word, n) that have near words, how many, and the most frequent of them.

    Of equally frequent ones the best is the first in code-point order. ``words`` should be stored: it is read several times.
    """
    n = words.count()
    levels = 1
    while levels < MOST_LEVELS and n > tile * 4 ** levels:
        levels += 1

    def search(group: pa.Table) -> pa.Table:
        asks = np.array(group.column("asks").to_pylist(), bool)
        found = _Best([w.encode("latin-1") for w in group.column("word").to_pylist()], group.column("n").to_numpy())
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        for i, j in found.pairs(left, right):
            found.add(i, j)
        return found.table()

    parts = _tiles(words, levels, tile, asking).groupBy("key", "tile", "share").applyInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


class Trie:
    """Vectors in order, as levels of nodes: a node is its parent's number and its count."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        v = vectors[self.order]
        new = np.ones(len(v), bool)
        node = np.zeros(len(v), np.int64)
        self.keys, self.first = [], []
        changed = np.zeros(len(v), bool)
        changed[:1] = True
        for g in range(v.shape[1]):
            changed[1:] |= v[1:, g] != v[:-1, g]
            new = np.flatnonzero(changed)
            self.keys.append(node[new] * (TOP + 1) + v[new, g])
            parents = node[new]
            self.first.append(np.searchsorted(parents, np.arange(parents[-1] + 2 if len(parents) else 1)))
            node = np.cumsum(changed) - 1
        self.ends = np.r_[new, len(v)]

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For nodes above ``level``: index into ``nodes`` and child, for every child."""
        return _spread(self.first[level][nodes], self.first[level][nodes + 1])

    def child(self, level: int, nodes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The child of each node with the given count, and whether there is one."""
        keys, asked = self.keys[level], nodes * (TOP + 1) + counts
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return at, (keys[at] == asked) & (counts >= 0) & (counts <= TOP)


def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every value of the ranges [start, end), with the number of its range."""
    n = end - start
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def meetings(left: Trie, right: Trie, levels: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf numbers (left, right) whose vectors differ by at most one surplus of the right and then one deficit.

    Depth first over slices of at most ``AT_ONCE`` node pairs, so what is held does not depend on the number of words.
    """
    zero = np.zeros(1, np.int64)
    stack = [(0, zero, zero, np.zeros(1, np.int8))]  # level, left node, right node, spent: 0 none, 1 surplus, 2 both
    while stack:
        level, a, b, spent = stack.pop()
        if level == levels:
            yield a, b
            continue
        owner, child = left.children(level, a)
        count = left.keys[level][child] % (TOP + 1)
        for step, may, then in ((0, (0, 1, 2), 0), (1, (0,), 1), (-1, (1,), 1)):
            allowed = np.isin(spent[owner], may)
            own, kid = owner[allowed], child[allowed]
            at, there = right.child(level, b[own], count[allowed] + step)
            for i in range(0, len(own), AT_ONCE):
                s = slice(i, i + AT_ONCE)
                ok = there[s]
                if ok.any():
                    stack.append((level + 1, kid[s][ok], at[s][ok], spent[own[s][ok]] + np.int8(then)))


class _Best:
    """Near words found so far, and of each word how many it has and the most frequent one."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = words, n.astype(np.int64)
        self.lens = np.array([len(w) for w in words], np.int64)
        of = group_of()
        flat = np.frombuffer(b"".join(words), np.uint8)
        owner = np.repeat(np.arange(len(words)), self.lens)
        counts = np.bincount(owner * GROUPS + of[flat], minlength=len(words) * GROUPS).reshape(-1, GROUPS)
        self.vectors = np.minimum(counts, TOP)
        short = np.flatnonzero(self.lens <= WIDTH)
        from_start, from_end = np.zeros((len(words), WIDTH), np.uint8), np.zeros((len(words), WIDTH), np.uint8)
        for i in short.tolist():
            w = np.frombuffer(words[i], np.uint8)
            from_start[i, :len(w)] = w
            from_end[i, :len(w)] = w[::-1]
        self.from_start, self.from_end = from_start, from_end
        # Places in order of the words: equal words, which occur once on each side, have the same place.
        _, self.place = np.unique(np.array(words, object), return_inverse=True) if words else (None, np.zeros(0, np.int64))
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        self.near = np.zeros(len(words), np.int64)
        self.best = np.full(len(words), -1, np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers of near words, each pair of different words once."""
        if not len(left) or not len(right):
            return
        a, b = Trie(self.vectors[left]), Trie(self.vectors[right])
        for la, lb in meetings(a, b, GROUPS):
            # Words of a leaf are consecutive in the trie's order; their pairs are taken a slice at a time.
            p, i = _spread(a.ends[la], a.ends[la + 1])
            wide = (b.ends[lb + 1] - b.ends[lb])[p]
            cuts = np.flatnonzero(np.diff(np.cumsum(wide) // AT_ONCE)) + 1
            for rows in np.split(np.arange(len(p)), cuts):
                q, j = _spread(b.ends[lb][p[rows]], b.ends[lb + 1][p[rows]])
                x, y = left[a.order[i[rows][q]]], right[b.order[j]]
                same = (self.vectors[x] == self.vectors[y]).all(axis=1)
                once = ~same | (self.place[x] < self.place[y])
                x, y = x[once], y[once]
                ok = self.verified(x, y)
                if ok.any():
                    yield x[ok], y[ok]

    def verified(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Do the words differ by exactly one letter? From the lengths of their common beginnings and ends."""
        la, lb = self.lens[x], self.lens[y]
        ok = (np.abs(la - lb) <= 1) & (self.place[x] != self.place[y])
        matrix = ok & (la <= WIDTH) & (lb <= WIDTH)
        r = np.flatnonzero(matrix)
        least = np.minimum(la[r], lb[r])

        def common(m: np.ndarray) -> np.ndarray:
            apart = m[x[r]] != m[y[r]]
            return np.minimum(np.where(apart.any(axis=1), apart.argmax(axis=1), WIDTH), least)

        ok[r] = common(self.from_start) + common(self.from_end) >= np.where(la[r] == lb[r], la[r] - 1, least)
        for i in np.flatnonzero(ok & ~matrix).tolist():
            ok[i] = one_apart(self.words[x[i]], self.words[y[i]])
        return ok

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        self.links.append((x, y))
        self.held += len(x)
        if self.held > 4 * AT_ONCE:
            self.reduce()

    def reduce(self) -> None:
        if not self.links:
            return
        x, y = (np.concatenate(z) for z in zip(*self.links))
        self.links, self.held = [], 0
        owner, other = np.r_[x, y], np.r_[y, x]
        self.near += np.bincount(owner, minlength=len(self.near))
        known = np.flatnonzero(self.best >= 0)
        owner, other = np.r_[owner, known], np.r_[other, self.best[known]]
        order = np.lexsort((self.place[other], -self.n[other], owner))
        owner, other = owner[order], other[order]
        first = np.r_[True, owner[1:] != owner[:-1]]
        self.best[owner[first]] = other[first]

    def table(self) -> pa.Table:
        self.reduce()
        rows = np.flatnonzero(self.near).tolist()
        return pa.table({
            "word": pa.array([self.words[i].decode("latin-1") for i in rows], pa.string()), "n_near": pa.array(self.near[rows]),
            "best_n": pa.array(self.n[self.best[rows]], pa.int64()),
            "best": pa.array([self.words[self.best[i]].decode("latin-1") for i in rows], pa.string()),
        })


def one_apart(a: bytes, b: bytes) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def variants(words: DataFrame, ratio: int = RATIO, tile: int = TILE, asking: int = ASKING) -> DataFrame:
    """word, n, n_near, form, form_n, root for each of ``words`` (word, n).

    The form is the most frequent near word, where it is at least ``ratio`` times as frequent. The root follows forms
    to the last. Every step multiplies the count by the ratio, so a few rounds of jumping to the form's form reach it;
    each round is a stored table, and the loop ends when no row has moved.
    """
    words = stored(words, "words")
    found = near(words, tile, asking)
    often = F.col("best_n") >= ratio * F.col("n")
    rows = stored(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(often, F.col("best")).alias("form"),
        F.when(often, F.col("best_n")).alias("form_n"),
    ), "variants")
    links = stored(rows.filter("form is not null").select("word", F.col("form").alias("to")), "forms")
    while True:
        further = links.select(F.col("word").alias("to"), F.col("to").alias("on"))
        links = stored(links.join(further, "to", "left").select("word", F.coalesce("on", "to").alias("to"), F.col("on").isNotNull().alias("moved")), "forms")
        if not links.filter("moved").head(1):
            break
        links = links.drop("moved")
    return rows.join(links.select("word", F.col("to").alias("root")), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
