"""Substring dedup of word windows by difference-cover anchors.

{0, 1, 3} is a difference cover modulo 7: for any two positions there is a shift below 7 after
which both lie at cover positions. Two equal windows of 13 words therefore share an anchor, an
equal run of 7 words that begins at a cover position in both. So only 3 of 7 positions are hashed
and sent; an anchor that no second document has ends the matter for all it would cover. Windows
that hold a shared anchor are then extended to their full 13 words and compared by the smallest
document id that has them, never pair by pair, so a passage that a third of all documents share
costs one entry for each block of documents.

Words are ``[^\\x20\\x09-\\x0D]+``, windows never cross documents. Defined cases: a null text has
no words; documents with fewer than ``WINDOW`` words lose nothing; equal doc_ids are not smaller
than each other; a null doc_id is larger than every other; an empty table gives an empty table;
only ``doc_id`` (bigint) and ``text`` are read. Windows are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from crossroads.llm import exchange
from crossroads.llm.exchange import Block
from crossroads.llm.hashing import prefix_sums, span_hash, window_hash, words

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1


class _Words:
    """The words of a block and what is hashed of them."""

    def __init__(self, block: Block):
        self.block = block
        self.start, self.end, self.doc = words(block.data, block.starts)
        self.hashes = span_hash(prefix_sums(block.data), self.start, self.end)
        self.n = np.bincount(self.doc, minlength=len(block.ids)) if len(self.doc) else np.zeros(len(block.ids), np.int64)
        first = np.cumsum(self.n) - self.n
        self.place = np.arange(len(self.doc)) - first[self.doc]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors at cover positions of documents long enough."""
        fits = (self.place + ANCHOR <= self.n[self.doc]) & (self.n[self.doc] >= WINDOW)
        at = np.flatnonzero(fits & np.isin(self.place % PERIOD, COVER))
        return at, window_hash(self.hashes, ANCHOR)[at]

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows that hold one of the anchors at ``shared``."""
        seen = np.zeros(len(self.doc) + 1, np.int64)
        seen[shared + 1] = 1
        seen = np.cumsum(seen)
        at = np.flatnonzero(self.place + WINDOW <= self.n[self.doc])
        at = at[seen[at + PERIOD] > seen[at]]
        return at, window_hash(self.hashes, WINDOW)[at]


def _anchor_rows(block: Block, n: int) -> Iterator[tuple]:
    """For each bucket: the anchors' low hash bits, and whether two documents of the block have them."""
    w = _Words(block)
    at, h = w.anchors()
    distinct, inverse = np.unique(h, return_inverse=True)
    least, most = np.full(len(distinct), len(block.ids)), np.full(len(distinct), -1)
    np.minimum.at(least, inverse, w.doc[at])
    np.maximum.at(most, inverse, w.doc[at])
    for b, i, j in exchange.by_bucket(distinct, n):
        yield b, block.number, distinct[i:j].astype(np.uint32).tobytes(), np.packbits(most[i:j] > least[i:j]).tobytes()


def _shared(rows: list[dict]) -> list[bytes]:
    """Bits: is the anchor in more than one document? A false yes by the shortened hash only costs a later look."""
    keys = [np.frombuffer(r["keys"], np.uint32) for r in rows]
    sizes = [len(k) for k in keys]
    yes = exchange.bits([r["twice"] for r in rows], sizes)
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    yes[order[1:][same]] = True
    yes[order[:-1][same]] = True
    return [np.packbits(x).tobytes() for x in exchange.cut(yes, sizes)]


def _shared_windows(w: _Words, told: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    at, h = w.anchors()
    distinct, inverse = np.unique(h, return_inverse=True)
    yes = exchange.bits(told.get("anchor", []), [j - i for _, i, j in exchange.by_bucket(distinct, n)])
    return w.windows(at[yes[inverse]] if len(at) else at)


def _firsts(w: _Words, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows, the smallest id that has each in the block, and where each window is among them."""
    distinct, inverse = np.unique(h, return_inverse=True)
    first = np.full(len(distinct), exchange.NO_ID)
    np.minimum.at(first, inverse, w.block.sort_ids[w.doc[at]])
    return distinct, first, inverse


def _window_rows(block: Block, told: dict, n: int) -> Iterator[tuple]:
    """For each bucket: the windows' hashes and the smallest id of the block that has each."""
    w = _Words(block)
    distinct, first, _ = _firsts(w, *_shared_windows(w, told, n))
    for b, i, j in exchange.by_bucket(distinct, n):
        ids, which = np.unique(first[i:j], return_inverse=True)
        yield b, block.number, distinct[i:j].tobytes(), ids.tobytes(), which.astype(np.uint16).tobytes()


def _earlier(rows: list[dict]) -> list[bytes]:
    """Bits: does a document with a smaller id than the block's smallest have the window?"""
    keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    first = np.concatenate([np.frombuffer(r["ids"], np.int64)[np.frombuffer(r["which"], np.uint16)] for r in rows])
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    least = np.full(len(distinct), exchange.NO_ID)
    np.minimum.at(least, inverse, first)
    return [np.packbits(x).tobytes() for x in exchange.cut(least[inverse] < first, [len(k) for k in keys])]


def _kept_rows(block: Block, told: dict, n: int) -> Iterator[tuple]:
    w = _Words(block)
    at, h = _shared_windows(w, told, n)
    distinct, first, inverse = _firsts(w, at, h)
    yes = exchange.bits(told.get("window", []), [j - i for _, i, j in exchange.by_bucket(distinct, n)])
    ids = block.sort_ids
    gone = at[yes[inverse] | (first[inverse] < ids[w.doc[at]])] if len(at) else at
    step = np.zeros(len(w.doc) + 1, np.int64)
    np.add.at(step, gone, 1)
    np.add.at(step, gone + WINDOW, -1)
    out = np.cumsum(step)[:-1] > 0
    ends = np.cumsum(w.n)
    for i, doc_id in enumerate(block.ids):
        here = block.body[block.starts[i]:block.starts[i] + block.lens[i]].split()
        mask = out[ends[i] - w.n[i]:ends[i]]
        removed = int(mask.sum())
        if removed:
            here = [x for x, m in zip(here, mask.tolist()) if not m]
        yield doc_id, int(w.n[i]), removed, b" ".join(here).decode()


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, a row for each document."""
    n = exchange.buckets(docs.sparkSession)
    source = exchange.blocks(docs)
    asked = exchange.asked(source, lambda b: _anchor_rows(b, n), "bucket int, block long, keys binary, twice binary")
    anchors = exchange.answers(asked, _shared, "anchor")
    asked = exchange.told(source, anchors, lambda b, t: _window_rows(b, t, n), "bucket int, block long, keys binary, ids binary, which binary")
    windows = exchange.answers(asked, _earlier, "window")
    return exchange.told(source, anchors.union(windows), lambda b, t: _kept_rows(b, t, n), "doc_id long, n_words long, n_removed long, kept string")
