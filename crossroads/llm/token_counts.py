"""Token counts by a map-side two-tier lookup of pre-token lengths.

Tier one is a compact table of frequent pre-tokens and their token counts, broadcast: at most
``FREQUENT`` entries of at most ``LONGEST`` bytes, so at most about 1.6 MB whatever the corpus.
Tier two is a cache in each Python worker, filled by encoding the pre-tokens that tier one
misses; it is emptied when it holds ``CACHED`` entries. Pre-tokens are never shuffled.

The frequent pre-tokens come from one pass over all documents: each task keeps counts in a
summary of bounded size (when it overflows, every count goes down by one and zeros leave), and
the summaries are added up. The table only decides what is quick; every count is exact.

A byte-level vocabulary splits a text by its pre-token pattern and encodes each piece on its own,
so lengths add up. Special strings inside texts are split off first, as the library does by
default, and count as one token. Defined cases: null and empty texts have 0 tokens; repeated rows
are counted each for itself; an empty table gives an empty table; only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from crossroads.llm.frames import map_texts, stored, text_slices

FREQUENT = 50_000
LONGEST = 24
CACHED = 200_000
LIMIT = 512

#: Fixed value: the published pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class Lengths(dict):
    """Pre-token to token count: the broadcast tier below, the worker's own entries on top."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.path, self.frequent = path, frequent
        t = tokenizer(path)
        specials = sorted((x.content for x in t.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.split = regex.compile("|".join([*map(regex.escape, specials), PATTERN])) if specials else regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.pieces = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.frequent) + CACHED:
            self.clear()
            self.update(self.frequent)
        n = self[piece] = len(tokenizer(self.path).encode(piece, add_special_tokens=False).ids)
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or self.special.search(text) is None:
            return sum(map(self.__getitem__, self.pieces.findall(text)))
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += sum(map(self.__getitem__, self.pieces.findall(text[at:m.start()]))) + 1
            at = m.end()
        return total + sum(map(self.__getitem__, self.pieces.findall(text[at:])))


_WORKER: dict[str, Lengths] = {}


def _lengths(path: str, shared) -> Lengths:
    key = f"{path} {shared.id if hasattr(shared, 'id') else id(shared)}"
    if key not in _WORKER:
        _WORKER.clear()
        words, counts = shared.value
        _WORKER[key] = Lengths(path, dict(zip(words.split("\n"), counts)))
    return _WORKER[key]


#: Summaries that one task merges.
MERGED = 16


def _packed(kept: Counter, most: int) -> pa.RecordBatch:
    top = kept.most_common(most)
    return pa.RecordBatch.from_arrays(
        [pa.array(["\n".join(w for w, _ in top)], pa.string()), pa.array([[n for _, n in top]], pa.list_(pa.int64()))], ["words", "n"])


def frequent_pretokens(docs: DataFrame, most: int = FREQUENT) -> list[str]:
    """At most ``most`` frequent pre-tokens of the form " word", from bounded summaries of all documents.

    A task's summary is one row of at most ``most`` words and counts. Rows are merged ``MERGED`` at a time, each round into
    fewer rows of the same bound, and the last one comes to the driver: words are never shuffled one by one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in batches:
            for part in text_slices(batch):
                for text in part.column("text").to_pylist():
                    if text:
                        kept.update(text.split())
                        while len(kept) > 4 * most:
                            kept = Counter({w: n - 1 for w, n in kept.items() if n > 1})
        yield _packed(Counter({w: n for w, n in kept.items() if len(w.encode()) <= LONGEST}), most)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in batches:
            for words, n in zip(batch.column("words").to_pylist(), batch.column("n").to_pylist()):
                for w, k in zip(words.split("\n"), n):
                    kept[w] += k
        if kept:
            yield _packed(kept, most)

    found = stored(docs.select("text").mapInArrow(count, "words string, n array<long>"), "frequent")
    while (rows := found.count()) > 1:
        found = stored(found.repartition(-(-rows // MERGED)).mapInArrow(merge, "words string, n array<long>"), "frequent")
    last = found.first()
    return sorted(last["words"].split("\n")) if last and last["n"] else []


def counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, bytes, tokens by the vocabulary file ``path``, and whether there are more than ``limit`` tokens."""
    pieces = regex.compile(PATTERN)
    words = dict.fromkeys(piece for w in frequent_pretokens(docs) for piece in pieces.findall(f" {w}") if "\n" not in piece)
    ids = tokenizer(path).encode_batch(list(words), add_special_tokens=False)
    shared = docs.sparkSession.sparkContext.broadcast(("\n".join(words), bytes(min(255, len(x.ids)) for x in ids)))

    def run(part: pa.RecordBatch) -> dict:
        lengths = _lengths(path, shared)
        texts = part.column("text").to_pylist()
        n = [lengths.count(t) for t in texts]
        return {"n_bytes": [len(t.encode()) if t else 0 for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_texts(docs, run, [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])
