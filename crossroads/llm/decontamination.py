"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items. For every pattern length a shift table says
how far the search may jump after seeing a block of two words; a block that ends a pattern leads
to a bucket, which is keyed by the first block of its patterns; what is left is compared word by
word. Documents are only scanned: no shuffle. The pattern tables are broadcast and their size is
checked before by what they grow with, the words of the benchmark: each word begins at most one
window, at about 700 bytes of tables. A benchmark above ``most_words`` is searched in shares of about
that size. Then the documents get a row number in a table in the shared folder, every share is
searched in the same job and yields the number and the hits of documents that have any, and these are
joined back. An item is never cut, so a share is as large as its longest item at least.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Defined cases: a null
text has no words and is not hit; an empty benchmark hits nothing; items without words have no
window; equal windows of several items count for each of them; an item_id that occurs twice is one
item, and a repeated benchmark row is searched once; windows of an item whose id is null hit words
but are not listed; repeated documents are judged each for itself.
"""

from __future__ import annotations

import math
from ast import literal_eval
from collections import defaultdict
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from crossroads.llm.frames import map_texts, stored

#: Every byte that is no part of a word becomes a space; A-Z becomes a-z; bytes from 0x80 stay.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: The same words in a text whose letters are as they were, for counting them on Spark's side.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class WuManber:
    """Shift tables, suffix buckets and patterns of a set of word windows, by pattern length."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            length = min(size, len(ids))
            for i in range(len(ids) - length + 1 if ids else 0):
                owners[tuple(ids[i:i + length])].add(item)
        self.base = len(self.vocabulary) + 1
        self.tables: list[tuple[int, dict, dict]] = []
        by_length: dict[int, list] = defaultdict(list)
        for pattern, names in owners.items():
            by_length[len(pattern)].append((pattern, tuple(sorted(x for x in names if x is not None))))
        for length, patterns in sorted(by_length.items()):
            shift: dict[int, int] = {}
            buckets: dict[int, dict] = defaultdict(lambda: defaultdict(list))
            for pattern, names in patterns:
                blocks = self.blocks(pattern)
                for at, block in enumerate(blocks):
                    shift[block] = min(shift.get(block, len(blocks)), len(blocks) - 1 - at)
                buckets[blocks[-1]][blocks[0]].append((list(pattern), names))
            self.tables.append((length, shift, {k: dict(v) for k, v in buckets.items()}))

    def blocks(self, ids) -> list[int]:
        """The blocks of two words of a pattern; a pattern of one word is its own block."""
        return [a * self.base + b for a, b in zip(ids, ids[1:])] if len(ids) > 1 else [ids[0]]

    def search(self, words: list[bytes]) -> list[tuple[int, int, tuple]]:
        """(start, length, items) of every occurrence."""
        known, base, found = self.vocabulary, self.base, []
        ids = [known.get(w, 0) for w in words]
        for length, shift, buckets in self.tables:
            least, jump, at, end = min(2, length), max(1, length - 1), length - 1, len(ids)
            while at < end:
                block = ids[at - 1] * base + ids[at] if least == 2 else ids[at]
                step = shift.get(block, jump)
                if step:
                    at += step
                    continue
                start = at - length + 1
                first = ids[start] * base + ids[start + 1] if least == 2 else ids[start]
                for pattern, names in buckets[block].get(first, ()):
                    if ids[start:at + 1] == pattern:
                        found.append((start, length, names))
                at += 1
        return found


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pack(spans: list[tuple[int, int]], items: set[str]) -> bytes:
    return repr((spans, sorted(items))).encode()


def _scan(docs: DataFrame, items: list, size: int, fields: list[StructField], keep: tuple[str, ...], finish) -> DataFrame:
    """Documents against the windows of ``items``; hits of other shares come in ``__states``, if there is such a column."""
    spark = docs.sparkSession
    columns = tuple(dict.fromkeys((*keep, "text", *[c for c in ("__states",) if c in docs.columns])))
    shared = spark.sparkContext.broadcast(WuManber(items, size).__dict__)

    def run(part: pa.RecordBatch) -> dict:
        index = WuManber.__new__(WuManber)
        index.__dict__ = shared.value
        states = part.column("__states").to_pylist() if "__states" in columns else [None] * part.num_rows
        rows = []
        for text, told in zip(part.column("text").to_pylist(), states):
            words = words_of(text)
            found = index.search(words)
            others = [literal_eval(state.decode()) for state in told or ()]
            spans = _united([*((s, s + n) for s, n, _ in found), *(span for spans, _ in others for span in spans)])
            rows.append(finish(len(words), spans, {x for _, _, owners in found for x in owners}.union(*(names for _, names in others))))
        return {f.name: [r[i] for r in rows] for i, f in enumerate(fields)}

    return map_texts(docs, run, fields, columns, keep)


def _found(n: int, spans: list, items: set[str]) -> tuple:
    return n, spans, sorted(items)


_FOUND = [
    StructField("n_words", LongType()),
    StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
    StructField("items", ArrayType(StringType())),
]


def hits(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, most_words: int = 300_000, keep: tuple[str, ...] = ("doc_id",),
    fields: list[StructField] = _FOUND, finish=_found,
) -> DataFrame:
    """The ``keep`` columns of each document, its number of words, the word ranges that are hit (end exclusive) and the items found.

    The benchmark is measured first; it is searched whole if it has at most ``most_words`` words,
    else in shares of about that size.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.regexp_count("text", F.lit(_WORD)))).first()[0] or 0
    shares = max(1, math.ceil(total / most_words))
    rows_of = lambda wanted: [(r["item_id"], r["text"]) for r in wanted.toLocalIterator()]
    if shares == 1:
        return _scan(docs, rows_of(items), size, fields, keep, finish)
    items = stored(items, "benchmark")
    share = F.pmod(F.xxhash64("item_id", "text"), F.lit(shares))
    columns = list(dict.fromkeys((*keep, "text")))
    numbered = stored(docs.select(*columns, F.monotonically_increasing_id().alias("__row")), "hits")
    state = [StructField("__state", BinaryType())]
    pack = lambda n, spans, names: (_pack(spans, names) if spans else None,)
    found = [_scan(numbered, rows_of(items.filter(share == k)), size, state, ("__row",), pack).filter("__state is not null") for k in range(shares)]
    # at most one state per share and document
    states = reduce(DataFrame.unionByName, found).groupBy("__row").agg(F.collect_list("__state").alias("__states"))
    return _scan(numbered.join(states, "__row", "left"), [], size, fields, keep, finish)


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The documents that no benchmark window occurs in, all their columns as they were."""
    fields = [StructField("__hit", BooleanType())]
    marked = hits(docs, benchmark, size, keep=tuple(docs.columns), fields=fields, finish=lambda n, spans, names: (bool(spans),))
    return marked.filter(~F.col("__hit")).select(*docs.columns)
