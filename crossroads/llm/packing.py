"""Conflict-constrained best-fit packing of documents into bins of a fixed number of tokens.

Open bins are kept in order of what room they have left. Each carries a bitmap of the sources and
duplicate clusters it holds; an item conflicts with a bin that shares a bit with it. The search for
an item starts at the first bin with enough room and goes on to the next larger until one is
compatible, which is the tightest compatible one. Bins lie in small runs that carry the bits all of
their bins share, so a run that conflicts as a whole is passed over at once: a source that holds a
third of all documents does not make every search a walk over all bins.

Documents are dealt by hash into groups of about ``GROUP`` items, longest first within a group, and
groups are packed independently; only ids, lengths and hashes are shuffled. The hash is of a row
number, stored with them first, so that a repeated task deals alike and a hot source, a cluster or
one row repeated many times is spread over the groups like everything else. A document longer than a bin is cut into whole bins
and a rest; nothing is cut off. Length is counted in words unless another column is named.

Defined cases: a document without words has one row with null bin and length 0; null sources are one
source, null texts are no duplicates of each other; repeated rows are items of one cluster and one
source and never share a bin; ties go to the bin opened first, items tie by id; an empty table gives
an empty table; columns besides those named are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossroads.llm.frames import stored

CAPACITY = 2048
GROUP = 20_000
RUN = 128


class OpenBins:
    """Bins with room, in order of (room, number), in runs of at most ``2 * RUN``."""

    def __init__(self):
        self.runs: list[list[tuple[int, int]]] = []
        self.shared: list[int] = []
        self.bits: dict[int, int] = {}

    def _refresh(self, at: int) -> None:
        bits, shared = self.bits, -1
        for _, number in self.runs[at]:
            shared &= bits[number]
            if not shared:
                break
        self.shared[at] = shared

    def _run_of(self, entry: tuple[int, int]) -> int:
        """The first run whose last entry is not below ``entry``."""
        lo, hi = 0, len(self.runs)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.runs[mid][-1] < entry:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def add(self, room: int, number: int, bits: int) -> None:
        self.bits[number] = bits
        at = min(self._run_of((room, number)), len(self.runs) - 1)
        if at < 0:
            self.runs.append([(room, number)])
            self.shared.append(bits)
            return
        insort(self.runs[at], (room, number))
        self.shared[at] &= bits
        if len(self.runs[at]) > 2 * RUN:
            self.runs[at:at + 1] = [self.runs[at][:RUN], self.runs[at][RUN:]]
            self.shared.insert(at, 0)
            self._refresh(at)
            self._refresh(at + 1)

    def take(self, length: int, bits: int) -> tuple[int, int, int] | None:
        """Removes and returns (room, number, bits) of the tightest bin that fits and does not conflict."""
        at = self._run_of((length, -1))
        place = bisect_left(self.runs[at], (length, -1)) if at < len(self.runs) else 0
        for at in range(at, len(self.runs)):
            if not self.shared[at] & bits:
                run = self.runs[at]
                for i in range(place, len(run)):
                    room, number = run[i]
                    if not self.bits[number] & bits:
                        del run[i]
                        if run:
                            self._refresh(at)
                        else:
                            del self.runs[at], self.shared[at]
                        return room, number, self.bits.pop(number)
            place = 0
        return None


def best_fit(items: list[tuple[int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, bits) in the order given."""
    bins, made, out = OpenBins(), 0, []
    for length, bits in items:
        found = bins.take(length, bits)
        if found is None:
            room, number, held = capacity, made, 0
            made += 1
        else:
            room, number, held = found
        out.append((number, capacity - room))
        if room > length:
            bins.add(room - length, number, held | bits)
    return out


def _conflict_bits(sources: list, clusters: list) -> list[int]:
    """A bit for each source; a bit for each cluster of which the group has more than one item."""
    number = {s: i for i, s in enumerate(sorted(set(sources), key=lambda s: (s is not None, s)))}
    seen: dict = {}
    for c in clusters:
        if c is not None:
            seen[c] = seen.get(c, 0) + 1
    repeated = {c: len(number) + i for i, c in enumerate(sorted(c for c, n in seen.items() if n > 1))}
    return [1 << number[s] | (1 << repeated[c] if c in repeated else 0) for s, c in zip(sources, clusters)]


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def copies(text: str = "text") -> Column:
    """The cluster of texts that are equal but for case; null texts have none."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(F.lower(text)))


def packed(docs: DataFrame, capacity: int = CAPACITY, length: Column | None = None, cluster: Column | None = None, group: int = GROUP) -> DataFrame:
    """doc_id, piece, piece_start, length, bin_id and bin_offset; a row for each document, more for those longer than a bin."""
    items = stored(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), (words() if length is None else length.cast("long")).alias("n"),
        (copies() if cluster is None else cluster).alias("cluster"), F.monotonically_increasing_id().alias("row"),
    ), "items")
    pieces = items.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / capacity) - 1).cast("int")))).select(
        "doc_id", "source", "cluster", "row", "piece", (F.col("piece").cast("long") * capacity).alias("piece_start"),
        F.least(F.lit(capacity), F.col("n") - F.col("piece").cast("long") * capacity).alias("length"),
    )
    groups = max(1, math.ceil(items.agg(F.count("*")).first()[0] / group))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("int")).drop("row")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "piece_start", "length", "bin_id", "bin_offset"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table["length"].to_pylist()
        n = sum(x > 0 for x in lengths)
        some = table.slice(0, n)
        bits = _conflict_bits(some["source"].to_pylist(), some["cluster"].to_pylist())
        placed = best_fit(list(zip(lengths[:n], bits)), capacity)
        base = table["group"][0].as_py() << 32
        empty = [None] * (len(lengths) - n)
        return table.select(names[:4]).append_column("bin_id", pa.array([base + b for b, _ in placed] + empty, pa.int64())).append_column(
            "bin_offset", pa.array([o for _, o in placed] + empty, pa.int64()))

    return dealt.groupBy("group").applyInArrow(run, f"doc_id {kind}, piece int, piece_start long, length long, bin_id long, bin_offset long")
