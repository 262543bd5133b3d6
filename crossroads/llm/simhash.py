"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: words lower-cased (A-Z), shingles of ``SHINGLE`` words joined by a space, XXH64 with
seed 42 of each, repeats included; a bit is 1 if it is set in over half of them. Two fingerprints
link if they differ in at most ``RADIUS`` bits.

Only distinct fingerprints are compared. They are laid in tiles by the population counts of their
two halves, within a tile in blocks by the counts of their first and third quarters; a block never
holds more than about ``BLOCK`` fingerprints. Two fingerprints within the radius have counts that
differ by at most the radius, so a tile meets only the tiles around it, and a pair of blocks is
dropped when its counts are too far apart. What is left is compared as a matrix with exclusive-or
and bit counts in numpy. Of the links found, a task hands on a spanning forest, never all pairs of
a group. Components are then joined up on Spark.

Defined cases: a null or empty text has fingerprint 0, linked like any other; fewer than
``SHINGLE`` words are one shingle; repeated rows share their component; null doc_ids are passed
over when the smallest id of a component is taken (null if all are); an empty table gives an empty
table; other columns of ``docs`` are not read by ``near_duplicates`` and are kept by ``distinct``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from crossroads.llm.components import components, forest
from crossroads.llm.frames import joined_to_unique, map_texts, stored

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCK = 4096
#: Population counts of quarters that share a block.
GRAIN = 3
#: Links that a task holds before it reduces them to a forest.
HELD = 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(whole, SEED)]
    else:
        ends = np.flatnonzero(np.frombuffer(whole, np.uint8) == 0x20)
        starts = [0, *(ends + 1).tolist()]
        stops = [*ends.tolist(), len(whole)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(whole[a:b], SEED) for a, b in zip(starts, stops[shingle - 1:])]
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), name: str = "fingerprint") -> DataFrame:
    """The ``keep`` columns and the fingerprint as a bigint (its 64 bits), a row for each document."""

    def run(part: pa.RecordBatch) -> dict:
        return {name: np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)}

    return map_texts(docs, run, [StructField(name, LongType())], tuple(dict.fromkeys((*keep, "text"))), keep)


def _count(bits: Column, at: int, width: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(bits, at).bitwiseAND(F.lit((1 << width) - 1)))


def _blocks(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints packed by tile (a, b: counts of the halves) and block (p, q: counts of two quarters, salt)."""
    fp = F.col("fingerprint")
    keyed = fps.select(
        fp, _count(fp, 0, 32).alias("a"), _count(fp, 32, 32).alias("b"),
        F.floor(_count(fp, 0, 16) / GRAIN).cast("int").alias("p"), F.floor(_count(fp, 32, 16) / GRAIN).cast("int").alias("q"),
    )
    key = ["a", "b", "p", "q"]
    # One row for each combination of four counts: at most 33 * 33 * 6 * 6, whatever the number of fingerprints.
    sizes = keyed.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    salted = keyed.join(F.broadcast(sizes), key).withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.col("salts")).cast("int"))
    return salted.groupBy(*key, "salt").agg(F.collect_list("fingerprint").alias("fps"))


def _apart(da: Column, p: Column, other: Column) -> Column:
    """The least difference of the two quarters of a half, given the difference of the half and the ranges of one quarter."""
    low, high = (p - other - 1) * GRAIN + 1, (p - other + 1) * GRAIN - 1
    beyond = F.greatest(F.lit(0), low - F.greatest(F.lit(0), da), F.least(F.lit(0), da) - high)
    return F.abs(da) + 2 * beyond


def _pairs(blocks: DataFrame, radius: int) -> DataFrame:
    """Each pair of blocks that may hold a link, once, as (left, right) arrays; a block meets itself too."""
    around = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)]
    steps = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in around]))
    left = blocks.select(
        steps.alias("d"), F.col("a").alias("a0"), F.col("b").alias("b0"), F.col("p").alias("p0"), F.col("q").alias("q0"),
        F.col("salt").alias("s0"), F.col("fps").alias("left"),
    ).withColumn("a", F.col("a0") + F.col("d.x")).withColumn("b", F.col("b0") + F.col("d.y"))
    same_tile = (F.col("d.x") == 0) & (F.col("d.y") == 0)
    order = F.struct("p0", "q0", "s0") <= F.struct("p", "q", "salt")
    near = _apart(F.col("a0") - F.col("a"), F.col("p0"), F.col("p")) + _apart(F.col("b0") - F.col("b"), F.col("q0"), F.col("q")) <= radius
    return left.join(blocks.withColumnRenamed("fps", "right"), ["a", "b"]).filter((~same_tile | order) & near).select("left", "right")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect exactly the distinct fingerprints that links within ``radius`` connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, held = [], [], 0
        for batch in batches:
            columns = []
            for name in ("left", "right"):
                lists = batch.column(name)
                columns.append((lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)))
            (lo, lv), (ro, rv) = columns
            for i in range(batch.num_rows):
                left, right = lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]]
                rows = max(1, (1 << 20) // max(1, len(right)))
                for at in range(0, len(left), rows):
                    a, b = np.nonzero(np.bitwise_count(left[at:at + rows, None] ^ right[None, :]) <= radius)
                    if len(a):
                        us.append(left[at + a].view(np.int64))
                        vs.append(right[b].view(np.int64))
                        held += len(a)
                if held > HELD:
                    u, v = forest(np.concatenate(us), np.concatenate(vs))
                    us, vs, held = [u], [v], len(u) // 2
        u, v = forest(np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return _pairs(_blocks(fps.select("fingerprint").distinct()), radius).mapInArrow(run, "u long, v long")


def _labelled(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints with the column ``__class``, the smallest fingerprint (as bigint) of their component."""
    found = components(links(prints, radius)).select(F.col("node").alias("fingerprint"), F.col("component").alias("__class"))
    return prints.join(found, "fingerprint", "left").withColumn("__class", F.coalesce("__class", "fingerprint"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links.

    Classes are worked out on distinct fingerprints; a fingerprint or a class that holds much of the table never
    brings its rows together in one task.
    """
    marked = stored(fingerprints(docs), "fingerprints")
    prints = stored(_labelled(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), radius), "classes")
    least = prints.groupBy("__class").agg(F.min("least").alias("component_id"))
    named = stored(joined_to_unique(prints, least, ["__class"]).select("fingerprint", "component_id"), "components")
    return joined_to_unique(marked, named, ["fingerprint"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def distinct(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each component, that of the smallest doc_id, all its columns as they were.

    The documents are stored with a row number first, so that rows with the same id stay apart.
    """
    columns = docs.columns
    marked = stored(fingerprints(docs, tuple(columns), "__fp").withColumn("__row", F.monotonically_increasing_id()), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__row")).alias("__first")
    prints = marked.groupBy(F.col("__fp").alias("fingerprint")).agg(first)
    best = _labelled(prints, radius).groupBy("__class").agg(F.min("__first").alias("best"))
    return marked.join(best.select(F.col("best.__row").alias("__row")), "__row", "left_semi").select(*columns)
