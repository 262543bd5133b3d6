"""Questions and answers between blocks of documents and hash buckets.

Dedup operators ask of millions of hashes "where else is this?". Documents are first stored as
blocks of about a megabyte of text (``blocks``), whose numbers stay the same however often a task
is repeated. A block sends each bucket one row with its distinct hashes packed (``asked``); the
bucket answers each block with packed bits (``answers``), which are stored; the next pass reads
the blocks with their answers (``told``). A hash that is found in every document costs a bucket one
entry for each block, not one for each occurrence, and no text is sent where bits will do. The
number of buckets follows ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from crossroads.llm.frames import partitions, stored, text_slices

BLOCK_BYTES = 1 << 20
BUCKETS_PER_PARTITION = 4
#: The id of a document whose id is null: none is larger.
NO_ID = np.iinfo(np.int64).max


def blocks(docs: DataFrame, most: int = BLOCK_BYTES) -> DataFrame:
    """doc_id (bigint) and whole text of ``docs`` as stored rows of block number, ids, byte lengths and compressed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in text_slices(batch, most=most):
                text = part.column("text").fill_null("").cast(pa.large_string())
                ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
                body = text.buffers()[2].slice(ends[0], ends[-1] - ends[0]) if ends[-1] > ends[0] else b""
                yield pa.RecordBatch.from_arrays([
                    pa.array([n]), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(ends)], pa.list_(pa.int64())), pa.array([pa.compress(body, "zstd", asbytes=True)], pa.binary()),
                ], ["block", "ids", "lens", "body"])
                n += 1

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(read.mapInArrow(run, "block long, ids array<long>, lens array<long>, body binary"), "blocks")


@dataclass
class Block:
    number: int
    ids: list
    starts: np.ndarray
    lens: np.ndarray
    body: bytes
    bits: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def data(self) -> np.ndarray:
        return np.frombuffer(self.body, np.uint8)

    @property
    def sort_ids(self) -> np.ndarray:
        return np.array([NO_ID if i is None else i for i in self.ids], np.int64)


def block_of(row: dict) -> Block:
    lens = np.array(row["lens"], np.int64)
    total = int(lens.sum())
    body = pa.decompress(row["body"], total, "zstd", asbytes=True) if total else b""
    return Block(row["block"], row["ids"], np.cumsum(lens) - lens, lens, body)


def rows_of(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """One row at a time, so that one block is unpacked at a time."""
    for i in range(table.num_rows):
        yield table.slice(i, 1).to_pylist()[0]


def asked(source: DataFrame, fn: Callable[[Block], Iterator[tuple]], schema: str) -> DataFrame:
    """The rows that ``fn`` makes of each block."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                yield from _batches(fn(block_of(row)), arrow)

    return source.mapInArrow(run, schema)


def _batches(rows: Iterator[tuple], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    made = list(rows)
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], arrow.field(i).type) for i in range(len(arrow))], schema=arrow)


def answers(questions: DataFrame, fn: Callable[[list[dict]], list[bytes]], kind: str) -> DataFrame:
    """``fn`` gets all rows of a bucket and gives one answer for each; stored as (block, bucket, kind, answer)."""
    schema = "block long, bucket int, kind string, answer binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        out = [(r["block"], r["bucket"], kind, a) for r, a in zip(rows, fn(rows))]
        return pa.Table.from_batches(_batches(out, arrow))

    return stored(questions.groupBy("bucket").applyInArrow(run, schema), f"answers-{kind}")


def told(source: DataFrame, replies: DataFrame, fn: Callable[[Block, dict[str, list[bytes]]], Iterator[tuple]], schema: str) -> DataFrame:
    """The rows that ``fn`` makes of each block and its answers, by kind in order of the bucket."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        by_kind: dict[str, list[tuple[int, bytes]]] = {}
        for r in got.to_pylist():
            by_kind.setdefault(r["kind"], []).append((r["bucket"], r["answer"]))
        found = {k: [a for _, a in sorted(v, key=lambda x: x[0])] for k, v in by_kind.items()}
        made = [b for row in rows_of(own) for b in _batches(fn(block_of(row), found), arrow)]
        return pa.Table.from_batches(made, schema=arrow)

    return source.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def buckets(spark) -> int:
    return partitions(spark) * BUCKETS_PER_PARTITION


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Rises with the hash, so sorted hashes are sorted by bucket."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def by_bucket(h: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets that sorted hashes fall in."""
    b = bucket_of(h, n).astype(np.int64)
    cuts = np.r_[0, np.flatnonzero(np.diff(b)) + 1, len(b)] if len(b) else np.zeros(1, int)
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(b[i]), i, j


def bits(packed: list[bytes], sizes: list[int]) -> np.ndarray:
    """The packed answers of consecutive buckets as one array of booleans."""
    parts = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p, n in zip(packed, sizes, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def cut(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1]) if sizes else []
