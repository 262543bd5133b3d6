"""What the document operators share: reading tables, running a function over whole texts, scratch tables.

Rows are handed to Python in Arrow batches and cut there into slices of a few megabytes of
text, so that what a function holds does not depend on how long the documents are (one very
long document is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from crossroads.session import stored  # noqa: F401

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys that ``joined_to_unique`` may broadcast.
MOST_KEYS = 1000


def joined_to_unique(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a table with one row for each key, where one key may hold much of ``left`` (a stored table).

    Keys with more than a 1 / ``MOST_KEYS`` part of the rows, and there can be no more than ``MOST_KEYS`` of them, are
    joined by broadcast, all others by a shuffle in which no key is large. Rows with a null in the key find nothing.
    """
    n = left.agg(F.count("*").alias("n")).scalar()
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    hot = left.filter(known).groupBy(*on).agg(F.count("*").alias("__n")).filter(F.col("__n") * MOST_KEYS > n)
    few = F.broadcast(hot.join(right, on, "left").drop("__n").withColumn("__hot", F.lit(True)))
    found = [c for c in right.columns if c not in on]
    marked = left.join(few.withColumnsRenamed({c: f"__{c}" for c in found}), on, "left")
    direct = marked.filter("`__hot`").select(*left.columns, *[F.col(f"__{c}").alias(c) for c in found])
    rest = marked.filter("`__hot` is null").select(*left.columns)
    return direct.unionByName(rest.join(right, on, "left").select(*left.columns, *found))


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in slices of at most ``most`` bytes of text or one row."""
    ends = pc.cumulative_sum(pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0)).to_numpy()
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(ends.searchsorted(before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_texts(
    docs: DataFrame, fn: Callable[[pa.RecordBatch], dict], fields: list[StructField], columns: tuple[str, ...] = ("doc_id", "text"),
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One output row for each row of ``docs``: the ``keep`` columns as they are and the columns that ``fn`` returns.

    ``fn`` gets a slice with ``columns`` and returns arrays or lists by name. Other columns of
    ``docs`` are not read, so their names cannot clash.
    """
    read = docs.select(*columns)
    schema = StructType([f for f in read.schema.fields if f.name in keep] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                out = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(f.name) if f.name in keep and f.name not in out else pa.array(out[f.name], arrow.field(f.name).type)
                        for f in schema.fields
                    ],
                    schema=arrow,
                )

    return read.mapInArrow(run, schema)
