"""Structured Streaming over prediction events: the batch operators, fed by increments.

Every query ends in a table at a path the caller names, with its state beside it: started again
with the same path it goes on where it stopped. Batches are written under their batch number and
replace themselves when repeated, so a restart or a lost executor changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import lane, monitor, windows
from ..sources import adapters, writers


def event_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """The events table, one file or a folder of part files, as a stream of prediction events.

    A stream takes a plain path for a folder; a pattern that fits this one name takes a file as well.
    """
    fields = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(fields).option("maxFilesPerTrigger", max_files).parquet(f"{sf_dir}/events.parque[t]")
    return adapters.as_prediction_events(raw).withColumn("ts", F.col("ts").cast("timestamp"))


def _run(stream: DataFrame, path: str, store, mode: str = "append") -> None:
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(store)
        .option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_to_table(stream: DataFrame, path: str, mode: str, each=None) -> str:
    """Run all available input through the query into the table at ``path``; returns the path.

    ``each(batch, batch_id)`` turns a micro-batch into the rows to store.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = each(batch, batch_id) if each else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    _run(stream, path, store, mode)
    return path


def deduplicated(stream: DataFrame, delay: str | None = None) -> DataFrame:
    """One row per event id. Files may come in any order of time: without ``delay`` every id is remembered.

    A ``delay`` bounds the state; ids are then told apart only among events closer than that.
    """
    if delay is None:
        return stream.dropDuplicates(["event_id"])
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def hourly_counters(stream: DataFrame, delay: str | None = None) -> DataFrame:
    """Predictions, invalid replies and latency per hour and result.

    The state has two rows per hour. ``delay`` drops hours from it, and rows that come later than that.
    """
    result = F.when(F.col("predicted") == "yes", "conflict").otherwise("no_conflict")
    timed = stream if delay is None else stream.withWatermark("ts", delay)
    return (
        timed.groupBy(F.window("ts", "1 hour").alias("w"), result.alias("conflict_result"))
        .agg(
            F.count("*").alias("n"), F.count_if(~F.col("json_valid")).alias("bad_json"),
            F.sum("latency_ms").alias("sum_ms"), F.max("latency_ms").alias("max_ms"),
        )
        .select(F.col("w.start").alias("hour"), "conflict_result", "n", "bad_json", "sum_ms", "max_ms")
    )


def latency_histogram(stream: DataFrame, delay: str | None = None) -> DataFrame:
    """Predictions per hour, result and latency bucket, beside the plain counters: at most 30 rows of state per hour."""
    result = F.when(F.col("predicted") == "yes", "conflict").otherwise("no_conflict")
    timed = stream if delay is None else stream.withWatermark("ts", delay)
    le = monitor.latency_bucket(F.col("latency_ms") / 1000.0)
    return (
        timed.groupBy(F.window("ts", "1 hour").alias("w"), result.alias("conflict_result"), le.alias("le"))
        .agg(F.count("*").alias("n"), F.sum("latency_ms").alias("sum_ms"))
        .select(F.col("w.start").alias("hour"), "conflict_result", "le", "n", "sum_ms")
    )


def newest_of_batches(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last stored version of each key of an update-mode table."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in keys and c != "batch"]
    last = F.max_by(F.struct(*values), "batch").alias("_v")
    return rows.groupBy(*keys).agg(last).select(*keys, "_v.*")


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies in, if it is there."""
    at, store = _folder(spark, path)
    store.delete(at, True)


def _versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """bucket -> the batches that wrote it, rising; from folder names alone, at most a few for each bucket."""
    at, store = _folder(spark, f"{path}/batch=*/bucket=*")
    out: dict[int, list[int]] = {}
    for found in store.globStatus(at) or []:
        whole = found.getPath()
        out.setdefault(int(whole.getName().split("=")[1]), []).append(int(whole.getParent().getName().split("=")[1]))
    return {b: sorted(v) for b, v in out.items()}


STATE_BUCKETS = 64


def triggers(
    stream: DataFrame, path: str, keys: list[str], order: list[str], n: int, buckets: int = STATE_BUCKETS,
) -> DataFrame:
    """The retraining decision per key over its last ``n`` events, evaluated and recorded after every batch.

    The events kept lie in ``path``/state in hash buckets of the key, under the batch that wrote them. A batch reads the
    newest version of the buckets its keys fall in and writes those anew; other buckets are not touched. Its decisions for the
    keys in these buckets go to ``path``/audit. A batch is cut to ``n`` rows per key before it meets the stored rows, so what
    is kept is at most n rows per key, however uneven the keys are. A version goes when a bucket has two newer ones; a
    repeated batch finds its predecessors still there and replaces itself. Returns the last decision for each key.
    """
    spark = stream.sparkSession
    state = f"{path}/state"

    def keep(batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        rows = windows.last_n_per_key(batch, keys, order, n).withColumn("bucket", bucket)
        touched = {r["bucket"] for r in rows.select("bucket").distinct().collect()}  # at most ``buckets`` numbers
        known = {b: [v for v in of if v < batch_id] for b, of in _versions(spark, state).items()}
        newest = [f"{state}/batch={known[b][-1]}/bucket={b}" for b in touched if known.get(b)]
        if newest:
            kept = spark.read.schema(batch.schema).parquet(*newest)
            rows = windows.last_n_per_key(kept.unionByName(batch), keys, order, n).withColumn("bucket", bucket)
        rows.write.partitionBy("bucket").mode("overwrite").parquet(f"{state}/batch={batch_id}")
        stored = spark.read.schema(rows.schema).parquet(f"{state}/batch={batch_id}")
        writers.append_trigger(monitor.trigger(stored.drop("bucket"), keys), f"{path}/audit", batch_id)
        for b, of in known.items():
            for v in of[:-2] if b not in touched else of[:-1]:
                _remove(spark, f"{state}/batch={v}/bucket={b}")

    _run(stream, path, keep)
    audit = spark.read.parquet(f"{path}/audit")
    values = [c for c in audit.columns if c not in (*keys, "batch", "evaluated_at")]
    last = F.max_by(F.struct(*values), "batch").alias("_v")
    return audit.groupBy(*keys).agg(last).select(*keys, "_v.*")


def labelled(scored: DataFrame) -> DataFrame:
    """Rule label and agreement for streamed scenario rows (``vehicles`` prepared); no state needed."""
    truth = scalar.yes_no(lane.any_conflict(F.col("vehicles")))
    return scored.withColumn("ground_truth", truth).withColumn(
        "rule_agreement", F.col("prediction.is_conflict") == F.col("ground_truth")
    )


def routed(stream: DataFrame, id_col: str, share_a: float) -> DataFrame:
    return stream.withColumn("routed_to", scalar.route(F.col(id_col).cast("string"), share_a))
