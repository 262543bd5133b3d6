"""Sinks: tables, JSON lines, event and audit appends, report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import lane, prefix


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] = ()) -> None:
    out = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        out = out.option("header", True).option("escape", '"')
    (out.partitionBy(*partition_by) if partition_by else out).save(path)


def write_features(df: DataFrame, path: str, ts: str = "event_timestamp") -> None:
    """Feature table partitioned by date, so a point-in-time read prunes to its days."""
    write_table(df.withColumn("event_date", F.to_date(ts)), path, partition_by=["event_date"])


def write_chat_lines(records: DataFrame, path: str, compression: str = "gzip", lines_per_file: int = 500_000) -> None:
    """Chat records as lines of JSON.

    Every line repeats the instruction, so plain lines take many times the input; ``compression="none"`` writes them for a
    tool that takes no other. A compressed file is read by one task, hence the bound on its lines.
    """
    lines = records.select(F.to_json(F.struct("messages")).alias("value"))
    lines.write.mode("overwrite").option("maxRecordsPerFile", lines_per_file).text(path, compression=compression)


def prediction_events(scored: DataFrame) -> DataFrame:
    """Log rows from scored scenarios: rule label and agreement are computed here.

    ``scored`` has scenario_id, vehicles (prepared), prediction struct, latency_ms, json_valid,
    fallback_used, timestamp and both versions; a scenario the rule cannot judge gets NULL.
    """
    judged = scored.withColumn(
        "ground_truth", F.when(F.col("vehicles").isNotNull(), scalar.yes_no(lane.any_conflict(F.col("vehicles"))))
    )
    bare = F.transform("vehicles", lambda v: F.struct(*[v[f].alias(f) for f in lane.S.VEHICLE_FIELDS if f != "seq"]))
    return judged.select(
        F.col("scenario_id").cast("string").alias("scenario_id"), "timestamp", "model_version", "prompt_version",
        bare.alias("vehicles"), "prediction", F.round("latency_ms", 1).alias("latency_ms"), "json_valid",
        "fallback_used", "ground_truth", (F.col("prediction.is_conflict") == F.col("ground_truth")).alias("rule_agreement"),
    )


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def append_trigger(triggers: DataFrame, path: str, batch: int) -> None:
    """One evaluation's records, under its number: written again it replaces itself."""
    triggers.withColumn("evaluated_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def report_table(**tables: DataFrame) -> DataFrame:
    """Tidy union of metric tables: (report, dimension, metric, value), one row per number."""
    tall = []
    for name, df in tables.items():
        numbers = [c for c, t in df.dtypes if t in ("double", "bigint", "int", "float")]
        labels = [c for c, t in df.dtypes if t == "string"]
        cells = ", ".join(f"'{c}', cast(`{c}` as double)" for c in numbers)
        dimension = F.concat_ws("/", *labels) if labels else F.lit("all")
        tall.append(df.select(
            F.lit(name).alias("report"), dimension.alias("dimension"),
            F.expr(f"stack({len(numbers)}, {cells}) as (metric, value)")))
    return prefix.union_all(tall)
