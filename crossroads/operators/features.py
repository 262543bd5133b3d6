"""Model-ready feature tables from the raw vehicle table, and point-in-time lookups of features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from . import prefix


def scenario_aggregates(vehicles: DataFrame) -> DataFrame:
    """Mean and top speed, vehicle count, mean distance per scenario; combined before the exchange."""
    return vehicles.groupBy("scenario_id").agg(
        F.avg("speed").alias("avg_speed_in_scenario"),
        F.max("speed").alias("max_speed_in_scenario"),
        F.count("vehicle_id").alias("num_vehicles_in_scenario"),
        F.avg("distance_to_intersection").alias("avg_distance_in_scenario"),
    )


def with_scenario_aggregates(vehicles: DataFrame) -> DataFrame:
    """The aggregates on every row.

    A join and not a window: a scenario that holds much of the table stays spread over
    tasks, because the aggregated side has one row per scenario.
    """
    return vehicles.join(scenario_aggregates(vehicles), "scenario_id", "left")


def encoded(raw: DataFrame) -> DataFrame:
    """Direction and label codes, and this vehicle's wait and rank from the literal texts."""
    waits = scalar.python_literal(F.col("waiting_times"), "map<string,int>")
    ranks = scalar.python_literal(F.col("priority_order"), "map<string,int>")
    return raw.withColumns({
        "direction_enc": scalar.direction_code(F.col("direction")),
        "conflict_label": scalar.label_code(F.col("is_conflict")),
        "vehicle_waiting_time": scalar.own_wait(waits, F.col("vehicle_id")),
        "vehicle_priority": scalar.own_priority(ranks, F.col("vehicle_id")),
    })


def build(raw: DataFrame) -> DataFrame:
    """The whole chain: codes, maps, scenario aggregates, raw columns dropped (those present)."""
    full = encoded(raw).transform(with_scenario_aggregates)
    return full.drop(*[c for c in C.DROPPED_COLUMNS if c in full.columns])


def fit_scaler(df: DataFrame, columns: list[str] = C.NUMERIC_FEATURES) -> dict[str, tuple[float, float]]:
    """column -> (mean, population deviation), a constant column getting deviation 1. One aggregation."""
    columns = [c for c in columns if c in df.columns]
    row = scaler_table(df, columns).collect()
    return {r["column"]: (r["mean"], r["scale"]) for r in row}


def scaler_table(df: DataFrame, columns: list[str] = C.NUMERIC_FEATURES) -> DataFrame:
    """The fit as a table (column, mean, scale), to be stored next to the features."""
    columns = [c for c in columns if c in df.columns]
    one = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
    cells = ", ".join(f"'{c}', m_{c}, s_{c}" for c in columns)
    return one.select(F.expr(f"stack({len(columns)}, {cells}) as (column, mean, sd)")).select(
        "column", "mean", F.when(F.col("sd") == 0, 1.0).otherwise(F.col("sd")).alias("scale")
    )


def scaled(df: DataFrame, fit: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in fit.items()})


# --- point in time ---------------------------------------------------------------


def latest(features: DataFrame, keys: list[str], ts: str, tie: str, until: Column | None = None) -> DataFrame:
    """Newest row per entity, up to ``until``; combined before the exchange."""
    rows = features if until is None else features.filter(F.col(ts) <= until)
    fields = [c for c in rows.columns if c not in keys and c not in (ts, tie)]
    best = F.max(F.struct(ts, tie, *fields)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, "_best.*")


def materialise(snapshot: DataFrame, features: DataFrame, keys: list[str], ts: str, tie: str, until: Column) -> DataFrame:
    """The snapshot brought forward to ``until`` with newer feature rows."""
    newer = features.filter(F.col(ts) <= until).select(*snapshot.columns)
    return latest(snapshot.unionByName(newer), keys, ts, tie)


def as_of(
    labels: DataFrame, features: DataFrame, key: str, ts: str, tie: str, values: list[str], ttl_days: int = C.FEATURE_TTL_DAYS,
) -> DataFrame:
    """For each label row the newest feature row at or before it, not older than the TTL.

    Both tables run along (key, time), features first where times are equal; the newest feature so far is a
    running maximum. ``prefix.running`` cuts the run into even parts, so a key, or one day of a key, that
    holds much of the table is spread over many tasks.
    """
    found = F.struct(F.col(ts).alias("ts"), F.col(tie).alias("tie"), *values)
    none = F.lit(None)
    known = features.select(
        key, F.col(ts).alias("_at"), F.lit(0).alias("_side"), found.alias("_f"), none.cast(labels.schema).alias("_l")
    )
    asked = labels.select(
        key, F.col(ts).alias("_at"), F.lit(1).alias("_side"), none.cast(known.schema["_f"].dataType).alias("_f"),
        F.struct(*labels.columns).alias("_l"),
    )
    times = features.select(key, F.col(ts).alias("_at")).unionByName(labels.select(key, F.col(ts).alias("_at"))).withColumn("_side", F.lit(0))
    seen = prefix.running(known.unionByName(asked), [key], ["_at", "_side"], {"_now": ("max", F.col("_f"))}, cut_by=times).filter("_l is not null")
    fresh = F.col("_now.ts") >= F.col("_at") - F.expr(f"INTERVAL {ttl_days} DAYS")
    out = [F.when(fresh, F.col(f"_now.{v}")).alias(f"feature_{v}") for v in values]
    return seen.select("_l.*", F.when(fresh, F.col("_now.ts")).alias("feature_ts"), *out)
