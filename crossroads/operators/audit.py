"""Subgroup audit: the same scores over seven groupings of the scenarios, and their spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from . import lane, metrics
from . import scenarios as S

DIMENSIONS = [
    "direction", "lane_parity", "vehicle_count", "movement_type", "speed_range", "distance_range", "conflict_density",
]


def scenario_attributes(scenarios: DataFrame) -> DataFrame:
    """Adds the seven group columns, each from the first non-NULL value in the scenario.

    Needs ``number_of_conflicts``. Lane parity and movement are the same column, as audited.
    """
    first = lambda field: S.first_value(F.col("vehicles"), field)
    return scenarios.withColumns({
        "direction": first("direction"),
        "lane_parity": scalar.lane_parity(first("lane")),
        "vehicle_count": scalar.size_band(F.size("vehicles")),
        "movement_type": scalar.lane_parity(first("lane")),
        "speed_range": scalar.speed_band(first("speed")),
        "distance_range": scalar.distance_band(first("distance_to_intersection")),
        "conflict_density": scalar.density_band(F.col("number_of_conflicts")),
    })


def mean_reference_wait(scenarios: DataFrame) -> DataFrame:
    """Adds ``avg_ref_wait``: mean wait over the vehicles in any lane-rule pair, 0 without pairs."""
    keep = [c for c in scenarios.columns if c not in ("scenario_id", "vehicles")]
    paired = lane.with_pairs(scenarios)
    outcomes = lane.outcome_array(F.col("vehicles"), F.col("pairs"))
    # without pairs there is no outcome to look for
    told = F.when(F.size("pairs") > 0, F.transform(outcomes, lambda o: o["wait"])).otherwise(F.array().cast("array<int>"))
    waits = paired.select("scenario_id", "vehicles", *keep, told.alias("w"))
    total = F.aggregate("w", F.lit(0), lambda a, x: a + x)
    return waits.select(
        "scenario_id", "vehicles", *keep,
        F.when(F.size("w") > 0, total / F.size("w")).otherwise(0.0).alias("avg_ref_wait"),
    )


def by_dimension(records: DataFrame) -> DataFrame:
    """One row per record and dimension: (dimension, grp); a NULL group is dropped."""
    cells = ", ".join(f"'{d}', {d}" for d in DIMENSIONS)
    tall = records.select(
        "scenario_id", "true_label", "predicted_label", "wait_error",
        F.expr(f"stack({len(DIMENSIONS)}, {cells}) as (dimension, grp)"),
    )
    return tall.filter("grp is not null")


def subgroup_metrics(records: DataFrame) -> DataFrame:
    """Scores of every group of every dimension, in one scan and one aggregation.

    ``records`` has the group columns, both labels and ``wait_error`` (0 when a conflict was
    predicted, else the mean reference wait).
    """
    t, p = F.col("true_label") == "yes", F.col("predicted_label") == "yes"
    out = by_dimension(records).groupBy("dimension", "grp").agg(
        F.count("*").alias("n"), *metrics.confusion_counts(),
        F.round(F.avg("wait_error"), 4).alias("wt_mae_s"),
        F.round(metrics.share(t), 4).alias("conflict_rate_true"),
        F.round(metrics.share(p), 4).alias("conflict_rate_pred"),
    )
    return out.select(
        "dimension", "grp", "n", *metrics.scores(), "wt_mae_s", "conflict_rate_true", "conflict_rate_pred"
    )


def disparity(groups: DataFrame) -> DataFrame:
    """Largest minus smallest score per dimension (0 with fewer than two groups), and the flags."""
    gap = lambda c: F.when(F.count("*") >= 2, F.round(F.max(c) - F.min(c), 4)).otherwise(0.0).alias(f"{c}_disparity")
    out = groups.groupBy("dimension").agg(
        F.count("*").alias("n_groups"), gap("f1"), gap("fnr"), gap("accuracy"),
        F.round(F.avg("wt_mae_s"), 4).alias("mean_wt_mae_s"),
    )
    return out.withColumns({
        "bias_detected": F.col("f1_disparity") > C.BIAS_MAX_GAP,
        "safety_bias_detected": F.col("fnr_disparity") > C.BIAS_MAX_GAP,
    })
