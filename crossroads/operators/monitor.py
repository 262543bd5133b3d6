"""Monitoring decisions over a window of prediction events, and the counters behind the gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import fill, fixed
from . import metrics

# fixed values: upper bounds of the latency histogram, in seconds
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def window_counts() -> list[Column]:
    labelled = F.col("ground_truth").isNotNull()
    t, p = F.col("ground_truth") == "yes", F.col("predicted") == "yes"
    agree = F.col("rule_agreement")
    return [
        F.count("*").alias("n_window"), F.count_if(labelled).alias("n_labeled"),
        F.count_if(t & p).alias("tp"), F.count_if(t & ~p).alias("fn"),
        F.count_if(~F.coalesce(F.col("json_valid"), F.lit(True))).alias("bad_json"),
        F.count_if(agree.isNotNull()).alias("n_agree"), F.count_if(agree).alias("agree"),
        F.count_if(p).alias("conflicts"),
    ]


def trigger(window: DataFrame, by: list[str] = [], drift_detected: bool | DataFrame = False) -> DataFrame:
    """One row per group: metrics, reasons and the retraining flag.

    Thresholds are compared before rounding. Recall, miss rate and agreement only count
    where there is ground truth. An empty window asks for nothing. ``drift_detected`` may be a
    table of one row and one column, which is read inside the plan; no row or NULL counts as no drift.
    """
    counts = window.withColumn(
        "rule_agreement", F.col("predicted") == F.col("ground_truth")
    ).groupBy(*by).agg(*window_counts())
    pos = F.col("tp") + F.col("fn") + metrics.EPS
    have = F.col("n_labeled") > 0
    recall, fnr = F.when(have, F.col("tp") / pos), F.when(have, F.col("fn") / pos)
    failure = F.when(F.col("n_window") > 0, F.col("bad_json") / F.col("n_window"))
    agreement = F.when(F.col("n_agree") > 0, F.col("agree") / F.col("n_agree"))
    rate = F.when(F.col("n_window") > 0, F.col("conflicts") / F.col("n_window"))
    rows = counts.select(*by, "n_window", "n_labeled", recall.alias("recall"), fnr.alias("fnr"),
                         failure.alias("json_failure_rate"), agreement.alias("rule_agreement_rate"),
                         rate.alias("conflict_rate"))
    drift = drift_detected.scalar() if isinstance(drift_detected, DataFrame) else F.lit(drift_detected)
    rows = rows.withColumn("_drift", F.coalesce(drift, F.lit(False)))
    c = F.col
    breached = {
        "fnr": (c("fnr") > C.FNR_MAX, C.FNR_MAX),
        "recall": (c("recall") < C.RECALL_MIN, C.RECALL_MIN),
        "json_failure_rate": (c("json_failure_rate") > C.JSON_FAILURE_MAX, C.JSON_FAILURE_MAX),
        "rule_agreement_rate": (c("rule_agreement_rate") < C.RULE_AGREEMENT_MIN, C.RULE_AGREEMENT_MIN),
    }
    reasons = F.array_compact(F.array(
        *[F.when(cond, fill(C.TRIGGER_TEXT[n], value=fixed(c(n), 3), limit=str(limit))) for n, (cond, limit) in breached.items()],
        F.when(c("_drift") & (c("n_window") > 0), C.TRIGGER_TEXT["drift"]),
    ))
    rounded = ["recall", "fnr", "json_failure_rate", "rule_agreement_rate", "conflict_rate"]
    out = rows.withColumn("triggers", reasons)
    reason = F.when(c("n_window") == 0, C.TRIGGER_TEXT["empty"]).when(
        F.size("triggers") > 0, F.array_join("triggers", "; ")
    ).otherwise(C.TRIGGER_TEXT["fine"])
    return out.select(
        *by, (F.size("triggers") > 0).alias("should_retrain"), reason.alias("reason"), "triggers",
        "n_window", "n_labeled", *[F.round(c(r), 4).alias(r) for r in rounded],
    )


def decide(health: DataFrame) -> DataFrame:
    """The scheduled decision from rows of metrics; an absent metric counts as healthy.

    Columns: fnr, recall, drift_detected, robustness, rule_agreement_rate (any may be NULL).
    """
    healthy = {"fnr": 0.0, "recall": 1.0, "drift_detected": False, "robustness": 1.0, "rule_agreement_rate": 1.0}
    v = {
        k: F.coalesce(F.col(k), F.lit(d)) if k in health.columns else F.lit(d) for k, d in healthy.items()
    }
    reasons = F.array_compact(F.array(
        F.when(v["fnr"] > C.FNR_MAX, "fnr"), F.when(v["recall"] < C.RECALL_MIN, "recall"),
        F.when(v["drift_detected"], "drift"), F.when(v["robustness"] < C.ROBUSTNESS_MIN, "robustness"),
        F.when(v["rule_agreement_rate"] < C.RULE_AGREEMENT_MIN, "rule_agreement"),
    ))
    return health.withColumn("reasons", reasons).withColumn("should_retrain", F.size("reasons") > 0)


def latency_bucket(latency_s: Column) -> Column:
    """Smallest bound the latency does not exceed; +Inf above all."""
    chain = F.lit("+Inf")
    for bound in reversed(LATENCY_BUCKETS):
        chain = F.when(latency_s <= bound, str(bound)).otherwise(chain)
    return chain


def counters(events: DataFrame) -> DataFrame:
    """Predictions by result and latency bucket; sum over buckets for the plain counter."""
    result = F.when(F.col("predicted") == "yes", "conflict").otherwise("no_conflict")
    return events.groupBy(
        result.alias("conflict_result"), latency_bucket(F.col("latency_ms") / 1000.0).alias("le")
    ).agg(F.count("*").alias("n"), F.round(F.sum("latency_ms"), 2).alias("sum_ms"))
