"""Confusion counts and what follows from them, per any grouping, in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from . import joins, prefix

EPS = 1e-9


def confusion_counts(truth: str = "true_label", predicted: str = "predicted_label") -> list[Column]:
    t, p = F.col(truth) == "yes", F.col(predicted) == "yes"
    return [
        F.count_if(t & p).alias("tp"), F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & p).alias("fp"), F.count_if(~t & ~p).alias("tn"),
    ]


def confusion(records: DataFrame, by: list[str]) -> DataFrame:
    return records.groupBy(*by).agg(*confusion_counts())


def accuracy() -> Column:
    return scalar.ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))


def precision() -> Column:
    return scalar.ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return scalar.ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def f1() -> Column:
    return scalar.ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def fnr(no_positive: float) -> Column:
    """Missed share of the positives. Without positives the offline runs say 1, the online ones 0."""
    if no_positive == 1.0:
        return 1 - recall()
    return F.col("fn") / (F.col("fn") + F.col("tp") + EPS)


def scores(digits: int = 4, no_positive: float = 0.0) -> list[Column]:
    named = {
        "accuracy": accuracy(), "precision": precision(), "recall": recall(), "f1": f1(), "fnr": fnr(no_positive),
    }
    return [F.round(c, digits).alias(n) for n, c in named.items()]


def share(flag: Column) -> Column:
    return F.avg(flag.cast("int"))


def variant_metrics(records: DataFrame, by: list[str] = ["variant"]) -> DataFrame:
    """The A/B table without latencies: scores, reply validity, fallback, rule disagreement, rates."""
    t, p = F.col("true_label"), F.col("predicted_label")
    out = records.groupBy(*by).agg(
        F.count("*").alias("n"), *confusion_counts(),
        F.round(share(F.col("json_valid")), 4).alias("json_validity_rate"),
        F.round(share(~F.col("json_valid")), 4).alias("fallback_rate"),
        F.round(share(p != F.col("rule_label")), 4).alias("rule_disagree_rate"),
        F.round(share(t == "yes"), 4).alias("conflict_rate_true"),
        F.round(share(p == "yes"), 4).alias("conflict_rate_pred"),
    )
    rest = ["json_validity_rate", "fallback_rate", "rule_disagree_rate", "conflict_rate_true", "conflict_rate_pred"]
    return out.select(*by, "n", *scores(), *rest)


def fnr_two_ways(records: DataFrame, by: list[str]) -> DataFrame:
    return confusion(records, by).select(
        *by, (F.col("tp") + F.col("fn")).alias("n_positive"),
        F.round(fnr(1.0), 4).alias("fnr_offline"), F.round(fnr(0.0), 4).alias("fnr_online"),
    )


def percentiles(records: DataFrame, by: list[str], value: str, shares: dict[str, float], digits: int = 1) -> DataFrame:
    """Exact linearly interpolated percentiles.

    Values are counted first, then numbered by running counts, so neither a group's values
    nor its histogram meet in one task.
    """
    counts = records.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    placed = prefix.running(counts, by, [value], {"_upto": ("sum", F.col("_c"))})
    total = counts.groupBy(*by).agg(F.sum("_c").alias("_n"))
    rows = placed.join(total, by)

    def at(position):
        return F.min(F.when(F.col("_upto") > position, F.col(value)))

    ends = []
    for name, q in shares.items():
        place = q * (F.col("_n") - 1)
        ends += [at(F.floor(place)).alias(f"{name}_lo"), at(F.ceil(place)).alias(f"{name}_hi")]
    out = rows.groupBy(*by, "_n").agg(*ends)
    final = []
    for name, q in shares.items():
        place = q * (F.col("_n") - 1)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        final.append(F.round(lo + (hi - lo) * (place - F.floor(place)), digits).alias(name))
    return out.select(*by, *final)


def approximate_percentiles(records: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    return records.groupBy(*by).agg(
        *[F.percentile_approx(value, q, 10000).alias(name) for name, q in shares.items()]
    )


#: Size of the sketch's summaries: the rank of a quantile is off by about 0.7 % of the rows at most, whatever their number.
SKETCH_K = 400


def latency_sketches(records: DataFrame, by: list[str], value: str = "latency_ms") -> DataFrame:
    """One mergeable quantile sketch per group (say, per variant and day), to be stored; combined before the exchange."""
    known = records.filter(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), SKETCH_K).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, by: list[str], shares: dict[str, float]) -> DataFrame:
    """Quantiles per coarser group from stored sketches, merged without the rows: ``by``, n, and a column for each share."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", SKETCH_K).alias("_s"))
    return merged.select(
        *by, F.kll_sketch_get_n_double("_s").alias("n"),
        *[F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias(name) for name, q in shares.items()],
    )


def wait_error(waits: DataFrame, by: list[str], predicted: str = "predicted_waits", reference: str = "reference_waits") -> DataFrame:
    """Mean over scenarios of the mean absolute error of waiting times, per ``by``; both columns are maps by vehicle."""
    error = joins.wait_map_error(F.col(predicted), F.col(reference))
    return waits.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg(error), 4).alias("waiting_time_mae"))


def recall_by_size(records: DataFrame) -> DataFrame:
    """Recall per variant and size band; a band without records gives 0."""
    bands = [scalar.size_band(F.lit(4)), scalar.size_band(F.lit(5))]
    counted = confusion(records.withColumn("band", scalar.size_band(F.col("num_vehicles"))), ["variant", "band"])
    both = counted.select("variant").distinct().withColumn("band", F.explode(F.array(*bands)))
    return both.join(counted, ["variant", "band"], "left").select(
        "variant", "band", F.round(F.coalesce(recall(), F.lit(0.0)), 4).alias("recall")
    )


def typed(records: DataFrame) -> DataFrame:
    """Adds ``scenario_type``: every record is 'mixed', and one of exact size 4 or 8 also that type."""
    n = F.col("num_vehicles")
    kinds = F.array_compact(F.array(
        F.lit("mixed"), F.when(n == 4, "4-vehicle"), F.when(n == 8, "8-vehicle")
    ))
    return records.withColumn("scenario_type", F.explode(kinds))


def variant_type_grid(records: DataFrame) -> DataFrame:
    """Scores per (variant, scenario type); the false-negative rate is 1 - recall here."""
    return confusion(typed(records), ["variant", "scenario_type"]).select(
        "variant", "scenario_type", "tp", "fn", "fp", "tn", *scores(no_positive=1.0)
    )


def variant_averages(records: DataFrame) -> DataFrame:
    """Mean of the type cells per variant, each cell counting the same."""
    cells = confusion(typed(records), ["variant", "scenario_type"]).select(
        "variant", accuracy().alias("accuracy"), f1().alias("f1"), fnr(1.0).alias("fnr")
    )
    return cells.groupBy("variant").agg(
        *[F.round(F.avg(c), 4).alias(f"avg_{c}") for c in ("accuracy", "f1", "fnr")]
    )


def normalised_confusion(records: DataFrame, by: list[str]) -> DataFrame:
    """Cells divided by their row total; an empty row divides by 1."""
    counts = confusion(records, by)
    yes, no = F.greatest(F.lit(1), F.col("tp") + F.col("fn")), F.greatest(F.lit(1), F.col("fp") + F.col("tn"))
    cell = lambda c, total: F.round(F.col(c) / total, 4).alias(f"{c}_share")
    return counts.select(*by, cell("tp", yes), cell("fn", yes), cell("fp", no), cell("tn", no))


def rule_agreement(records: DataFrame, by: list[str]) -> DataFrame:
    """Share of predictions equal to the rule's label; records without one do not count."""
    return records.groupBy(*by).agg(
        F.count("rule_label").alias("n"),
        F.round(share(F.col("predicted_label") == F.col("rule_label")), 4).alias("rule_agreement_rate"),
    )


def two_predictors(records: DataFrame, by: list[str] = []) -> DataFrame:
    """Cases where each of two predictors passes, and where they agree.

    ``first`` and ``second`` hold 'yes'/'no', or NULL for a failed or skipped call.
    """
    ok = lambda c: F.count_if(F.coalesce(F.col(c) == F.col("true_label"), F.lit(False)))
    return records.groupBy(*by).agg(
        F.count("*").alias("n"), ok("first").alias("first_pass"), ok("second").alias("second_pass"),
        F.count_if(F.col("first").isNull() | F.col("second").isNull()).alias("not_comparable"),
        F.count_if(F.coalesce(F.col("first") == F.col("second"), F.lit(False))).alias("agree"),
    )


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """n and accuracy of both arms, also of an arm nothing was routed to."""
    arms = lambda v: (
        F.count_if(F.col("routed_to") == v).alias(f"n_{v.lower()}"),
        F.coalesce(F.avg(F.when(F.col("routed_to") == v, F.col("correct").cast("int"))), F.lit(0.0))
        .alias(f"accuracy_{v.lower()}"),
    )
    wide = outcomes.agg(*arms("A"), *arms("B"))
    return wide.select(F.expr("stack(2, 'A', n_a, accuracy_a, 'B', n_b, accuracy_b) as (variant, n, accuracy)"))


def winner(records: DataFrame) -> DataFrame:
    """The more accurate variant, A on a tie."""
    right = F.col("true_label") == F.col("predicted_label")
    acc = lambda v: F.avg(F.when(F.col("variant") == v, right.cast("int")))
    return records.agg(acc("A").alias("a"), acc("B").alias("b")).select(
        F.round("a", 4).alias("accuracy_a"), F.round("b", 4).alias("accuracy_b"),
        F.when(F.col("b") > F.col("a"), "B").otherwise("A").alias("winner"),
    )


def wait_histogram(waits: DataFrame, value: str, bins: int = 12) -> DataFrame:
    """Equal-width bins between the smallest and the largest value; the last bin is closed."""
    span = waits.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("mean"))
    rows = waits.join(F.broadcast(span), F.col("hi") >= F.col("lo"))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(width == 0, 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / width)))
    return rows.withColumn("bin", place.cast("int")).groupBy("bin").agg(
        F.count("*").alias("n"), F.round(F.any_value("mean"), 4).alias("mean")
    )


def score_summary(records: DataFrame, by: list[str]) -> DataFrame:
    """Model-run summary: scores on answered calls, mean latency, share of failed calls."""
    failed = F.col("predicted_label").isNull()
    out = records.groupBy(*by).agg(
        *confusion_counts(), F.avg(F.when(~failed, F.col("latency_ms"))).alias("latency"),
        share(failed).alias("errors"),
    )
    return out.select(
        *by, *scores(no_positive=1.0), F.round("latency", 2).alias("avg_latency_ms"),
        F.round("errors", 4).alias("error_rate"),
    )
