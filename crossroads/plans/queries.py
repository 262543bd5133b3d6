"""The registered queries: each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar, text
from ..operators import (
    audit, cascade, features, joins, lane, metrics, monitor, near, perturb, sampling, stats, training_sets, validation,
    windows,
)
from ..operators import scenarios as S
from ..session import new_table_path, stored
from ..sources import adapters as A
from ..sources import generators, readers, writers
from ..streaming import events as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _map_text(m: str):
    """A map as text, entries by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(
        e["key"], F.lit(":"), F.coalesce(e["value"].cast("string"), F.lit("None")))), ",")


def _messages(messages: str = "messages"):
    """A chat record as text, every message with its role."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n").alias("messages")


def _vehicles_text():
    """The whole vehicle list as text, in its order."""
    said = lambda v: F.concat_ws(" ", *[v[f] for f in S.VEHICLE_FIELDS if f != "seq"])
    return F.array_join(F.transform("vehicles", said), ";").alias("vehicles")


def _texts(made: DataFrame) -> DataFrame:
    """Whole decisions with lists and maps as text."""
    pair = lambda p: F.concat(p["vehicle1_id"], F.lit("-"), p["vehicle2_id"])
    told = {
        "places_of_conflicts": lambda c: F.array_join(c, ","), "conflict_vehicles": lambda c: F.array_join(F.transform(c, pair), ","),
        "decisions": lambda c: F.array_join(c, "; "), "priority_order": _map_text, "waiting_times": _map_text,
    }
    return made.select(*[told[c](c).alias(c) if c in told else F.col(c) for c in made.columns])


# --- lane rule -----------------------------------------------------------------


@query
def vehicles(spark, d):
    return A.vehicles(spark, d)


@query
def lane_priority_waits(spark, d):
    return lane.priority_waits(lane.pairs(A.scenarios(spark, d)))


@query
def lane_pairs(spark, d):
    return lane.pairs(A.scenarios(spark, d))


@query
def lane_pairs_any_size(spark, d):
    return lane.pairs_of_rows(A.vehicles(spark, d))


@query
def lane_decisions_by_supplier(spark, d):
    """A supplier's lines as one scenario of hundreds of vehicles: yes/no for each, lists for none."""
    made = lane.decisions_of_rows(A.supplier_rows(spark, d))
    return made.select("scenario_id", "n_vehicles", "n_involved", "is_conflict", "number_of_conflicts", "reason")


@query
def lane_decisions_any_size(spark, d):
    return _texts(lane.decisions_of_rows(A.raw_rows(spark, d), 8).drop("n_involved"))


@query
def lane_decisions(spark, d):
    return _texts(lane.decisions(A.scenarios(spark, d)))


@query
def lane_last_pair_view(spark, d):
    return lane.last_pair_view(lane.pairs(A.scenarios(spark, d)))


@query
def lane_override(spark, d):
    given = A.scenarios(spark, d).join(A.order_labels(spark, d), "scenario_id")
    return _texts(lane.decisions(given, "given_label")).drop("given_label")


@query
def lane_fallback(spark, d):
    given = A.scenarios(spark, d).join(A.order_labels(spark, d), "scenario_id")
    return _texts(lane.fallback_decisions(given, "given_label"))


@query
def lane_batch_score(spark, d):
    """Repeated ids, one-vehicle scenarios and speeds out of range are refused and take the fallback by order status."""
    return _texts(lane.score(_flawed(spark, d), A.order_labels(spark, d)))


def _flawed(spark, d) -> DataFrame:
    """Vehicle rows whose ids repeat within a scenario, some without a direction."""
    bad = (F.col("scenario_id") % 10 == 0) & (F.col("seq") == 1)
    return A.vehicles(spark, d).withColumns({
        "vehicle_id": F.concat("direction", "destination"), "direction": F.when(~bad, F.col("direction")),
    })


@query
def decisions_with_repeated_ids(spark, d):
    """Both rules on scenarios whose ids repeat: vehicles with one id share the entry of the decision's maps."""
    same = lambda v: v.withField("vehicle_id", F.concat(v["direction"], v["destination"]))
    rows = A.scenarios(spark, d).withColumn("vehicles", F.transform("vehicles", same))
    by_lane = _texts(lane.decisions(rows)).select("scenario_id", F.col("priority_order").alias("lane_order"), F.col("waiting_times").alias("lane_waits"))
    by_near = _texts(near.decisions(rows)).select("scenario_id", F.col("priority_order").alias("near_order"), F.col("waiting_times").alias("near_waits"))
    return by_lane.join(by_near, "scenario_id")


@query
def lane_rule_distribution(spark, d):
    return lane.rule_distribution(lane.pairs(A.scenarios(spark, d)))


@query
def rule_explanations(spark, d):
    return training_sets.explanations(lane.pairs(A.scenarios(spark, d)))


# --- near rule, generator rule, cascade -------------------------------------------


@query
def near_pairs(spark, d):
    return near.pairs(A.scenarios(spark, d))


@query
def near_priorities(spark, d):
    return near.priorities(A.scenarios(spark, d))


@query
def near_priorities_any_size(spark, d):
    return near.priorities_of_rows(A.vehicles(spark, d))


@query
def near_decisions(spark, d):
    return _texts(near.decisions(A.scenarios(spark, d)))


@query
def generator_labels(spark, d):
    return near.generator_labels(A.scenarios(spark, d))


@query
def cascade_waits(spark, d):
    return cascade.waits(A.scenarios(spark, d))


@query
def cascade_waits_any_size(spark, d):
    return cascade.waits_of_rows(A.vehicles(spark, d))


# --- validation -------------------------------------------------------------------


@query
def raw_dataset(spark, d):
    return A.raw_dataset(spark, d)


@query
def validation_report(spark, d):
    return validation.report(A.observed(spark, d))


@query
def expectation_report(spark, d):
    return validation.expectations(A.observed(spark, d))


@query
def unexpected_values(spark, d):
    return validation.unexpected_values(A.observed(spark, d))


@query
def request_contract(spark, d):
    return S.scenario_status(S.normalise(A.observed(spark, d)))


@query
def duplicate_ids(spark, d):
    return S.duplicate_ids(A.observed(spark, d).filter("vehicle_id is not null"))


@query
def vehicle_quarantine(spark, d):
    rows = S.quarantine(S.normalise(A.observed(spark, d)), contract=True)
    return rows.groupBy(F.coalesce("reason", F.lit("fine")).alias("reason")).agg(F.count("*").alias("n"))


# --- features ---------------------------------------------------------------------


def _r(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query
def scenario_features(spark, d):
    return _r(features.scenario_aggregates(A.raw_rows(spark, d)))


@query
def encoded_features(spark, d):
    return features.encoded(A.raw_dataset(spark, d)).select(
        "scenario_id", "vehicle_id", "direction_enc", "conflict_label", "vehicle_waiting_time", "vehicle_priority"
    )


@query
def feature_table(spark, d):
    return _r(features.build(A.raw_dataset(spark, d)))


@query
def scaler_parameters(spark, d):
    cols = ["lane", "speed", "distance_to_intersection", "direction_enc"]
    rows = A.vehicles(spark, d).withColumn("direction_enc", scalar.direction_code(F.col("direction")))
    return _r(features.scaler_table(rows, cols), 4)


@query
def scaled_features(spark, d):
    rows = A.vehicles(spark, d).select("scenario_id", "seq", "lane", "speed", "distance_to_intersection")
    cols = ["lane", "speed", "distance_to_intersection"]
    return _r(features.scaled(rows, features.fit_scaler(rows, cols)), 4)


@query
def python_literal_maps(spark, d):
    one = A.raw_dataset(spark, d).select("scenario_id", "priority_order", "waiting_times").distinct()
    ranks = scalar.python_literal(F.col("priority_order"), "map<string,int>")
    waits = scalar.python_literal(F.col("waiting_times"), "map<string,int>")
    return one.select("scenario_id", waits.alias("w"), F.explode(ranks).alias("vehicle_id", "rank")).select(
        "scenario_id", "vehicle_id", "rank", F.try_element_at("w", F.col("vehicle_id")).alias("wait")
    )


@query
def asof_features(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    asked = ev.filter("event_type = 'purchase'").select("event_id", "ts", "user_id")
    known = ev.filter("event_type <> 'purchase'").select("event_id", "ts", "user_id", "value")
    out = features.as_of(asked, known, "user_id", "ts", "event_id", ["value"], ttl_days=2)
    return out.select("event_id", "user_id", F.col("feature_ts").cast("string").alias("feature_ts"), "feature_value")


@query
def latest_features(spark, d):
    ev = A.table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return features.latest(ev, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query
def materialised_features(spark, d):
    ev = A.table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    old = features.latest(ev, ["user_id"], "ts", "event_id", F.lit("2024-01-10").cast("timestamp_ntz"))
    out = features.materialise(old, ev, ["user_id"], "ts", "event_id", F.lit("2024-01-20").cast("timestamp_ntz"))
    return out.select("user_id", "event_id", "value")


# --- samples, splits, leakage --------------------------------------------------------


def _labels(spark, d) -> DataFrame:
    return lane.with_label(A.scenarios(spark, d), "is_conflict").select("scenario_id", "is_conflict", "vehicles")


def _labels_only(spark, d) -> DataFrame:
    return _labels(spark, d).select("scenario_id", "is_conflict")


@query
def class_balance(spark, d):
    return sampling.class_counts(_labels_only(spark, d))


@query
def balanced_sample(spark, d):
    return sampling.balanced(_labels_only(spark, d), 50)


@query
def equal_class_sample(spark, d):
    return sampling.equal_classes(_labels_only(spark, d), 50)


@query
def sample_overall(spark, d):
    return sampling.overall(_labels_only(spark, d), 50)


@query
def first_scenarios(spark, d):
    return sampling.first_n(_labels_only(spark, d), 50)


@query
def data_gates(spark, d):
    """What the balance, leakage and validation gates look at, and whether they let the data through."""
    evaluation, training = _by_status(spark, d)
    balance = sampling.class_counts(_labels_only(spark, d)).select(
        F.lit("balance").alias("gate"), "minority_ratio", F.col("balanced").alias("passed"))
    leakage = sampling.overlap(evaluation, "key", training).select(
        F.lit("leakage").alias("gate"), F.col("n_leaked").cast("double"), (F.col("n_leaked") == 0).alias("passed"))
    failed = validation.report(A.observed(spark, d)).agg(F.count_if(~F.col("passed")).alias("n"))
    checks = failed.select(F.lit("validation").alias("gate"), F.col("n").cast("double"), (F.col("n") == 0).alias("passed"))
    return balance.toDF("gate", "measure", "passed").union(leakage).union(checks)


@query
def sample_per_group(spark, d):
    rows = A.scenarios(spark, d).select("scenario_id", F.size("vehicles").alias("n_vehicles"))
    return sampling.per_group(rows, ["n_vehicles"], 20)


@query
def undersample(spark, d):
    labels = near.with_label(A.scenarios(spark, d), "is_conflict").select("scenario_id", "is_conflict")
    return sampling.undersampled(labels)


@query
def hash_split(spark, d):
    return sampling.split(_labels_only(spark, d))


@query
def stratified_split(spark, d):
    return sampling.stratified_split(_labels_only(spark, d))


def _by_status(spark, d) -> tuple[DataFrame, DataFrame]:
    """Evaluation and training scenarios by order status, with a key of their lanes and destinations."""
    key = S.content_key(F.col("vehicles"), ["lane", "destination"])
    rows = A.scenarios(spark, d).select("scenario_id", key.alias("key"))
    status = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("scenario_id"), "o_orderstatus")
    both = rows.join(status, "scenario_id")
    return both.filter("o_orderstatus = 'P'"), both.filter("o_orderstatus <> 'P'")


@query
def leakage_anti_join(spark, d):
    evaluation, training = _by_status(spark, d)
    return sampling.without_content_of(evaluation, "key", training).select("scenario_id")


@query
def leakage_overlap(spark, d):
    evaluation, training = _by_status(spark, d)
    return sampling.overlap(evaluation, "key", training)


@query
def semi_join_vehicles(spark, d):
    picked = _labels_only(spark, d).filter("is_conflict = 'yes'")
    return sampling.with_content_of(A.raw_rows(spark, d), "scenario_id", picked).select("scenario_id", "seq", "vehicle_id")


@query
def balanced_supplement(spark, d):
    key = S.content_key(F.col("vehicles"))
    # read by both sides, the exclusions, the counts and the draw; labels and digests are made once
    rows = stored(_labels(spark, d).select("scenario_id", "is_conflict", F.size("vehicles").alias("n"), key.alias("key")), "labelled")
    eight = rows.filter("n = 8").drop("n")
    used = sampling.overall(rows.drop("n"), 50, seed=7)
    return sampling.supplemented(eight, rows.drop("n"), used, 400, "key").select("scenario_id", "is_conflict")


@query
def ab_route(spark, d):
    return A.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("scenario_id"),
        scalar.md5_mod_100(F.concat(F.lit("ab_scenario_"), F.col("o_orderkey"))).cast("int").alias("slot"),
        scalar.route(F.concat(F.lit("ab_scenario_"), F.col("o_orderkey")), 0.15).alias("routed_to"),
    )


@query
def ab_outcome_summary(spark, d):
    p = A.predictions(spark, d)
    rid = F.concat(F.lit("ab_scenario_"), F.col("scenario_id"))
    sent = p.withColumn("routed_to", scalar.route(rid, 0.15)).filter("routed_to = variant")
    return _r(metrics.outcome_summary(sent.withColumn("correct", F.col("true_label") == F.col("predicted_label"))))


# --- texts and chat records ------------------------------------------------------------


@query
def scenario_text(spark, d):
    return A.scenarios(spark, d).select("scenario_id", text.scenario_text(F.col("vehicles")).alias("text"))


@query
def report_text(spark, d):
    return A.scenarios(spark, d).select("scenario_id", text.report_text(F.col("vehicles")).alias("text"))


@query
def arrival_text(spark, d):
    return A.scenarios(spark, d).select("scenario_id", text.arrival_text(F.col("vehicles")).alias("text"))


@query
def analysis_text(spark, d):
    made = lane.decisions(A.scenarios(spark, d))
    return made.select("scenario_id", text.analysis_text({c: F.col(c) for c in made.columns}).alias("text"))


@query
def chat_records(spark, d):
    return training_sets.label_records(_labels(spark, d), "is_conflict").select("scenario_id", _messages())


@query
def chat_lines(spark, d):
    """Chat records written as lines of JSON and read back."""
    path = new_table_path(spark, "chat-lines")
    writers.write_chat_lines(training_sets.label_records(_labels(spark, d), "is_conflict"), path)
    return spark.read.schema("messages array<struct<role:string,content:string>>").json(path).select(_messages())


@query
def zero_shot_prompts(spark, d):
    return training_sets.prompts(A.scenarios(spark, d), "zero-shot").select("scenario_id", "mode", _messages())


@query
def decision_chat_records(spark, d):
    made = training_sets.decision_records(A.scenarios(spark, d), "Resolve the scenario.")
    return made.select("scenario_id", _messages())


@query
def raw_row_chat_records(spark, d):
    made = training_sets.raw_row_records(A.raw_dataset(spark, d), "Resolve the scenario.")
    return made.select("scenario_id", _messages())


@query
def few_shot_prompts(spark, d):
    shown = [("Vehicle V1 alone.", "no"), ("Vehicles V1 and V2 meet.", "yes")]
    made = training_sets.prompts(A.scenarios(spark, d), "few-shot", examples=shown)
    return made.select("scenario_id", "mode", _messages())


# --- metrics -----------------------------------------------------------------------------


@query
def predictions(spark, d):
    return A.predictions(spark, d).withColumn("ts", F.col("ts").cast("string"))


@query
def confusion_by_variant(spark, d):
    return metrics.confusion(A.predictions(spark, d), ["variant"])


@query
def variant_metrics(spark, d):
    return metrics.variant_metrics(A.predictions(spark, d))


@query
def fnr_two_ways(spark, d):
    return metrics.fnr_two_ways(A.predictions(spark, d), ["variant", "num_vehicles"])


@query
def latency_percentiles(spark, d):
    return metrics.percentiles(A.predictions(spark, d), ["variant"], "latency_ms", {"p50": 0.5, "p95": 0.95})


@query
def recall_by_size(spark, d):
    return metrics.recall_by_size(A.predictions(spark, d))


@query
def variant_type_grid(spark, d):
    return metrics.variant_type_grid(A.predictions(spark, d))


@query
def variant_averages(spark, d):
    return metrics.variant_averages(A.predictions(spark, d))


@query
def normalised_confusion(spark, d):
    return metrics.normalised_confusion(A.predictions(spark, d), ["variant"])


@query
def rule_agreement(spark, d):
    return metrics.rule_agreement(A.predictions(spark, d), ["variant"])


@query
def two_predictor_agreement(spark, d):
    return metrics.two_predictors(joins.paired(A.predictions(spark, d)))


@query
def ab_winner(spark, d):
    return metrics.winner(A.predictions(spark, d))


@query
def score_summary(spark, d):
    return metrics.score_summary(A.predictions(spark, d).withColumn(
        "predicted_label", F.when(F.col("json_valid"), F.col("predicted_label"))), ["variant"])


@query
def wait_mae(spark, d):
    """Lane-rule waits as reference, near-rule waits as the prediction, per scenario."""
    s = A.scenarios(spark, d)
    ref = lane.decisions(s).select("scenario_id", F.col("waiting_times").alias("ref"))
    pred = near.decisions(s).select("scenario_id", F.col("waiting_times").alias("pred"))
    return ref.join(pred, "scenario_id").select(
        "scenario_id", F.round(joins.wait_map_error(F.col("pred"), F.col("ref")), 6).alias("wt_mae")
    )


@query
def variant_wait_mae(spark, d):
    """Waiting error per variant: where a variant is wrong about a scenario it tells the near rule's waits."""
    s = A.scenarios(spark, d)
    ref = lane.decisions(s).select("scenario_id", F.col("waiting_times").alias("reference_waits"))
    other = near.decisions(s).select("scenario_id", F.col("waiting_times").alias("other"))
    told = A.predictions(spark, d).select("scenario_id", "variant", (F.col("predicted_label") == F.col("true_label")).alias("right"))
    rows = told.join(ref.join(other, "scenario_id"), "scenario_id")
    return metrics.wait_error(rows.withColumn("predicted_waits", F.when(F.col("right"), F.col("reference_waits")).otherwise(F.col("other"))), ["variant"])


@query
def latency_sketch(spark, d):
    """Daily sketches per variant, merged: for each share whether the quantile's exact rank is within two percent of it."""
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    p = A.predictions(spark, d).select("variant", "latency_ms", F.to_date("ts").alias("day"))
    merged = metrics.sketch_quantiles(metrics.latency_sketches(p, ["variant", "day"]), ["variant"], shares)
    cells = ", ".join(f"'{name}', {q}d, {name}" for name, q in shares.items())
    told = merged.select("variant", "n", F.expr(f"stack({len(shares)}, {cells}) as (share, q, value)"))  # three rows per variant
    ranked = p.join(F.broadcast(told), "variant").groupBy("variant", "share", "q", "n").agg(
        F.avg((F.col("latency_ms") <= F.col("value")).cast("int")).alias("upto"), F.avg((F.col("latency_ms") < F.col("value")).cast("int")).alias("below"))
    close = (F.col("upto") >= F.col("q") - 0.02) & (F.col("below") <= F.col("q") + 0.02)
    return ranked.select("variant", "share", "n", close.alias("close"))


def _mean_waits(spark, d) -> DataFrame:
    waits = lane.priority_waits(lane.pairs(A.scenarios(spark, d)))
    return waits.groupBy("scenario_id").agg(F.avg("wait").alias("mean_wait"))


@query
def mean_wait_per_scenario(spark, d):
    return _r(_mean_waits(spark, d))


@query
def wait_histogram(spark, d):
    return metrics.wait_histogram(_mean_waits(spark, d), "mean_wait")


@query
def scenario_sizes(spark, d):
    return joins.with_scenario_size(A.raw_rows(spark, d)).select("scenario_id", "seq", "n_vehicles")


# --- windows ------------------------------------------------------------------------------


@query
def rolling_accuracy(spark, d):
    out = windows.rolling_accuracy(A.predictions(spark, d), ["variant"], ["ts", "scenario_id"], cut_by=A.prediction_places(spark, d))
    return out.select("variant", "scenario_id", "idx", F.round("rolling_accuracy", 4).alias("rolling_accuracy"))


@query
def rolling_fnr(spark, d):
    out = windows.rolling_fnr(A.predictions(spark, d), ["variant"], ["ts", "scenario_id"], cut_by=A.prediction_places(spark, d))
    return out.select("variant", "scenario_id", "idx", F.round("rolling_fnr", 4).alias("rolling_fnr"))


@query
def running_metrics(spark, d):
    out = windows.running_metrics(A.predictions(spark, d), ["variant"], ["ts", "scenario_id"], cut_by=A.prediction_places(spark, d))
    return out.select("variant", "scenario_id", "step", "accuracy", "precision", "recall", "f1", "fnr")


@query
def last_n_window(spark, d):
    return windows.last_n(A.prediction_events(spark, d), ["ts", "event_id"], C.WINDOW_SIZE).select("event_id", "user_id")


@query
def last_n_per_user(spark, d):
    return windows.last_n_per_key(A.prediction_events(spark, d), ["user_id"], ["ts", "event_id"], 5).select(
        "user_id", "event_id")


# --- audit and what-if -----------------------------------------------------------------------


def _audit_records(spark, d) -> DataFrame:
    s = lane.with_label(A.scenarios(spark, d), "true_label")
    near_v = F.filter("vehicles", lambda v: scalar.is_near(v["distance_to_intersection"], False))
    s = s.withColumn("_from", F.transform(near_v, lambda v: v["direction"]))  # listed once, counted in generated code
    total = F.size("_from")
    of_direction = lambda x: total - F.size(F.array_remove("_from", x))
    same = sum((of_direction(x) * (of_direction(x) - 1) / 2 for x in C.DIRECTIONS), F.lit(0))
    s = s.withColumn("number_of_conflicts", (total * (total - 1) / 2 - same).cast("int")).drop("_from")
    s = audit.scenario_attributes(audit.mean_reference_wait(s))
    p = A.with_variants(s).filter("variant = 'A'")
    return p.withColumn("wait_error", F.when(F.col("predicted_label") == "yes", 0.0).otherwise(F.col("avg_ref_wait")))


@query
def subgroup_metrics(spark, d):
    return audit.subgroup_metrics(_audit_records(spark, d))


@query
def subgroup_disparity(spark, d):
    return audit.disparity(audit.subgroup_metrics(_audit_records(spark, d)))


@query
def perturb_speed(spark, d):
    return perturb.lane_records(A.scenarios(spark, d), "speed")


@query
def perturb_distance(spark, d):
    return perturb.lane_records(A.scenarios(spark, d), "distance")


@query
def perturb_lane(spark, d):
    return perturb.single_vehicle_records(A.scenarios(spark, d), ["lane"])


@query
def perturb_destination(spark, d):
    return perturb.single_vehicle_records(A.scenarios(spark, d), ["destination"])


@query
def perturb_order(spark, d):
    return perturb.order_records(A.scenarios(spark, d))


@query
def perturb_order_any_predictor(spark, d):
    """The same by whole copies, as any predictor needs them."""
    return perturb.records(A.scenarios(spark, d), "vehicle_order")


@query
def perturb_distance_any_predictor(spark, d):
    """The near rule as the predictor, to show the general form."""
    rule = lambda s: near.with_label(s, "prediction")
    return perturb.records(A.scenarios(spark, d), "distance", rule)


def _rates(spark, d) -> DataFrame:
    return perturb.flip_rates(perturb.all_records(A.scenarios(spark, d)))


@query
def flip_rates(spark, d):
    return _rates(spark, d)


@query
def flip_rate_by_magnitude(spark, d):
    return perturb.by_magnitude(perturb.lane_records(A.scenarios(spark, d), "speed"))


@query
def stability(spark, d):
    return perturb.stability(_rates(spark, d))


@query
def feature_ranking(spark, d):
    return perturb.feature_ranking(_rates(spark, d))


@query
def speed_flip_table(spark, d):
    return perturb.speed_table(perturb.flip_rates(perturb.lane_records(A.scenarios(spark, d), "speed")))


@query
def heat_table(spark, d):
    return perturb.heat_table(perturb.lane_records(A.scenarios(spark, d), "speed", "distance"))


@query
def sensitivity(spark, d):
    return perturb.sensitivity(A.scenarios(spark, d))


# --- a layout from a file -------------------------------------------------------------------------


def _second_layout(spark) -> DataFrame:
    """The second layout, written as a layout file to the shared folder and read back as one row."""
    path = new_table_path(spark, "layout")
    cell = json.dumps({"intersection_layout": {d: {str(n): r for n, r in lanes.items()} for d, lanes in C.LAYOUT_SECOND.items()}})
    spark.createDataFrame([(cell,)], "value string").coalesce(1).write.text(path)
    return readers.layout_row(readers.lane_layout(spark, path))


@query
def layout_file_movements(spark, d):
    return lane.prepared(A.vehicles(spark, d), _second_layout(spark)).select("scenario_id", "seq", F.col("m").alias("movement"))


@query
def layout_file_pairs(spark, d):
    return lane.pairs(A.scenarios(spark, d, _second_layout(spark)))


@query
def layout_file_labels_any_size(spark, d):
    return lane.labels_of_rows(A.supplier_rows(spark, d), _second_layout(spark))


@query
def layout_file_one_vehicle(spark, d):
    """Other lanes and destinations of the layout in use, one vehicle at a time."""
    layout = _second_layout(spark)
    return perturb.single_vehicle_records(A.scenarios(spark, d, layout), ["lane", "destination"], layout=layout)


@query
def layout_file_rerouted_any_predictor(spark, d):
    """The same by whole copies for any predictor, here the lane rule."""
    layout = _second_layout(spark)
    return perturb.records(A.scenarios(spark, d, layout), "destination", layout=layout)


@query
def layout_file_sensitivity(spark, d):
    layout = _second_layout(spark)
    return perturb.sensitivity(A.scenarios(spark, d, layout), layout)


# --- statistics and monitoring ----------------------------------------------------------------


@query
def chi_square(spark, d):
    return stats.chi_square(A.predictions(spark, d))


@query
def mann_whitney_u(spark, d):
    return stats.mann_whitney(A.predictions(spark, d), "latency_ms", "variant", "A", "B")


def _drift_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = A.raw_rows(spark, d).select("scenario_id", "lane", "speed", "distance_to_intersection")
    status = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("scenario_id"), "o_orderstatus")
    both = rows.join(status, "scenario_id").drop("scenario_id")
    shifted = both.filter("o_orderstatus = 'P'").withColumn("speed", F.col("speed") * 1.05)
    return both.filter("o_orderstatus <> 'P'"), shifted


@query
def ks_statistic(spark, d):
    return stats.ks_test(*_drift_sides(spark, d))


@query
def drift_flags(spark, d):
    tests = stats.ks_test(*_drift_sides(spark, d))
    by = lambda rule: stats.drift(tests, rule).withColumn("rule", F.lit(rule))
    return by("any").unionByName(by("share"))


def _told(out: DataFrame) -> DataFrame:
    return out.withColumn("triggers", F.array_join("triggers", "; "))


@query
def trigger_window(spark, d):
    return _told(monitor.trigger(windows.last_n(A.prediction_events(spark, d), ["ts", "event_id"], C.WINDOW_SIZE)))


@query
def trigger_with_drift(spark, d):
    """Drift comes as a table: it stays in the plan, the driver sees none of it."""
    last = windows.last_n_per_key(A.prediction_events(spark, d), ["user_id"], ["ts", "event_id"], C.WINDOW_SIZE)
    found = stats.drift(stats.ks_test(*_drift_sides(spark, d))).select("drift_detected")
    return _told(monitor.trigger(last, ["user_id"], drift_detected=found))


@query
def trigger_per_user(spark, d):
    last = windows.last_n_per_key(A.prediction_events(spark, d), ["user_id"], ["ts", "event_id"], C.WINDOW_SIZE)
    return _told(monitor.trigger(last, ["user_id"]))


@query
def retrain_decision(spark, d):
    m = metrics.variant_metrics(A.predictions(spark, d)).select(
        "variant", "fnr", "recall", (1 - F.col("rule_disagree_rate")).alias("rule_agreement_rate"))
    out = monitor.decide(m)
    return out.select("variant", "should_retrain", F.array_join("reasons", ",").alias("reasons"))


@query
def metric_counters(spark, d):
    return monitor.counters(A.prediction_events(spark, d))


@query
def report_tables(spark, d):
    p = A.predictions(spark, d)
    return writers.report_table(
        ab=metrics.confusion(p, ["variant"]), offline=metrics.confusion(metrics.typed(p), ["variant", "scenario_type"])
    )


@query
def evaluation_reports(spark, d):
    """The bias, robustness, explanation and combined reports as one tidy table."""
    rates = stored(_rates(spark, d), "rates")  # a few dozen rows, read by two reports
    p = A.predictions(spark, d)
    p = stored(p.select("variant", "true_label", "predicted_label", "rule_label", "json_valid"), "predictions")  # read by two reports
    return writers.report_table(
        bias=audit.subgroup_metrics(_audit_records(spark, d)), robustness=rates, stability=perturb.stability(rates),
        explain=perturb.sensitivity(A.scenarios(spark, d)).select("feature", "normalised"),
        agreement=metrics.rule_agreement(p, ["variant"]), combined=metrics.variant_metrics(p),
    ).withColumn("value", F.round("value", 4))


# --- streams -------------------------------------------------------------------------------


@query
def stream_hourly_metrics(spark, d):
    path = stream.run_to_table(stream.hourly_counters(stream.event_stream(spark, d)), new_table_path(spark, "hourly"), "update")
    out = stream.newest_of_batches(spark, path, ["hour", "conflict_result"])
    return out.select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), "conflict_result", "n", "bad_json",
                      F.round("sum_ms", 2).alias("sum_ms"), F.round("max_ms", 2).alias("max_ms"))


@query
def stream_latency_histogram(spark, d):
    path = stream.run_to_table(stream.latency_histogram(stream.event_stream(spark, d)), new_table_path(spark, "histogram"), "update")
    out = stream.newest_of_batches(spark, path, ["hour", "conflict_result", "le"])
    return out.select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), "conflict_result", "le", "n", F.round("sum_ms", 2).alias("sum_ms"))


@query
def stream_trigger(spark, d):
    path = new_table_path(spark, "triggers")
    out = stream.triggers(stream.event_stream(spark, d), path, ["user_id"], ["ts", "event_id"], C.WINDOW_SIZE)
    return _told(out)


@query
def stream_dedup(spark, d):
    twice = stream.event_stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    path = stream.run_to_table(stream.deduplicated(twice), new_table_path(spark, "dedup"), "append")
    return spark.read.parquet(path).select("event_id", "user_id", "predicted")


@query
def stream_routed(spark, d):
    path = stream.run_to_table(stream.routed(stream.event_stream(spark, d), "event_id", 0.29), new_table_path(spark, "routed"), "append")
    return spark.read.parquet(path).groupBy("routed_to", "predicted").agg(F.count("*").alias("n"))


# --- generators and files --------------------------------------------------------------------


def _order_ids(spark, d) -> DataFrame:
    return A.table(spark, d, "orders").select(F.col("o_orderkey").alias("scenario_id"))


@query
def generated_scenarios(spark, d):
    return generators.two_lane(_order_ids(spark, d))


@query
def generated_labelled(spark, d):
    made = generators.labelled(generators.two_lane(_order_ids(spark, d)))
    return made.select("scenario_id", "seq", "vehicle_id", "rank", "wait", "is_conflict", "number_of_conflicts")


@query
def generated_eight_lane(spark, d):
    return _r(generators.eight_lane(_order_ids(spark, d), num_vehicles=6, fixed_count=False), 6)


@query
def balanced_scenarios(spark, d):
    made = generators.eight_lane(_order_ids(spark, d), num_vehicles=5)
    labelled = lane.with_label(lane.packed(made), "is_conflict").select("scenario_id", "is_conflict")
    return generators.class_balanced(labelled, 1001, cut_by=_order_ids(spark, d))


@query
def generated_rows_cut(spark, d):
    return generators.limit_rows(generators.two_lane(_order_ids(spark, d)), 1000)


@query
def scenario_csv_scan(spark, d):
    """Scenario cells of both keys, and three kinds of flaw that go to quarantine with their problem."""
    path = new_table_path(spark, "scenario-csv")
    s = _labels(spark, d)
    rows = S.to_json_text(s).join(s.select("scenario_id", F.upper("is_conflict").alias("is_conflict")), "scenario_id")
    i, cell = F.col("scenario_id"), F.col("scenario")
    renamed = lambda key: F.regexp_replace(cell, "^\\{\"vehicles_scenario\"", "{\"" + key + "\"")
    flawed = F.when(i % 5 == 0, F.left(cell, F.lit(30))).when(i % 7 == 0, renamed("cars")).when(
        i % 11 == 0, '{"vehicles":"none"}').when(i % 2 == 0, renamed("vehicles")).otherwise(cell)
    writers.write_table(rows.withColumn("scenario", flawed), path, "csv")
    good, bad = readers.scenario_csv(spark, path)
    return good.withColumn("problem", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True).select(
        F.col("scenario_id").cast("long").alias("scenario_id"), "is_conflict",
        F.when(F.col("vehicles").isNotNull(), _vehicles_text()).alias("vehicles"), "problem")


@query
def vehicle_csv_scan(spark, d):
    path = new_table_path(spark, "vehicle-csv")
    names = readers.schema.RAW_VEHICLES.fieldNames()
    writers.write_table(A.raw_dataset(spark, d).select(*names), path, "csv")
    return readers.vehicle_csv(spark, path).select(*names)


def _log(spark, d) -> str:
    path = new_table_path(spark, "prediction-log")
    waits = F.map_from_arrays(F.transform("vehicles", lambda v: v["vehicle_id"]), F.transform("vehicles", lambda v: v["lane"]))
    scored = A.scenarios(spark, d).join(A.order_labels(spark, d), "scenario_id").select(
        "scenario_id", "vehicles", F.lit("2024-01-01T00:00:00+00:00").alias("timestamp"), F.lit("m1").alias("model_version"),
        F.lit("p1").alias("prompt_version"),
        F.struct(F.col("given_label").alias("is_conflict"), waits.alias("waiting_times"), waits.alias("priority_order")).alias("prediction"),
        (F.col("scenario_id") % 1000 / 7.0).alias("latency_ms"), F.lit(True).alias("json_valid"), F.lit(False).alias("fallback_used"))
    writers.append_events(writers.prediction_events(scored), path)
    return path


@query
def prediction_log_scan(spark, d):
    flat = readers.flat_events(readers.prediction_log(spark, _log(spark, d)))
    return flat.select(
        F.col("scenario_id").cast("long").alias("scenario_id"), _vehicles_text(),
        F.col("`prediction.is_conflict`").alias("predicted"), _map_text("`prediction.waiting_times`").alias("waiting_times"),
        _map_text("`prediction.priority_order`").alias("priority_order"), "ground_truth", "rule_agreement", "latency_ms",
        "model_version", "prompt_version", "json_valid", "fallback_used")


@query
def reply_validity(spark, d):
    """Replies as JSON: some lack a key, some are cut off."""
    i = F.col("scenario_id")
    made = lane.decisions(A.scenarios(spark, d))
    whole = F.to_json(F.struct("is_conflict", "decisions", "priority_order", "waiting_times"))
    lacking = F.to_json(F.struct("is_conflict", "decisions"))
    reply = F.when(i % 7 == 0, lacking).when(i % 11 == 0, F.left(whole, F.lit(20))).otherwise(whole)
    return made.select("scenario_id", scalar.reply_is_valid(reply).alias("json_valid"))


@query
def answer_labels(spark, d):
    """Free-text answers to labels, by containment and by equality."""
    i = F.col("scenario_id")
    answer = F.when(i % 3 == 0, F.concat(F.lit(" "), F.upper("is_conflict"), F.lit(" "))).when(
        i % 3 == 1, F.concat("is_conflict", F.lit(", they meet."))).otherwise(F.col("is_conflict"))
    return _labels_only(spark, d).select(
        "scenario_id", scalar.answer_label(answer).alias("contained"), scalar.answer_label(answer, exact=True).alias("exact"))


@query
def scenario_type_filter(spark, d):
    return S.only_size(A.scenarios(spark, d), 4).select("scenario_id", F.size("vehicles").alias("n_vehicles"))


@query
def feature_parquet_scan(spark, d):
    """Stored features, partitioned by date, read back for one week."""
    path = new_table_path(spark, "features")
    ev = A.table(spark, d, "events").select("user_id", F.col("ts").alias("event_timestamp"), "event_id", "value")
    writers.write_features(ev, path)
    week = F.col("event_date").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"))
    return readers.features(spark, path).filter(week).select("user_id", "event_id", "value")


@query
def stream_rule_labels(spark, d):
    """Scenarios arriving as a stream get the rule's label on the way, without state."""
    path = new_table_path(spark, "incoming")
    given = A.scenarios(spark, d).join(A.order_labels(spark, d), "scenario_id")
    given.select("scenario_id", "vehicles", F.struct(F.col("given_label").alias("is_conflict")).alias("prediction")).write.parquet(path)
    incoming = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    done = stream.run_to_table(stream.labelled(incoming), new_table_path(spark, "labelled"), "append")
    return spark.read.parquet(done).select("scenario_id", "ground_truth", "rule_agreement")


@query
def lane_pairs_all_sizes(spark, d):
    """Whole orders as scenarios, split by size, each part by the form that suits it."""
    return lane.all_pairs(A.raw_rows(spark, d))


@query
def exploded_layout_movements(spark, d):
    """Movement of each vehicle by joining the layout table, the table form of the lookup."""
    layout = readers.lane_layout(spark).select("direction", "lane", "destination", "place")  # twenty rows
    rows = A.vehicles(spark, d).join(F.broadcast(layout), ["direction", "lane", "destination"], "left")
    turn = F.when(F.col("place").isNull(), "unknown").when(F.col("lane") % 2 == 0, "left").when(
        F.col("place") == 0, "right").when(F.col("place") == 1, "straight").otherwise("left")
    return rows.select("scenario_id", "seq", turn.alias("movement"))
