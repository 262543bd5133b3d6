import json

import pytest
from pyspark.sql import functions as F

import brute
from crossroads import constants as C
from crossroads import schema
from crossroads.functions import scalar, text
from crossroads.operators import audit, features, joins, lane, metrics, monitor, sampling, training_sets, validation, windows
from crossroads.operators import scenarios as S
from crossroads.sources import adapters, generators, readers, writers
from crossroads.streaming import events as stream

GOOD = ("V1", 1, 50.0, 60.0, "north", "A", "yes", 1, "['intersection']", "[{'vehicle1_id': 'V1', 'vehicle2_id': 'V2'}]",
        "['Potential conflict: Vehicle V2 must yield to Vehicle V1']", "{'V1': 1, 'V2': None}", "{'V1': 0, 'V2': 3}", "S1")
OTHER = ("V2", 2, 30.0, 70.0, "south", "C", *GOOD[6:])


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), schema.RAW_VEHICLES)


def changed(row, **kw):
    names = schema.RAW_VEHICLES.fieldNames()
    return tuple(kw.get(n, v) for n, v in zip(names, row))


# --- validation -------------------------------------------------------------------


def failed(df):
    return {(r.column_name, r.check_name) for r in validation.report(df).filter("not passed").collect()}


def test_validation_cases(spark):
    assert failed(raw(spark, GOOD, OTHER)) == set()
    assert failed(raw(spark, changed(GOOD, direction="up"))) == {("direction", "allowed")}
    assert failed(raw(spark, changed(GOOD, is_conflict="maybe"))) == {("is_conflict", "allowed")}
    assert failed(raw(spark, changed(GOOD, vehicle_id=None))) == {("vehicle_id", "no_nulls")}
    assert failed(raw(spark, changed(GOOD, speed=201.0, lane=0))) == {("speed", "max"), ("lane", "min")}
    assert ("*", "row_count") in failed(spark.createDataFrame([], schema.RAW_VEHICLES))
    gone = validation.report(raw(spark, GOOD).drop("lane", "speed")).collect()
    assert {(r.column_name, r.passed) for r in gone} == {("lane", False), ("speed", False)}
    with pytest.raises(ValueError, match="direction:allowed=1"):
        validation.gate(validation.report(raw(spark, changed(GOOD, direction="up"))))


def test_request_contract_cases(spark):
    one = raw(spark, changed(GOOD, scenario_id="a"), changed(GOOD, scenario_id="b"), changed(OTHER, scenario_id="b", direction="diagonal"),
              changed(GOOD, scenario_id="c"), changed(OTHER, scenario_id="c", speed=-10.0), changed(GOOD, scenario_id="d"), changed(OTHER, scenario_id="d"),
              changed(GOOD, scenario_id="e"), changed(GOOD, scenario_id="e"))
    got = {r.scenario_id: r.reason for r in S.scenario_status(one).collect()}
    assert got == {"a": "too few vehicles", "b": "invalid direction", "c": "negative or missing speed", "d": None, "e": "duplicate vehicle_id"}
    with pytest.raises(ValueError, match="invalid direction=1"):
        S.assert_clean(one.filter("scenario_id = 'b'"))


# --- features ---------------------------------------------------------------------


def test_feature_chain_keeps_rows_and_drops_raw_columns(spark):
    bad = changed(OTHER, vehicle_id="V9", waiting_times="not a dict", priority_order="{'V9': 0}", direction="up", is_conflict=None)
    out = features.build(raw(spark, GOOD, OTHER, bad))
    assert not set(C.DROPPED_COLUMNS) & set(out.columns) and set(C.NUMERIC_FEATURES) <= set(out.columns)
    got = {r.speed: r for r in out.filter("lane = 1 or direction = 'south'").collect()}
    assert (got[50.0].vehicle_waiting_time, got[50.0].vehicle_priority, got[50.0].direction_enc, got[50.0].conflict_label) == (0, 1, 0, 1)
    assert (got[30.0].vehicle_waiting_time, got[30.0].vehicle_priority) == (3, 99)
    odd = out.filter("direction = 'up'").collect()[0]
    assert (odd.vehicle_waiting_time, odd.vehicle_priority, odd.direction_enc, odd.conflict_label) == (0, 99, -1, 0)
    assert odd.num_vehicles_in_scenario == 3 and abs(odd.avg_speed_in_scenario - 110 / 3) < 1e-9


def test_scaling_uses_population_deviation_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "speed double, lane double")
    fit = features.fit_scaler(df, ["speed", "lane", "absent"])
    assert fit == {"speed": (2.0, 1.0), "lane": (5.0, 1.0)}
    assert sorted(r.speed for r in features.scaled(df, fit).collect()) == [-1.0, 1.0]


def test_python_literals(spark):
    df = spark.createDataFrame([("{'a': None, 'b': 2}",), ("[broken",), ("{}",)], "x string")
    got = [r.m for r in df.select(scalar.python_literal(F.col("x"), "map<string,int>").alias("m")).collect()]
    assert got == [{"a": None, "b": 2}, None, {}]
    named = spark.createDataFrame([("['say None, please', None]",)], "x string")
    assert named.select(scalar.python_literal(F.col("x"), "array<string>").alias("m")).collect()[0].m[1] is None


# --- scalars and texts ---------------------------------------------------------------


def test_md5_modulus_and_routing(spark):
    import hashlib
    ids = [f"ab_scenario_{i}" for i in range(60)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").select(
        "id", scalar.md5_mod_100(F.col("id")).alias("m"), scalar.route(F.col("id"), 0.29).alias("to"))
    for r in df.collect():
        want = int(hashlib.md5(r.id.encode()).hexdigest(), 16) % 100
        assert r.m == want and r.to == ("A" if want < 28 else "B")


def test_fixed_decimals_round_like_exact_arithmetic(spark):
    values = [5.625, 45.25, 45.35, 45.45, 0.15, 9.995, 2.675, 0.5, 12.0, 99.999, 1e6 + 0.125, 0.05, 7.749999999999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", *[text.fixed(F.col("v"), k).alias(f"d{k}") for k in (1, 2, 3)]).collect():
        assert [r.d1, r.d2, r.d3] == ["%.1f" % r.v, "%.2f" % r.v, "%.3f" % r.v]


def test_bands_leave_zero_out(spark):
    df = spark.createDataFrame([(0.0,), (40.0,), (40.1,), (70.0,), (71.0,)], "v double")
    got = [r.b for r in df.select(scalar.speed_band(F.col("v")).alias("b")).collect()]
    assert got == [None, "slow (<40)", "medium (40-70)", "medium (40-70)", "fast (>70)"]


def test_reply_validity_and_answers(spark):
    df = spark.createDataFrame([('{"is_conflict":1,"decisions":[],"priority_order":{},"waiting_times":{}}',), ('{"is_conflict":1}',), ("{",), (None,)], "x string")
    assert [r.ok for r in df.select(scalar.reply_is_valid(F.col("x")).alias("ok")).collect()] == [True, False, False, False]
    a = spark.createDataFrame([(" Yes. ",), ("YES",), ("no",)], "x string")
    got = [(r.c, r.e) for r in a.select(scalar.answer_label(F.col("x")).alias("c"), scalar.answer_label(F.col("x"), True).alias("e")).collect()]
    assert got == [("yes", "no"), ("yes", "yes"), ("no", "no")]


def test_chat_records_and_analysis(rows):
    s = lane.packed(rows([(1, 1, 1, 50, 100, "north", "F"), (1, 2, 3, 50, 100, "east", "B")]))
    one = training_sets.label_records(lane.with_label(s), "lane_label").collect()[0].messages
    assert [m.role for m in one] == ["system", "user", "assistant"] and one[2].content == "yes"
    assert one[1].content.endswith("Vehicle V1002 is in lane 3, moving east at a speed of 50.00 km/h, and is 100.00 meters away "
                                   "from the intersection, heading towards B.")
    assert '"2": ["E", "D", "C"]' in one[0].content
    told = training_sets.decision_records(s, "sys", max_examples=1).collect()[0].messages
    assert json.loads(told[2].content)["waiting_times"] == {"V1001": 2, "V1002": 0} and "vehicles" in json.loads(told[1].content)
    made = lane.decisions(s)
    report = made.select(text.analysis_text({c: F.col(c) for c in made.columns}).alias("t")).collect()[0].t
    assert report.splitlines()[:3] == ["Conflict detected.", "Number of conflicts: 1", "Involved vehicles: Vehicle V1001 and Vehicle V1002."]
    assert "Vehicle V1001: 2 second(s)" in report


# --- samples ---------------------------------------------------------------------------


def labelled(spark, yes, no):
    return spark.createDataFrame([(i, "yes" if i < yes else "no") for i in range(yes + no)], "scenario_id long, is_conflict string")


def test_splits_are_disjoint_stratified_and_stable(spark):
    df = labelled(spark, 200, 100)
    out = sampling.stratified_split(df)
    got = {(r.is_conflict, r.split): r["count"] for r in out.groupBy("is_conflict", "split").count().collect()}
    assert got == {("yes", "train"): 140, ("yes", "val"): 30, ("yes", "test"): 30, ("no", "train"): 70, ("no", "val"): 15, ("no", "test"): 15}
    assert out.select("scenario_id").distinct().count() == 300
    assert {tuple(r) for r in sampling.split(df).collect()} == {tuple(r) for r in sampling.split(df.repartition(7)).collect()}


def test_balance_and_undersampling(spark):
    df = labelled(spark, 20, 100)
    assert sampling.class_counts(df).collect()[0].balanced is False
    for out in (sampling.undersampled(df), sampling.rebalance(df)):
        assert {r.is_conflict: r["count"] for r in out.groupBy("is_conflict").count().collect()} == {"yes": 20, "no": 20}
    few = sampling.equal_classes(labelled(spark, 5, 100), 50)
    assert {r.is_conflict: r["count"] for r in few.groupBy("is_conflict").count().collect()} == {"yes": 5, "no": 5}
    with pytest.raises(ValueError):
        sampling.assert_unseen_seed(42)
    sampling.assert_unseen_seed(999)


def test_class_balanced_generation_accepts_in_order(spark):
    labels = ["yes"] * 6 + ["no", "yes", "no", "no", "no", "no"]
    df = spark.createDataFrame(list(enumerate(labels)), "scenario_id long, is_conflict string")
    counts, accepted = {"yes": 0, "no": 0}, []
    for i, x in enumerate(labels):
        if len(accepted) < 7 and counts[x] < 7 / 2:
            counts[x] += 1
            accepted.append(i)
    assert sorted(r.scenario_id for r in generators.class_balanced(df, 7).collect()) == accepted


def test_generators_stay_in_the_layout_and_ignore_partitioning(spark):
    ids = generators.ids(spark, 80)
    two = generators.two_lane(ids)
    assert sorted(map(str, two.collect())) == sorted(map(str, generators.two_lane(ids.repartition(5)).collect()))
    for r in two.collect():
        assert r.destination in C.LAYOUT_TWO_LANE[r.direction] and 10 <= r.speed <= 90 and 10 <= r.distance_to_intersection <= 500 and r.lane in (1, 2)
    eight = generators.eight_lane(ids, num_vehicles=8, fixed_count=False)
    for r in eight.collect():
        assert r.destination in C.LAYOUT_EIGHT_LANE[r.direction][r.lane] and 20 <= r.speed < 80
    assert S.duplicate_ids(eight).count() == 0
    sizes = [r.n for r in two.groupBy("scenario_id").agg(F.count("*").alias("n")).collect()]
    assert min(sizes) >= 2 and max(sizes) <= 8 and len(set(sizes)) > 3


# --- scores, audit, monitor ---------------------------------------------------------------


def test_published_confusion_case(spark):
    rows = [("yes", "yes")] * 20 + [("no", "no")] * 20 + [("no", "yes")] * 8 + [("yes", "no")] * 2
    df = spark.createDataFrame(rows, "true_label string, predicted_label string").withColumn("v", F.lit(1))
    r = metrics.confusion(df, ["v"]).select(*metrics.scores()).collect()[0]
    assert (r.accuracy, r.precision, r.recall, r.f1, r.fnr) == (0.8, 0.7143, 0.9091, 0.8, 0.0909)


def test_scores_without_positives(spark):
    df = spark.createDataFrame([(1, "no", "no")], "v int, true_label string, predicted_label string")
    r = metrics.fnr_two_ways(df, ["v"]).collect()[0]
    assert (r.n_positive, r.fnr_offline, r.fnr_online) == (0, 1.0, 0.0)


def test_wait_map_error(spark):
    df = spark.createDataFrame([({"a": 3}, {"a": 1, "b": 4}), ({"a": 3}, {})], "p map<string,int>, r map<string,int>")
    assert [r.e for r in df.select(joins.wait_map_error(F.col("p"), F.col("r")).alias("e")).collect()] == [3.0, 0.0]


def test_disparity_needs_two_groups(spark):
    g = spark.createDataFrame([("d", "x", 0.9, 0.0, 0.9, 0.0), ("d", "y", 0.7, 0.2, 0.8, 0.5), ("e", "z", 0.1, 0.1, 0.1, 0.0)],
                              "dimension string, grp string, f1 double, fnr double, accuracy double, wt_mae_s double")
    got = {r.dimension: (r.f1_disparity, r.bias_detected, r.safety_bias_detected) for r in audit.disparity(g).collect()}
    assert got == {"d": (0.2, True, True), "e": (0.0, False, False)}


def test_first_value_skips_nulls(rows):
    s = lane.packed(rows([(1, 1, 1, 50, 100, None, "F"), (1, 2, 3, 50, 100, "east", "B")]))
    assert s.select(S.first_value(F.col("vehicles"), "direction").alias("x")).collect()[0].x == "east"


EVENT = "ground_truth string, predicted string, json_valid boolean"


def test_trigger_compares_before_rounding_and_ignores_unlabelled(spark):
    rows = [("yes", "yes", True)] * 95 + [("yes", "no", True)] * 5 + [(None, "no", True)] * 3
    r = monitor.trigger(spark.createDataFrame(rows, EVENT)).collect()[0]
    assert (r.should_retrain, r.n_labeled, r.recall, r.fnr, r.reason) == (False, 100, 0.95, 0.05, "All metrics within thresholds")
    rows = [("yes", "no", False)] * 2 + [("yes", "yes", True)] * 2
    r = monitor.trigger(spark.createDataFrame(rows, EVENT), drift_detected=True).collect()[0]
    assert r.triggers == ["FNR=0.500 > threshold 0.08 (safety-critical)", "Recall=0.500 < threshold 0.92",
                          "JSON failure rate=0.500 > threshold 0.02", "Rule agreement=0.500 < threshold 0.75", "Data drift detected in input features"]
    empty = monitor.trigger(spark.createDataFrame([], EVENT)).collect()[0]
    assert (empty.should_retrain, empty.reason) == (False, "No predictions logged yet")


def test_decision_takes_absent_metrics_as_healthy(spark):
    df = spark.createDataFrame([(0.1, None), (None, 0.5), (None, None)], "fnr double, robustness double")
    assert [r.reasons for r in monitor.decide(df).collect()] == [["fnr"], ["robustness"], []]


# --- files and streams -----------------------------------------------------------------------


def test_scenario_cells(spark):
    v = '{"lane": 1, "speed": 50.5, "distance_to_intersection": 10, "direction": " North ", "destination": "F"}'
    cells = [f'{{"vehicles_scenario": [{v}]}}', f'{{"vehicles": [{v}, {v}]}}', '{"vehicles": 3}', "{broken", '{"x": 1}']
    df = spark.createDataFrame([(str(i), c, " YES ") for i, c in enumerate(cells)], "scenario_id string, scenario string, is_conflict string")
    got = {r.scenario_id: r for r in readers.parse_scenarios(df).collect()}
    assert [got[str(i)].problem for i in range(5)] == [None, None, "vehicles is not a list", "invalid JSON", "no vehicles key"]
    assert [x.vehicle_id for x in got["1"].vehicles] == ["V1", "V2"] and got["0"].vehicles[0].direction == "north"
    assert got["0"].is_conflict == "yes"


def test_prediction_log_drops_broken_lines(spark, tmp_path):
    good = {"scenario_id": "1", "prediction": {"is_conflict": "yes", "waiting_times": {"a": 1}, "priority_order": {}}, "latency_ms": 1.5}
    (tmp_path / "log.jsonl").write_text("\n".join([json.dumps(good), "{broken", json.dumps({**good, "scenario_id": "2"})]))
    log = readers.prediction_log(spark, str(tmp_path))
    assert sorted(r.scenario_id for r in log.collect()) == ["1", "2"]
    flat = readers.flat_events(log)
    assert "prediction.is_conflict" in flat.columns
    assert readers.prediction_log_with_bad_lines(spark, str(tmp_path)).count() == 3


def test_layout_files(spark, tmp_path):
    one, two = tmp_path / "eight.json", tmp_path / "two.json"
    one.write_text(json.dumps({"intersection_layout": {d: {str(n): x for n, x in ls.items()} for d, ls in C.LAYOUT_EIGHT_LANE.items()}}))
    assert sorted(map(tuple, readers.lane_layout(spark, str(one)).collect())) == sorted(map(tuple, readers.lane_layout(spark).collect()))
    two.write_text(json.dumps({"incoming_directions": C.DIRECTIONS, "lanes_per_direction": 2, "destinations": C.LAYOUT_TWO_LANE}))
    assert readers.two_lane_layout(spark, str(two)).count() == 8
    two.write_text(json.dumps({"destinations": {}}))
    with pytest.raises(ValueError):
        readers.two_lane_layout(spark, str(two))


def test_raw_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    writers.write_table(raw(spark, GOOD, OTHER), path, "csv")
    back = readers.vehicle_csv(spark, path).collect()
    assert sorted(tuple(r)[:-1] for r in back) == sorted([GOOD, OTHER]) and all(r._corrupt is None for r in back)


def test_report_table_is_tidy(spark):
    a = spark.createDataFrame([("A", 1, 0.5)], "variant string, n int, accuracy double")
    got = {(r.report, r.dimension, r.metric, r.value) for r in writers.report_table(ab=a).collect()}
    assert got == {("ab", "A", "n", 1.0), ("ab", "A", "accuracy", 0.5)}


def test_stream_over_several_files_equals_batch(spark, tmp_path):
    rows = [(i, "yes" if i % 3 else "no", "yes" if i % 4 else "no", i % 9 != 0, i % 2, float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, ground_truth string, predicted string, json_valid boolean, user_id int, latency_ms double")
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id") * 60))
    source = str(tmp_path / "in")
    for k in range(3):
        df.filter(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(source)
    incoming = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    got = {r.user_id: r for r in stream.triggers(incoming(), str(tmp_path / "last"), ["user_id"], ["ts", "event_id"], 25).collect()}
    from crossroads.operators import windows
    want = {r.user_id: r for r in monitor.trigger(windows.last_n_per_key(df, ["user_id"], ["ts", "event_id"], 25), ["user_id"]).collect()}
    assert got == want
    path = stream.run_to_table(stream.hourly_counters(incoming(), "1 day"), str(tmp_path / "hours"), "update")
    hours = stream.newest_of_batches(spark, path, ["hour", "conflict_result"])
    batch = df.groupBy(F.date_trunc("hour", "ts").alias("hour"), F.when(F.col("predicted") == "yes", "conflict").otherwise("no_conflict").alias("conflict_result")).agg(
        F.count("*").alias("n"))
    assert {tuple(r) for r in hours.select("hour", "conflict_result", "n").collect()} == {tuple(r) for r in batch.collect()}
    twice = incoming().withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = stream.run_to_table(stream.deduplicated(twice, "1 day"), str(tmp_path / "once"), "append")
    assert spark.read.parquet(once).count() == 120


def test_streams_read_folders_of_parts_out_of_order_and_go_on_after_a_stop(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{small}/events.parquet")
    table = str(tmp_path / "sf" / "events.parquet")
    late, early = events.filter("event_id % 2 = 0").orderBy(F.desc("ts")), events.filter("event_id % 2 = 1")
    late.coalesce(1).write.parquet(table)
    hourly, path = str(tmp_path / "hourly"), str(tmp_path / "triggers")
    run = lambda: (
        stream.run_to_table(stream.hourly_counters(stream.event_stream(spark, str(tmp_path / "sf"))), hourly, "update"),
        stream.triggers(stream.event_stream(spark, str(tmp_path / "sf")), path, ["user_id"], ["ts", "event_id"], 20),
    )
    run()
    early.repartition(2).write.mode("append").parquet(table)
    _, decided = run()
    run()  # nothing new
    total = stream.newest_of_batches(spark, hourly, ["hour", "conflict_result"]).agg(F.sum("n")).first()[0]
    assert total == events.count()
    whole = adapters.prediction_events(spark, small).withColumn("ts", F.col("ts").cast("timestamp"))
    want = monitor.trigger(windows.last_n_per_key(whole, ["user_id"], ["ts", "event_id"], 20), ["user_id"])
    assert sorted(map(tuple, decided.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert spark.read.parquet(f"{path}/audit").select("batch").distinct().count() == 3


def test_a_batch_leaves_the_buckets_of_other_keys_alone(spark, tmp_path):
    fields = "event_id long, ground_truth string, predicted string, json_valid boolean, user_id int, latency_ms double"

    def events(users, first):
        rows = [(first + i, "yes" if i % 3 else "no", "yes", True, u, 1.0) for i, u in enumerate(users * 5)]
        return spark.createDataFrame(rows, fields).withColumn("ts", F.timestamp_seconds(F.col("event_id")))

    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    every, few = list(range(40)), [3]
    run = lambda: stream.triggers(
        spark.readStream.schema(events(few, 0).schema).parquet(source), path, ["user_id"], ["ts", "event_id"], 4, buckets=16)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "out" / "state").rglob("*.parquet")}
    events(every, 0).coalesce(1).write.parquet(source)
    run()
    before = files()
    whole = events(every, 0)
    for k in range(1, 5):
        events(few, 1000 * k).coalesce(1).write.mode("append").parquet(source)
        whole = whole.unionByName(events(few, 1000 * k))
        decided = run()
    after = files()
    kept = set(before) & set(after)
    assert len(kept) == len(before) - 1 and all(after[f] == before[f] for f in kept)  # only the bucket of user 3 moved on
    assert len(after) == len(kept) + 2  # its last version and the one before
    want = monitor.trigger(windows.last_n_per_key(whole, ["user_id"], ["ts", "event_id"], 4), ["user_id"])
    assert sorted(map(tuple, decided.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_samples_of_any_size_are_the_first_drawn(spark):
    df = labelled(spark, 3000, 5000).repartition(5)
    drawn = sorted((r.is_conflict, r.d, r.scenario_id) for r in df.withColumn("d", sampling.draw("scenario_id", 42)).collect())
    for n in (0, 2, 4001, 100_000):
        want = {i for c in ("yes", "no") for i in [r[2] for r in drawn if r[0] == c][:n // 2]}
        assert {r.scenario_id for r in sampling.balanced(df, n).collect()} == want
    small = sampling.first_drawn(df, spark.createDataFrame([("yes", 7)], "is_conflict string, _want long"), "is_conflict", bits=4)
    assert {r.scenario_id for r in small.collect()} == {r[2] for r in [x for x in drawn if x[0] == "yes"][:7]}


def test_rebalance_keeps_a_balanced_table_whole(spark):
    df = labelled(spark, 50, 50).unionByName(spark.createDataFrame([(1000, None), (1001, "maybe")], "scenario_id long, is_conflict string"))
    assert sampling.rebalance(df).count() == 102
