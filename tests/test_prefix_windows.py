import random

from pyspark.sql import functions as F

from crossroads.operators import features, metrics, prefix, stats, windows


def sequence(spark, n=3000, hot=0.8, seed=3):
    """Two keys, one of them holding most rows; few distinct times, so ties are common."""
    rnd = random.Random(seed)
    data = [("A" if rnd.random() < hot else "B", rnd.randrange(20), i, rnd.choice(["yes", "no"]), rnd.choice(["yes", "no"]))
            for i in range(n)]
    df = spark.createDataFrame(data, "variant string, ts int, scenario_id int, true_label string, predicted_label string")
    return data, df.repartition(4)


def in_order(data, key):
    return sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))


def test_a_hot_key_spans_partitions_and_running_values_are_exact(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data, df = sequence(spark)
        cut = prefix.ranged(df, ["variant"], ["ts", "scenario_id"])
        assert cut.filter("variant = 'A'").select("_part").distinct().count() > 1
        out = prefix.running(df, ["variant"], ["ts", "scenario_id"], {
            "n": ("sum", F.lit(1)), "hi": ("max", F.col("scenario_id")), "lo": ("min", F.when(F.col("ts") > 3, F.col("scenario_id")))})
        excl = prefix.running(df, ["variant"], ["ts", "scenario_id"], {"hi": ("max", F.col("scenario_id"))}, exclusive=True)
        got = {(r.variant, r.scenario_id): r for r in out.collect()}
        before = {(r.variant, r.scenario_id): r.hi for r in excl.collect()}
        for key in "AB":
            hi, lo = None, None
            for n, r in enumerate(in_order(data, key), 1):
                assert before[key, r[2]] == hi
                hi = r[2] if hi is None else max(hi, r[2])
                if r[1] > 3:
                    lo = r[2] if lo is None else min(lo, r[2])
                g = got[key, r[2]]
                assert (g.n, g.hi, g.lo) == (n, hi, lo)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rolling_windows_are_whole_across_chunks(spark):
    data, df = sequence(spark, 400)
    for chunk in (10, 37, 1_000_000):
        out = windows.rolling_accuracy(df, ["variant"], ["ts", "scenario_id"], chunk=chunk).collect()
        assert len(out) == len(data)
        got = {(r.variant, r.scenario_id): r.rolling_accuracy for r in out}
        for key in "AB":
            right = [int(r[3] == r[4]) for r in in_order(data, key)]
            for i, r in enumerate(in_order(data, key)):
                part = right[max(0, i - 9): i + 1]
                assert abs(got[key, r[2]] - sum(part) / len(part)) < 1e-12


def test_rolling_fnr_and_running_metrics(spark):
    data, df = sequence(spark, 300)
    fnr = {(r.variant, r.scenario_id): r.rolling_fnr for r in windows.rolling_fnr(df, ["variant"], ["ts", "scenario_id"], chunk=11).collect()}
    run = {(r.variant, r.scenario_id): r for r in windows.running_metrics(df, ["variant"], ["ts", "scenario_id"]).collect()}
    for key in "AB":
        seen = in_order(data, key)
        for i, r in enumerate(seen):
            last = seen[max(0, i - 9): i + 1]
            pos = sum(x[3] == "yes" for x in last)
            missed = sum(x[3] == "yes" and x[4] == "no" for x in last)
            assert abs(fnr[key, r[2]] - missed / (pos + 1e-9)) < 1e-9
            ok = sum(x[3] == x[4] for x in seen[: i + 1])
            assert run[key, r[2]].step == i + 1 and abs(run[key, r[2]].accuracy - ok / (i + 1)) <= 5.1e-5


def test_last_n_counts_bad_lines_before_dropping_them(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(50)], "ts int, broken boolean")
    out = windows.last_n(df, ["ts"], 10, bad=F.col("broken"))
    assert sorted(r.ts for r in out.collect()) == [40, 41, 43, 44, 46, 47, 49]


def test_percentiles_interpolate(spark):
    rnd = random.Random(5)
    data = [(k, float(rnd.randrange(40))) for k in "AB" for _ in range(77)]
    out = metrics.percentiles(spark.createDataFrame(data, "k string, v double"), ["k"], "v", {"p50": 0.5, "p95": 0.95}, digits=9)
    for r in out.collect():
        vs = sorted(v for k, v in data if k == r.k)
        for q, got in ((0.5, r.p50), (0.95, r.p95)):
            place = q * (len(vs) - 1)
            lo = int(place)
            want = vs[lo] + (vs[min(lo + 1, len(vs) - 1)] - vs[lo]) * (place - lo)
            assert abs(got - want) < 1e-9


def test_chi_square_published_case(spark):
    rows = [("A", "yes", "yes")] * 41 + [("A", "yes", "no")] * 9 + [("B", "yes", "yes")] * 48 + [("B", "yes", "no")] * 2
    r = stats.chi_square(spark.createDataFrame(rows, "variant string, true_label string, predicted_label string")).collect()[0]
    assert (r.chi2, r.p_value, r.significant) == (3.6772, 0.0552, False)


def test_chi_square_degenerate_table(spark):
    rows = [("A", "yes", "yes")] * 4 + [("B", "yes", "yes")] * 4
    r = stats.chi_square(spark.createDataFrame(rows, "variant string, true_label string, predicted_label string")).collect()[0]
    assert (r.chi2, r.p_value, r.significant) == (0.0, 1.0, False)


def test_mann_whitney_ranks_with_ties(spark):
    rnd = random.Random(8)
    a, b = [float(rnd.randrange(30)) for _ in range(80)], [float(rnd.randrange(5, 35)) for _ in range(60)]
    df = spark.createDataFrame([("A", x) for x in a] + [("B", x) for x in b], "arm string, v double")
    r = stats.mann_whitney(df, "v", "arm", "A", "B").collect()[0]
    assert r.u == sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert 0 <= r.p_value < 0.05


def test_ks_statistic_and_no_drift_between_equal_tables(spark):
    rnd = random.Random(9)
    x, y = [rnd.gauss(0, 1) for _ in range(200)], [rnd.gauss(0.7, 1) for _ in range(150)]
    ref, prod = spark.createDataFrame([(v, "a") for v in x], "v double, s string"), spark.createDataFrame([(v, 1) for v in y], "v double, w int")
    r = stats.ks_test(ref, prod).collect()[0]
    want = max(abs(sum(a <= z for a in x) / 200 - sum(b <= z for b in y) / 150) for z in x + y)
    assert abs(r.statistic - want) < 1e-6 and r.drifted
    same = stats.ks_test(ref, ref)
    assert same.collect()[0].p_value == 1.0
    assert stats.drift(same).collect()[0].drift_detected is False
    assert stats.ks_test(ref.select("s"), prod).count() == 0


def test_as_of_takes_newest_at_or_before_within_ttl(spark):
    import datetime as dt
    rnd = random.Random(4)
    day0 = dt.datetime(2024, 1, 1)
    at = lambda: day0 + dt.timedelta(hours=rnd.randrange(24 * 30))
    feats = [(rnd.choice([1, 1, 1, 2]), at(), i, float(i)) for i in range(60)]
    labels = [(rnd.choice([1, 2, 3]), at(), 1000 + i) for i in range(80)]
    f = spark.createDataFrame(feats, "vehicle_id int, ts timestamp, event_id int, value double")
    q = spark.createDataFrame(labels, "vehicle_id int, ts timestamp, label_id int")
    out = features.as_of(q, f, "vehicle_id", "ts", "event_id", ["value"], ttl_days=7).collect()
    assert len(out) == len(labels)
    for r in out:
        known = [x for x in feats if x[0] == r.vehicle_id and x[1] <= r.ts]
        best = max(known, key=lambda x: (x[1], x[2])) if known else None
        fresh = best is not None and best[1] >= r.ts - dt.timedelta(days=7)
        assert r.feature_value == (best[3] if fresh else None)


def test_as_of_spreads_a_key_that_holds_most_of_a_day(spark):
    rnd = random.Random(11)
    known = [(1 if rnd.random() < 0.9 else rnd.randrange(2, 9), 1_700_000_000 + rnd.randrange(86_400), i, rnd.random()) for i in range(4000)]
    asked = [(1 if rnd.random() < 0.9 else rnd.randrange(2, 9), 1_700_000_000 + rnd.randrange(86_400), i) for i in range(500)]
    at = F.timestamp_seconds(F.col("s")).alias("ts")
    f = spark.createDataFrame(known, "user long, s long, id long, value double").select("user", at, "id", "value", "s")
    q = spark.createDataFrame(asked, "user long, s long, q long").select("user", at, "q", "s")
    out = features.as_of(q, f, "user", "ts", "id", ["value"], ttl_days=1).collect()
    got = {r.q: r.feature_value for r in out}
    for user, s, i in asked:
        best = max(((k[1], k[2], k[3]) for k in known if k[0] == user and k[1] <= s), default=None)
        assert got[i] == (best and best[2])
    parts = prefix.ranged(f, ["user"], ["ts"]).filter("user = 1").groupBy("_part").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 0.6 * 0.9 * len(known)


def test_plans_run_nothing_before_the_action(spark):
    seen = spark.sparkContext.statusTracker()
    before = set(seen.getJobIdsForGroup(None))
    _, df = sequence(spark, 200)
    prefix.running(df, ["variant"], ["ts", "scenario_id"], {"n": ("sum", F.lit(1))})
    windows.rolling_accuracy(df, ["variant"], ["ts", "scenario_id"])
    assert set(seen.getJobIdsForGroup(None)) == before
