import pytest
from pyspark.sql import functions as F

import brute
from crossroads import constants as C
from crossroads.operators import lane, near, perturb

DATA = brute.scenario_rows(11, [2, 3, 4, 5, 6, 8] * 8, speeds=(0, 4, 20, 36, 54, 72), distances=(6, 40, 100, 300))


def label(vs):
    return "yes" if brute.lane_pairs(vs) else "no"


def reach_of(direction):
    return [d for (name, _), ds in brute.REACH.items() if name == direction for d in ds]


def copies(vs, feature):
    """[(delta, changed vehicle list)] by the description of each test."""
    edit = lambda i, pos, x: [tuple(x if j == pos else f for j, f in enumerate(v)) if k == i else v for k, v in enumerate(vs)]
    if feature == "speed":
        return [(str(d), [(*v[:3], max(5.0, v[3] + d), *v[4:]) for v in vs]) for d in C.SPEED_DELTAS]
    if feature == "distance":
        return [(str(d), [(*v[:4], max(5.0, v[4] + d), *v[5:]) for v in vs]) for d in C.DISTANCE_DELTAS]
    out = []
    for i, v in enumerate(vs):
        if feature == "lane":
            others = [n for (name, n) in brute.REACH if name == v[5] and n != v[2]]
            out.append((str(i), edit(i, 2, others[0])))
        else:
            for k, d in enumerate([d for d in reach_of(v[5]) if d != v[6]][:3]):
                out.append((str(k), edit(i, 6, d)))
    return out


def expected(feature):
    rows = []
    for sid, vs in brute.by_scenario(DATA).items():
        rows += [(sid, delta, label(vs), label(c)) for delta, c in copies(vs, feature)]
    return sorted(rows)


def got(df):
    return sorted((r.scenario_id, r.delta, r.base_pred, r.perturbed_pred) for r in df.collect())


@pytest.mark.parametrize("feature", ["speed", "distance", "lane", "destination"])
def test_both_forms_match_a_loop(rows, feature):
    s = lane.packed(rows(DATA))
    want = expected(feature)
    assert any(b != p for _, _, b, p in want)
    assert got(perturb.records(s, feature)) == want
    fast = perturb.lane_records(s, feature) if feature in ("speed", "distance") else perturb.single_vehicle_records(s, [feature])
    assert got(fast) == want


def test_orders_are_permutations_and_equal_ones_are_left_out(rows):
    s = lane.packed(rows(DATA))
    out = perturb.reordered(s, shuffles=4).collect()
    for r in out:
        ids = [v.vehicle_id for v in r.vehicles]
        assert [v.seq for v in r.vehicles] == list(range(1, len(ids) + 1))
        assert sorted(ids) == [f"V{1000 + i}" for i in range(1, len(ids) + 1)] and ids != sorted(ids)
    again = perturb.reordered(s.repartition(3), shuffles=4).collect()
    assert {(r.scenario_id, r.delta, str(r.vehicles)) for r in out} == {(r.scenario_id, r.delta, str(r.vehicles)) for r in again}


def test_sensitivity_is_a_mean_of_scenario_means(rows):
    table = {r.feature: r for r in perturb.sensitivity(lane.packed(rows(DATA))).collect()}
    groups = brute.by_scenario(DATA)
    totals = dict.fromkeys(["speed", "distance", "destination", "lane"], 0.0)
    for vs in groups.values():
        flips = {k: [] for k in totals}
        for i, v in enumerate(vs):
            change = lambda pos, x: label([tuple(x if j == pos else f for j, f in enumerate(w)) if k == i else w for k, w in enumerate(vs)])
            flips["speed"] += [change(3, max(5.0, v[3] + d)) != label(vs) for d in C.SPEED_DELTAS]
            flips["distance"] += [change(4, max(5.0, v[4] + d)) != label(vs) for d in C.DISTANCE_DELTAS]
            flips["destination"] += [change(6, d) != label(vs) for d in [d for d in reach_of(v[5]) if d != v[6]][:3]]
            flips["lane"] += [change(2, n) != label(vs) for (name, n) in brute.REACH if name == vs[0][5] and n != v[2]]
        for k, f in flips.items():
            totals[k] += sum(f) / len(f)
    for k, total in totals.items():
        assert table[k].importance == pytest.approx(total / len(groups), abs=6e-5)
    assert table["vehicle_order"].importance == 0 and max(r.normalised for r in table.values()) == 1


def test_published_stability(spark):
    rates = spark.createDataFrame(
        [("speed", None, 0.04), ("distance", None, 0.184), ("lane", None, 0.0), ("destination", None, 0.0), ("vehicle_order", None, 0.0)],
        "feature string, delta string, flip_rate double")
    assert perturb.stability(rates).collect()[0].overall_stability == 0.9552
    order = {r.place: r.feature for r in perturb.feature_ranking(rates).collect()}
    assert [order[i] for i in range(1, 6)] == ["distance", "speed", "lane", "destination", "vehicle_order"]


def test_any_predictor_can_be_used(rows):
    always = lambda s: s.withColumn("prediction", F.lit("no"))
    out = perturb.records(lane.packed(rows(DATA)), "lane", always)
    assert out.filter("changed").count() == 0
    by_near = perturb.records(lane.packed(rows(DATA)), "distance", lambda s: near.with_label(s, "prediction"))
    assert by_near.filter("changed").count() > 0
