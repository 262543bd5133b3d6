import pytest
from pyspark.sql import functions as F

import brute
from crossroads import constants as C
from crossroads.operators import cascade, lane, near
from crossroads.operators import scenarios as S

SMALL = brute.scenario_rows(1, [2, 3, 4, 5, 6, 8, 12, 20] * 12)
LARGE = brute.scenario_rows(2, [45, 3, 70, 2])  # two scenarios above the contract


def pair_set(df):
    return {(r.scenario_id, r.seq1, r.seq2, r.winner_seq, r.wait) for r in df.collect()}


def expected_pairs(data):
    return {(s, *p) for s, vs in brute.by_scenario(data).items() for p in brute.lane_pairs(vs)}


def ranks(df):
    return {(r.scenario_id, r.seq): (r["rank"], r.wait) for r in df.collect()}


def expected_ranks(data, rule):
    return {(s, q): v for s, vs in brute.by_scenario(data).items() for q, v in rule(vs).items()}


def test_lane_pairs_match_a_loop(rows):
    assert pair_set(lane.pairs(lane.packed(rows(SMALL)))) == expected_pairs(SMALL)


@pytest.mark.parametrize("data", [SMALL, LARGE])
def test_lane_pairs_by_rows_match_a_loop(rows, data):
    assert pair_set(lane.pairs_of_rows(rows(data))) == expected_pairs(data)


def test_all_pairs_covers_both_sizes(rows):
    both = SMALL[:60] + [(s + 1000, *rest) for s, *rest in LARGE]
    assert pair_set(lane.all_pairs(rows(both))) == expected_pairs(both)


def test_every_scenario_has_a_decision_whatever_its_size(spark, rows):
    both = SMALL[:60] + [(s + 1000, *rest) for s, *rest in LARGE]
    got = {r.scenario_id: r for r in lane.decisions_of_rows(rows(both)).collect()}
    listed = {r.scenario_id: r.asDict(recursive=True) for r in lane.decisions(lane.packed(rows(both))).collect()}
    for s, vs in brute.by_scenario(both).items():
        pairs, r = brute.lane_pairs(vs), got.pop(s)
        assert (r.n_vehicles, r.is_conflict) == (len(vs), "yes" if pairs else "no")
        assert r.n_involved == len({q for p in pairs for q in p[:2]})
        if len(vs) > 20:
            assert r.reason and r.decisions is None and s not in listed
        else:
            told = r.asDict(recursive=True)
            assert r.reason is None and all(told[k] == v for k, v in listed[s].items())
    assert not got


def test_a_scenario_of_a_hundred_thousand_vehicles(spark):
    places = [(d, n, to) for d, lanes in C.LAYOUT_EIGHT_LANE.items() for n, reach in lanes.items() for to in reach]
    place = F.element_at(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(n).alias("n"), F.lit(to).alias("to")) for d, n, to in places]),
                         (F.pmod(F.xxhash64("id"), F.lit(len(places))) + 1).cast("int"))
    many = spark.range(100_000).select(
        F.lit(1).cast("long").alias("scenario_id"), F.col("id").cast("int").alias("seq"), F.col("id").cast("string").alias("vehicle_id"),
        place["n"].alias("lane"), F.lit(36.0).alias("speed"), (F.col("id") * 45.0).alias("distance_to_intersection"),
        place["d"].alias("direction"), place["to"].alias("destination"))
    few = many.limit(2).withColumn("scenario_id", F.lit(2).cast("long"))
    got = {r.scenario_id: r for r in lane.decisions_of_rows(many.unionByName(few)).collect()}
    assert set(got) == {1, 2}  # 4.5 seconds between any two: no conflict, however many there are
    assert (got[1].n_vehicles, got[1].n_involved, got[1].is_conflict, got[1].reason) == (100_000, 0, "no", "too many vehicles to list")


def test_pack_marks_large_scenarios_and_keeps_none_of_their_rows(rows):
    packed = S.pack(rows(LARGE)).collect()
    assert {r.scenario_id: r.vehicles is None for r in packed} == {1: True, 2: False, 3: True, 4: False}


def test_near_ranks_match_a_loop(rows):
    assert ranks(near.priorities(lane.packed(rows(SMALL)))) == expected_ranks(SMALL, brute.near_result)


def test_near_ranks_by_rows_match_a_loop_at_any_size(rows):
    assert ranks(near.priorities_of_rows(rows(LARGE))) == expected_ranks(LARGE, brute.near_result)


def test_cascade_matches_a_loop(rows):
    assert ranks(cascade.waits(lane.packed(rows(SMALL)))) == expected_ranks(SMALL, brute.cascade_result)


def test_cascade_by_rows_matches_a_loop_at_any_size(rows):
    assert ranks(cascade.waits_of_rows(rows(LARGE))) == expected_ranks(LARGE, brute.cascade_result)


def test_ranks_are_a_permutation_and_winners_do_not_wait(rows):
    out = near.priorities(lane.packed(rows(SMALL))).groupBy("scenario_id").agg(
        F.count("*").alias("n"), F.countDistinct("rank").alias("u"), F.max("rank").alias("m")).collect()
    assert all(r.n == r.u == r.m for r in out)


def test_labels_agree_with_pairs(rows):
    s = near.with_label(lane.with_label(lane.packed(rows(SMALL))))
    got = {r.scenario_id: (r.lane_label, r.near_label) for r in s.collect()}
    for sid, vs in brute.by_scenario(SMALL).items():
        near_any = any(a[5] != b[5] and a[4] <= 80 and b[4] <= 80 for i, a in enumerate(vs) for b in vs[i + 1:])
        assert got[sid] == ("yes" if brute.lane_pairs(vs) else "no", "yes" if near_any else "no")


def test_decision_takes_longest_wait_and_first_rank(rows):
    made = {r.scenario_id: r for r in lane.decisions(lane.packed(rows(SMALL))).collect()}
    for sid, vs in brute.by_scenario(SMALL).items():
        waits, first = {}, {}
        for q1, q2, w, wait in brute.lane_pairs(vs):
            for q in (q1, q2):
                first.setdefault(f"V{1000 + q}", 1 if q == w else 2)
                waits[f"V{1000 + q}"] = max(waits.get(f"V{1000 + q}", 0), 0 if q == w else wait)
        r = made[sid]
        assert r.waiting_times == waits and r.priority_order == first
        assert r.number_of_conflicts == len(r.decisions) == len(r.conflict_vehicles)
        assert r.places_of_conflicts == (["intersection"] if waits else [])


# --- published cases -----------------------------------------------------------------

NEAR_CASES = [  # (vehicles as (direction, distance), pairs)
    ([("north", 50), ("south", 55)], 1), ([("east", 30), ("west", 70)], 1), ([("north", 50), ("east", 60)], 1),
    ([("north", 50), ("north", 60)], 0), ([("north", 400), ("south", 500)], 0), ([("north", 30), ("south", 500)], 0),
    ([("north", 40), ("south", 50), ("east", 45)], 3),
]
LANE_CASES = [  # (vehicles as (lane, speed, distance, direction, destination), any conflict)
    ([(1, 50, 100, "north", "F"), (3, 50, 100, "east", "B")], True),
    ([(1, 50, 50, "north", "F"), (3, 20, 500, "east", "B")], False),
    ([(1, 50, 100, "north", "F"), (2, 50, 100, "north", "E")], False),
    ([(5, 50, 100, "south", "B"), (7, 50, 100, "west", "D")], False),  # two right turns do not cross
    ([(1, 50, 100, "north", "F"), (3, 50, 100, "east", "B"), (5, 55, 100, "south", "D")], True),
]


def test_published_near_cases(rows):
    data = [(i, q, 1, 60, dist, d, "A") for i, (vs, _) in enumerate(NEAR_CASES) for q, (d, dist) in enumerate(vs, 1)]
    counts = {r.scenario_id: r["count"] for r in near.pairs(lane.packed(rows(data))).groupBy("scenario_id").count().collect()}
    assert [counts.get(i, 0) for i in range(len(NEAR_CASES))] == [n for _, n in NEAR_CASES]


def test_published_priority_case(rows):
    got = ranks(near.priorities(lane.packed(rows([(1, 1, 1, 80, 40, "north", "A"), (1, 2, 1, 30, 50, "south", "C")]))))
    assert got[1, 1] == (1, 0) and got[1, 2][0] == 2 and got[1, 2][1] > 0


def test_published_lane_cases(rows):
    data = [(i, q, ln, sp, di, d, to) for i, (vs, _) in enumerate(LANE_CASES) for q, (ln, sp, di, d, to) in enumerate(vs, 1)]
    got = {r.scenario_id: r.lane_label for r in lane.with_label(lane.packed(rows(data))).collect()}
    assert [got[i] == "yes" for i in range(len(LANE_CASES))] == [yes for _, yes in LANE_CASES]
    first = lane.pairs(lane.packed(rows(data))).filter("scenario_id = 0").collect()[0]
    assert first.winner_seq == 2 and first.rule_used == "straight priority"


def test_stopped_winner_gives_no_wait_value(rows):
    got = ranks(near.priorities(lane.packed(rows([(1, 1, 1, 0, 40, "north", "A"), (1, 2, 1, 0, 50, "south", "C")]))))
    assert got == {(1, 1): (1, 0), (1, 2): (2, None)}


def test_near_boundary_is_closed_for_the_rule_and_open_for_the_generator(rows):
    s = lane.packed(rows([(1, 1, 1, 30, 80, "north", "A"), (1, 2, 1, 20, 80, "south", "C")]))
    assert near.pairs(s).count() == 1 and near.pairs(s, inclusive=False).count() == 0


def test_listed_direction_pairs_restrict(rows):
    s = lane.packed(rows([(1, 1, 1, 30, 20, "north", "A"), (1, 2, 1, 20, 20, "south", "C"), (1, 3, 1, 20, 20, "east", "C")]))
    assert near.pairs(s, listed=[("south", "north")]).count() == 1


def test_generator_leaves_losers_unranked_and_draws_waits(rows):
    out = near.generator_labels(lane.packed(rows(SMALL))).collect()
    assert all(r.wait == 0 or 2 <= r.wait <= 6 for r in out)
    assert any(r["rank"] is None for r in out) and all(r.wait > 0 for r in out if r["rank"] is None)


def test_trusted_label_only_where_a_movement_is_unknown(spark, rows):
    data = [(1, 1, 1, 50, 100, "north", "F"), (1, 2, 3, 50, 100, "east", "B"), (2, 1, 1, 50, 100, "north", "X"), (2, 2, 3, 50, 100, "east", "B")]
    labels = spark.createDataFrame([(1, "no"), (2, "yes")], "scenario_id long, given string")
    made = {r.scenario_id: r for r in lane.decisions(lane.packed(rows(data)).join(labels, "scenario_id"), "given").collect()}
    assert made[1].is_conflict == "yes" and made[2].is_conflict == "yes" and made[2].number_of_conflicts == 0


def test_batch_scoring_keeps_failures_as_errors(spark, rows):
    data = [(1, 1, 1, 50, 100, "north", "F"), (1, 2, 3, 50, 100, "east", "B"), (2, 1, 1, 50, 100, "diagonal", "F"),
            (2, 2, 1, 50, 100, "north", "F"), (3, 1, 1, 50, 100, "north", "F")] + [(4, q, 1, 50, 100, "north", "F") for q in range(1, 30)]
    got = {r.scenario_id: (r.error, r.is_conflict) for r in lane.score(rows(data)).collect()}
    assert got == {1: (None, "yes"), 2: ("invalid direction", None), 3: ("too few vehicles", None), 4: ("too many vehicles", None)}


def test_repeated_ids_share_an_entry_and_do_not_stop_the_job(spark):
    """Two vehicles called V1: the last one counts in the near rule's maps, the first pair and longest wait in the lane rule's."""
    data = [(1, 1, "V1", 1, 50.0, 60.0, "north", "F"), (1, 2, "V2", 3, 50.0, 60.0, "east", "B"), (1, 3, "V1", 5, 40.0, 60.0, "south", "D")]
    df = spark.createDataFrame(data, "scenario_id long, seq int, vehicle_id string, lane int, speed double, distance_to_intersection double, direction string, destination string")
    by_near = near.decisions(lane.packed(df)).collect()[0]
    assert set(by_near.priority_order) == {"V1", "V2"} and by_near.priority_order["V1"] == 3
    by_lane = lane.decisions(lane.packed(df)).collect()[0]
    assert set(by_lane.priority_order) == {"V1", "V2"} and by_lane.number_of_conflicts == len(by_lane.decisions)
    assert lane.score(df).collect()[0].error == "duplicate vehicle_id"


def test_refused_scenarios_take_the_fallback(spark, rows):
    data = [(1, 1, 1, 50, 100, "north", "F"), (1, 2, 3, 50, 100, "east", "B")] + [(2, q, 1, 50, 100, "north", "F") for q in range(1, 31)]
    labels = spark.createDataFrame([(1, "no"), (2, "yes")], "scenario_id long, given_label string")
    got = {r.scenario_id: r for r in lane.score(rows(data), labels).collect()}
    assert (got[1].error, got[1].is_conflict) == (None, "yes")
    assert (got[2].error, got[2].is_conflict, got[2].number_of_conflicts) == ("too many vehicles", "yes", 1)
    assert [tuple(p) for p in got[2].conflict_vehicles] == [("V1001", "V1002")] and got[2].waiting_times == {}
