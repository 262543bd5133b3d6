"""Pairs tested by numbers, lists made once: what the reports at size stand on."""

import itertools
import re

from pyspark.sql import functions as F

from crossroads import constants as C
from crossroads.operators import lane, perturb
from crossroads.plans.queries import QUERIES
from crossroads.sources import adapters

SMALL = "/root/testdata/sf0.001"


def test_bits_say_what_the_rule_says_of_every_two_paths(spark):
    """Direction codes of a layout with names of its own (-1) and unknown movements too."""
    each = list(itertools.product(range(-1, len(C.DIRECTIONS)), ("right", "straight", "left", "unknown", None)))
    rows = spark.createDataFrame([(a, b) for a in each for b in each], "a struct<d:int,m:string>, b struct<d:int,m:string>")
    a, b = F.col("a"), F.col("b")
    by_bits = lane.shares(lane.crossed_bits(a), lane.path_bit(b))
    got = rows.select("a", "b", F.coalesce(lane.paths_cross(a, b), F.lit(False)).alias("rule"), by_bits.alias("bits")).collect()
    assert [r for r in got if r.rule != r.bits] == [] and sum(r.bits for r in got) > 100


def test_reports_read_stored_predictions(spark):
    plan = QUERIES["evaluation_reports"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_totalprice" not in plan and "o_orderdate" not in plan


def test_lists_are_made_once(spark):
    """An explode that drops empty lists makes them a second time, to ask whether they are empty."""
    s = adapters.scenarios(spark, SMALL)
    for df in (perturb.single_vehicle_records(s, ["lane", "destination"]), perturb.single_vehicle_scores(s), perturb.lane_records(s, "speed")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        filters = re.findall(r"Filter (.*)", plan)
        assert filters and not any("transform(" in f or "slice(" in f for f in filters)


def test_scores_of_all_features_come_from_one_pass(spark):
    s = adapters.scenarios(spark, SMALL)
    empty = s.limit(1).select(F.lit(-1).cast("long").alias("scenario_id"), F.slice("vehicles", 1, 0).alias("vehicles"))
    moved = perturb.order_records(s, shuffles=4, always_reverse=True)
    orders = moved.groupBy("scenario_id", "feature").agg((F.count_if("changed") / F.count("*")).alias("score"))
    told = lambda df: sorted(map(tuple, df.select("scenario_id", "feature", "score").collect()))
    assert told(perturb.scores(s.unionByName(empty))) == told(perturb.single_vehicle_scores(s).unionByName(orders))
    plan = perturb.sensitivity(s)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1


def test_a_layout_with_a_name_of_its_own_and_odd_vehicles(spark, rows):
    """By pairs as by whole copies: stopped vehicles, unknown lanes and directions, a single vehicle."""
    layout = C.LAYOUT_EIGHT_LANE | {"ramp": {9: ["A", "B", "C"], 10: ["D", "E"]}}
    data = [(k, q, ln, sp, di, d, to) for k in range(12) for q, (ln, sp, di, d, to) in enumerate([
        (9, 40, 60 + 9 * k, "ramp", "A"), (10, 40, 50, "ramp", "E"), (3, 36, 60, "east", "H"), (1, 0, 40, "north", "E"), (4, 50, 70, "east", "Z"),
        (77, 30, 30, "west", "D"), (5, 45, 75, "south", "B"), (2, 35, 55, "nowhere", "F")][: 1 + k % 8], start=1)]
    s = lane.packed(rows(data), layout)
    got = lambda df: sorted((r.scenario_id, r.delta, r.base_pred, r.perturbed_pred) for r in df.collect())
    flipped = set()
    for feature in ("lane", "destination", "speed", "distance"):
        want = got(perturb.records(s, feature, layout=layout))
        flipped |= {feature for _, _, b, p in want if b != p}
        fast = perturb.lane_records(s, feature) if feature in ("speed", "distance") else perturb.single_vehicle_records(s, [feature], layout=layout)
        assert got(fast) == want, feature
    assert flipped >= {"lane", "destination", "speed"}
