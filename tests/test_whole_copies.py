"""Whole copies for any predictor: what holds for all copies of a scenario is made once, results stay those of the plain rule."""

import re

import pytest
from pyspark.sql import functions as F
from test_what_if import DATA

from crossroads import constants as C
from crossroads.operators import lane, perturb
from crossroads.sources import readers

# a stopped vehicle, sides and lanes no layout knows, a missing destination, a number that two vehicles share, a single vehicle
ODD = [
    (901, 1, 1, 0, 40, "north", "F"), (901, 2, 3, 50, 40, "east", "E"), (901, 3, 5, 50, 40, "south", "B"), (901, 4, 99, 50, 40, "up", "F"),
    (902, 1, 1, 50, 40, "north", "F"), (902, 1, 3, 50, 40, "east", "E"), (902, 2, 6, 50, 41, "south", None), (902, 3, None, 50, 40, None, None),
    (903, 1, 1, 50, 40, "north", "F"),
]


def plain(s):
    return lane.with_label(s, "prediction")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("feature", ["lane", "destination"])
def test_the_list_made_once_gives_the_plain_answers(rows, feature):
    s = lane.packed(rows(DATA + ODD))
    want = rows_of(perturb.records(s, feature, plain))
    assert any(r[5] for r in want) and rows_of(perturb.records(s, feature)) == want


def test_only_copies_that_keep_arrivals_and_order_bring_the_list(rows):
    s, seen = lane.packed(rows(DATA)), []

    def rule(scenarios):
        seen.append("close" in scenarios.columns)
        return perturb.lane_rule(scenarios)

    rule.once = perturb.lane_rule.once
    for feature in C.PERTURBED_FEATURES:
        perturb.records(s, feature, rule)
        assert seen == [feature in ("lane", "destination")] * 2
        seen.clear()


def test_the_list_is_that_of_the_rule(rows):
    s = lane.with_close(lane.packed(rows(DATA + ODD)))
    both = s.select(F.coalesce(lane.any_conflict(F.col("vehicles")), F.lit(False)), F.coalesce(lane.any_crossing(F.col("vehicles"), F.col("close")), F.lit(False)))
    assert both.filter(f"`{both.columns[0]}`").count() > 0 and all(a == b for a, b in both.collect())


def test_copies_do_not_carry_the_layout_and_list_choices_once(spark, rows):
    layout = readers.layout_row(readers.lane_layout(spark))
    df = perturb.records(lane.packed(rows(DATA)), "destination", layout=layout)
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("Subquery")[0]
    copies = next(line for line in plan.splitlines() if "Generate posexplode" in line)
    assert "layout" not in copies
    assert len(re.findall(r"slice\(filter\(", df._jdf.queryExecution().optimizedPlan().toString())) == 1
