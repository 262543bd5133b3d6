import re

import pytest

import __spark_entry__ as entry
from crossroads.operators import lane
from crossroads.plans.oracle import ORACLE
from crossroads.plans.queries import QUERIES
from crossroads.sources import adapters

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_and_published_counts(spark):
    out = entry.entry(spark)
    assert out.columns == ["scenario_id", "seq", "vehicle_id", "rank", "wait"]
    rows = out.collect()
    assert (len(rows), sum(r.wait for r in rows), sum(r["rank"] == 1 for r in rows)) == (1570, 790, 801)


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (?:hash|range|Single)", plan))


@pytest.mark.parametrize("name", [
    "lane_pairs", "lane_priority_waits", "lane_decisions", "near_priorities", "cascade_waits", "perturb_speed",
    "perturb_destination", "scenario_text",
])
def test_scenario_work_needs_one_exchange(spark, name):
    assert exchanges(entry.queries()[name](spark, SMALL)) == 1


def test_no_line_is_left_out(spark):
    lines = adapters.table(spark, SMALL, "lineitem").count()
    assert adapters.vehicles(spark, SMALL).count() == lines


def test_scan_reads_only_needed_columns(spark):
    plan = lane.pairs(adapters.scenarios(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in plan.split("ReadSchema")[1]
