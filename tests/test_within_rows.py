"""Scenario work stays in the scenario's row: a task holds one scenario at a time, whatever its partition's size."""

import re

import pytest
from pyspark.sql import functions as F

from crossroads.functions import scalar
from crossroads.operators import near, perturb
from crossroads.plans.queries import QUERIES
from crossroads.sources import adapters, generators

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "scenario_text", "lane_decisions", "near_decisions", "near_priorities", "cascade_waits", "raw_dataset", "raw_row_chat_records",
    "generated_labelled", "perturb_lane", "perturb_destination", "perturb_order",
])
def test_nothing_is_grouped_or_joined_per_scenario(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not re.search(r"Aggregate\(keys=\[scenario_id", plan.split("Subquery")[0]) and "ObjectHash" not in plan and "Join" not in plan


def test_shifts_are_one_row_per_scenario_while_grouped(spark):
    plan = plan_of(perturb.lane_records(adapters.scenarios(spark, SMALL), "speed", "distance"))
    keys = re.findall(r"keys=\[([^\]]*)\]", plan)
    assert keys and all("delta" not in k for k in keys)


def test_generated_rows_are_made_once(spark):
    ids = spark.range(40).withColumnRenamed("id", "scenario_id")
    made = generators.two_lane(ids).withColumn("colour", F.col("seq") * 2)
    out = generators.labelled(made)
    assert plan_of(out).count("Range (") == 1
    got = {(r.scenario_id, r.seq): r for r in out.collect()}
    plain = {(r.scenario_id, r.seq): r for r in made.collect()}
    assert set(got) == set(plain) and all(got[k].colour == plain[k].colour and got[k].vehicle_id == plain[k].vehicle_id for k in got)
    labels = near.generator_labels(generators.S.pack(made)).collect()
    assert all((got[r.scenario_id, r.seq]["rank"], got[r.scenario_id, r.seq].wait) == (r["rank"], r.wait) for r in labels)


def test_a_literal_is_read_once_per_column(spark):
    df = QUERIES["raw_row_chat_records"](spark, SMALL)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 4
    rows = spark.createDataFrame([("{'V1': None, 'None': 2}",), ("None",), ("{'NoneV': 1}",)], "t string")
    got = [r.m for r in rows.select(scalar.python_literal(F.col("t"), "map<string,int>").alias("m")).collect()]
    assert got[0]["V1"] is None and got[0]["None"] == 2 and got[2] == {"NoneV": 1}
