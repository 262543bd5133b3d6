"""What several parts of a query read is made once."""

from pyspark.sql import functions as F

from crossroads.operators import perturb
from crossroads.plans.queries import QUERIES
from crossroads.sources import adapters

SMALL = "/root/testdata/sf0.001"


def scans(df, table) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count(table)


def test_labels_and_digests_are_made_once(spark):
    df = QUERIES["balanced_supplement"](spark, SMALL)
    assert scans(df, "l_orderkey") == 0 and df.filter(F.col("is_conflict").isin("yes", "no")).count() > 0


def test_flip_rates_are_made_once_for_all_reports(spark):
    assert scans(QUERIES["evaluation_reports"](spark, SMALL), "Expand") == 0


def test_scores_have_no_row_for_each_choice(spark):
    """The score of the records, which the sensitivity made a row per vehicle and choice for."""
    s = adapters.scenarios(spark, SMALL)
    features = ["speed", "distance", "lane", "destination"]
    recs = perturb.single_vehicle_records(s, features, lanes_of_first=True)
    want = recs.groupBy("scenario_id", "feature").agg((F.count_if("changed") / F.count("*")).alias("score"))
    told = lambda df: sorted(map(tuple, df.select("scenario_id", "feature", "score").collect()))
    made = perturb.single_vehicle_scores(s)
    assert told(made) == told(want) and any(x[2] for x in told(made))
