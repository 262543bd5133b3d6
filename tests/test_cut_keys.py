"""Running values look for cuts only where keys go on in another part, and classes fill up in two passes."""

import random

from pyspark.sql import functions as F

from crossroads.operators import prefix
from crossroads.sources import generators


def test_keys_without_a_cut_are_one_part_and_values_are_exact(spark):
    rnd = random.Random(4)
    data = [(rnd.randrange(300) if rnd.random() < 0.5 else 1000, i) for i in range(4000)]
    df = spark.createDataFrame(data, "k int, o int").repartition(4)
    cut = prefix.ranged(df, ["k"], ["o"], 8)
    per = {r.k: (r.n, r.hot) for r in cut.groupBy("k").agg(
        F.countDistinct("_part").alias("n"), F.max(F.col("_goes_on") | F.col("_came")).alias("hot")).collect()}
    assert per[1000][0] > 1 and sum(not hot for _, hot in per.values()) >= len(per) - 7
    assert cut.filter(~F.col("_goes_on") & ~F.col("_came")).select("_part").distinct().count() <= 2
    out = prefix.running(df, ["k"], ["o"], {"n": ("sum", F.lit(1))}, backward={"left": ("sum", F.lit(1))}, parts=8).collect()
    places = {}
    for k, o in sorted(data):
        places.setdefault(k, []).append(o)
    assert len(out) == len(data)
    for r in out:
        at = places[r.k].index(r.o)
        assert (r.n, r.left) == (at + 1, len(places[r.k]) - at)


def test_classes_fill_in_id_order_and_are_made_twice(spark):
    rnd = random.Random(6)
    data = [(i, rnd.choice(["yes", "no", "no", "no", None])) for i in rnd.sample(range(10_000), 600)]
    df = spark.createDataFrame(data, "scenario_id int, is_conflict string").repartition(4)
    for total in (1, 7, 101, 300, 5000):
        seen, want = {}, []
        for i, c in sorted(data):
            if seen.get(c, 0) < (total + 1) // 2 and len(want) < total:
                seen[c] = seen.get(c, 0) + 1
                want.append((i, c))
        assert sorted(tuple(r) for r in generators.class_balanced(df, total).collect()) == want
    ids = spark.range(100).withColumnRenamed("id", "scenario_id")
    made = ids.withColumn("is_conflict", F.when(F.md5(F.col("scenario_id").cast("string")) < "8", "yes").otherwise("no"))
    plan = generators.class_balanced(made, 50, cut_by=ids)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5") <= 4  # twice in either pass at most
