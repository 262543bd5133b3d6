"""Orders beyond the request contract of 20 vehicles keep their decisions."""

from pyspark.sql import functions as F

from crossroads.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_repeated_ids_in_orders_of_more_than_twenty(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_orderkey <= 40")
    # All lines of orders 1 to 40 in two orders: far more than 20 vehicles each, besides the small ones.
    merged = lines.withColumn("l_orderkey", (F.lit(-1) - F.col("l_orderkey") % 2).cast(lines.schema["l_orderkey"].dataType))
    lines.unionByName(merged).write.parquet(str(tmp_path / "lineitem.parquet"))
    sizes = {r["l_orderkey"]: r["count"] for r in spark.read.parquet(str(tmp_path / "lineitem.parquet")).groupBy("l_orderkey").count().collect()}
    assert min(sizes[-1], sizes[-2]) > 20
    out = QUERIES["decisions_with_repeated_ids"](spark, str(tmp_path)).collect()
    assert sorted(r["scenario_id"] for r in out) == sorted(sizes)
    large = {r["scenario_id"]: r for r in out if r["scenario_id"] < 0}
    assert all(r["lane_order"] and r["near_order"] for r in large.values())
