"""The junction tables, derived from the star-schema tables of the test data.

A scenario is an order, a vehicle one of its lines. Plans are lazy, and a scenario table
costs one exchange: lines are numbered within their order and packed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from ..operators import lane, near, prefix
from ..operators import scenarios as S

# fixed values of the adapter
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
VARIANTS = [("A", 11, 1500), ("B", 29, 300)]  # variant, wrong when id % m = 0, base latency


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _destination(lane_no: Column, place: Column) -> Column:
    """The lane's destination at a place (from 0); X, which no lane reaches, beyond the last one."""
    lanes = {n: names for lanes in C.LAYOUT_EIGHT_LANE.values() for n, names in lanes.items()}
    by_lane = F.array(*[F.array(*map(F.lit, lanes[n])) for n in sorted(lanes)])
    return F.coalesce(F.get(F.element_at(by_lane, lane_no), place), F.lit("X"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER).withColumn("seq", nth)


def _as_vehicles(lines: DataFrame, scenario: str = "l_orderkey") -> DataFrame:
    part, supp, number = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    lane_no = (2 * (part % 4) + 1 + (supp % 2)).cast("int")
    stopped = (F.col("l_discount") == 0) & (F.col("l_tax") == 0)
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    directions = F.array(*[F.lit(d) for d in ("north", "east", "south", "west")])
    return lines.select(
        F.col(scenario).alias("scenario_id"),
        "seq",
        F.concat(F.lit("V"), (1000 + F.col("seq")).cast("string")).alias("vehicle_id"),
        lane_no.alias("lane"),
        F.when(stopped, 0.0).otherwise(10.0 + (cents % 8001) / 100.0).alias("speed"),
        (10.0 + (F.col("l_quantity") - 1) * 10).alias("distance_to_intersection"),
        F.element_at(directions, (part % 4 + 1).cast("int")).alias("direction"),
        _destination(lane_no, F.when(number == 7, 2).otherwise(number % 2)).alias("destination"),
    )


def scenarios(spark: SparkSession, sf_dir: str, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """(scenario_id, vehicles): every order, packed; also those with a single line, which are in no conflict.

    An order has few lines (17 at most in the test data) and its lines meet in one task anyway to be numbered.
    """
    rows = lane.prepared(raw_rows(spark, sf_dir), layout)
    return S.gathered(rows, "seq", S.packed_fields(rows))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vehicle of the same scenarios; never packed, so an order of any size stays spread."""
    return raw_rows(spark, sf_dir)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle rows of all orders."""
    return _as_vehicles(_lines(spark, sf_dir))


def supplier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle rows with a supplier's lines as a scenario: hundreds of vehicles each, numbered in order of their orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    placed = prefix.numbered(lines, ["l_suppkey"], ["l_orderkey", *LINE_ORDER], "seq").withColumn("seq", (F.col("seq") + 1).cast("int"))
    return _as_vehicles(placed, "l_suppkey")


def labelled_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios with the lane rule's and the near rule's yes/no."""
    return near.with_label(lane.with_label(scenarios(spark, sf_dir), "true_label"), "rule_label")


def with_variants(labelled: DataFrame) -> DataFrame:
    """Two prediction rows per scenario: each variant is wrong on its own share of ids."""
    choices = F.array(*[
        F.struct(F.lit(v).alias("variant"), F.lit(m).alias("m"), F.lit(b).alias("base")) for v, m, b in VARIANTS
    ])
    wrong = F.col("scenario_id") % F.col("m") == 0
    return labelled.select("*", F.inline(choices)).withColumn(
        "predicted_label", scalar.yes_no((F.col("true_label") == "yes") != wrong)
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored records: one row per scenario and variant."""
    scored = labelled_scenarios(spark, sf_dir).select(
        "scenario_id", "true_label", "rule_label", F.size("vehicles").alias("num_vehicles")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scenario_id"),
        F.col("o_orderdate").alias("ts"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )
    return with_variants(scored.join(orders, "scenario_id")).select(
        "scenario_id", "variant", "num_vehicles", "ts", "true_label", "predicted_label", "rule_label",
        (F.col("cents") % 5000 + F.col("base")).cast("double").alias("latency_ms"),
        (F.col("scenario_id") % 53 != 0).alias("json_valid"),
    )


def prediction_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant, time and id of all orders: where predictions lie in their sequences, without scoring them."""
    placed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scenario_id"), F.col("o_orderdate").alias("ts"))
    return placed.withColumn("variant", F.explode(F.array(*[F.lit(v) for v, _, _ in VARIANTS])))


def as_prediction_events(events: DataFrame) -> DataFrame:
    """The prediction log, from the events table; works on a stream as well."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return events.withColumn("k", k).select(
        "event_id", "ts", "user_id", "k",
        F.when(F.col("event_id") % 97 != 0, scalar.yes_no(F.col("k") >= 50)).alias("ground_truth"),
        scalar.yes_no((F.col("k") >= 50) != (F.col("event_id") % 17 == 0)).alias("predicted"),
        (~((F.col("event_type") == "error") & (F.col("event_id") % 10 == 0))).alias("json_valid"),
        (F.col("value") * 10).alias("latency_ms"),
    )


def prediction_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_prediction_events(table(spark, sf_dir, "events"))


def order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label from elsewhere: 'yes' for finished orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scenario_id"), scalar.yes_no(F.col("o_orderstatus") == "F").alias("given_label")
    )


def raw_dataset(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    """The 14-column table with Python-literal text columns, labelled by the generator's rule.

    Ranks, waits and texts are made in the scenario's row and go out with each of its vehicles: no join, no group.
    """
    made = scenarios(spark, sf_dir)
    # the generator leaves vehicles that only lose unranked and draws the waits of all that ever lose
    told = lambda v: v.withField("rank", F.when(v["group"] != 2, v["rank"])).withField(
        "wait", F.when(v["stronger"].isNotNull(), near.generator_wait(F.col("scenario_id"), v["seq"], seed)).otherwise(0))
    rows = near.ranked(made, False, list_pairs=True, keep=["vehicles"]).withColumn("ranked", F.transform("ranked", told))
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    listed = lambda items: F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    dict_text = lambda value: F.concat(F.lit("{"), F.array_join(F.transform("entries", lambda e: F.concat(
        quoted(e["vehicle_id"]), F.lit(": "), F.coalesce(e[value].cast("string"), F.lit("None")))), ", "), F.lit("}"))
    pair_text = lambda p: F.concat(
        F.lit("{'vehicle1_id': "), quoted(p["vehicle1_id"]), F.lit(", 'vehicle2_id': "), quoted(p["vehicle2_id"]), F.lit("}"))
    labels = near.summary(rows).select(
        "scenario_id", "vehicles", "is_conflict", "number_of_conflicts",
        listed(F.transform("places_of_conflicts", quoted)).alias("places_text"),
        listed(F.transform("conflict_vehicles", pair_text)).alias("pairs_text"),
        listed(F.transform("decisions", quoted)).alias("decisions_text"),
        dict_text("rank").alias("priority_order"), dict_text("wait").alias("waiting_times"),
    ).withColumnsRenamed({"places_text": "places_of_conflicts", "pairs_text": "conflict_vehicles", "decisions_text": "decisions"})
    each = S.unpack(labels, *[c for c in labels.columns if c not in ("scenario_id", "vehicles")])
    return each.select("scenario_id", *[f for f in S.VEHICLE_FIELDS if f != "seq"], *labels.columns[2:])


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle rows as a sensor might deliver them: odd spellings, values out of range, NULLs, repeated ids."""
    flag = F.col("l_returnflag")
    text = F.lit("[]")
    spelled = F.when(flag == "A", "north").when(flag == "N", " East ").when(F.col("l_linestatus") == "O", "diagonal")
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_tax") > 0, F.concat(F.lit("V"), F.col("l_linenumber").cast("string"))).alias("vehicle_id"),
        (F.col("l_linenumber") * 2 - 1).cast("int").alias("lane"),
        (F.col("l_extendedprice") / 400 - 5).alias("speed"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") * 45).alias("distance_to_intersection"),
        spelled.alias("direction"),
        F.lit("A").alias("destination"),
        F.when(flag == "R", "maybe").otherwise("yes").alias("is_conflict"),
        (F.col("l_linenumber") - 2).cast("int").alias("number_of_conflicts"),
        text.alias("places_of_conflicts"), text.alias("conflict_vehicles"), text.alias("decisions"),
        text.alias("priority_order"), text.alias("waiting_times"),
        F.col("l_orderkey").alias("scenario_id"),
    )
