"""Readers with explicit schemas. Bad rows go to a quarantine column or table, never to an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import schema


def vehicle_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw 14-column table. A row that does not fit the schema keeps its text in ``_corrupt``."""
    fields = T.StructType(schema.RAW_VEHICLES.fields + [T.StructField("_corrupt", T.StringType())])
    return (
        spark.read.schema(fields).option("header", True).option("escape", '"')
        .option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    )


_LOOSE = T.ArrayType(schema.struct(
    vehicle_id=T.StringType(), lane=T.StringType(), speed=T.DoubleType(),
    distance_to_intersection=T.DoubleType(), direction=T.StringType(), destination=T.StringType(),
))
_SCENARIO = schema.struct(vehicles_scenario=_LOOSE, vehicles=_LOOSE)


def scenario_cell_problem(cell: Column) -> Column:
    """Why a scenario cell cannot be used, NULL when it can: bad JSON, no vehicle key, not a list."""
    keys = F.json_object_keys(cell)
    body = F.coalesce(F.get_json_object(cell, "$.vehicles_scenario"), F.get_json_object(cell, "$.vehicles"))
    named = F.array_contains(keys, "vehicles_scenario") | F.array_contains(keys, "vehicles")
    return (
        F.when(F.try_parse_json(cell).isNull() | keys.isNull(), "invalid JSON")
        .when(~named, "no vehicles key")
        .when(F.coalesce(~F.ltrim(body).startswith("["), F.lit(True)), "vehicles is not a list")
    )


def parse_scenarios(rows: DataFrame) -> DataFrame:
    """(scenario_id, is_conflict, vehicles, problem) from rows with a JSON ``scenario`` cell.

    Takes the key ``vehicles_scenario`` or ``vehicles``; a vehicle without id becomes V1, V2, ...
    """
    cell = F.from_json("scenario", _SCENARIO)
    listed = F.coalesce(F.col("_cell.vehicles_scenario"), F.col("_cell.vehicles"))
    typed = F.transform(listed, lambda v, i: F.struct(
        (i + 1).cast("int").alias("seq"),
        F.coalesce(v["vehicle_id"], F.concat(F.lit("V"), (i + 1).cast("string"))).alias("vehicle_id"),
        v["lane"].try_cast("int").alias("lane"), v["speed"].alias("speed"),
        v["distance_to_intersection"].alias("distance_to_intersection"),
        F.lower(F.trim(v["direction"])).alias("direction"), v["destination"].alias("destination")))
    return rows.withColumn("_cell", cell).select(
        "scenario_id", F.lower(F.trim("is_conflict")).alias("is_conflict"),
        typed.alias("vehicles"), scenario_cell_problem(F.col("scenario")).alias("problem"),
    )


def scenario_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good scenarios, quarantined rows with their problem) of a CSV whose cell holds the JSON."""
    rows = (
        spark.read.schema("scenario_id string, scenario string, is_conflict string")
        .option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    )
    parsed = parse_scenarios(rows)
    return parsed.filter("problem is null").drop("problem"), parsed.filter("problem is not null").drop("vehicles")


def prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """The JSONL log without its broken lines."""
    return spark.read.schema(schema.PREDICTION_EVENT).option("mode", "DROPMALFORMED").json(path)


def prediction_log_with_bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines, broken ones marked in ``_corrupt``: a last-N window counts them before they leave."""
    fields = T.StructType(schema.PREDICTION_EVENT.fields + [T.StructField("_corrupt", T.StringType())])
    return spark.read.schema(fields).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def flat_events(events: DataFrame) -> DataFrame:
    """Nested fields as dotted columns; the vehicle list stays a list."""
    rest = [c for c in events.columns if c not in ("prediction", "_corrupt")]
    nested = [F.col(f"prediction.{f}").alias(f"prediction.{f}") for f in events.schema["prediction"].dataType.fieldNames()]
    return events.select(*rest, *nested)


def lane_layout(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(direction, lane, place, destination) of the eight-lane layout; from a JSON file or the built-in one."""
    if path is None:
        rows = [
            (d, n, i, dest) for d, lanes in C.LAYOUT_EIGHT_LANE.items() for n, ds in lanes.items()
            for i, dest in enumerate(ds)
        ]
        return spark.createDataFrame(rows, "direction string, lane int, place int, destination string")
    cell = spark.read.text(path, wholetext=True).select(
        F.from_json(F.get_json_object("value", "$.intersection_layout"), "map<string,map<string,array<string>>>").alias("m")
    )
    if cell.filter("m is null").count():
        raise ValueError("layout has no intersection_layout key")
    return cell.select(F.explode("m").alias("direction", "lanes")).select(
        "direction", F.explode("lanes").alias("lane", "reach")
    ).select("direction", F.col("lane").cast("int").alias("lane"), F.posexplode("reach").alias("place", "destination"))


def layout_row(rows: DataFrame) -> DataFrame:
    """Layout rows as one row with one value, direction -> lane -> destinations in order; rules and what-if read it.

    Lanes stand in order of their numbers. A layout without rows gives a NULL value, under which every movement is unknown.
    """
    reach = F.transform(F.array_sort(F.collect_list(F.struct("place", "destination"))), lambda x: x["destination"])
    lanes = F.map_from_entries(F.array_sort(F.collect_list(F.struct("lane", "reach"))))
    layout = F.map_from_entries(F.collect_list(F.struct("direction", "lanes")))
    return (
        rows.groupBy("direction", "lane").agg(reach.alias("reach")).groupBy("direction").agg(lanes.alias("lanes"))
        .agg(layout.alias("layout"))
    )


def two_lane_layout(spark: SparkSession, path: str) -> DataFrame:
    """(direction, place, destination) of the two-lane layout file; a missing key is an error."""
    doc = spark.read.json(path, multiLine=True)
    missing = [k for k in C.LAYOUT_REQUIRED_KEYS if k not in doc.columns]
    if missing:
        raise ValueError(f"layout keys missing: {missing}")
    return (
        doc.select(F.explode(F.from_json(F.to_json("destinations"), "map<string,array<string>>")).alias("direction", "d"))
        .select("direction", F.posexplode("d").alias("place", "destination"))
    )


def features(spark: SparkSession, path: str) -> DataFrame:
    """The stored feature table, partitioned by date, with its event time."""
    return spark.read.parquet(path)
