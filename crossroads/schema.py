"""Spark schemas of the tables, and the contract of the raw vehicle table."""

from pyspark.sql import types as T

from . import constants as C

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


VEHICLE = struct(vehicle_id=S, lane=I, speed=D, distance_to_intersection=D, direction=S, destination=S)

RAW_VEHICLES = struct(
    vehicle_id=S, lane=I, speed=D, distance_to_intersection=D, direction=S, destination=S,
    is_conflict=S, number_of_conflicts=I, places_of_conflicts=S, conflict_vehicles=S,
    decisions=S, priority_order=S, waiting_times=S, scenario_id=S,
)

PAIR_IDS = T.ArrayType(struct(vehicle1_id=S, vehicle2_id=S))
RANK_MAP = T.MapType(S, I)

PREDICTION_EVENT = struct(
    scenario_id=S, timestamp=S, model_version=S, prompt_version=S,
    vehicles=T.ArrayType(VEHICLE),
    prediction=struct(is_conflict=S, waiting_times=RANK_MAP, priority_order=RANK_MAP),
    latency_ms=D, json_valid=B, fallback_used=B, ground_truth=S, rule_agreement=B,
)

# fixed values: the contract of the raw table, (column, kind of check, argument)
CONTRACT = (
    [(c, "no_nulls", None) for c in RAW_VEHICLES.fieldNames()]
    + [("direction", "allowed", ["north", "south", "east", "west"]), ("is_conflict", "allowed", ["yes", "no"])]
    + [
        ("lane", "min", C.LANE_RANGE[0]), ("lane", "max", C.LANE_RANGE[1]),
        ("speed", "min", C.SPEED_RANGE[0]), ("speed", "max", C.SPEED_RANGE[1]),
        ("distance_to_intersection", "min", C.DISTANCE_RANGE[0]),
        ("distance_to_intersection", "max", C.DISTANCE_RANGE[1]),
        ("number_of_conflicts", "min", 0),
    ]
)

# fixed values: the shorter expectation suite
EXPECTATIONS = [
    ("vehicle_id", "no_nulls", None), ("is_conflict", "no_nulls", None),
    ("is_conflict", "allowed", ["yes", "no"]),
    ("direction", "allowed", ["north", "south", "east", "west"]),
    ("speed", "between", C.SPEED_RANGE),
    ("distance_to_intersection", "between", C.DISTANCE_RANGE),
    ("lane", "between", C.LANE_RANGE),
]
