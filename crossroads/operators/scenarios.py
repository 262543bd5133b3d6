"""From vehicle rows to one row per scenario and back.

A scenario row holds ``vehicles``, an array of structs ordered by ``seq``. The request
contract allows 2 to 20 vehicles, so the array is small; packing enforces that before
the shuffle. Larger groups are never packed: ``split_by_size`` hands them out as rows,
and the rules resolve them as rows (see ``lane.pairs_of_rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar

VEHICLE_FIELDS = [
    "seq", "vehicle_id", "lane", "speed", "distance_to_intersection", "direction", "destination",
]
PREPARED_FIELDS = ["d", "m", "t"]  # added by lane.prepared


def packed_fields(vehicles: DataFrame) -> list[str]:
    return VEHICLE_FIELDS + [f for f in PREPARED_FIELDS if f in vehicles.columns]


def gathered(numbered: DataFrame, nth: str, fields: list[str]) -> DataFrame:
    """(scenario_id, vehicles): vehicle rows numbered from 1 in ``nth`` by a window over their scenario, packed where they lie.

    The rows are already sorted by scenario, so a window without an order gathers them as they stream by: a task holds
    one scenario at a time. A grouped list would sort the partition again and keep all its lists in memory.
    """
    whole = F.collect_list(F.struct(*fields)).over(Window.partitionBy("scenario_id"))
    return numbered.select("scenario_id", nth, whole.alias("_all")).filter(F.col(nth) == 1).select(
        "scenario_id", F.sort_array("_all").alias("vehicles"))


def pack(vehicles: DataFrame, max_vehicles: int = C.MAX_VEHICLES, extra: list[str] = []) -> DataFrame:
    """(scenario_id, vehicles, oversized): at most ``max_vehicles`` rows of a scenario meet in one task.

    The rank filter is applied on the map side as well, so a scenario that holds a large
    part of the table sends ``max_vehicles + 1`` rows per task. Such a scenario is marked
    ``oversized`` and its array is NULL; nothing is resolved from a cut array.
    """
    fields = [*packed_fields(vehicles), *extra]
    nth = F.row_number().over(Window.partitionBy("scenario_id").orderBy("seq"))
    kept = vehicles.select("scenario_id", *fields).withColumn("_nth", nth).filter(F.col("_nth") <= max_vehicles + 1)
    return (
        gathered(kept, "_nth", fields)
        .withColumn("oversized", F.size("vehicles") > max_vehicles)
        .withColumn("vehicles", F.when(~F.col("oversized"), F.col("vehicles")))
    )


def heads(vehicles: DataFrame, n: int) -> DataFrame:
    """(scenario_id, vehicles): the first ``n`` vehicles of each scenario; the rank filter also runs before the exchange."""
    nth = F.row_number().over(Window.partitionBy("scenario_id").orderBy("seq"))
    kept = vehicles.select("scenario_id", *VEHICLE_FIELDS).withColumn("_nth", nth).filter(F.col("_nth") <= n)
    return gathered(kept, "_nth", VEHICLE_FIELDS)


def first_of_id(entries: Column, key: str = "vehicle_id") -> Column:
    """Array entries whose id no earlier entry has."""
    return F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, F.lit(1), i), lambda x: x[key] == e[key]))


def map_by_id(entries: Column, value: str, key: str = "vehicle_id") -> Column:
    """id -> value; of entries that share an id the last one in order counts."""
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x[key] == e[key]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e[key], e[value])))


def split_by_size(vehicles: DataFrame, max_vehicles: int = C.MAX_VEHICLES) -> tuple[DataFrame, DataFrame]:
    """(packed scenarios within the limit, vehicle rows of all larger scenarios)."""
    packed = pack(vehicles, max_vehicles)
    large = packed.filter("oversized").select("scenario_id")
    return packed.filter(~F.col("oversized")).drop("oversized"), vehicles.join(large, "scenario_id", "left_semi")


def unpack(scenarios: DataFrame, *keep: str) -> DataFrame:
    return scenarios.select("scenario_id", *keep, F.inline("vehicles"))


def to_json_text(scenarios: DataFrame) -> DataFrame:
    """(scenario_id, scenario): the JSON form other tools read, without the position column."""
    fields = [f for f in VEHICLE_FIELDS if f != "seq"]
    bare = F.transform("vehicles", lambda v: F.struct(*[v[f].alias(f) for f in fields]))
    return scenarios.select(
        "scenario_id", F.to_json(F.struct(bare.alias("vehicles_scenario"))).alias("scenario")
    )


def content_key(vehicles: Column, fields: list[str] | None = None) -> Column:
    """A digest of the vehicles' content, the same for the same list whatever the scenario id."""
    fields = fields or [f for f in VEHICLE_FIELDS if f != "seq"]
    return F.sha2(
        F.array_join(
            F.transform(vehicles, lambda v: F.concat_ws(",", *[v[f].cast("string") for f in fields])), ";"
        ),
        256,
    )


def first_value(vehicles: Column, field: str) -> Column:
    """First non-NULL value of one field in scenario order; the list is only searched when the first vehicle has none."""
    known = F.filter(F.transform(vehicles, lambda v: v[field]), lambda x: x.isNotNull())
    return F.coalesce(F.get(vehicles, F.lit(0))[field], F.get(known, F.lit(0)))


def only_size(scenarios: DataFrame, n: int | None) -> DataFrame:
    """Scenarios with exactly ``n`` vehicles; None keeps the mix."""
    return scenarios if n is None else scenarios.filter(F.size("vehicles") == n)


# --- cleaning and rejection ---------------------------------------------------


def normalise(vehicles: DataFrame) -> DataFrame:
    """Direction lower-cased and trimmed, numbers cast; a bad number becomes NULL, not an error."""
    out = vehicles.withColumn("direction", scalar.clean_direction(F.col("direction")))
    for name, kind in (("lane", "int"), ("speed", "double"), ("distance_to_intersection", "double")):
        out = out.withColumn(name, F.col(name).try_cast(kind))
    return out.withColumn("vehicle_id", F.col("vehicle_id").cast("string"))


def rejection_reason(contract: bool = False) -> Column:
    """Why a vehicle row is refused, NULL when it is fine. ``contract`` adds the request ranges."""
    speed, distance, lane = F.col("speed"), F.col("distance_to_intersection"), F.col("lane")
    checks = [
        (F.coalesce(F.col("vehicle_id"), F.lit("")) == "", "empty vehicle_id"),
        (F.coalesce(speed < 0, F.lit(True)), "negative or missing speed"),
        (F.coalesce(distance < 0, F.lit(True)), "negative or missing distance"),
        (F.coalesce(~F.col("direction").isin(C.DIRECTIONS), F.lit(True)), "invalid direction"),
    ]
    if contract:
        checks += [
            (speed > C.SPEED_RANGE[1], "speed above range"),
            (distance > C.DISTANCE_RANGE[1], "distance above range"),
            (F.coalesce(~lane.between(*C.LANE_RANGE), F.lit(True)), "lane out of range"),
        ]
    return F.coalesce(*[F.when(bad, text) for bad, text in checks])


def quarantine(vehicles: DataFrame, contract: bool = False) -> DataFrame:
    """All rows with a ``reason`` column; filter on NULL for the good ones."""
    return vehicles.withColumn("reason", rejection_reason(contract))


def duplicate_ids(vehicles: DataFrame) -> DataFrame:
    """(scenario_id, vehicle_id, n) for every id a scenario holds more than once; pre-aggregated."""
    return (
        vehicles.groupBy("scenario_id", "vehicle_id").agg(F.count("*").alias("n")).filter("n > 1")
    )


def scenario_status(vehicles: DataFrame) -> DataFrame:
    """One row per scenario against the request contract: size, bad rows, duplicate ids, reason.

    Two aggregations with map-side combine; no window and no list, so group size does not matter.
    """
    per_id = (
        quarantine(vehicles, contract=True)
        .groupBy("scenario_id", "vehicle_id")
        .agg(F.count("*").alias("_n"), F.count("reason").alias("_bad"), F.min("reason").alias("_why"))
    )
    out = per_id.groupBy("scenario_id").agg(
        F.sum("_n").alias("n_vehicles"),
        F.sum("_bad").alias("n_bad"),
        F.sum((F.col("_n") > 1).cast("int")).alias("n_duplicate_ids"),
        F.min("_why").alias("_why"),
    )
    reason = F.coalesce(
        F.col("_why"),
        F.when(F.col("n_duplicate_ids") > 0, "duplicate vehicle_id"),
        F.when(F.col("n_vehicles") < C.MIN_VEHICLES, "too few vehicles"),
        F.when(F.col("n_vehicles") > C.MAX_VEHICLES, "too many vehicles"),
    )
    return out.withColumn("reason", reason).drop("_why")


def assert_clean(vehicles: DataFrame) -> None:
    """Raise once, naming the counts per reason, when any row is refused."""
    bad = quarantine(vehicles).filter("reason is not null").groupBy("reason").count().collect()
    if bad:
        raise ValueError("refused vehicle rows: " + ", ".join(f"{r['reason']}={r['count']}" for r in bad))
