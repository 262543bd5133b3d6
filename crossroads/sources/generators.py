"""Scenario generators. Every value is a hash of (seed, scenario, vehicle): no random state,
the same rows under any partitioning and after any retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from ..operators import near, prefix
from ..operators import scenarios as S


def uniform(seed: int, purpose: str, *parts: Column, group: int = 0) -> Column:
    """A number in [0, 1) from one 32-bit group of an md5."""
    return scalar.md5_number(F.concat_ws("|", F.lit(seed), F.lit(purpose), *parts), group) / 2**32


def pick(options: list, u: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (F.floor(u * len(options)) + 1).cast("int"))


def _between(lo: float, hi: float, u: Column, digits: int = 2) -> Column:
    return F.round(lo + (hi - lo) * u, digits)


def _rows(ids: DataFrame, seed: int, n: int | None, n_max: int) -> DataFrame:
    size = F.lit(n) if n else (2 + F.floor(uniform(seed, "size", F.col("scenario_id")) * (n_max - 1))).cast("int")
    # ids often come from few files: spread them before the hashing that makes the values
    spread = ids.select("scenario_id").repartition("scenario_id")
    return spread.withColumn("seq", F.explode(F.sequence(F.lit(1), size)))


def two_lane(ids: DataFrame, seed: int = 42, num_vehicles: int | None = None) -> DataFrame:
    """Vehicle rows of two-lane scenarios, 2 to 8 vehicles (or exactly ``num_vehicles``), one scenario per id."""
    at = (F.col("scenario_id"), F.col("seq"))
    rows = _rows(ids, seed, num_vehicles, 8)
    names = list(C.LAYOUT_TWO_LANE)
    rows = rows.withColumn("direction", pick(names, uniform(seed, "a", *at)))
    dest = F.lit(None).cast("string")
    for name, options in C.LAYOUT_TWO_LANE.items():
        dest = F.when(F.col("direction") == name, pick(options, uniform(seed, "a", *at, group=2))).otherwise(dest)
    return rows.select(
        "scenario_id", "seq",
        F.format_string("V%04d", F.floor(uniform(seed, "b", *at, group=2) * 10000)).alias("vehicle_id"),
        (1 + F.floor(uniform(seed, "a", *at, group=1) * C.LANES_PER_DIRECTION)).cast("int").alias("lane"),
        _between(10, 90, uniform(seed, "b", *at)).alias("speed"),
        _between(10, 500, uniform(seed, "b", *at, group=1)).alias("distance_to_intersection"),
        "direction", dest.alias("destination"),
    )


def eight_lane(ids: DataFrame, seed: int = 42, num_vehicles: int = 5, fixed_count: bool = True) -> DataFrame:
    """Vehicle rows valid by the eight-lane layout; ids are unique within a scenario, of at most the contract's size."""
    if num_vehicles > C.MAX_VEHICLES:
        raise ValueError(f"at most {C.MAX_VEHICLES} vehicles")
    at = (F.col("scenario_id"), F.col("seq"))
    rows = _rows(ids, seed, num_vehicles if fixed_count else None, num_vehicles)
    rows = rows.withColumn("direction", pick(list(C.LAYOUT_EIGHT_LANE), uniform(seed, "a", *at)))
    lane_no, dest = F.lit(None).cast("int"), F.lit(None).cast("string")
    u_lane, u_dest = uniform(seed, "a", *at, group=1), uniform(seed, "a", *at, group=2)
    for name, lanes in C.LAYOUT_EIGHT_LANE.items():
        lane_no = F.when(F.col("direction") == name, pick(list(lanes), u_lane)).otherwise(lane_no)
    rows = rows.withColumn("lane", lane_no)
    for lanes in C.LAYOUT_EIGHT_LANE.values():
        for number, reach in lanes.items():
            dest = F.when(F.col("lane") == number, pick(reach, u_dest)).otherwise(dest)
    # a block of numbers per vehicle place keeps ids apart without a check
    block = 9000 // C.MAX_VEHICLES
    number = 1000 + (F.col("seq") - 1) * block + F.floor(uniform(seed, "b", *at, group=2) * block)
    return rows.select(
        "scenario_id", "seq", F.concat(F.lit("V"), number.cast("string")).alias("vehicle_id"), "lane",
        (20 + 60 * uniform(seed, "b", *at)).alias("speed"),
        (50 + 450 * uniform(seed, "b", *at, group=1)).alias("distance_to_intersection"),
        "direction", dest.alias("destination"),
    )


def ids(spark, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "scenario_id")


def labelled(vehicles: DataFrame, seed: int = 42) -> DataFrame:
    """Generated vehicle rows with their labels: rank and wait by the generator's rule, and the scenario's yes/no and pairs.

    Labels are made in the scenario's row and go out with its vehicles: the rows are made and packed once, nothing is joined.
    """
    own = [c for c in vehicles.columns if c != "scenario_id"]
    made = S.pack(vehicles, extra=[c for c in own if c not in S.packed_fields(vehicles)]).filter("scenario_id is not null")
    rows = near.ranked(made, inclusive=False, list_pairs=True, keep=["vehicles"])
    loses = lambda v: v["wait"].isNull() | (v["wait"] > 0)
    told = lambda v: F.struct(
        v["seq"].alias("seq"), F.when(v["group"] != 2, v["rank"]).alias("rank"),
        F.when(loses(v), near.generator_wait(F.col("scenario_id"), v["seq"], seed)).otherwise(0).alias("wait"),
    )
    pairs = F.aggregate("ranked", F.lit(0), lambda n, v: n + F.coalesce(F.size(v["led"]), F.lit(0)))
    # both lists by place: a vehicle meets its own label
    both = rows.select("scenario_id", pairs.alias("number_of_conflicts"), "vehicles", F.array_sort(F.transform("ranked", told)).alias("label"))
    each = both.select("scenario_id", "number_of_conflicts", F.inline(F.arrays_zip("vehicles", "label")))
    return each.select(
        "scenario_id", *[F.col(f"vehicles.{c}").alias(c) for c in own], "label.rank", "label.wait",
        scalar.yes_no(F.col("number_of_conflicts") > 0).alias("is_conflict"), "number_of_conflicts",
    )


def limit_rows(vehicles: DataFrame, n: int) -> DataFrame:
    """The first ``n`` vehicle rows by (scenario, place): the last scenario may be cut."""
    return vehicles.orderBy("scenario_id", "seq").limit(n)


def class_balanced(
    labelled: DataFrame, total: int, label: str = "is_conflict", id_col: str = "scenario_id", cut_by: DataFrame | None = None
) -> DataFrame:
    """Scenarios in id order, each class accepted while it has fewer than half of ``total``.

    Ids are cut into even parts, by ``cut_by`` when it is cheaper to make. How many of each class a part holds tells where
    classes and the whole are full: the table is made twice, for these counts and for the places inside the parts.
    """
    half, own = (total + 1) // 2, ["_part", label]
    cuts, place, parts = prefix.points(labelled if cut_by is None else cut_by, [], [id_col])
    cut = prefix.placed(labelled.select(*labelled.columns), [], cuts, place, parts).drop("_goes_on", "_came")
    earlier = lambda *keys: Window.partitionBy(*keys).orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*own).agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier(label)), F.lit(0)))
    taken = F.greatest(F.lit(0), F.least("_n", F.lit(half) - F.col("_before")))
    # a row per part and class
    carried = counts.withColumn("_taken", F.coalesce(F.sum(taken).over(earlier()), F.lit(0))).filter(
        (F.col("_before") < half) & (F.col("_taken") < total)).select("_part", F.col(label).alias("_label"), "_before", "_taken")
    rows = cut.join(F.broadcast(carried), ["_part"]).filter(F.col(label).eqNullSafe(F.col("_label")))
    accepted = rows.withColumn("_idx", F.row_number().over(Window.partitionBy(*own).orderBy(id_col))).filter(F.col("_before") + F.col("_idx") <= half)
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(id_col))
    return accepted.withColumn("_nth", nth).filter(F.col("_taken") + F.col("_nth") <= total).select(*labelled.columns)
