"""Arrival cascade: all vehicles of a scenario that are in any conflict go one after the other.

Each goes when it arrives or two seconds after the one before has gone, whichever is later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from . import lane, prefix


def waits(scenarios: DataFrame) -> DataFrame:
    """One row per vehicle of every packed scenario; not in any pair: rank NULL, wait 0.

    start_i = 2 i + max over j <= i of (t_j - 2 j), i being the place in arrival order. The queue
    is a list in the scenario's row, so a task holds one scenario at a time.
    """
    v = F.col("vehicles")
    meets = lambda a: F.coalesce(F.exists(v, lambda b: lane.conflict(a, b)), F.lit(False))
    place = lambda a: F.struct((~meets(a)).alias("outside"), a["t"].alias("t"), a["seq"].alias("seq"), a["vehicle_id"].alias("vehicle_id"))
    queue = F.array_sort(F.transform(v, place))  # those in no pair come last
    rows = scenarios.select("scenario_id", queue.alias("queue"))
    lead = lambda i: F.array_max(F.transform(F.slice("queue", F.lit(1), i + 1), lambda x, j: x["t"] - C.CLEARING_S * j))
    wait = lambda x, i: whole_seconds(C.CLEARING_S * i + lead(i) - x["t"])
    told = F.transform("queue", lambda x, i: F.struct(
        x["seq"].alias("seq"), x["vehicle_id"].alias("vehicle_id"), F.when(~x["outside"], i + 1).cast("int").alias("rank"),
        F.when(~x["outside"], wait(x, i)).otherwise(0).alias("wait")))
    return rows.select("scenario_id", F.inline(told))


def whole_seconds(seconds: Column) -> Column:
    """Rounded up; the ninth decimal is noise of the additions, not a reason to wait a second more."""
    return F.ceil(F.round(seconds, 9)).cast("int")


def waits_of_rows(vehicles: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """The same for scenarios of any size, without pairs; a queue may span many tasks.

    Places and the running maximum are taken inside each part of the queue. A part begins after the
    ``n`` vehicles of all earlier parts, so its values move by two seconds for each of them.
    """
    own, order = ["scenario_id", "_part"], ["t", "seq"]
    rows = lane.involved_of_rows(vehicles, layout).select("scenario_id", "seq", "vehicle_id", "t", "involved")
    along = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = F.when(F.col("involved"), F.col("t") - C.CLEARING_S * (F.col("rank") - 1))
    queued = lambda cut: cut.withColumn("rank", F.count_if("involved").over(along)).withColumn("lead", F.max(free).over(along))
    points, place, parts = prefix.points(lane.prepared(vehicles, layout), ["scenario_id"], order)
    local = queued(prefix.placed(rows, ["scenario_id"], points, place, parts))
    several = queued(prefix.placed(prefix.of_cut_keys(rows, ["scenario_id"], points), ["scenario_id"], points, place, parts))
    before = Window.partitionBy("scenario_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        several.filter(F.col("_goes_on") | F.col("_came")).groupBy(*own).agg(F.max("rank").alias("n"), F.max("lead").alias("lead"))
        .withColumn("_n", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("_lead", F.max(F.col("lead") - C.CLEARING_S * F.col("_n")).over(before))
        .select(*own, "_n", "_lead")
    )  # at most two rows per part
    timed = local.join(F.broadcast(carried), own, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rank = F.col("rank") + F.col("_n")
    start = C.CLEARING_S * (rank - 1) + F.greatest(F.col("lead") - C.CLEARING_S * F.col("_n"), "_lead")
    return timed.select(
        "scenario_id", "seq", "vehicle_id", F.when(F.col("involved"), rank).cast("int").alias("rank"),
        F.when(F.col("involved"), whole_seconds(start - F.col("t"))).otherwise(0).alias("wait"),
    )
