"""Near rule: different approaches, both within 80 m; the faster vehicle goes first.

The reference loop hands out ranks while it walks the pairs. The closed form used here:
a vehicle that ever wins ranks by its first win, one in no pair or none lost comes next in
list order, one that only loses comes last in list order; the wait comes from the first lost pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from . import prefix
from . import scenarios as S
from .lane import ordered_pairs, yield_text


def approach(v: Column) -> Column:
    return F.struct(
        v["seq"].alias("seq"), v["vehicle_id"].alias("vehicle_id"), v["direction"].alias("direction"),
        v["speed"].alias("speed"),
        v["distance_to_intersection"].alias("distance"),
        scalar.near_arrival_s(v["speed"], v["distance_to_intersection"]).alias("t"),
    )


def directions_meet(a: Column, b: Column, listed: list[tuple[str, str]] | None = None) -> Column:
    """All six unordered pairs of different directions meet; ``listed`` restricts them."""
    if listed is None:
        return a["direction"] != b["direction"]
    names = [F.lit("|".join(sorted(p))) for p in listed]
    found = F.concat_ws("|", F.array_sort(F.array(a["direction"], b["direction"])))
    return F.array_contains(F.array(*names), found)


def resolve(a: Column, b: Column) -> Column:
    first = a["speed"] >= b["speed"]
    pick = lambda yes, no, f: F.when(first, yes[f]).otherwise(no[f])
    t = pick(a, b, "t")
    return F.struct(
        a["seq"].alias("seq1"), b["seq"].alias("seq2"),
        a["vehicle_id"].alias("vehicle1_id"), b["vehicle_id"].alias("vehicle2_id"),
        pick(a, b, "seq").alias("winner_seq"), pick(b, a, "seq").alias("loser_seq"),
        pick(a, b, "vehicle_id").alias("winner_id"), pick(b, a, "vehicle_id").alias("loser_id"),
        loser_wait(t).alias("wait"),
    )


def loser_wait(winner_t: Column) -> Column:
    """At least two seconds; NULL when the winner stands still and never arrives."""
    return F.when(winner_t.isNotNull(), F.greatest(F.lit(2), F.ceil(winner_t).cast("int") + 1))


def pairs(scenarios: DataFrame, inclusive: bool = True, listed=None) -> DataFrame:
    """One row per near-rule pair of packed scenarios; only near vehicles are paired."""
    near = F.filter("vehicles", lambda v: scalar.is_near(v["distance_to_intersection"], inclusive))
    both = ordered_pairs(scenarios.select("scenario_id", near.alias("vehicles")))
    a, b = F.col("a"), F.col("b")
    return (
        both.filter(directions_meet(a, b, listed))
        .select("scenario_id", resolve(approach(a), approach(b)).alias("p")).select("scenario_id", "p.*")
    )


def with_label(scenarios: DataFrame, name: str = "near_label", inclusive: bool = True) -> DataFrame:
    """Adds yes/no: two near vehicles from different directions exist. No pair is made."""
    near = F.filter("vehicles", lambda v: scalar.is_near(v["distance_to_intersection"], inclusive))
    directions = F.array_distinct(F.transform(near, lambda v: v["direction"]))
    return scenarios.withColumn(name, scalar.yes_no(F.size(directions) >= 2))


def ranked(scenarios: DataFrame, inclusive: bool = True, list_pairs: bool = False, keep: list[str] = []) -> DataFrame:
    """(scenario_id, ``keep``, ranked): per packed scenario its vehicles in order of rank, each with ``rank``, ``wait``, ``group`` and the
    ``stronger`` one it first loses to.

    The first win of a vehicle is against its earliest weaker counterpart, the first loss
    against its earliest stronger one, so two minima per vehicle replace the walk over pairs.
    ``list_pairs`` adds ``led``, the pairs in which the vehicle is the earlier one. All stays in the
    scenario's row: nothing is exploded or grouped, so a task holds one scenario at a time.
    """
    near = F.filter("vehicles", lambda v: scalar.is_near(v["distance_to_intersection"], inclusive))
    beats = lambda a, b: (a["speed"] > b["speed"]) | ((a["speed"] == b["speed"]) & (a["seq"] < b["seq"]))
    met = lambda a, test: F.filter("near", lambda b: directions_meet(a, b) & test(b))
    other = lambda b: F.struct(
        b["seq"].alias("seq"), b["vehicle_id"].alias("vehicle_id"),
        scalar.near_arrival_s(b["speed"], b["distance_to_intersection"]).alias("t"),
    )

    def minima(a):
        reaches = scalar.is_near(a["distance_to_intersection"], inclusive)
        pair = lambda b: F.struct(b["seq"].alias("seq2"), a["vehicle_id"].alias("vehicle1_id"), b["vehicle_id"].alias("vehicle2_id"))
        listed = [F.when(reaches, F.transform(met(a, lambda b: a["seq"] < b["seq"]), pair)).alias("led")] if list_pairs else []
        return F.struct(
            a["seq"].alias("seq"), a["vehicle_id"].alias("vehicle_id"),
            F.when(reaches, F.array_min(F.transform(met(a, lambda b: beats(a, b)), lambda b: b["seq"]))).alias("weaker"),
            F.when(reaches, F.array_min(F.transform(met(a, lambda b: ~beats(a, b)), other))).alias("stronger"), *listed,
        )

    def place(v):
        kept = ["seq", "vehicle_id", "stronger", *(["led"] if list_pairs else [])]
        group, place1, place2, wait = standing(v)
        return F.struct(group, place1, place2, *[v[f].alias(f) for f in kept], wait)

    found = scenarios.filter(F.size("vehicles") > 0).select("scenario_id", *keep, *([] if "vehicles" in keep else ["vehicles"]), near.alias("near"))
    found = found.select("scenario_id", *keep, F.transform("vehicles", minima).alias("found"))
    placed = found.select("scenario_id", *keep, F.array_sort(F.transform("found", place)).alias("placed"))
    numbered = lambda v, i: v.withField("rank", (i + 1).cast("int"))
    return placed.select("scenario_id", *keep, F.transform("placed", numbered).alias("ranked"))


def standing(v: Column) -> list[Column]:
    """From the earliest weaker seq and the stronger counterpart: group, place in it, and wait."""
    won, lost = v["weaker"].isNotNull(), v["stronger"].isNotNull()
    return [
        F.when(won, 0).when(~lost, 1).otherwise(2).alias("group"),
        F.when(won, F.least(v["seq"], v["weaker"])).otherwise(v["seq"]).alias("place1"),
        F.when(won, F.greatest(v["seq"], v["weaker"])).otherwise(0).alias("place2"),
        F.when(lost, loser_wait(v["stronger"]["t"])).otherwise(0).alias("wait"),
    ]


def priorities(scenarios: DataFrame, inclusive: bool = True) -> DataFrame:
    """One row per vehicle of every packed scenario: rank, wait, and whether it only loses."""
    return ranked(scenarios, inclusive).select("scenario_id", F.explode("ranked").alias("v")).select(
        "scenario_id", "v.seq", "v.vehicle_id", "v.rank", "v.wait", (F.col("v.group") == 2).alias("only_loses"),
    )


def summary(scenarios: DataFrame) -> DataFrame:
    """Ranked scenarios (with ``led``) with what a decision says.

    ``decisions`` has one text per losing vehicle in the order of first losses, ``conflict_vehicles`` all
    pairs in list order, ``entries`` the vehicles in list order. At most 20 vehicles each.
    """
    loss = lambda v: F.struct(
        F.least(v["seq"], v["stronger"]["seq"]).alias("p1"), F.greatest(v["seq"], v["stronger"]["seq"]).alias("p2"),
        yield_text(v["vehicle_id"], v["stronger"]["vehicle_id"]).alias("text"),
    )
    losers = F.filter("ranked", lambda v: v["stronger"].isNotNull())
    entry = lambda v: F.struct(*[v[f].alias(f) for f in ("seq", "vehicle_id", "rank", "wait", "led")])
    kept = [c for c in scenarios.columns if c not in ("scenario_id", "ranked")]
    out = scenarios.select(
        "scenario_id", *kept, F.array_sort(F.transform(losers, loss)).alias("losses"), F.array_sort(F.transform("ranked", entry)).alias("entries"))
    bare = lambda p: F.struct(p["vehicle1_id"], p["vehicle2_id"])
    led = F.flatten(F.transform("entries", lambda x: F.coalesce(F.transform(x["led"], bare), F.array())))
    out = out.withColumn("conflict_vehicles", led)
    any_pair = F.size("conflict_vehicles") > 0
    return out.select(
        "scenario_id", *kept, scalar.yes_no(any_pair).alias("is_conflict"), F.size("conflict_vehicles").alias("number_of_conflicts"),
        F.when(any_pair, F.array(F.lit("intersection"))).otherwise(F.array().cast("array<string>")).alias("places_of_conflicts"),
        "conflict_vehicles", F.transform("losses", lambda x: x["text"]).alias("decisions"), "entries",
    )


def decisions(scenarios: DataFrame, inclusive: bool = True) -> DataFrame:
    """One decision per scenario, with or without conflict."""
    out = summary(ranked(scenarios, inclusive, list_pairs=True))
    by_id = lambda value: S.map_by_id(F.col("entries"), value)
    return out.withColumns({"priority_order": by_id("rank"), "waiting_times": by_id("wait")}).drop("entries")


def generator_wait(scenario_id: Column, seq: Column, seed: int) -> Column:
    """2..6 seconds from a hash of the vehicle's place: the same under any partitioning."""
    return (2 + scalar.md5_number(F.concat_ws("|", F.lit(seed), scenario_id, seq)) % 5).cast("int")


def generator_labels(scenarios: DataFrame, seed: int = 42) -> DataFrame:
    """The generator's variant: closer than 80 m, drawn waits, vehicles that only lose stay unranked."""
    rows = priorities(scenarios, inclusive=False)
    loses = F.col("wait").isNull() | (F.col("wait") > 0)
    return rows.select(
        "scenario_id", "seq", "vehicle_id",
        F.when(~F.col("only_loses"), F.col("rank")).alias("rank"),
        F.when(loses, generator_wait(F.col("scenario_id"), F.col("seq"), seed)).otherwise(0).alias("wait"),
    )


# --- scenarios of any size: no pairs at all --------------------------------------


def priorities_of_rows(vehicles: DataFrame) -> DataFrame:
    """The same ranks and waits from vehicle rows, for scenarios of any size.

    Vehicles are ordered by strength (speed, then earlier place). The first win of a vehicle
    needs only the earliest weaker vehicle of each other direction, its first loss the earliest
    stronger one: running minima from both ends of the strength order, one per direction, instead
    of pairs. They go through ``prefix.running``, so one scenario may span many tasks.
    """
    rows = vehicles.select("scenario_id", approach(F.struct(*S.VEHICLE_FIELDS)).alias("v")).select(
        "scenario_id", "v.*", F.coalesce(scalar.is_near(F.col("v.distance")), F.lit(False)).alias("near")
    )
    seen = F.struct("seq", "t", "vehicle_id")
    of = lambda d: F.when(F.col("near") & (F.col("direction") == d), seen)
    met = prefix.running(
        rows, ["scenario_id"], ["speed", "-seq"], {f"weaker_{d}": ("min", of(d)) for d in C.DIRECTIONS},
        exclusive=True, backward={f"stronger_{d}": ("min", of(d)) for d in C.DIRECTIONS},
    )

    def earliest_other(side):
        return F.when(F.col("near"), F.least(
            *[F.when(F.col("direction") != d, F.col(f"{side}_{d}")) for d in C.DIRECTIONS]
        ))

    ordered = met.select(
        "scenario_id", "seq", "vehicle_id", earliest_other("weaker")["seq"].alias("weaker"),
        earliest_other("stronger").alias("stronger"),
    ).select("scenario_id", "seq", "vehicle_id", *standing(F.struct("seq", "weaker", "stronger")))
    # Places are list places: the rows themselves, once for each group, tell where to cut.
    places = vehicles.select(
        "scenario_id", F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("group"), F.col("seq").alias("place1"), F.lit(0).alias("place2"), "seq"
    )
    placed = prefix.running(
        ordered, ["scenario_id"], ["group", "place1", "place2", "seq"], {"rank": ("sum", F.lit(1))}, cut_by=places
    )
    return placed.select(
        "scenario_id", "seq", "vehicle_id", F.col("rank").cast("int"), "wait",
        (F.col("group") == 2).alias("only_loses"),
    )
