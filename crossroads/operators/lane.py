"""Lane rule: paths cross by movement, arrivals at most four seconds apart, yield by movement and side.

Within the request contract a scenario is one row, and its pairs are made inside the row:
after packing, pairs, ranks and waits need no further exchange and no join.
``pairs_of_rows`` gives the same pairs for scenarios of any size by an equi-join on
(scenario, four-second band).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from ..functions.text import fill
from . import prefix
from . import scenarios as S


def prepared(vehicles: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """Vehicle rows with what the rule needs of each: direction code ``d``, movement ``m``, arrival ``t``.

    Computed once per vehicle in generated code, before packing; pairs only compare the results.
    ``layout`` is a dict or the one row of a layout file, see ``scalar.layout_map``.
    """
    return vehicles.withColumns({
        "d": scalar.direction_code(F.col("direction")),
        "m": scalar.movement(F.col("direction"), F.col("lane"), F.col("destination"), layout),
        "t": scalar.lane_arrival_s(F.col("speed"), F.col("distance_to_intersection")),
    })


def packed(vehicles: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """Vehicle rows of contract-sized scenarios as prepared scenario rows; see ``scenarios.pack``.

    Larger scenarios have no such row. ``decisions_of_rows`` and ``score`` answer for every scenario.
    """
    return S.pack(prepared(vehicles, layout)).filter(~F.col("oversized")).drop("oversized")


def paths_cross(a: Column, b: Column) -> Column:
    """Opposite approaches cross when exactly one turns left; adjacent ones unless both turn right."""
    known = (a["m"] != "unknown") & (b["m"] != "unknown") & (a["d"] != b["d"])
    opposite = (a["d"] + 2) % 4 == b["d"]
    return known & F.when(opposite, (a["m"] == "left") != (b["m"] == "left")).otherwise(
        ~((a["m"] == "right") & (b["m"] == "right"))
    )


#: Paths with a number: a direction code (-1 for one that is none of the four) and a known movement.
MOVEMENTS = ("right", "straight", "left")
PATHS = [(d, m) for d in range(-1, len(C.DIRECTIONS)) for m in MOVEMENTS]


def _known_paths_cross(a: tuple[int, str], b: tuple[int, str]) -> bool:
    """``paths_cross`` of two numbered paths, for the table of ``crossed_bits``."""
    (d1, m1), (d2, m2) = a, b
    return d1 != d2 and ((m1 == "left") != (m2 == "left") if (d1 + 2) % 4 == d2 else not m1 == m2 == "right")


def _of_path(v: Column, values: dict[tuple[int, str], int]) -> Column:
    """The value of the vehicle's path, 0 when its movement is unknown; the movement is named once, it may be a long expression."""
    listed = [values[d, m] for d in range(-1, len(C.DIRECTIONS)) for m in MOVEMENTS]
    turn = F.create_map(*[F.lit(x) for i, m in enumerate(MOVEMENTS) for x in (m, i)])[v["m"]]
    return F.coalesce(F.get(F.array(*map(F.lit, listed)), (v["d"] + 1) * len(MOVEMENTS) + turn), F.lit(0))


def path_bit(v: Column) -> Column:
    """The vehicle's path as one bit, 0 when its movement is unknown."""
    return _of_path(v, {p: 1 << i for i, p in enumerate(PATHS)})


def crossed_bits(v: Column) -> Column:
    """The paths that cross the vehicle's own: ``paths_cross(a, b)`` is ``shares(crossed_bits(a), path_bit(b))``.

    Made once per vehicle, so that a pair costs one comparison of numbers, and the paths of a whole list are one number.
    """
    return _of_path(v, {a: sum(1 << i for i, b in enumerate(PATHS) if _known_paths_cross(a, b)) for a in PATHS})


def shares(bits: Column, others: Column) -> Column:
    return bits.bitwiseAND(others) != 0


def arrivals_close(a: Column, b: Column) -> Column:
    return F.coalesce(F.abs(a["t"] - b["t"]) <= C.ARRIVAL_GAP_S, F.lit(False))


def conflict(a: Column, b: Column) -> Column:
    return arrivals_close(a, b) & paths_cross(a, b)  # the cheap test, which few pass, first


def first_goes(a: Column, b: Column) -> Column:
    """True when ``a`` has right of way over ``b`` (``a`` is the earlier of the two in the list)."""
    return (
        F.when(F.abs(a["t"] - b["t"]) > C.SAME_TIME_S, a["t"] <= b["t"])
        .when((a["m"] == "straight") != (b["m"] == "straight"), a["m"] == "straight")
        .when((a["m"] == "right") & (b["m"] == "left"), True)
        .when((a["m"] == "left") & (b["m"] == "right"), False)
        .otherwise(F.pmod(b["d"] - a["d"], F.lit(4)) != 1)
    )


def rule_used(a: Column, b: Column) -> Column:
    turns = F.array(a["m"], b["m"])
    return (
        F.when(F.abs(a["t"] - b["t"]) > C.SAME_TIME_S, "arrival time")
        .when((a["m"] == "straight") != (b["m"] == "straight"), "straight priority")
        .when(F.array_contains(turns, "right") & F.array_contains(turns, "left"), "right-turn priority")
        .otherwise("right-hand rule")
    )


def yield_wait(winner_t: Column, loser_t: Column) -> Column:
    return F.ceil(F.greatest(F.lit(0.0), winner_t + C.CLEARING_S - loser_t)).cast("int")


def resolve(a: Column, b: Column) -> Column:
    """One conflict pair as a struct: who waits for whom, how long, and by which rule."""
    goes = first_goes(a, b)
    return F.struct(
        a["seq"].alias("seq1"), b["seq"].alias("seq2"),
        a["vehicle_id"].alias("vehicle1_id"), b["vehicle_id"].alias("vehicle2_id"),
        a["m"].alias("movement1"), b["m"].alias("movement2"),
        F.when(goes, a["seq"]).otherwise(b["seq"]).alias("winner_seq"),
        F.when(goes, a["vehicle_id"]).otherwise(b["vehicle_id"]).alias("winner_id"),
        F.when(goes, b["vehicle_id"]).otherwise(a["vehicle_id"]).alias("loser_id"),
        F.when(goes, yield_wait(a["t"], b["t"])).otherwise(yield_wait(b["t"], a["t"])).alias("wait"),
        rule_used(a, b).alias("rule_used"),
    )


# --- scenarios within the contract: one row each --------------------------------


def any_conflict(vehicles: Column) -> Column:
    """The rule's yes/no for one row; stops at the first conflict."""
    return F.exists(
        vehicles, lambda a: F.exists(vehicles, lambda b: (a["seq"] < b["seq"]) & conflict(a, b))
    )


def with_close(scenarios: DataFrame) -> DataFrame:
    """Adds ``close``: places in the list and directions of the pairs that arrive close together from different sides.

    It holds for every copy that leaves arrivals, directions and the order of the list alone, see ``any_crossing``.
    """
    at = F.transform("vehicles", lambda v, i: F.struct(v["seq"].alias("seq"), v["d"].alias("d"), v["t"].alias("t"), i.alias("i")))
    met = lambda a, b: (a["seq"] < b["seq"]) & (a["d"] != b["d"]) & arrivals_close(a, b)
    pair = lambda a, b: F.struct(a["i"].alias("i"), a["d"].alias("d1"), b["i"].alias("j"), b["d"].alias("d2"))
    listed = lambda vs: F.flatten(F.transform(vs, lambda a: F.transform(F.filter(vs, lambda b: met(a, b)), lambda b: pair(a, b))))
    # named by a function of its own, the list is made once and its fields are read as they were made
    return scenarios.withColumn("close", F.get(F.transform(F.array(at), listed), F.lit(0)))


def any_crossing(vehicles: Column, close: Column) -> Column:
    """``any_conflict`` from the list of ``with_close``: only the paths of its pairs are tested."""
    moves = lambda place, d: {"d": d, "m": F.get(vehicles, place)["m"]}
    return F.exists(close, lambda p: paths_cross(moves(p["i"], p["d1"]), moves(p["j"], p["d2"])))


def any_unknown(vehicles: Column) -> Column:
    return F.exists(vehicles, lambda a: a["m"] == "unknown")


def with_label(scenarios: DataFrame, name: str = "lane_label") -> DataFrame:
    """Adds the lane rule's 'yes'/'no'."""
    return scenarios.withColumn(name, scalar.yes_no(any_conflict(F.col("vehicles"))))


def pairs_within(vehicles: Column, test: Callable[[Column, Column], Column], made: Callable[[Column, Column], Column]) -> Column:
    """``made(a, b)`` of the ordered pairs of one list that pass ``test``, in list order.

    The list stays in its row: pairs are neither exploded nor grouped, so a task holds one scenario at a time.
    """
    rest = lambda i: F.slice(vehicles, i + 2, F.size(vehicles))
    return F.flatten(F.transform(
        vehicles, lambda a, i: F.transform(F.filter(rest(i), lambda b: test(a, b)), lambda b: made(a, b))))


def with_pairs(scenarios: DataFrame) -> DataFrame:
    """Adds ``pairs``: the scenario's conflict pairs in (seq1, seq2) order, empty where there are none."""
    return scenarios.filter(F.size("vehicles") > 0).withColumn("pairs", pairs_within(F.col("vehicles"), conflict, resolve))


def ordered_pairs(scenarios: DataFrame) -> DataFrame:
    """(scenario_id, a, b) for each ordered pair inside a scenario row: at most 190, made in place."""
    first = scenarios.select("scenario_id", "vehicles", F.posexplode("vehicles").alias("i", "a"))
    rest = F.slice("vehicles", F.col("i") + 2, F.size("vehicles"))
    return first.select("scenario_id", "a", F.explode(rest).alias("b"))


def pairs(scenarios: DataFrame) -> DataFrame:
    """One row per conflict pair of packed scenarios."""
    a, b = F.col("a"), F.col("b")
    return (
        ordered_pairs(scenarios).filter(conflict(a, b))
        .select("scenario_id", resolve(a, b).alias("p")).select("scenario_id", "p.*")
    )


# --- scenarios of any size: one row per vehicle ---------------------------------


def pairs_of_rows(vehicles: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """The same pairs from vehicle rows, for scenarios of any size.

    Conflicting arrivals are at most one four-second band apart, so each vehicle meets only
    its own and the neighbouring bands of its scenario: a scenario that holds much of the
    table spreads over its bands. Vehicles that can never conflict leave before the join.
    """
    rows = (
        prepared(vehicles, layout)
        .filter((F.col("m") != "unknown") & F.col("t").isNotNull())
        .select("scenario_id", F.struct("seq", "vehicle_id", "d", "m", "t").alias("a"))
        .withColumn("band", F.floor(F.col("a.t") / C.ARRIVAL_GAP_S))
    )
    near = rows.select(
        "scenario_id", F.col("a").alias("b"),
        F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
    )
    a, b = F.col("a"), F.col("b")
    return (
        rows.join(near, ["scenario_id", "band"])
        .filter((a["seq"] < b["seq"]) & conflict(a, b))
        .select("scenario_id", resolve(a, b).alias("p"))
        .select("scenario_id", "p.*")
    )


def involved_of_rows(vehicles: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """Prepared vehicle rows with ``involved``: is the vehicle in any conflict? Any scenario size, no pairs.

    Of each kind of approach and movement only the nearest arrival before and after can matter: if
    that one is too far apart, all others are. So two running values per kind answer the question.
    """
    rows = prepared(vehicles, layout)
    kinds = [(d, m) for d in range(len(C.DIRECTIONS)) for m in ("right", "straight", "left")]
    at = lambda d, m: F.when((F.col("d") == d) & (F.col("m") == m), F.col("t"))
    met = prefix.running(
        rows, ["scenario_id"], ["t", "seq"], {f"_b_{d}_{m}": ("max", at(d, m)) for d, m in kinds},
        exclusive=True, backward={f"_a_{d}_{m}": ("min", at(d, m)) for d, m in kinds},
    )
    me = F.struct("d", "m", "t")
    hits = [
        conflict(me, F.struct(F.lit(d).alias("d"), F.lit(m).alias("m"), F.col(f"{side}_{d}_{m}").alias("t")))
        for d, m in kinds for side in ("_b", "_a")
    ]
    return met.select(*rows.columns, reduce(lambda a, b: a | b, hits).alias("involved"))


def labels_of_rows(vehicles: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """One row per scenario of any size: vehicles, vehicles in a conflict, yes/no, whether a movement is unknown."""
    return involved_of_rows(vehicles, layout).groupBy("scenario_id").agg(
        F.count("*").alias("n_vehicles"), F.count_if("involved").alias("n_involved"),
        scalar.yes_no(F.max("involved")).alias("is_conflict"), F.max(F.col("m") == "unknown").alias("any_unknown"),
    )


def decisions_of_rows(
    vehicles: DataFrame, max_listed: int = C.MAX_VEHICLES, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE
) -> DataFrame:
    """One row per scenario of any size: yes/no, vehicles in conflicts, and its whole decision or the ``reason`` for none.

    Yes or no needs no pairs and is there for every scenario. Pairs, texts and maps are lists in a row, so they are
    given up to ``max_listed`` vehicles; above that they are NULL, the reason says so, and ``pairs_of_rows``,
    ``priority_waits`` and ``cascade.waits_of_rows`` hold the same as rows.
    """
    labels = labels_of_rows(vehicles, layout).drop("any_unknown")
    small = S.pack(prepared(vehicles, layout), max_listed).filter(~F.col("oversized")).drop("oversized")
    listed = decisions(small).drop("is_conflict")
    reason = F.when(F.col("n_vehicles") > max_listed, "too many vehicles to list")
    return labels.join(listed, "scenario_id", "left").withColumn("reason", reason)


def all_pairs(vehicles: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """Pairs of a vehicle table with scenarios of every size: one form for all of them."""
    return pairs_of_rows(vehicles, layout)


# --- per vehicle ----------------------------------------------------------------


def sides(pair_rows: DataFrame) -> DataFrame:
    """Two rows per pair: each vehicle with its rank in the pair (1 goes, 2 waits) and its wait."""
    first_wins = F.col("winner_seq") == F.col("seq1")
    side = lambda seq, vid, wins: F.struct(
        F.col(seq).alias("seq"), F.col(vid).alias("vehicle_id"),
        F.when(wins, 1).otherwise(2).alias("rank"), F.when(wins, 0).otherwise(F.col("wait")).alias("wait"),
    )
    return pair_rows.select(
        "scenario_id", F.struct("seq1", "seq2").alias("at"),
        F.inline(F.array(side("seq1", "vehicle1_id", first_wins), side("seq2", "vehicle2_id", ~first_wins))),
    )


def priority_waits(pair_rows: DataFrame) -> DataFrame:
    """Rank of the first pair and longest wait, for each vehicle that is in any pair."""
    return (
        sides(pair_rows)
        .groupBy("scenario_id", "seq", "vehicle_id")
        .agg(F.min_by("rank", "at").alias("rank"), F.max("wait").alias("wait"))
    )


def last_pair_view(pair_rows: DataFrame) -> DataFrame:
    """The screen's variant: rank and wait of the last pair the vehicle is in."""
    last = F.max_by(F.struct("rank", "wait"), "at")
    return (
        sides(pair_rows)
        .groupBy("scenario_id", "seq", "vehicle_id")
        .agg(last.alias("_last"))
        .select("scenario_id", "seq", "vehicle_id", "_last.rank", "_last.wait")
    )


def rule_distribution(pair_rows: DataFrame) -> DataFrame:
    return pair_rows.groupBy("rule_used").agg(F.count("*").alias("n"))


# --- per scenario -----------------------------------------------------------------


def outcome_array(vehicles: Column, pair_list: Column) -> Column:
    """Per vehicle id in any pair, in scenario order: rank of its first pair, longest wait of all.

    Ids are the keys of the decision's maps, so vehicles that share an id share an outcome.
    """

    def own(v):
        return F.filter(pair_list, lambda p: (p["vehicle1_id"] == v["vehicle_id"]) | (p["vehicle2_id"] == v["vehicle_id"]))

    def outcome(v, mine):
        goes = lambda p: (p["winner_id"] == v["vehicle_id"]) & (p["loser_id"] != v["vehicle_id"])
        lost = F.transform(mine, lambda p: F.when(goes(p), 0).otherwise(p["wait"]))
        return F.struct(
            v["vehicle_id"].alias("vehicle_id"), F.when(goes(mine[0]), 1).otherwise(2).alias("rank"),
            F.array_max(lost).alias("wait"),
        )

    each = F.transform(S.first_of_id(vehicles), lambda v: F.struct(v.alias("v"), own(v).alias("mine")))
    return F.transform(F.filter(each, lambda e: F.size(e["mine"]) > 0), lambda e: outcome(e["v"], e["mine"]))


def decisions(scenarios: DataFrame, trusted_label: str | None = None) -> DataFrame:
    """One decision per scenario.

    With ``trusted_label`` (a 'yes'/'no' column) a scenario that has any vehicle of unknown
    movement takes its yes/no from that column; pairs and counts stay the rule's.
    """
    keep = [trusted_label] if trusted_label else []
    df = with_pairs(scenarios).withColumn(
        "outcomes", outcome_array(F.col("vehicles"), F.col("pairs"))
    ).withColumn("any_unknown", any_unknown(F.col("vehicles")))
    by_rule = scalar.yes_no(F.size("pairs") > 0)
    label = by_rule
    if trusted_label:
        trust = F.col("any_unknown") & F.col(trusted_label).isNotNull()
        label = F.when(trust, F.col(trusted_label)).otherwise(by_rule)
    return df.select(
        "scenario_id", *keep,
        label.alias("is_conflict"),
        F.size("pairs").alias("number_of_conflicts"),
        "any_unknown",
        F.when(F.size("pairs") > 0, F.array(F.lit("intersection"))).otherwise(F.array().cast("array<string>"))
        .alias("places_of_conflicts"),
        F.transform("pairs", lambda p: F.struct(p["vehicle1_id"], p["vehicle2_id"])).alias("conflict_vehicles"),
        F.transform("pairs", lambda p: yield_text(p["loser_id"], p["winner_id"])).alias("decisions"),
        F.map_from_entries(F.transform("outcomes", lambda o: F.struct(o["vehicle_id"], o["rank"]))).alias("priority_order"),
        F.map_from_entries(F.transform("outcomes", lambda o: F.struct(o["vehicle_id"], o["wait"]))).alias("waiting_times"),
    )


def yield_text(loser: Column, winner: Column) -> Column:
    return fill(C.YIELD_TEXT, loser=loser, winner=winner)


def fallback_decisions(scenarios: DataFrame, label: str) -> DataFrame:
    """The decision for scenarios the rule refuses: on 'yes' the first two vehicles form the one pair."""
    first, second = F.get("vehicles", F.lit(0))["vehicle_id"], F.get("vehicles", F.lit(1))["vehicle_id"]
    yes = F.coalesce(F.col(label) == "yes", F.lit(False))
    pair = yes & (F.size("vehicles") >= 2)
    empty = F.array()
    return scenarios.select(
        "scenario_id",
        scalar.yes_no(yes).alias("is_conflict"),
        yes.cast("int").alias("number_of_conflicts"),
        F.when(pair, F.array(F.struct(first.alias("vehicle1_id"), second.alias("vehicle2_id"))))
        .otherwise(empty.cast("array<struct<vehicle1_id:string,vehicle2_id:string>>")).alias("conflict_vehicles"),
        F.when(pair, F.array(yield_text(second, first))).otherwise(empty.cast("array<string>")).alias("decisions"),
        F.create_map().cast("map<string,int>").alias("priority_order"), F.create_map().cast("map<string,int>").alias("waiting_times"),
    )


def score(
    vehicles: DataFrame, labels: DataFrame | None = None, label: str = "given_label",
    layout: scalar.Layout = C.LAYOUT_EIGHT_LANE,
) -> DataFrame:
    """Batch scoring of a vehicle table: one row per scenario, with a decision or an ``error``.

    The rule only runs on scenarios that meet the contract. ``labels`` (scenario_id and a 'yes'/'no'
    column) gives refused scenarios the fallback decision beside their error.
    """
    status = S.scenario_status(vehicles).select("scenario_id", F.col("reason").alias("error"))
    accepted = status.filter("error is null").select("scenario_id")
    made = decisions(packed(vehicles, layout).join(accepted, "scenario_id", "left_semi"))
    out = status.join(made, "scenario_id", "left")
    if labels is None:
        return out
    refused = status.filter("error is not null").join(labels.select("scenario_id", label), "scenario_id")
    heads = S.heads(vehicles.join(refused.select("scenario_id"), "scenario_id", "left_semi"), 2)
    spare = fallback_decisions(heads.join(refused, "scenario_id"), label)
    shared = [c for c in spare.columns if c != "scenario_id"]
    joined = out.join(spare.withColumnsRenamed({c: f"_{c}" for c in shared}), "scenario_id", "left")
    return joined.select(*[F.coalesce(c, f"_{c}").alias(c) if c in shared else F.col(c) for c in out.columns])
