"""What-if copies of scenarios: change one thing, predict again, count flipped answers.

Two forms with the same records:

* ``records`` takes any predictor, a function that adds a ``prediction`` column to scenario
  rows. All copies of a feature go through one predictor pass; nothing loops over deltas.
* ``lane_records`` and ``single_vehicle_records`` are for the lane rule. It decides by
  pairs, so a delta only re-tests pairs whose paths cross, and a change to one vehicle only
  re-tests that vehicle's pairs. All work stays within the scenario's partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from . import lane, prefix

Predictor = Callable[[DataFrame], DataFrame]


def lane_rule(scenarios: DataFrame) -> DataFrame:
    """The lane rule as a predictor; rows that bring the list of ``lane.with_close`` only have the paths of its pairs tested."""
    if "close" not in scenarios.columns:
        return lane.with_label(scenarios, "prediction")
    return scenarios.withColumn("prediction", scalar.yes_no(lane.any_crossing(F.col("vehicles"), F.col("close"))))


#: What the predictor wants made once for a scenario and all its copies that leave arrivals and the order of the list alone.
lane_rule.once = lane.with_close


def with_layout(scenarios: DataFrame, layout: scalar.Layout) -> DataFrame:
    """Adds the layout as a column: lists are changed by functions over arrays, which take columns but no subqueries."""
    return scenarios.withColumn("layout", scalar.layout_map(layout))


def refreshed(v: Column, layout: scalar.Layout | None = None, **changed: Column) -> Column:
    """The vehicle with changed fields and the prepared fields that depend on them; a new movement is read from ``layout``."""
    now = lambda f: changed.get(f, v[f])
    if "speed" in changed or "distance_to_intersection" in changed:
        changed["t"] = scalar.lane_arrival_s(now("speed"), now("distance_to_intersection"))
    if "lane" in changed or "destination" in changed:
        changed["m"] = scalar.movement(v["direction"], now("lane"), now("destination"), layout)
    for field, value in changed.items():
        v = v.withField(field, value)
    return v


def _floored(value: Column, delta: Column) -> Column:
    return F.greatest(F.lit(C.PERTURBED_FLOOR), value + delta)


def _lanes_of(direction: Column) -> Column:
    """The lanes of a direction in ``layout``; those of the north for an unknown direction."""
    layout = F.col("layout")
    return F.map_keys(F.coalesce(layout[direction], layout["north"]))


def _destinations_of(direction: Column) -> Column:
    """All destinations of a direction in layout order; every letter of the layout for an unknown direction."""
    reach = lambda lanes: F.flatten(F.map_values(lanes))
    layout = F.col("layout")
    every = F.flatten(F.transform(F.map_values(layout), reach))
    return F.coalesce(reach(layout[direction]), F.array_sort(F.array_distinct(every)))


def _without(items: Column, own: Column) -> Column:
    """The items other than ``own``; none when that is NULL."""
    return F.when(own.isNotNull(), F.array_remove(items, own)).otherwise(F.slice(items, 1, 0))


def lane_alternative(v: Column) -> Column:
    """The first other lane of the vehicle's own direction."""
    return F.get(_without(_lanes_of(v["direction"]), v["lane"]), F.lit(0))


def destination_alternatives(v: Column) -> Column:
    """Up to three other destinations of the direction, in layout order."""
    return F.slice(_without(_destinations_of(v["direction"]), v["destination"]), 1, C.DESTINATION_VARIANTS)


# --- copies, for any predictor ---------------------------------------------------


def shifted(scenarios: DataFrame, feature: str) -> DataFrame:
    """One copy per delta, all vehicles changed together."""
    field, deltas = {
        "speed": ("speed", C.SPEED_DELTAS),
        "distance": ("distance_to_intersection", C.DISTANCE_DELTAS),
    }[feature]
    out = scenarios.withColumn("delta", F.explode(F.array(*map(F.lit, deltas))))
    change = lambda v: refreshed(v, **{field: _floored(v[field], F.col("delta"))})
    return out.withColumn("vehicles", F.transform("vehicles", change))


def _one_changed(
    scenarios: DataFrame, field: str, choices: Callable[[Column], Column], label: Callable, layout: scalar.Layout
) -> DataFrame:
    """One copy per vehicle and choice; ``label`` names the copy from (vehicle index, choice index).

    The layout is only beside a vehicle while its choices are listed; vehicles are read from the list by their index and
    copies put together from slices of it, in generated code.
    """
    each = with_layout(scenarios.select("*", F.posexplode("vehicles").alias("i", "v")), layout)
    each = each.withColumn("_choices", choices(F.col("v"))).drop("layout", "v")
    # the outer form: the plain one would list all choices a second time, to ask whether there are any
    each = each.select("*", F.posexplode_outer("_choices").alias("k", "choice")).drop("_choices").filter("k is not null")
    new = refreshed(F.get("vehicles", F.col("i")), layout, **{field: F.col("choice")})
    copy = F.concat(F.slice("vehicles", F.lit(1), F.col("i")), F.array(new), F.slice("vehicles", F.col("i") + 2, F.size("vehicles")))
    return each.withColumn("delta", label(F.col("i"), F.col("k"))).withColumn("vehicles", copy).drop("i", "k", "choice")


def lane_swapped(scenarios: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    choice = lambda v: F.filter(F.array(lane_alternative(v)), lambda x: x.isNotNull())
    return _one_changed(scenarios, "lane", choice, lambda i, k: i, layout)


def rerouted(scenarios: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    return _one_changed(scenarios, "destination", destination_alternatives, lambda i, k: k, layout)


def _order_names(shuffles: int) -> list[str]:
    return ["reverse"] + [f"shuffle{k}" for k in range(1, shuffles + 1)]


def _draws(name: Column, seed: int) -> Column:
    """The draw of each vehicle in the named order: a hash of the name and the vehicle."""
    drawn = lambda start, v: F.md5(F.coalesce(F.concat(start, F.lit("|"), v["seq"].cast("string")), start))
    # named by a function of its own, the start of all texts is made once
    of_start = lambda start: F.transform("vehicles", lambda v: drawn(start, v))
    return F.get(F.transform(F.array(F.concat_ws("|", F.lit(seed), name, F.col("scenario_id"))), of_start), F.lit(0))


def _order(name: Column, seed: int) -> Column:
    """The places in ``vehicles`` in the named order: reversed, or by their draws."""
    drawn = F.array_sort(F.transform(_draws(name, seed), lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    index = F.transform("vehicles", lambda v, i: i)
    return F.when(name == "reverse", F.reverse(index)).otherwise(F.transform(drawn, lambda x: x["i"]))


def reordered(scenarios: DataFrame, shuffles: int = 3, seed: int = 7, always_reverse: bool = False) -> DataFrame:
    """The reversed list and ``shuffles`` hash-ordered ones; copies equal to the original are left out."""
    out = scenarios.withColumn("delta", F.explode(F.array(*map(F.lit, _order_names(shuffles)))))
    out = out.withColumn("order", _order(F.col("delta"), seed))
    same = F.col("order") == F.transform("vehicles", lambda v, i: i)
    keep = ~same | (F.col("delta") == "reverse") if always_reverse else ~same
    place = F.transform("order", lambda i, j: F.get("vehicles", i).withField("seq", j + 1))
    return out.filter(keep).withColumn("vehicles", place).drop("order")


COPIES: dict[str, Callable[[DataFrame, scalar.Layout], DataFrame]] = {
    "speed": lambda s, _: shifted(s, "speed"),
    "distance": lambda s, _: shifted(s, "distance"),
    "lane": lane_swapped,
    "destination": rerouted,
    "vehicle_order": lambda s, _: reordered(s),
}
ONE_MOVEMENT = ("lane", "destination")  # copies that leave arrivals and the order of the list alone


def records(
    scenarios: DataFrame, feature: str, predictor: Predictor = lane_rule, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE
) -> DataFrame:
    """One row per perturbed copy: base and new prediction, and whether they differ.

    ``layout`` is the one the scenarios were prepared with; other lanes, destinations and movements come from it.
    """
    rows = scenarios.select("scenario_id", "vehicles")
    once = getattr(predictor, "once", None) if feature in ONE_MOVEMENT else None
    rows = once(rows) if once else rows
    base = predictor(rows).withColumnRenamed("prediction", "base_pred")
    copies = COPIES[feature](base.select(*rows.columns, "base_pred"), layout)
    made = predictor(copies).withColumnRenamed("prediction", "perturbed_pred")
    return made.select(
        "scenario_id", F.lit(feature).alias("feature"), F.col("delta").cast("string").alias("delta"),
        "base_pred", "perturbed_pred", (F.col("base_pred") != F.col("perturbed_pred")).alias("changed"),
        F.size("vehicles").alias("n_vehicles"),
    )


# --- the lane rule by pairs ------------------------------------------------------


def lane_records(scenarios: DataFrame, *features: str) -> DataFrame:
    """``records`` of speed and distance shifts under the lane rule, both in one pass when asked.

    Whether paths cross does not depend on the shift, so only crossing pairs meet the deltas.
    The first vehicle meets itself once, which keeps scenarios without crossing pairs. The answers to all shifts are
    one short row per scenario while pairs are counted; a row per shift only goes out.
    """
    a, b = F.col("a"), F.col("b")
    first = scenarios.select("scenario_id", F.size("vehicles").alias("n_vehicles"), "vehicles",
                             F.posexplode_outer("vehicles").alias("i", "a"))
    start = F.when(F.col("i") == 0, 1).otherwise(F.col("i") + 2)
    both = first.select("scenario_id", "n_vehicles", "i", "a",
                        F.posexplode_outer(F.slice("vehicles", start, F.size("vehicles"))).alias("j", "b"))  # no partner, no path
    itself = (F.col("i") == 0) & (F.col("j") == 0)
    crossing = both.filter(itself | lane.paths_cross(a, b))
    deltas = {"speed": C.SPEED_DELTAS, "distance": C.DISTANCE_DELTAS}
    shifts = [(f, x) for f in features for x in deltas[f]]
    moved = lambda f, x, v: scalar.lane_arrival_s(
        _floored(v["speed"], F.lit(x)) if f == "speed" else v["speed"],
        _floored(v["distance_to_intersection"], F.lit(x)) if f == "distance" else v["distance_to_intersection"])
    close = lambda t1, t2: F.coalesce(F.abs(t1 - t2) <= C.ARRIVAL_GAP_S, F.lit(False))
    out = crossing.groupBy("scenario_id", "n_vehicles").agg(
        F.max(~itself & close(a["t"], b["t"])).alias("base"),
        *[F.max(~itself & close(moved(f, x, a), moved(f, x, b))).alias(f"new_{k}") for k, (f, x) in enumerate(shifts)],
    )
    each = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(x).alias("delta"), F.col(f"new_{k}").alias("new")) for k, (f, x) in enumerate(shifts)])
    return _as_records(out.select("scenario_id", "n_vehicles", "base", F.inline(each)))


def _as_records(df: DataFrame) -> DataFrame:
    base, new = F.col("base"), F.col("new")
    return df.select(
        "scenario_id", "feature", F.col("delta").cast("string").alias("delta"),
        scalar.yes_no(base).alias("base_pred"), scalar.yes_no(new).alias("perturbed_pred"),
        (base != new).alias("changed"), "n_vehicles",
    )


def _orders(scenarios: DataFrame, shuffles: int, seed: int, always_reverse: bool, keep: list[str] = []) -> DataFrame:
    """One row per scenario: the base and, in ``orders``, each order's answer and whether it is tested.

    Draws are made once per scenario, vehicles are cut to what the rule reads. A pair meets the rule both ways; an order
    takes the answer for the vehicle that comes first there, looked up only in scenarios with a pair whose answer depends
    on that. An order that turns no pair round is the original.
    """
    names = _order_names(shuffles)
    vs = F.transform("vehicles", lambda v, i: F.struct(*_path(v), i.alias("i")))
    # the reversed list needs no draws: it turns every pair round
    ordered = scenarios.select(
        "scenario_id", *keep, F.size("vehicles").alias("n_vehicles"), vs.alias("vs"), *[_draws(F.lit(n), seed).alias(n) for n in names[1:]])
    # only pairs in which the rule says yes at least one way are kept
    met = lane.pairs_within(F.col("vs"), lambda a, b: lane.arrivals_close(a, b) & (_crosses(a, b) | _crosses(b, a)), lambda a, b: F.struct(
        a["i"].alias("i"), b["i"].alias("j"), _crosses(a, b).alias("ahead"), _crosses(b, a).alias("turned")))
    both = ordered.select("scenario_id", *keep, "n_vehicles", *names[1:], met.alias("met"))
    both = both.withColumns({
        "base": F.exists("met", lambda p: p["ahead"]), "either_way": F.exists("met", lambda p: p["ahead"] & p["turned"]),
        "depends": F.exists("met", lambda p: p["ahead"] != p["turned"])})
    # drawn places: ties keep the order of the list
    turned = lambda n, p: F.lit(True) if n == "reverse" else F.get(F.col(n), p["i"]) > F.get(F.col(n), p["j"])
    # an order moves something when some draw is below the one before it
    moved = lambda n: F.col("n_vehicles") > 1 if n == "reverse" else F.sort_array(n) != F.col(n)
    tested = lambda n: F.col("n_vehicles") > 0 if n == "reverse" and always_reverse else moved(n)
    orders = F.array(*[F.struct(
        F.lit(n).alias("delta"), F.when(~F.col("depends"), F.col("base")).otherwise(F.col("either_way") | F.exists(
            "met", lambda p: F.when(turned(n, p), p["turned"]).otherwise(p["ahead"]))).alias("new"),  # noqa: B023
        tested(n).alias("tested"),
    ) for n in names])
    return both.select("scenario_id", *keep, "n_vehicles", F.lit("vehicle_order").alias("feature"), "base", orders.alias("orders"))


def order_records(scenarios: DataFrame, shuffles: int = 3, seed: int = 7, always_reverse: bool = False) -> DataFrame:
    """``records`` of the vehicle order under the lane rule, the base and every order in one pass over half of the pairs."""
    told = _orders(scenarios, shuffles, seed, always_reverse)
    return _as_records(told.select("scenario_id", "n_vehicles", "feature", "base", F.inline_outer("orders")).filter("tested"))


def _with_order_flips(scenarios: DataFrame, shuffles: int, seed: int = 7) -> DataFrame:
    """(scenario_id, vehicles) with tests and flips of ``order_records``, the reversed list always tested, counted in the scenario's row."""
    told = _orders(scenarios, shuffles, seed, True, ["vehicles"])
    each = [F.get("orders", F.lit(k)) for k in range(len(_order_names(shuffles)))]
    count = lambda flags: sum((F.when(f, 1).otherwise(0) for f in flags), F.lit(0))
    return told.select("scenario_id", "vehicles", count([x["tested"] for x in each]).alias("n_vehicle_order"), count([
        x["tested"] & (x["new"] != F.col("base")) for x in each]).alias("vehicle_order"))


def _path(v: Column) -> list[Column]:
    """What pairs are tested by: arrival, path and the paths that cross it."""
    return [v["t"].alias("t"), lane.path_bit(v).alias("bit"), lane.crossed_bits(v).alias("crosses")]


def _crosses(a: Column, b: Column) -> Column:
    return lane.shares(a["crosses"], b["bit"])


#: What changes to a vehicle are made of; columns of their own, not a struct, once vehicles are rows.
OWN = ["seq", "d", "direction", "lane", "destination", "speed", "distance_to_intersection"]


def _own() -> dict[str, Column]:
    return {f: F.col(f) for f in OWN}


def _met_by_vehicle(scenarios: DataFrame, shifts: bool, layout: scalar.Layout, keep: list[str] = []) -> DataFrame:
    """One row per vehicle with its fields ``OWN``, whether its scenario has a conflict (``base``), one without it (``others``), and whom it may meet.

    ``close`` are the paths of those that arrive close to it, as bits, ``crossing`` the arrivals of those whose paths cross its own,
    made for ``shifts``. Lists are only walked to make these two; what a change leads to is tested in generated code.
    """
    listed = scenarios.select(
        "scenario_id", "vehicles", *keep, F.transform("vehicles", lambda v: v["t"]).alias("ts"),
        F.transform("vehicles", lane.path_bit).alias("bits"), F.transform("vehicles", lane.crossed_bits).alias("crosses"))
    # lists of numbers, not of structs; a vehicle's own path crosses neither its own nor any new one of its direction
    close_to = lambda at: F.zip_with("ts", "bits", lambda t, bit: F.when(lane.arrivals_close({"t": t}, {"t": at}), bit).otherwise(0))
    crossing_times = lambda x: F.filter(
        F.zip_with("ts", "bits", lambda t, bit: F.when(lane.shares(x, bit), t)), lambda t: t.isNotNull())
    met = listed.select("scenario_id", "vehicles", *keep, "crosses", F.transform("ts", close_to).alias("met"), *(
        [F.transform("crosses", crossing_times).alias("crossing")] if shifts else []))
    counted = met.withColumns({
        "own": F.zip_with("met", "crosses", lambda bits, x: F.size(F.filter(bits, lambda bit: lane.shares(x, bit)))),
        "close": F.transform("met", lambda bits: F.aggregate(bits, F.lit(0), lambda x, bit: x.bitwiseOR(bit)))})
    # the outer form, here and below: the plain one would make the lists a second time, to ask whether there is anything in them
    one = counted.select(
        "scenario_id", *keep, F.size("vehicles").alias("n_vehicles"), F.get("vehicles", F.lit(0))["direction"].alias("first_direction"), "own", "close",
        *(["crossing"] if shifts else []), (F.aggregate("own", F.lit(0), lambda n, own: n + own) / 2).alias("total"),
        F.posexplode_outer("vehicles").alias("i", "a")).filter("i is not null")
    at = lambda name: F.get(name, F.col("i"))
    vehicle = one.select(
        "scenario_id", *keep, "n_vehicles", "first_direction", *[F.col("a")[f].alias(f) for f in OWN], at("close").alias("close"),
        (at("crossing") if shifts else F.lit(None).cast("array<double>")).alias("crossing"),
        (F.col("total") > 0).alias("base"), (F.col("total") - at("own") > 0).alias("others"),
    )
    return with_layout(vehicle, layout)


def _other_lanes(a: dict[str, Column], of_first: bool) -> Column:
    lanes = _without(_lanes_of(F.col("first_direction") if of_first else a["direction"]), a["lane"])
    return lanes if of_first else F.slice(lanes, 1, 1)


def _on_lane(lane_no: Column, destination: Column) -> Column:
    """The paths that cross the vehicle's own to another destination, or from another lane."""
    return lane.crossed_bits({"d": F.col("d"), "m": scalar.movement(F.col("direction"), lane_no, destination, F.col("layout"))})


def _to_destination(k: int) -> Column:
    """The paths that cross the vehicle's own to its k-th other destination."""
    return lane.crossed_bits({"d": F.col("d"), "m": scalar.movement_at(F.col("lane"), F.col(f"place_{k}"))})


def _hit_in_time(new_t: Column) -> Column:
    return F.coalesce(F.exists("crossing", lambda t: F.abs(t - new_t) <= C.ARRIVAL_GAP_S), F.lit(False))


def single_vehicle_records(
    scenarios: DataFrame, features: list[str], lanes_of_first: bool = False, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE
) -> DataFrame:
    """One row per changed vehicle and choice under the lane rule: feature, delta, base, new, changed.

    A scenario's other pairs keep their answer (``others``), so only the changed vehicle's own
    pairs count. A shift leaves movements alone and only needs the arrivals of the partners it
    crosses; a new lane or destination leaves arrivals alone and only needs the paths of
    the partners that arrive close to it. Both are made once per vehicle.

    With ``lanes_of_first`` every vehicle tries the lanes of the first vehicle's direction, as
    the sensitivity score does; otherwise the lane of its own direction it is not in.
    """
    shifts = bool({"speed", "distance"} & set(features))
    a = _own()
    vehicle = _met_by_vehicle(scenarios, shifts, layout).withColumns({
        "try_lane": _other_lanes(a, lanes_of_first), "try_destination": destination_alternatives(a)})
    # a choice is a feature and a number; what it leads to is worked out in its own row
    shift_of = {"speed": C.SPEED_DELTAS, "distance": C.DISTANCE_DELTAS}
    how_many = {f: len(x) for f, x in shift_of.items()} | {"lane": 1, "destination": C.DESTINATION_VARIANTS}
    choice = lambda f, k: F.struct(F.lit(f).alias("feature"), k.alias("k"))
    choices = F.array(*[choice(f, F.lit(k)) for f in features if f != "lane" or not lanes_of_first for k in range(how_many[f])])
    if "lane" in features and lanes_of_first:
        lanes = F.transform("try_lane", lambda x, k: choice("lane", k))
        choices = F.concat(choices, lanes) if len(features) > 1 else lanes
    each = vehicle.select("*", F.inline_outer(choices))
    of = lambda name: F.col("feature") == name
    new_lane, new_destination = F.get("try_lane", F.col("k")), F.get("try_destination", F.col("k"))
    shift = {f: F.get(F.array(*[F.lit(float(x)) for x in xs]), F.col("k")) for f, xs in shift_of.items()}
    made = F.when(of("lane"), new_lane.isNotNull()).when(of("destination"), new_destination.isNotNull()).otherwise(F.col("feature").isNotNull())
    # the lane's delta is the vehicle's index in the list; in the score it only tells copies apart
    delta = F.when(of("lane"), F.col("k") if lanes_of_first else F.col("seq") - 1).otherwise(F.col("k"))
    for f, xs in shift_of.items():
        delta = F.when(of(f), F.get(F.array(*map(F.lit, xs)), F.col("k"))).otherwise(delta)
    way = _on_lane(F.when(of("lane"), new_lane).otherwise(F.col("lane")), F.when(of("destination"), new_destination).otherwise(F.col("destination")))
    hit = lane.shares(way, F.col("close"))
    if shifts:
        moved = lambda f, field: F.when(of(f), _floored(F.col(field), shift[f])).otherwise(F.col(field))
        new_t = scalar.lane_arrival_s(moved("speed", "speed"), moved("distance", "distance_to_intersection"))
        hit = F.when(of("lane") | of("destination"), hit).otherwise(_hit_in_time(F.col("new_t")))
        each = each.withColumn("new_t", new_t)
    return _as_records(each.filter(made).withColumns({"delta": delta, "new": F.col("others") | hit}))


def single_vehicle_scores(scenarios: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """(scenario_id, feature, score): flips per test of ``single_vehicle_records`` with all four features and ``lanes_of_first``."""
    return _scores(scenarios, layout, [])


def scores(scenarios: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE, shuffles: int = 4) -> DataFrame:
    """``single_vehicle_scores`` and those of ``order_records``, whose reversed list is always tested, in one pass over the scenarios."""
    return _scores(_with_order_flips(scenarios, shuffles), layout, ["vehicle_order"])


def _scores(scenarios: DataFrame, layout: scalar.Layout, counted_before: list[str]) -> DataFrame:
    """Scores by feature; those ``counted_before`` have their flips and tests in the scenario's row.

    The choices of a vehicle are counted in its row; a scenario adds up one short row per vehicle, not one per choice. A
    vehicle without which there is still a conflict flips nothing, nor does one that meets nobody before or after.
    """
    base, speed, distance = F.col("base"), F.col("speed"), F.col("distance_to_intersection")
    # what is read more than once gets a column, so that generated code stays short enough to be compiled
    of_scenario = [c for f in counted_before for c in (f, f"n_{f}")]
    vehicle = _met_by_vehicle(scenarios, True, layout, of_scenario).withColumns({
        "try_lane": _other_lanes(_own(), True), "try_destination": destination_alternatives(_own()),
        "reach": F.col("layout")[F.col("direction")][F.col("lane").cast("int")], "pace": scalar.lane_pace(speed)})
    to = lambda k: F.get("try_destination", F.lit(k))
    vehicle = vehicle.withColumns({
        "try_speed": F.array(*[scalar.lane_arrival_s(_floored(speed, F.lit(x)), distance) for x in C.SPEED_DELTAS]),
        "try_distance": F.array(*[_floored(distance, F.lit(x)) / F.col("pace") for x in C.DISTANCE_DELTAS]),
        **{f"place_{k}": F.array_position("reach", to(k)) for k in range(C.DESTINATION_VARIANTS)},
    })
    by_way = lambda crosses: lane.shares(crosses, F.col("close"))
    in_time = lambda f: F.when(F.size("crossing") > 0, F.size(F.filter(f, lambda t: _hit_in_time(t) != base))).otherwise(0)
    at = [F.when(to(k).isNotNull() & (by_way(_to_destination(k)) != base), 1).otherwise(0) for k in range(C.DESTINATION_VARIANTS)]
    flips = {
        "speed": in_time("try_speed"), "distance": in_time("try_distance"),
        "lane": F.when(F.col("close") != 0, F.size(F.filter("try_lane", lambda x: by_way(_on_lane(x, F.col("destination"))) != base))).otherwise(0),
        "destination": sum(at[1:], at[0]),
    }
    counted = vehicle.select("scenario_id", *of_scenario, *[F.size(f"try_{f}").alias(f"n_{f}") for f in flips], *[
        F.when(F.col("others"), 0).otherwise(n).alias(f) for f, n in flips.items()])
    sums = counted.groupBy("scenario_id").agg(*[(F.max if c in of_scenario else F.sum)(c).alias(c) for c in counted.columns[1:]])
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("long").alias("flips"), F.col(f"n_{f}").cast("long").alias("n"))
                     for f in [*flips, *counted_before]])
    return sums.select("scenario_id", F.inline(each)).filter("n > 0").select("scenario_id", "feature", (F.col("flips") / F.col("n")).alias("score"))


def all_records(scenarios: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """The five robustness tests under the lane rule, in one table."""
    return prefix.union_all([
        lane_records(scenarios, "speed", "distance"),
        single_vehicle_records(scenarios, ["lane", "destination"], layout=layout),
        order_records(scenarios),
    ])


# --- tables over the records --------------------------------------------------------


def flip_rates(recs: DataFrame, digits: int = 4) -> DataFrame:
    """Tests, flips and rate per feature (delta NULL) and per (feature, delta), in one pass."""
    per_delta = recs.groupBy("feature", "delta").agg(
        F.count("*").alias("n"), F.count_if("changed").alias("flips")
    )
    return (
        per_delta.groupingSets([["feature"], ["feature", "delta"]], "feature", "delta")
        .agg(F.sum("n").alias("tests"), F.sum("flips").alias("flips"))
        .withColumn("flip_rate", F.round(F.col("flips") / F.col("tests"), digits))
    )


def by_magnitude(recs: DataFrame) -> DataFrame:
    return recs.groupBy("feature", F.abs(F.col("delta").try_cast("int")).alias("magnitude")).agg(
        F.count("*").alias("tests"), F.round(F.avg(F.col("changed").cast("int")), 4).alias("flip_rate")
    )


def stability(rates: DataFrame) -> DataFrame:
    """Mean of 1 - rate over the features present; 1 when there are none."""
    return rates.filter("delta is null").agg(
        F.count("*").alias("n_features"),
        F.round(F.coalesce(F.avg(1 - F.col("flip_rate")), F.lit(1.0)), 4).alias("overall_stability"),
    )


def feature_ranking(rates: DataFrame) -> DataFrame:
    """Features by flip rate, the fixed order on ties."""
    names = F.array(*map(F.lit, C.PERTURBED_FEATURES))
    rows = rates.filter("delta is null").withColumn("ordinal", F.array_position(names, F.col("feature")))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("flip_rate"), "ordinal"))
    return rows.select("feature", "flip_rate", place.alias("place"))  # at most five rows


def speed_table(rates: DataFrame) -> DataFrame:
    rows = rates.filter((F.col("feature") == "speed") & F.col("delta").isin([str(x) for x in C.SPEED_TABLE_DELTAS]))
    return rows.select(
        "feature", F.concat(F.lit("+"), "delta", F.lit(" km/h")).alias("delta"), "flip_rate",
        F.concat(F.lit("40 km/h → "), (40 + F.col("delta").cast("int")).cast("string"), F.lit(" km/h")).alias("example"),
        F.when(F.col("flip_rate") > 0.5, "Yes (flipped)").otherwise("No (stable)").alias("decision_changed"),
    )


def heat_table(recs: DataFrame) -> DataFrame:
    """Product of the speed and distance flip rates for each pair of deltas (ten by ten)."""
    rate = F.avg(F.col("changed").cast("int"))
    per = recs.filter(F.col("feature").isin("speed", "distance")).groupBy("feature", "delta").agg(rate.alias("rate"))
    side = lambda name: F.array_agg(F.when(F.col("feature") == name, F.struct("delta", "rate")))
    both = per.agg(side("speed").alias("s"), side("distance").alias("d"))  # twenty rows by construction
    return both.select(F.explode("s").alias("s"), "d").select("s", F.explode("d").alias("d")).select(
        F.col("s.delta").cast("int").alias("speed_delta"), F.col("d.delta").cast("int").alias("distance_delta"),
        F.round(F.col("s.rate") * F.col("d.rate"), 6).alias("product"),
    )


def sensitivity(scenarios: DataFrame, layout: scalar.Layout = C.LAYOUT_EIGHT_LANE) -> DataFrame:
    """Per feature: mean over scenarios of flips per test (0 where nothing was tested), and its share of the largest."""
    sums = scores(scenarios, layout).groupBy("feature").agg(F.sum("score").alias("total"), F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(0))  # over at most five rows
    # the order feature tests every scenario, so its count is the number of scenarios
    scenarios_n = F.max(F.when(F.col("feature") == "vehicle_order", F.col("n"))).over(everything)
    rows = sums.select("feature", F.round(F.col("total") / scenarios_n, 4).alias("importance"))
    top = F.max("importance").over(everything)
    return rows.select(
        "feature", "importance",
        F.round(F.col("importance") / F.when(top == 0, 1.0).otherwise(top), 4).alias("normalised"),
    )
