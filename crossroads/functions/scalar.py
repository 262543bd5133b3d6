"""Row-level expressions over one vehicle, one label or one identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def lane_arrival_s(speed: Column, distance: Column) -> Column:
    """Seconds to the junction as the lane rule computes it; NULL stands for "never" (stopped)."""
    return distance / lane_pace(speed)


def lane_pace(speed: Column) -> Column:
    """Metres a second as the lane rule has them, NULL for a stopped vehicle."""
    return F.when(speed > 0, speed * 1000 / 3600)


def near_arrival_s(speed: Column, distance: Column) -> Column:
    """Seconds to the junction as the near rule computes it (other operand order, other last digit)."""
    return F.when(speed > 0, distance / (speed / 3.6))


def is_near(distance: Column, inclusive: bool = True, limit: float = C.NEAR_DISTANCE_M) -> Column:
    return distance <= limit if inclusive else distance < limit


def direction_code(direction: Column) -> Column:
    """north 0, east 1, south 2, west 3, anything else (NULL too) -1."""
    code = F.lit(-1)
    for i, name in enumerate(C.DIRECTIONS):
        code = F.when(direction == name, i).otherwise(code)
    return code.cast("int")


Layout = dict | DataFrame | Column


def layout_map(layout: Layout) -> Column:
    """A layout as one value: direction -> lane -> destinations in order.

    A dict becomes a literal. A table of one row and one column (``readers.layout_row``) is read once by a scalar
    subquery, however many expressions use it. A column is taken as it is.
    """
    if isinstance(layout, DataFrame):
        return layout.scalar()
    if isinstance(layout, Column):
        return layout
    lanes_of = lambda lanes: F.create_map(*[x for n, reach in lanes.items() for x in (F.lit(n), F.array(*map(F.lit, reach)))])
    return F.create_map(*[x for name, lanes in layout.items() for x in (F.lit(name), lanes_of(lanes))])


def movement(direction: Column, lane: Column, destination: Column, layout: Layout = C.LAYOUT_EIGHT_LANE) -> Column:
    """right / straight / left / unknown, from the position of the destination in the lane's list.

    Even lanes are left-turn lanes. The layout is one small value, so the lookup stays in generated code and needs no join.
    """
    return movement_at(lane, F.array_position(layout_map(layout)[direction][lane.cast("int")], destination))


def movement_at(lane: Column, place: Column) -> Column:
    """The movement to the destination at a place (from 1, 0 for none) in the lane's list."""
    odd = F.get(F.array(F.lit("right"), F.lit("straight"), F.lit("left")), (place - 1).cast("int"))
    return F.coalesce(F.when(lane % 2 == 0, F.when(place > 0, "left")).otherwise(odd), F.lit("unknown"))


def clean_direction(direction: Column) -> Column:
    return F.lower(F.trim(direction))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "yes").otherwise("no")


def label_code(label: Column) -> Column:
    """1 for 'yes', 0 for everything else including NULL."""
    return F.coalesce((label == "yes").cast("int"), F.lit(0))


def answer_label(answer: Column, exact: bool = False) -> Column:
    """yes/no from a free-text answer: contained, or the whole answer with ``exact``."""
    text = F.lower(F.trim(answer))
    return yes_no(text == "yes" if exact else text.contains("yes"))


def band(value: Column, bands: list[tuple[float, float, str]]) -> Column:
    """Name of the right-closed band; a value in none of them (0 among them) gives NULL."""
    return F.coalesce(*[F.when((value > low) & (value <= high), name) for low, high, name in bands])


def speed_band(speed: Column) -> Column:
    return band(speed, C.SPEED_BANDS)


def distance_band(distance: Column) -> Column:
    return band(distance, C.DISTANCE_BANDS)


def density_band(conflicts: Column) -> Column:
    none, one, more = C.DENSITY_NAMES
    return F.when(conflicts == 0, none).when(conflicts == 1, one).otherwise(more)


def lane_parity(lane: Column) -> Column:
    even, odd = C.PARITY_NAMES
    return F.when(lane % 2 == 0, even).otherwise(odd)


def size_band(vehicles: Column) -> Column:
    small, large = C.SIZE_NAMES
    return F.when(vehicles <= C.SMALL_UP_TO, small).otherwise(large)


def own_wait(waits: Column, vehicle_id: Column) -> Column:
    """This vehicle's wait from the scenario's map; absent, NULL or no map gives 0."""
    return F.coalesce(F.try_element_at(waits, vehicle_id), F.lit(0))


def own_priority(ranks: Column, vehicle_id: Column) -> Column:
    """This vehicle's rank; absent, NULL, 0 or no map gives 99."""
    return F.coalesce(F.nullif(F.try_element_at(ranks, vehicle_id), F.lit(0)), F.lit(C.MISSING_PRIORITY))


def md5_number(text: Column, start: int = 0) -> Column:
    """32 bits of the md5 of ``text`` as a number: group ``start`` of four."""
    return F.conv(F.substring(F.md5(text), 8 * start + 1, 8), 16, 10).cast("long")


def md5_mod_100(text: Column) -> Column:
    """The whole 128-bit md5 modulo 100, folded from four 32-bit groups."""
    weights = [pow(2, 32 * (3 - i), 100) for i in range(4)]
    return sum((md5_number(text, i) * w for i, w in enumerate(weights)), F.lit(0)) % 100


def route(request_id: Column, share_a: float = 0.5) -> Column:
    """Stable A/B routing of a request id; the share is truncated to whole percent."""
    return F.when(md5_mod_100(request_id) < int(share_a * 100), "A").otherwise("B")


def python_literal(text: Column, schema) -> Column:
    """Python dict or list text (single quotes, None) as a typed value; bad text gives NULL."""
    plain = text
    for name, value in (("None", "null"), ("True", "true"), ("False", "false")):
        spelled = F.regexp_replace(plain, rf"(^|[\[:,]\s*){name}(?=\s*($|[,\]}}]))", f"$1{value}")
        plain = F.when(text.contains(name), spelled).otherwise(plain)
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return F.from_json(plain, ddl, {"allowSingleQuotes": "true"})


def reply_is_valid(reply: Column, required: list[str] = C.REQUIRED_REPLY_KEYS) -> Column:
    """True when the reply is a JSON object that holds all required keys."""
    keys = F.json_object_keys(reply)
    missing = F.array_except(F.array(*map(F.lit, required)), keys)
    return F.coalesce(F.size(missing) == 0, F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.when(whole != 0, part / whole).otherwise(0.0)
