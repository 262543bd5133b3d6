"""Sentences and chat records from scenario rows. Templates are fixed formats."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def fixed(x: Column, digits: int) -> Column:
    """A non-negative double with ``digits`` decimals, rounded by its exact binary value, ties to even.

    The fraction is taken apart into two exact halves, so 45.25 gives 45.2 and 45.45, which is
    stored a little larger, gives 45.5. (``format_string`` rounds the shortest decimal form half up.)
    """
    n, unit, half = 10**digits, 2**26, 2**25
    whole = F.floor(x)
    part = (x - whole) * unit
    high = F.floor(part)
    low = (part - high) * n
    steps = high * n + F.floor(low)
    k, rest = F.floor(steps / unit).cast("long"), steps % unit
    beyond = (rest > half) | ((rest == half) & (low > F.floor(low)))
    tie_up = (rest == half) & (low == F.floor(low)) & (k % 2 == 1)
    k = F.when(beyond | tie_up, k + 1).otherwise(k)
    carry = F.when(k == n, 1).otherwise(0)
    return F.concat(
        (whole + carry).cast("string"), F.lit("."), F.lpad((k % n).cast("string"), digits, "0")
    )


def _two(x: Column) -> Column:
    return fixed(x, 2)


def fill(template: str, **values: Column | str) -> Column:
    """A fixed format with its {names} replaced by columns."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(values[name] if isinstance(values[name], Column) else F.lit(values[name]))
    return F.concat(*parts)


def _sentence(template: str, v: Column, **numbers: Column) -> Column:
    return fill(template, vehicle_id=v["vehicle_id"], lane=v["lane"].cast("string"), direction=v["direction"],
                destination=v["destination"], **numbers)


def scenario_text(vehicles: Column) -> Column:
    """One sentence per vehicle, joined by a space."""
    say = lambda v: _sentence(C.SCENARIO_SENTENCE, v, speed=_two(v["speed"]), distance=_two(v["distance_to_intersection"]))
    return F.array_join(F.transform(vehicles, say), " ")


def report_text(vehicles: Column) -> Column:
    """The readable report, one line per vehicle."""
    say = lambda v: _sentence(C.REPORT_SENTENCE, v, speed=_two(v["speed"]), distance=_two(v["distance_to_intersection"]))
    return F.array_join(F.transform(vehicles, say), "\n")


def arrival_text(vehicles: Column) -> Column:
    """One line per vehicle with its time of arrival; a stopped vehicle counts as 0.1 m/s."""
    eta = lambda v: v["distance_to_intersection"] / F.greatest(v["speed"] * 1000 / 3600, F.lit(0.1))
    say = lambda v: _sentence(C.ARRIVAL_SENTENCE, v, speed=fixed(v["speed"], 1),
                              distance=fixed(v["distance_to_intersection"], 1), eta=_two(eta(v)))
    return F.array_join(F.transform(vehicles, say), "\n")


def analysis_text(decision: dict[str, Column]) -> Column:
    """The analysis report of one decision: status, pairs, actions, ranks (NULL ones left out), waits."""
    say = C.ANALYSIS
    pairs, actions = decision["conflict_vehicles"], decision["decisions"]
    pair_list = F.transform(pairs, lambda p: fill(say["pair"], first=p["vehicle1_id"], second=p["vehicle2_id"]))

    def listing(title: str, line: str, entries: Column, otherwise: str) -> Column:
        shown = F.filter(F.map_entries(entries), lambda e: e["value"].isNotNull())
        lines = F.transform(shown, lambda e: fill(line, vehicle_id=e["key"], value=e["value"].cast("string")))
        body = F.concat(F.lit(title + "\n"), F.array_join(lines, "\n"))
        return F.when(F.size(entries) > 0, body).otherwise(otherwise)

    found = F.concat_ws(
        "\n", F.lit(say["found"]), fill(say["count"], n=decision["number_of_conflicts"].cast("string")),
        F.when(F.size(pairs) > 0, fill(say["involved"], pairs=F.array_join(pair_list, ", "))).otherwise(say["no_pairs"]),
        F.lit(say["actions"]),
        F.when(F.size(actions) > 0, F.array_join(actions, "\n")).otherwise(say["no_actions"]),
        listing(say["ranks"], say["rank"], decision["priority_order"], say["no_ranks"]),
        listing(say["waits"], say["wait"], decision["waiting_times"], say["no_waits"]),
    )
    return F.when(decision["is_conflict"] == "no", say["none"]).otherwise(found)


def rule_reason(rule: Column, winner: Column, loser: Column) -> Column:
    """Why the winner of a pair goes first."""
    why = {
        "arrival time": "arrives more than a second earlier",
        "straight priority": "goes straight while the other turns",
        "right-turn priority": "turns right while the other turns left",
        "right-hand rule": "comes from the right",
    }
    text = F.lit("has priority")
    for name, clause in why.items():
        text = F.when(rule == name, clause).otherwise(text)
    return F.concat(F.lit("Vehicle "), winner, F.lit(" goes before Vehicle "), loser, F.lit(": it "), text)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_messages(system: str, question: Column, answer: Column | None = None,
                  examples: list[tuple[str, str]] = ()) -> Column:
    """system, optional example pairs, question and, for training, the answer."""
    parts = [message("system", F.lit(system))]
    for asked, told in examples:
        parts += [message("user", F.lit(asked)), message("assistant", F.lit(told))]
    parts.append(message("user", question))
    if answer is not None:
        parts.append(message("assistant", answer))
    return F.array(*parts)


def label_question(vehicles: Column) -> Column:
    return F.concat(F.lit(C.CHAT_QUESTION), scenario_text(vehicles))
