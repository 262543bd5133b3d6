"""Training and evaluation sets: chat records from scenarios, and their sinks' row form."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar, text
from . import lane, sampling
from . import scenarios as S


def layout_prompt(layout: dict = C.LAYOUT_EIGHT_LANE) -> str:
    """The default instruction: the layout as JSON and the form of the answer."""
    return (
        "Junction layout as JSON (approach, lane, exits): " + json.dumps(layout)
        + "\nAnswer yes if the paths of any two of the listed vehicles clash in time, no if none do. One word."
    )


def label_records(scenarios: DataFrame, label: str, system: str | None = None) -> DataFrame:
    """(scenario_id, messages): question about the scenario text, answer yes/no."""
    messages = text.chat_messages(system or layout_prompt(), text.label_question(F.col("vehicles")), F.col(label))
    return scenarios.select("scenario_id", messages.alias("messages"))


def decision_records(scenarios: DataFrame, system: str, max_examples: int | None = None) -> DataFrame:
    """(scenario_id, messages): the scenario as JSON, answered by the whole decision as JSON."""
    if max_examples is not None:
        scenarios = sampling.first_n(scenarios, max_examples)
    asked = S.to_json_text(scenarios).select(
        "scenario_id", F.regexp_replace("scenario", "^\\{\"vehicles_scenario\"", "{\"vehicles\"").alias("question")
    )
    answer = F.to_json(F.struct(
        "is_conflict", "number_of_conflicts", "conflict_vehicles", "decisions", "priority_order", "waiting_times"))
    told = lane.decisions(scenarios).select("scenario_id", answer.alias("answer"))
    messages = text.chat_messages(system, F.col("question"), F.col("answer"))
    return asked.join(told, "scenario_id").select("scenario_id", messages.alias("messages"))


def raw_row_records(raw: DataFrame, system: str) -> DataFrame:
    """The single-row form: one vehicle asked about, the row's own labels as the answer."""
    vehicle = F.struct("vehicle_id", "lane", "speed", "distance_to_intersection", "direction", "destination")
    parsed = {
        "conflict_vehicles": "array<struct<vehicle1_id:string,vehicle2_id:string>>",
        "decisions": "array<string>", "priority_order": "map<string,int>", "waiting_times": "map<string,int>",
    }
    # read once, into columns: the answer names each of them several times
    raw = raw.withColumns({f"_{k}": scalar.python_literal(F.col(k), v) for k, v in parsed.items()})
    typed = {k: F.col(f"_{k}") for k in parsed}
    all_good = reduce(lambda x, y: x & y, [c.isNotNull() for c in typed.values()])
    empty = {k: (F.array() if v.startswith("array") else F.create_map()).cast(v) for k, v in parsed.items()}
    fields = [F.when(all_good, typed[k]).otherwise(empty[k]).alias(k) for k in parsed]
    answer = F.to_json(F.struct("is_conflict", "number_of_conflicts", *fields))
    asked = F.to_json(F.struct(F.array(vehicle).alias("vehicles")))
    return raw.select("scenario_id", text.chat_messages(system, asked, answer).alias("messages"))


def prompts(scenarios: DataFrame, mode: str, system: str | None = None, examples: list[tuple[str, str]] = ()) -> DataFrame:
    """What a model would be asked: zero-shot and fine-tuned alike, few-shot with example pairs."""
    shown = examples if mode == "few-shot" else ()
    messages = text.chat_messages(system or layout_prompt(), text.label_question(F.col("vehicles")), examples=shown)
    return scenarios.select("scenario_id", F.lit(mode).alias("mode"), messages.alias("messages"))


def as_lines(records: DataFrame, value: Column | None = None) -> DataFrame:
    """One JSON object per row, ready for a text sink."""
    return records.select((F.to_json(F.struct("messages")) if value is None else value).alias("value"))


def explanations(pair_rows: DataFrame) -> DataFrame:
    """Each pair's rule in words, with who goes and who waits."""
    return pair_rows.select(
        "scenario_id", "seq1", "seq2", F.col("rule_used").alias("priority_rule"),
        F.col("winner_id").alias("priority_vehicle"), F.col("loser_id").alias("yield_vehicle"), "wait",
        text.rule_reason(F.col("rule_used"), F.col("winner_id"), F.col("loser_id")).alias("conflict_reason"),
    )
