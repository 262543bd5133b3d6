"""Joins and comparisons over scenario tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wait_map_error(predicted: Column, reference: Column) -> Column:
    """Mean absolute difference over the reference map's vehicles, an absent prediction being 0.

    An empty reference gives 0.
    """
    waits = F.map_entries(reference)
    total = F.aggregate(
        waits, F.lit(0.0),
        lambda acc, e: acc + F.abs(F.coalesce(F.try_element_at(predicted, e["key"]), F.lit(0)) - e["value"]),
    )
    return F.when(F.size(reference) > 0, total / F.size(reference)).otherwise(0.0)


def with_scenario_size(rows: DataFrame) -> DataFrame:
    """The number of vehicles of the scenario on every row."""
    sizes = rows.groupBy("scenario_id").agg(F.count("*").alias("n_vehicles"))
    return rows.join(sizes, "scenario_id")


def paired(records: DataFrame) -> DataFrame:
    """Both variants of a scenario side by side; grouped, so a scenario scored once stays in."""
    pick = lambda v, c: F.max(F.when(F.col("variant") == v, F.col(c)))
    return records.groupBy("scenario_id").agg(
        F.max("true_label").alias("true_label"), F.max("rule_label").alias("rule_label"),
        pick("A", "predicted_label").alias("first"), pick("B", "predicted_label").alias("second"),
    )
