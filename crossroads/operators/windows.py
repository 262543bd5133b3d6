"""Rolling, running and last-N views of a prediction sequence.

A sequence may hold most of the table (two variants, one log), so none of these puts a
whole sequence in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import metrics, prefix


def rolling(
    df: DataFrame, keys: list[str], order: list[str], width: int, values: dict[str, Column], chunk: int = 1_000_000,
    cut_by: DataFrame | None = None,
) -> DataFrame:
    """Adds windowed values over the last ``width`` rows (fewer at the start).

    Rows are numbered along the sequence and cut into chunks of ``chunk`` rows; the last
    width - 1 rows of a chunk are copied to the next, so every window is whole in its chunk.
    """
    chunk = max(chunk, width)
    numbered = prefix.numbered(df, keys, order, "_idx", cut_by)
    home = F.floor(F.col("_idx") / chunk)
    visits = F.when(
        F.col("_idx") % chunk >= chunk - (width - 1), F.array(home, home + 1)
    ).otherwise(F.array(home))
    spread = numbered.withColumn("_chunk", F.explode(visits))
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_idx").rowsBetween(-(width - 1), Window.currentRow)
    out = spread.select("*", *[v(frame).alias(n) for n, v in values.items()])
    return out.filter(F.col("_chunk") == home).drop("_chunk").withColumnRenamed("_idx", "idx")


def rolling_accuracy(records: DataFrame, keys: list[str], order: list[str], width: int = 10, **kw) -> DataFrame:
    right = (F.col("true_label") == F.col("predicted_label")).cast("int")
    return rolling(records, keys, order, width, {"rolling_accuracy": lambda w: F.avg(right).over(w)}, **kw)


def rolling_fnr(records: DataFrame, keys: list[str], order: list[str], width: int = 10, **kw) -> DataFrame:
    positive = (F.col("true_label") == "yes").cast("int")
    missed = positive * (F.col("predicted_label") != "yes").cast("int")
    value = lambda w: F.sum(missed).over(w) / (F.sum(positive).over(w) + metrics.EPS)
    return rolling(records, keys, order, width, {"rolling_fnr": value}, **kw)


def running_metrics(records: DataFrame, keys: list[str], order: list[str], cut_by: DataFrame | None = None) -> DataFrame:
    """The scores after each prediction of the run."""
    t, p = F.col("true_label") == "yes", F.col("predicted_label") == "yes"
    one = lambda cond: ("sum", cond.cast("int"))
    counted = prefix.running(records, keys, order, {
        "tp": one(t & p), "fn": one(t & ~p), "fp": one(~t & p), "tn": one(~t & ~p), "step": ("sum", F.lit(1)),
    }, cut_by=cut_by)
    return counted.select(*records.columns, "step", *metrics.scores(no_positive=1.0))


def last_n(events: DataFrame, order: list[str], n: int, bad: Column | None = None) -> DataFrame:
    """The last ``n`` rows of the whole log. Rows marked ``bad`` count towards n, then leave."""
    rows = events.orderBy(*[F.desc(c) for c in order]).limit(n)
    return rows if bad is None else rows.filter(~bad)


def last_n_per_key(events: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows of each key; the rank filter also runs before the exchange."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return events.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")
