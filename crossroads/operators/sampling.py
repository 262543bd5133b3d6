"""Seeded samples, splits and balance. Order is a hash of the id: the same under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar
from . import prefix


def draw(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string")))


def per_group(df: DataFrame, groups: list[str], n: int, id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    """``n`` rows of each group. For small n; the rank filter also runs before the exchange."""
    nth = F.row_number().over(Window.partitionBy(*groups).orderBy(draw(id_col, seed), id_col))
    return df.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")


def overall(df: DataFrame, n: int, id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    return df.orderBy(draw(id_col, seed), id_col).limit(n)


def first_n(df: DataFrame, n: int, id_col: str = "scenario_id") -> DataFrame:
    """The first ``n`` by id, taken before any wide projection."""
    return df.orderBy(id_col).limit(n)


def class_counts(df: DataFrame, label: str = "is_conflict") -> DataFrame:
    """One row: yes, no, total, minority share, and whether it is at least 0.40."""
    yes, no = F.count_if(F.col(label) == "yes"), F.count_if(F.col(label) == "no")
    out = df.agg(yes.alias("n_yes"), no.alias("n_no"), F.count("*").alias("n"))
    part = scalar.ratio(F.least("n_yes", "n_no"), F.col("n"))
    return out.select("*", F.round(part, 4).alias("minority_ratio"), (part >= C.BALANCE_MIN).alias("balanced"))


def numbered_by_class(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """Adds ``_idx``, the place of a row in its class in drawn order. A class may be most of the table."""
    return prefix.numbered(df.withColumn("_draw", draw(id_col, seed)), [label], ["_draw", id_col], "_idx").drop("_draw")


def first_drawn(
    df: DataFrame, wanted: DataFrame, group: str, id_col: str = "scenario_id", seed: int = 42, bits: int = 16,
) -> DataFrame:
    """The first ``_want`` rows of each group in drawn order; ``wanted`` has (group, _want), a row for each of few groups.

    A histogram of the leading bits of the draws tells in which bucket a group is full. Rows of the buckets before pass
    by a filter; only the rows of that one bucket are ranked, a 2**-bits part of the group, however large ``_want`` is.
    """
    drawn = df.withColumn("_draw", draw(id_col, seed))
    drawn = drawn.withColumn("_bucket", F.conv(F.substring("_draw", 1, bits // 4), 16, 10).cast("int"))
    upto = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = drawn.groupBy(group, "_bucket").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    # One row per group: the bucket in which it is full, and how many of its rows are still wanted there.
    full = (
        sizes.join(F.broadcast(wanted), group).filter(F.col("_upto") >= F.col("_want"))
        .groupBy(group).agg(F.min(F.struct("_bucket", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_rest"))).alias("_cut"))
    )
    cuts = wanted.join(full, group, "left").filter("_want > 0").select(
        group, F.coalesce("_cut._bucket", F.lit(1 << bits)).alias("_full"), F.coalesce("_cut._rest", F.lit(0)).alias("_rest")
    )
    placed = drawn.join(F.broadcast(cuts), group)
    nth = F.row_number().over(Window.partitionBy(group).orderBy("_draw", id_col))
    edge = placed.filter(F.col("_bucket") == F.col("_full")).withColumn("_nth", nth).filter(F.col("_nth") <= F.col("_rest"))
    return placed.filter(F.col("_bucket") < F.col("_full")).select(*df.columns).unionByName(edge.select(*df.columns))


def _classes(df: DataFrame, label: str, want: Column) -> DataFrame:
    """(label, _want) for 'yes' and 'no', from their counts."""
    each = F.explode(F.array(F.lit("yes"), F.lit("no"))).alias(label)
    return class_counts(df, label).select("*", each).select(label, want.cast("long").alias("_want"))


def balanced(df: DataFrame, n: int, label: str = "is_conflict", id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    """n/2 of each class, or what there is."""
    return first_drawn(df, _classes(df, label, F.lit(n // 2)), label, id_col, seed)


def equal_classes(df: DataFrame, n: int, label: str = "is_conflict", id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    """The same number of both classes: the smallest of yes, no and n/2."""
    return first_drawn(df, _classes(df, label, F.least("n_yes", "n_no", F.lit(n // 2))), label, id_col, seed)


def undersampled(df: DataFrame, label: str = "is_conflict", id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    """All of the 'yes' class and as many of 'no', or all of 'no' when it is the smaller one."""
    return first_drawn(df, _classes(df, label, F.col("n_yes")), label, id_col, seed)


def rebalance(df: DataFrame, label: str = "is_conflict", id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    """The table as it is when balanced enough, else undersampled."""
    wanted = _classes(df, label, F.when(F.col("balanced"), F.greatest("n_yes", "n_no")).otherwise(F.col("n_yes")))
    enough = F.broadcast(class_counts(df, label).select(F.col("balanced").alias("_enough")))  # one row
    other = df.filter(~F.coalesce(F.col(label).isin("yes", "no"), F.lit(False))).join(enough, F.col("_enough")).drop("_enough")
    return first_drawn(df, wanted, label, id_col, seed).unionByName(other)


def split(df: DataFrame, id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    """train / val / test by hash, 70/15/15 in expectation; row by row, no exchange."""
    u = scalar.md5_number(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"))) / 2**32
    return df.withColumn("split", F.when(u < 0.70, "train").when(u < 0.85, "val").otherwise("test"))


def stratified_split(df: DataFrame, label: str = "is_conflict", id_col: str = "scenario_id", seed: int = 42) -> DataFrame:
    """train / val / test with exact 70/15/15 shares inside each class (rounded down, rest to test)."""
    placed = numbered_by_class(df, label, id_col, seed)
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    rows = placed.join(F.broadcast(sizes), label)  # one row per class
    train, val = F.floor(F.col("_n") * 0.70), F.floor(F.col("_n") * 0.85)
    part = F.when(F.col("_idx") < train, "train").when(F.col("_idx") < val, "val").otherwise("test")
    return rows.withColumn("split", part).drop("_idx", "_n")


def with_content_of(df: DataFrame, key: str, selected: DataFrame) -> DataFrame:
    """Rows whose key is among the selected ones."""
    return df.join(selected.select(key).distinct(), key, "left_semi")


def without_content_of(df: DataFrame, key: str, seen: DataFrame) -> DataFrame:
    """Rows whose content key does not occur in ``seen``; its keys are made distinct first."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def overlap(df: DataFrame, key: str, seen: DataFrame) -> DataFrame:
    """One row: how many rows of ``df`` have content that ``seen`` has too."""
    return with_content_of(df, key, seen).agg(F.count("*").alias("n_leaked"))


def assert_unseen_seed(seed: int, training_seeds: list[int] = C.TRAINING_SEEDS) -> None:
    if seed in training_seeds:
        raise ValueError(f"evaluation seed {seed} was used for training")


def supplemented(
    typed: DataFrame, mixed: DataFrame, used: DataFrame, n: int, key: str, id_col: str = "scenario_id", seed: int = 999
) -> DataFrame:
    """``typed`` topped up to ``n`` rows with mixed ones whose content is in neither ``typed`` nor ``used``."""
    fresh = without_content_of(without_content_of(mixed, key, typed), key, used).withColumn("_all", F.lit(0))
    wanted = typed.agg((n - F.count("*")).alias("_want")).select(F.lit(0).alias("_all"), "_want")
    return typed.unionByName(first_drawn(fresh, wanted, "_all", id_col, seed).select(*typed.columns))
