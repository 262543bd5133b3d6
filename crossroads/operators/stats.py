"""Statistical tests as aggregations: chi-square, Mann-Whitney, Kolmogorov-Smirnov, drift."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from . import prefix


@F.pandas_udf(T.DoubleType())
def erfc(x: pd.Series) -> pd.Series:
    """Complementary error function; only ever applied to one aggregated row per test."""
    return x.map(lambda v: None if v is None or math.isnan(v) else math.erfc(v))


def chi_square(records: DataFrame) -> DataFrame:
    """2x2 test of correct counts between arms A and B, with Yates' correction.

    A degenerate table gives (0, 1, false).
    """
    right = F.col("true_label") == F.col("predicted_label")
    arm = lambda v, ok: F.count_if((F.col("variant") == v) & ok).cast("double")
    t = records.agg(
        arm("A", right).alias("a"), arm("A", ~right).alias("b"),
        arm("B", right).alias("c"), arm("B", ~right).alias("d"),
    )
    return t.select(*chi_square_of(*map(F.col, "abcd"))).select(
        F.round("chi2", 4).alias("chi2"), F.round("p_value", 4).alias("p_value"),
        (F.col("p_value") < C.DRIFT_P_VALUE).alias("significant"),
    )


def chi_square_of(a: Column, b: Column, c: Column, d: Column) -> list[Column]:
    n = a + b + c + d
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    diff = F.abs(a * d - b * c)
    corrected = F.greatest(diff - F.least(n / 2, diff), F.lit(0.0))
    chi2 = F.when(margins > 0, n * corrected * corrected / margins).otherwise(0.0)
    return [chi2.alias("chi2"), F.when(margins > 0, erfc(F.sqrt(chi2 / 2))).otherwise(1.0).alias("p_value")]


def mann_whitney(df: DataFrame, value: str, arm: str, first: str, second: str) -> DataFrame:
    """Two-sided rank test, normal approximation with tie and continuity correction.

    Equal values are counted together; ranks come from running counts over the values.
    """
    is_first = F.count_if(F.col(arm) == first).cast("double")
    counts = (
        df.filter(F.col(value).isNotNull() & F.col(arm).isin(first, second))
        .groupBy(value).agg(is_first.alias("x"), F.count("*").cast("double").alias("c"))
    )
    placed = prefix.running(counts, [], [value], {"upto": ("sum", F.col("c"))})
    rank = F.col("upto") - F.col("c") + (F.col("c") + 1) / 2
    sums = placed.agg(
        F.sum("x").alias("n1"), F.sum(F.col("c") - F.col("x")).alias("n2"),
        F.sum(F.col("x") * rank).alias("r1"),
        F.sum(F.col("c") * F.col("c") * F.col("c") - F.col("c")).alias("ties"),
    )
    n1, n2, n = F.col("n1"), F.col("n2"), F.col("n1") + F.col("n2")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = (F.greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / spread
    done = sums.select(n1.cast("long").alias("n1"), n2.cast("long").alias("n2"), u1.alias("u"), z.alias("z"))
    return done.select("n1", "n2", "u", F.round("z", 4).alias("z"),
                       F.round(F.least(F.lit(1.0), erfc(F.col("z") / math.sqrt(2))), 4).alias("p_value"))


def common_numeric(left: DataFrame, right: DataFrame) -> list[str]:
    """Numeric columns both tables have; from the schemas, no job."""
    numeric = lambda df: {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return sorted(numeric(left) & numeric(right))


def ks_p_value(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic tail 2 sum (-1)^(k-1) exp(-2 k^2 x^2), kept within 0 and 1; 1 for tiny x."""
    x = F.sqrt(n1 * n2 / (n1 + n2)) * d
    term = lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x)
    tail = 2 * F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda acc, k: acc + term(k))
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))


def ks_test(reference: DataFrame, production: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Two-sample statistic and p value per column; NULLs do not count. No columns gives no rows."""
    columns = common_numeric(reference, production) if columns is None else columns
    spark = reference.sparkSession
    if not columns:
        return spark.createDataFrame([], "column string, n_ref long, n_prod long, statistic double, p_value double, drifted boolean")

    def long(df, side):
        cells = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
        stacked = df.select(F.expr(f"stack({len(columns)}, {cells}) as (column, value)"))
        return stacked.filter("value is not null").withColumn("side", F.lit(side))

    counts = (
        long(reference, 0).unionByName(long(production, 1))
        .groupBy("column", "value")
        .agg(F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("p"))
    )
    placed = prefix.running(counts, ["column"], ["value"], {"cr": ("sum", F.col("r")), "cp": ("sum", F.col("p"))})
    totals = counts.groupBy("column").agg(F.sum("r").alias("n_ref"), F.sum("p").alias("n_prod"))
    gap = F.abs(F.col("cr") / F.col("n_ref") - F.col("cp") / F.col("n_prod"))
    table = (
        placed.join(totals, "column").filter("n_ref > 0 and n_prod > 0")
        .groupBy("column", "n_ref", "n_prod").agg(F.max(gap).alias("statistic"))
    )
    p = ks_p_value(F.col("statistic"), F.col("n_ref").cast("double"), F.col("n_prod").cast("double"))
    # p in a step of its own: next to an alias of the same name its lambda would see the rounded statistic
    return table.withColumn("_p", p).select(
        "column", "n_ref", "n_prod", F.round("statistic", 6).alias("statistic"), F.round("_p", 4).alias("p_value"),
        (F.col("_p") < C.DRIFT_P_VALUE).alias("drifted"),
    )


def drift(tests: DataFrame, rule: str = "any") -> DataFrame:
    """One row: is there drift? By ``any`` drifted column, or by ``share`` above 0.2."""
    n, bad = F.count("*"), F.count_if("drifted")
    out = tests.agg(n.alias("n_tested"), bad.alias("n_drifted"))
    part = F.when(F.col("n_tested") > 0, F.col("n_drifted") / F.col("n_tested")).otherwise(0.0)
    found = F.col("n_drifted") > 0 if rule == "any" else part > C.DRIFT_SHARE_MAX
    return out.select("n_tested", "n_drifted", F.round(part, 4).alias("drift_share"), found.alias("drift_detected"))
