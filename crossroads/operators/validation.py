"""Contract checks over the raw vehicle table: one aggregation for all checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema


def failing(column: str, check: str, arg) -> Column:
    """True for a row that breaks the check. A NULL breaks 'allowed', not the ranges."""
    c = F.col(column)
    number = c.try_cast("double")
    return {
        "no_nulls": lambda: c.isNull(),
        "allowed": lambda: F.coalesce(~c.isin(arg), F.lit(True)),
        "min": lambda: F.coalesce(number < arg, F.lit(False)),
        "max": lambda: F.coalesce(number > arg, F.lit(False)),
        "between": lambda: F.coalesce((number < arg[0]) | (number > arg[1]), F.lit(False)),
    }[check]()


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def report(df: DataFrame, checks=None, required: list[str] | None = None, row_count: bool = True) -> DataFrame:
    """(check_name, column_name, n_bad, passed).

    Missing columns are found in the schema and end the report there, before any job.
    """
    checks = schema.CONTRACT if checks is None else checks
    required = sorted({c for c, _, _ in checks}) if required is None else required
    missing = missing_columns(df, required)
    if missing:
        rows = [("required_columns", c, 1, False) for c in missing]
        return df.sparkSession.createDataFrame(rows, "check_name string, column_name string, n_bad long, passed boolean")
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(failing(*c)).alias(f"b{i}") for i, c in enumerate(checks)])
    cells = [f"'{kind}', '{col}', b{i}" for i, (col, kind, _) in enumerate(checks)]
    cells.append("'required_columns', '*', cast(0 as bigint)")
    if row_count:
        cells.append("'row_count', '*', cast(n = 0 as bigint)")
    tall = counts.select(F.expr(f"stack({len(cells)}, {', '.join(cells)}) as (check_name, column_name, n_bad)"))
    return tall.withColumn("passed", F.col("n_bad") == 0)


def expectations(df: DataFrame) -> DataFrame:
    return report(df, schema.EXPECTATIONS, row_count=False)


def unexpected_values(df: DataFrame, checks=None, n: int = 5) -> DataFrame:
    """Up to ``n`` distinct values per column outside its allowed set, smallest first.

    Distinct values are counted before they are ranked, so their number does not matter.
    """
    checks = [c for c in (schema.CONTRACT if checks is None else checks) if c[1] == "allowed"]
    cells = ", ".join(f"'{c}', cast(`{c}` as string)" for c, _, _ in checks)
    tall = df.select(F.expr(f"stack({len(checks)}, {cells}) as (column_name, value)"))
    bad = None
    for column, _, allowed in checks:
        this = (F.col("column_name") == column) & F.coalesce(~F.col("value").isin(allowed), F.lit(True))
        bad = this if bad is None else bad | this
    counted = tall.filter(bad).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    return counted.withColumn("place", place).filter(F.col("place") <= n).drop("place")


def gate(checks: DataFrame) -> None:
    """Raise once, naming all failed checks."""
    failed = checks.filter("not passed").collect()  # one row per check
    if failed:
        names = ", ".join(f"{r['column_name']}:{r['check_name']}={r['n_bad']}" for r in failed)
        raise ValueError(f"validation failed: {names}")
