"""Every registered query once, against its SQL on the same tables."""

import math
import os

import duckdb
import pytest

from crossroads.plans.oracle import ORACLE
from crossroads.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(value):
    """Equal values as equal text: floats to nine digits, whole numbers whatever their type."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((plain(k), plain(v)) for k, v in value.items()))
    if hasattr(value, "as_tuple"):
        return f"{float(value):.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return f"{float(value):.9g}" if isinstance(value, int) else str(value)


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


@pytest.fixture(scope="session")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def matches(out, sql, name):
    got = rows_of(out.columns, [tuple(r) for r in out.collect()])
    said = sql.execute(ORACLE[name])
    want = rows_of([d[0] for d in said.description], said.fetchall())
    assert sorted(out.columns) == sorted(d[0] for d in said.description)
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    matches(QUERIES[name](spark, SMALL), sql, name)


@pytest.fixture(scope="session")
def parts(spark, tmp_path_factory):
    """The same tables, events as a folder of three parts."""
    folder = tmp_path_factory.mktemp("parts")
    for t in TABLES:
        if t != "events":
            os.symlink(f"{SMALL}/{t}.parquet", folder / f"{t}.parquet")
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(3).write.parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("stream_")))
def test_streams_over_a_folder_of_parts(spark, sql, parts, name):
    matches(QUERIES[name](spark, parts), sql, name)
