"""Lines of chat records on disk."""

import glob
import os

from pyspark.sql import functions as F

from crossroads.operators import lane, training_sets
from crossroads.plans import queries
from crossroads.sources import adapters, writers

SMALL = "/root/testdata/sf0.001"
READ = "messages array<struct<role:string,content:string>>"


def records(spark):
    return training_sets.label_records(lane.with_label(adapters.scenarios(spark, SMALL), "is_conflict"), "is_conflict")


def test_lines_do_not_take_the_room_of_their_text(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lines")
    monkeypatch.setattr(queries, "new_table_path", lambda *_: path)
    read = queries.QUERIES["chat_lines"](spark, SMALL)
    text = sum(len(r.messages.encode()) for r in read.collect())
    assert sum(map(os.path.getsize, glob.glob(f"{path}/part-*"))) * 5 < text


def test_files_have_a_bound_and_plain_lines_can_be_asked_for(spark, tmp_path):
    made = records(spark)
    path, plain = str(tmp_path / "packed"), str(tmp_path / "plain")
    writers.write_chat_lines(made, path, lines_per_file=100)
    writers.write_chat_lines(made, plain, compression="none")
    told = lambda rows: sorted(str(r.messages) for r in rows)
    want = told(made.collect())
    read = spark.read.schema(READ).json(path)
    assert told(read.collect()) == told(spark.read.schema(READ).json(plain).collect()) == want
    per_file = read.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) <= 100 and sum(r["count"] for r in per_file) == len(want)
    assert all(open(f, encoding="utf-8").read(1) == "{" for f in glob.glob(f"{plain}/part-*.txt"))
