"""The corpus pipeline against the same stages in plain loops."""

import corpus_pipeline
import pytest
from tests.llm import plain
from tests.llm.conftest import ODD, SF

import __spark_entry__ as entry
from crossroads.llm import pii, quality
from crossroads.llm.queries import ORACLE, QUERIES


def test_registered():
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in entry.queries()) == 1
    assert "pipeline" in entry.queries()
    assert set(ORACLE) <= set(QUERIES) and set(QUERIES) <= set(entry.queries())


def expected(spark, rows):
    """doc_id -> masked text of what the stages keep."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    good = {r["doc_id"] for r in quality.measures(made).filter("kept").collect()}
    rows = [(i, t) for i, t in rows if i in good]
    rows = [(i, t) for i, t in rows if (i, i) in {(a, c) for a, _, c in plain.simhash(rows)}]
    return {i: pii.mask(t) for i, t in rows if not plain.contamination(t, items)["contaminated"]}


def test_stages_take_effect_in_order(spark, table, documents):
    base = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows = base + [(10**6 + i, t) for i, t in enumerate(ODD)] + [(2 * 10**6, base[0][1]), (2 * 10**6 + 1, base[0][1] + " me@mail.example.com")]
    docs = table(rows).repartition(3)
    want = expected(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == before.columns, name
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    name, pack = corpus_pipeline.STAGES[-1]
    out = pack(spark, docs, SF).collect()
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: len(plain.words(t)) for i, t in want.items()}


def test_empty_documents(spark, table):
    docs = table([])
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
    assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_have_the_right_form(name, stage):
    assert isinstance(name, str) and callable(stage)
