"""Operators that judge each document for itself: quality rules, personal data, benchmark hits, token counts."""

import pytest
from tests.llm import plain
from tests.llm.conftest import ODD, SF

from crossroads.llm import decontamination, pii, quality, token_counts
from crossroads.llm.queries import QUERIES, hit_digests, span_digests, vocabulary_file


def same(result, texts, expected):
    """Every row of ``result`` has the columns that ``expected`` gives for its text."""
    rows = result.collect()
    assert len(rows) == len(texts)
    by_id = dict(texts)
    for r in rows:
        want = expected(by_id[r["doc_id"]])
        assert {k: r[k] for k in want} == want, (r["doc_id"], by_id[r["doc_id"]])


def cases(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]


@pytest.mark.parametrize("name, expected", [("quality", plain.quality), ("pii", plain.personal)])
def test_against_loops(table, documents, name, expected):
    texts = cases(documents)
    docs = table(texts).repartition(3)
    same(quality.measures(docs) if name == "quality" else span_digests(pii.table(docs)), texts, expected)


def test_quality_keeps_prose_and_drops_junk(table):
    prose = " ".join(f"the house{i} on street{i} of town{i}" for i in range(20))
    junk = " ".join(f"$$#{i} | <{i}>" for i in range(60))
    docs = table([prose, junk, None, "of the " * 100])
    assert [r["doc_id"] for r in quality.passing(docs).collect()] == [0]
    assert quality.passing(docs).columns == docs.columns
    assert quality.passing(docs.limit(0)).count() == 0


def test_quality_has_no_python(documents):
    plan = quality.measures(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_filters_on_measures_do_not_split_texts_again(documents):
    for df in (quality.passing(documents), quality.measures(documents).filter("kept")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(coalesce(text") == 2  # words and lines, once each


def test_benchmark_hits(spark, table, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    more = [(1001, "tiny one"), (1002, None), (1003, "..."), (1004, "Solo"), (1005, items[0][1]), (None, "nameless words here"), (1004, "solo")]
    bench = spark.createDataFrame(items + more, "item_id long, text string")
    texts = cases(documents) + [(2 * 10**6, "A TINY, one! solo-act"), (2 * 10**6 + 1, "some nameless words here."), (2 * 10**6 + 2, f"x {items[3][1]} y {items[3][1]}")]
    expected = lambda t: plain.contamination(t, items + more)
    same(hit_digests(decontamination.hits(table(texts), bench)), texts, expected)
    some = texts[::3] + texts[-3:]
    same(hit_digests(decontamination.hits(table(some), bench.unionByName(bench), most_words=1500)), some, expected)
    same(hit_digests(decontamination.hits(table(some + some), bench, most_words=400)), some + some, expected)
    kept = decontamination.clean(table(texts), bench)
    assert kept.columns == table(texts).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in texts if not expected(t)["contaminated"]}
    assert hit_digests(decontamination.hits(table(some), bench.limit(0))).filter("contaminated or n_items > 0").count() == 0


def test_pii_adds_checked_and_named_spans(table):
    text = "x iban DE89 3704 0044 0532 0130 00 AND MORE; no DE89370400440532013001; my ssn 123-45-6789; and plain " + "z " * 30 + "123-45-6789"
    found = pii.spans(text)
    assert [text[a:b] for k, a, b, _ in found if k == "iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert [k for k, *_ in found].count("id_number") == 1
    assert pii.mask("a@b.co, 4111 1111 1111 1111!") == "<EMAIL>, <CARD>!"
    out = {r["doc_id"]: r["text"] for r in pii.masked(table(["me a@b.co", None, ""])).collect()}
    assert out == {0: "me <EMAIL>", 1: None, 2: ""}


def test_pii_is_linear():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "a@" * 200_000, "AB12" * 100_000, "x." * 200_000 + "@"):
        pii.spans(text)


def test_token_counts(table, documents, monkeypatch):
    path = vocabulary_file("byte_bpe_50k.json")
    whole = token_counts.tokenizer(path)
    expected = lambda t: {"n_bytes": len((t or "").encode()), "n_tokens": len(whole.encode(t or "", add_special_tokens=False).ids)}
    texts = cases(documents)
    same(token_counts.counts(table(texts), path), texts, expected)
    monkeypatch.setattr(token_counts, "CACHED", 3)
    few = token_counts.Lengths(path, {" the": 1})
    assert all(few.count(t) == expected(t)["n_tokens"] for t in ODD)
    assert token_counts.counts(table([]), path).count() == 0


@pytest.mark.parametrize("name", ["op5_personal_data", "op7_token_counts", "op8_benchmark_hits", "op9_quality_rules"])
def test_queries_read_whole_tables(spark, documents, name):
    assert QUERIES[name](spark, SF).count() == documents.count()
