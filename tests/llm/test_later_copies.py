"""Bytes that a 400-byte string covers which starts earlier too, against loops."""

import pytest
from tests.llm.conftest import ODD, SF
from tests.llm.test_suffix_dedup import planted

from crossroads.llm import suffix_dedup
from crossroads.llm.queries import QUERIES


def later_bytes(rows, k=400):
    """(id, later bytes, runs of them) of each (id, text); ids are distinct."""
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    seen, out = set(), []
    for i, t in texts:
        gone = set()
        for j in range(len(t) - k + 1):
            w = t[j:j + k]
            if w in seen:
                gone.update(range(j, j + k))
            seen.add(w)
        out.append((i, len(gone), sum(j - 1 not in gone for j in gone)))
    return out


def got(docs):
    return sorted((r["doc_id"], r["n_later"], r["n_later_spans"]) for r in suffix_dedup.measured(docs).collect())


def distinct_ids(rows):
    """Ids that fall as rows go on, so that first copies lie behind later ones in a block."""
    return [(10_000 - 3 * i, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_later_copies_against_loops(table, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "MOST_WINDOWS", 500)
    rows = distinct_ids(planted())
    rows += [(20_000, rows[4][1] * 2), (20_001, "z" * 5 + rows[4][1] + "q" + rows[4][1][:450])]
    assert got(table(rows).repartition(4)) == later_bytes(rows)


def test_first_copies_are_not_later_ones(table):
    text = "".join(f"{i} words " for i in range(100))
    rows = [(5, "a " + text), (2, text + " b"), (9, text), (1, "short"), (3, "")]
    found = {i: n for i, n, _ in got(table(rows))}
    assert found[2] == 0 and found[5] == found[9] == len(text) and found[1] == found[3] == 0


def test_same_and_null_ids_keep_one_copy(table):
    text = "".join(f"{i} words " for i in range(100))
    found = got(table([(7, text), (7, text), (7, text)]).repartition(2))
    assert sorted(n for _, n, _ in found) == [0, len(text), len(text)]
    found = suffix_dedup.measured(table([(None, text), (3, text), (None, text)])).collect()
    assert sorted((r["doc_id"] or -1, r["n_later"]) for r in found) == [(-1, len(text)), (-1, len(text)), (3, 0)]


def test_query_against_loops(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = QUERIES["op3_suffix_array_dedup"](spark, SF).collect()
    assert sorted((r["doc_id"], r["n_later"], r["n_later_spans"]) for r in found) == later_bytes(rows)
    assert all(r["n_later"] <= r["n_removed"] for r in found)
    assert got(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")) == later_bytes(list(enumerate(ODD)))
