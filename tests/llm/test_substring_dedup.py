import random

import pytest
from tests.llm import plain
from tests.llm.conftest import ODD, SF

from crossroads.llm import exchange, substring_dedup
from crossroads.llm.queries import QUERIES


def check(docs, rows):
    got = sorted(map(repr, map(tuple, substring_dedup.deduplicated(docs).collect())))
    assert got == sorted(map(repr, plain.substring(rows)))


def planted():
    """Random texts over few words with shared passages of 12, 13, 14 and 40 words, and repeated and null ids."""
    rng = random.Random(5)
    passages = [[f"p{n}w{i}" for i in range(n)] for n in (12, 13, 14, 40)]
    rows = []
    for i in range(120):
        ws = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(0, 60))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = p[rng.randrange(0, 3):]
        rows.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n", " \t "]).join(ws)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, "a b " * 50), (503, "b a " * 50)]
    return rows


def test_against_loops(table, documents, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    check(table(rows).repartition(3), rows)
    rows = planted()
    check(table(rows).repartition(4), rows)


def test_empty_table(table):
    assert substring_dedup.deduplicated(table([])).count() == 0


def test_blocks_hold_whole_texts(table):
    rows = [(i, t) for i, t in enumerate(ODD)]
    seen = []
    for r in exchange.blocks(table(rows), most=100).collect():
        b = exchange.block_of(r.asDict())
        seen += [(i, b.body[s:s + n].decode()) for i, s, n in zip(b.ids, b.starts, b.lens)]
    assert sorted(seen) == [(i, t or "") for i, t in rows]


@pytest.mark.parametrize("name", ["op6_substring_dedup"])
def test_query_reads_the_whole_table(spark, documents, name):
    assert QUERIES[name](spark, SF).count() == documents.count()
