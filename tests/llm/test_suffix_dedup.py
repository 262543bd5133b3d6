import random

import numpy as np
import pytest
from tests.llm import plain
from tests.llm.conftest import ODD, SF

from crossroads.llm import suffix_dedup
from crossroads.llm.queries import QUERIES


def check(docs, rows):
    got = [tuple(r) for r in suffix_dedup.deduplicated(docs).collect()]
    assert sorted(((i, n, r, s, bytes(k)) for i, n, r, s, k in got), key=repr) == sorted(plain.repeated_bytes(rows), key=repr)


def planted(seed=3):
    """Random texts with passages of 399 to 2000 bytes, cut at random, and a periodic text."""
    rng = random.Random(seed)
    letters = "abcdefgh é\n"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n) for n in (380, 399, 400, 401, 500, 900, 2000)]
    rows = []
    for i in range(150):
        t = text(rng.randrange(0, 700))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            a = rng.randrange(0, 60)
            p = p[a:len(p) - rng.randrange(0, 60)]
            at = rng.randrange(len(t) + 1)
            t = t[:at] + p + t[at:]
        rows.append((rng.choice([i, 7, None]), t))
    return [*rows, (900, rows[4][1]), (901, rows[4][1]), (902, "ab" * 1500), (903, "x" * 401), (904, "y" * 400), (905, "z" * 399)]


def test_against_loops(table, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    check(table(rows).repartition(3), rows)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_edges_and_hot_cores(table, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = planted()
    check(table(rows).repartition(4), rows)


def test_index_matches_are_the_longest():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 2), (2, 1), (60, 1), (200, 2), (400, 3)):
        parts, ends = [], []
        for u in range(4):
            parts.append(np.r_[rng.integers(0, letters, n) + 10, u])
        text = np.concatenate(parts)
        got = suffix_dedup.RunLengthIndex(text, len(text)).matches()
        for i in range(len(text)):
            best = 0
            for j in range(len(text)):
                k = 0
                while i != j and max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                    k += 1
                best = max(best, k)
            assert got[i] == best, (n, letters, i)


def test_empty_table(table):
    assert suffix_dedup.deduplicated(table([])).count() == 0


@pytest.mark.parametrize("name", ["op3_suffix_array_dedup"])
def test_query_reads_the_whole_table(spark, documents, name):
    assert QUERIES[name](spark, SF).count() == documents.count()
