import random

import pytest
from tests.llm import plain
from tests.llm.conftest import ODD, SF

from crossroads.llm import simhash
from crossroads.llm.components import components
from crossroads.llm.queries import QUERIES


def test_against_loops(table, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    rows += [(None, rows[0][1]), (7, rows[1][1]), (3, rows[1][1]), (None, "only here without an id")]
    got = [tuple(r) for r in simhash.near_duplicates(table(rows).repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(plain.simhash(rows), key=repr)


def near_prints(n, seed):
    """Fingerprints in chains and clouds of few changed bits, over many population counts, besides random ones."""
    rng = random.Random(seed)
    out = [0, 1, 3, 2**64 - 1, 2**64 - 2, 0xFFFFFFFF, 0xFFFFFFFF00000000]
    for _ in range(n):
        x = rng.getrandbits(64)
        if rng.random() < 0.2:
            x &= rng.getrandbits(64)
        out.append(x)
        for _ in range(rng.choice([0, 0, 1, 5, 20])):
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << b
            out.append(x)
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = near_prints(400, block)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    found = {r["node"]: r["component"] for r in components(simhash.links(spark.createDataFrame(signed, "fingerprint long"))).collect()}
    label = plain.near_components(prints)
    groups, want = {}, {}
    for x, (s,) in zip(prints, signed):
        groups.setdefault(found.get(s, s), set()).add(x)
        want.setdefault(label[x], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (2001, 2000), (2000, 2001)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 200)} | {2001: 2000}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each_group_stays(table, documents):
    base = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows = base + [(10**6, base[0][1]), (0, base[0][1]), (None, base[0][1]), (10**6 + 1, "all alone in this table")]
    docs = table(rows).repartition(3)
    kept = simhash.distinct(docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, _, c in plain.simhash(rows)})
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert simhash.distinct(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op4_simhash_near_dedup"])
def test_query_reads_the_whole_table(spark, documents, name):
    assert QUERIES[name](spark, SF).count() == documents.count()
