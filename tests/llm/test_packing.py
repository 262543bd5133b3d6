import random

import pytest
from tests.llm import plain
from tests.llm.conftest import ODD, SF

from crossroads.llm import packing
from crossroads.llm.queries import QUERIES


def walked(items, capacity):
    """Best fit by looking at every bin."""
    rooms, held, out = [], [], []
    for length, bits in items:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length and not held[i] & bits]
        if fits:
            i = min(fits)[1]
        else:
            i = len(rooms)
            rooms.append(capacity)
            held.append(0)
        out.append((i, capacity - rooms[i]))
        rooms[i] -= length
        held[i] |= bits
    return out


@pytest.mark.parametrize("run", [128, 2])
def test_search_finds_what_a_walk_finds(monkeypatch, run):
    monkeypatch.setattr(packing, "RUN", run)
    rng = random.Random(run)
    for n, sources in ((0, 1), (1, 1), (300, 1), (300, 4), (800, 20), (800, 300)):
        items = []
        for _ in range(n):
            bits = 1 << (0 if rng.random() < 0.36 else rng.randrange(sources))
            if rng.random() < 0.3:
                bits |= 1 << sources + rng.randrange(5)
            items.append((rng.randrange(1, 101), bits))
        assert packing.best_fit(items, 100) == walked(items, 100)


def test_bins_hold_every_word_once_and_no_conflict(table, documents):
    docs = documents.selectExpr("doc_id", "text", "source", "n_chars as length", "lang as bin_id")
    out = packing.packed(docs, capacity=300, group=90).collect()
    rows = {r["doc_id"]: r for r in documents.collect()}
    pieces, bins = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["piece_start"], r["length"]))
        if r["length"]:
            bins.setdefault(r["bin_id"], []).append((r["bin_offset"], r["length"], rows[r["doc_id"]]))
    for i, r in rows.items():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(pieces[i])):
            assert (piece, start) == (k, at)
            at += length
        assert at == len(plain.words(r["text"]))
    for held in bins.values():
        at = 0
        for offset, length, _ in sorted(held, key=lambda x: x[0]):
            assert offset == at
            at += length
        assert at <= 300
        assert len({r["source"] for *_, r in held}) == len(held)
        assert len({r["text"].lower() for *_, r in held}) == len(held)


def test_groups_pack_as_a_walk_does(table, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)] + [(3, "x y"), (3, "x y"), (None, "x y"), (None, None)]
    got = {}
    for r in packing.packed(table(rows).repartition(3), capacity=500).collect():
        got.setdefault((r["doc_id"], r["piece"], r["length"]), []).append((r["bin_id"], r["bin_offset"]))
    seen, items = {}, []
    for _, t in rows:
        if t is not None:
            seen[t.lower()] = seen.get(t.lower(), 0) + max(1, -(-len(plain.words(t)) // 500))
    many = {t: 1 + k for k, t in enumerate(t for t, n in seen.items() if n > 1)}
    for i, t in rows:
        n = len(plain.words(t))
        for p in range(max(1, -(-n // 500))):
            items.append((min(500, n - 500 * p), i, p, 1 | (1 << many[t.lower()] if t is not None and t.lower() in many else 0)))
    items.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    some = [x for x in items if x[0]]
    want = {}
    for (length, i, p, _), place in zip(some, walked([(x[0], x[3]) for x in some], 500)):
        want.setdefault((i, p, length), []).append(place)
    for length, i, p, _ in items:
        if not length:
            want.setdefault((i, p, 0), []).append((None, None))
    assert {k: sorted(v, key=repr) for k, v in got.items()} == {k: sorted(v, key=repr) for k, v in want.items()}


def test_one_row_repeated_is_spread_over_groups(table):
    out = packing.packed(table([(5, "a b c")] * 400 + [(None, None)] * 400).repartition(3), capacity=10, group=80).collect()
    assert len(out) == 800 and sum(r["length"] for r in out) == 1200
    bins = [r["bin_id"] for r in out if r["length"]]
    assert len(set(bins)) == 400  # copies of one source never share a bin
    assert len({b >> 32 for b in bins}) == 10


def test_empty_table(table):
    assert packing.packed(table([])).count() == 0


@pytest.mark.parametrize("name", ["op1_best_fit_packing"])
def test_query_reads_the_whole_table(spark, documents, name):
    assert QUERIES[name](spark, SF).select("doc_id").distinct().count() == documents.count()
