import random

import numpy as np
import pyarrow as pa
import pytest
from tests.llm import plain
from tests.llm.conftest import ODD, SF

from crossroads.llm import lm_scoring
from crossroads.llm.elias_fano import EliasFano, encode
from crossroads.llm.queries import QUERIES


def test_elias_fano_finds_what_is_there():
    rng = random.Random(4)
    for n, universe in ((0, 10), (1, 1), (1, 1 << 62), (5, 5), (1000, 1001), (5000, 1 << 40), (70_000, 1 << 20), (3000, 1 << 60)):
        x = np.array(sorted(rng.sample(range(universe), n)), np.uint64)
        if n == 5000:  # clusters and gaps
            x = np.unique(np.concatenate([x[:100], np.arange(4900, dtype=np.uint64) + np.uint64(1 << 30)]))
        code = EliasFano(encode(x, universe))
        assert code.find(x).tolist() == list(range(len(x)))
        others = np.array([v for v in (rng.randrange(2 * universe) for _ in range(2000))], np.uint64)
        want = [int(np.searchsorted(x, v)) if v in set(x.tolist()) else -1 for v in others.tolist()]
        assert code.find(others).tolist() == want


def compare(got, want, order):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert tuple(g[:5]) == tuple(w[:5])
        assert abs(g[5] - w[5]) < 1e-6 * (1 + abs(w[5]))
        # rounding down costs at most one step of the quotient and of the weight for each level and token
        lost = (lm_scoring.Q_STEP + lm_scoring.G_STEP) * (order - 1) * w[2]
        assert -lost - 1e-6 <= g[6] - w[6] <= 1e-6, (g, w)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_loops(table, documents, order):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    rows += [(None, "the the the"), (None, None), (5, rows[0][1]), (6, rows[0][1].upper())]
    got = lm_scoring.scores(table(rows).repartition(3), order).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    compare([tuple(r) for r in got], plain.language_model(rows, order), order)


def test_sends_in_parts_change_nothing(table, documents, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()]
    monkeypatch.setattr(lm_scoring, "HELD", 100)
    got = [tuple(r) for r in lm_scoring.scores(table(rows)).collect()]
    compare(got, plain.language_model(rows), 3)


def test_probabilities_sum_to_at_most_one(table):
    """Over all known tokens and one unseen one the model gives away nearly 1 after any context, never more."""
    training = [f"{x} {y} {z}" for x in "abc" for y in "aab" for z in "bca"] + ["a b a b a c", "b a b"]
    model = lm_scoring.train(table(training))
    reader = lm_scoring.Reader(model)
    for context in ([], ["a"], ["a", "b"], ["b", "a"], ["c", "c"], ["zz"], ["zz", "a"]):
        texts = [" ".join([*context, w]) for w in ("a", "b", "c", "unseen")] + [" ".join(context)]
        n, _, _, p = lm_scoring.token_probabilities(reader, pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]))
        at = np.cumsum(n) - n + len(context)  # the token after the context; the end token in the last text
        assert 0.85 < p[at].sum() <= 1 + 1e-9, (context, p[at])


def test_nothing_to_learn_from(table):
    assert lm_scoring.scores(table([])).count() == 0
    held = [i for i in range(50) if plain.language_model([(i, "x")])[0][1]][:2]
    rows = [(i, "only held out") for i in held]
    compare([tuple(r) for r in lm_scoring.scores(table(rows)).collect()], plain.language_model(rows), 3)


def test_held_out_texts_are_better_told_than_by_words_alone(documents):
    out = lm_scoring.scores(documents).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert out["s"] > out["b"]


@pytest.mark.parametrize("name", ["op2_lm_scoring"])
def test_query_reads_the_whole_table(spark, documents, name):
    assert QUERIES[name](spark, SF).count() == documents.count()
