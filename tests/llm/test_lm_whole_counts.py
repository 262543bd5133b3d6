"""The query's model has every n-gram that was counted, and a frequent context does not bound its quotients."""

import numpy as np
import pyarrow as pa
from tests.llm import plain
from tests.llm.conftest import SF
from tests.llm.test_lm_scoring import compare

from crossroads.llm import lm_scoring
from crossroads.llm.queries import QUERIES


def test_the_query_keeps_ngrams_seen_once(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = QUERIES["op2_lm_scoring"](spark, SF).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    compare([tuple(r) for r in got], plain.language_model(rows, least=1), 3)


def test_quotients_of_very_frequent_contexts():
    q = np.array([0.25, 0.25 / 6e7, 0.25 / 3e9, 0.25 / 1e12])
    told = 10.0 ** (-lm_scoring.Q_STEP * lm_scoring._log_code(q, lm_scoring.Q_STEP))
    assert (told <= q * (1 + 1e-6)).all() and (told > q * 0.99).all()


def test_each_pair_of_a_slice_is_looked_up_once(table, monkeypatch):
    """Repeats of a pair in a slice cost no search of their own, and counting looks up no weights."""
    texts = ["the cat sat on the mat"] * 50 + ["the cat ran", "a mat unseen"]
    model = lm_scoring.train(table(texts), least=1)
    reader, asked = lm_scoring.Reader(model), []
    find = lm_scoring.EliasFano.find
    monkeypatch.setattr(lm_scoring.EliasFano, "find", lambda self, x: asked.append(len(x)) or find(self, x))
    part = pa.RecordBatch.from_arrays([pa.array(texts * 3)], ["text"])
    hashes, n = lm_scoring._tokens(part)
    number, _ = reader.number_words(hashes)
    before = np.r_[-1, number[:-1]]
    asked.clear()
    node, q, g = reader.children(2, before, number)
    assert sum(asked) <= len({*zip(before.tolist(), number.tolist())})
    # as each token by itself
    for i in range(0, len(node), 7):
        one = reader.children(2, before[i:i + 1], number[i:i + 1])
        assert (node[i], q[i], g[i]) == tuple(x[0] for x in one)
    monkeypatch.setattr(lm_scoring.Reader, "weights", None)
    assert (reader.children(2, before, number, values=False)[0] == node).all()
