import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.conftest import ODD, SF

from crossroads.llm import token_output
from crossroads.llm.queries import QUERIES, vocabulary_file

PATH = vocabulary_file("word_bpe_49k.json")


def expected(rows):
    """(id, start, tokens, crc) sorted by id, nulls first, then the text's hash as the rows come."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return {(i, x): [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in rows}


def test_round_trip(spark, table, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)] + [(-5, "negative"), (2**62, "large")]
    want = expected(rows)
    docs = table(rows).repartition(5)
    store = token_output.write(docs, PATH, shard_bytes=60_000)
    assert len(store.before) > 5
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_output.read(docs, store, token_output.crc32, "ids_crc32 long").collect()}
    start = 0
    for i, t in sorted(rows):
        ids = want[i, t]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        start += len(ids)
    assert len(got) == len(rows)
    back = {r["doc_id"]: r["ids"] for r in token_output.read(docs.filter("doc_id < 50"), store).collect()}
    assert back == {i: want[i, t] for i, t in rows if i < 50}


def test_repeated_null_and_unknown_keys(spark, table):
    rows = [(None, "no id"), (None, "none either"), (4, "four"), (4, "four"), (4, "other four"), (1, None), (9, "")]
    want = expected(rows)
    store = token_output.write(table(rows).repartition(3), PATH)
    keys = table([(4, ""), (4, ""), (None, ""), (9, ""), (1, ""), (77, ""), (-1, "")])
    out = [(r["doc_id"], r["start"], tuple(r["ids"])) for r in token_output.read(keys, store).collect()]
    assert sorted((i, ids) for i, _, ids in out if i is not None) == sorted((i, tuple(want[i, t])) for i, t in rows if i is not None)
    assert sorted(ids for i, _, ids in out if i is None) == sorted(tuple(want[i, t]) for i, t in rows if i is None)
    by_start = sorted(out, key=lambda r: r[1])
    assert [i for i, *_ in by_start] == [None, None, 1, 4, 4, 4, 9]
    assert [s for _, s, _ in by_start] == np.cumsum([0, *(len(x) for *_, x in by_start)])[:-1].tolist()


def test_empty_table(table):
    store = token_output.write(table([]), PATH)
    assert store.before == {}
    assert token_output.read(table([(1, "")]), store).count() == 0


def test_perfect_hash():
    rng = random.Random(2)
    for n in (0, 1, 2, 63, 5000):
        keys = np.array(rng.sample(range(1 << 60), n), np.uint64)
        table = token_output.PerfectHash.of(keys)
        assert sorted(table.find(keys).tolist()) == list(range(n))
        assert len(table.bits) * 64 <= 4 * n + 64 * 12


def test_bounds_send_nulls_first():
    ids, dealt = pa.array([None, 1, 5, 6, 9], pa.int64()), np.arange(5, dtype=np.uint64)
    assert token_output._shard_of(ids, dealt, np.array([5, 9])).tolist() == [0, 0, 1, 1, 2]


def test_one_id_and_nulls_over_several_shards(table, tmp_path):
    least = -(2**63)
    rows = [(7, f"the same words {i % 40}") for i in range(600)] + [(7, "one row many times")] * 200
    rows += [(None, f"no id {i % 9}") for i in range(500)] + [(i, f"another {i}") for i in range(300) if i != 7] + [(least, "the least id")]
    want = expected(rows)
    docs = table(rows).repartition(4)
    store = token_output.write(docs, PATH, folder=f"file:{tmp_path}/ids", shard_bytes=800)
    assert (store.bounds == 7).sum() > 4 and (store.bounds == token_output.NULL_AT).sum() > 4
    sizes = [len(token_output.Shard(store.folder, k).starts) - 1 for k in store.before]
    assert max(sizes) < 200
    out = [(r["doc_id"], r["start"], tuple(r["ids"])) for r in token_output.read(docs, store).collect()]
    assert sorted((i is not None, i or 0, ids) for i, _, ids in out) == sorted((i is not None, i or 0, tuple(want[i, t])) for i, t in rows)
    out.sort(key=lambda r: r[1])
    assert [i for i, *_ in out] == [None] * 500 + sorted(i for i, _ in rows if i is not None)
    assert [s for _, s, _ in out] == np.cumsum([0, *(len(x) for *_, x in out)])[:-1].tolist()


@pytest.mark.parametrize("name", ["op10_token_output"])
def test_query_reads_the_whole_table(spark, documents, name):
    assert QUERIES[name](spark, SF).count() == documents.count()


def test_words_from_pieces_are_the_library_s_words(monkeypatch):
    """Random words of plain and other characters, also with tiny caches."""
    rng = random.Random(9)
    signs = "abcXYZéÉñßÿÖ'.,;!?-_<>|@#0123456789stremvld" + "×÷ªµ¼İıﬁǅ" + "\u0301\u0308" + "漢😀\u00a0\u2003\x1c\x00\x7f"
    texts = [" ".join("".join(rng.choice(signs) for _ in range(rng.randrange(1, 9))) for _ in range(30)) for _ in range(400)]
    texts += ["it's IT'S we'LL '' 'sx ''s ,'s <|endoftext|> a<|startoftext|>b <|endof", "DON'T ÀÉÎ straße STRASSE", "", " ", "  a\n\n b\t\x0b\x0c\r"]
    want = [[*x.ids, 1] for x in token_output.Encoder(PATH).whole.encode_batch(texts, add_special_tokens=False)]
    for cached in (300_000, 5):
        monkeypatch.setattr(token_output, "CACHED", cached)
        got = [np.frombuffer(p, "<u2").tolist() for p in token_output.Encoder(PATH).packed(pa.array(texts))]
        assert got == want
