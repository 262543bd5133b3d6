"""The conversation trie against plain loops over all beginnings."""

import random
import zlib

import pytest
from tests.llm import plain

from crossroads.llm import prefix_trie
from crossroads.llm.frames import stored

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k string"


def ordered(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, role or "", hash_of(text or ""), text or ""))
    return {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in out.items()}


def hash_of(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def expected(convs):
    members, ends = {}, {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    name = {k: (min(v), len(k)) for k, v in members.items()}
    children, saved, leaves = {}, {}, {}
    for k in sorted(members, key=len, reverse=True):
        saved[k] = saved.get(k, 0) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
        leaves[k] = leaves.get(k, 0) or 1
        if k:
            up = k[:-1]
            children[up] = children.get(up, 0) + 1
            saved[up] = saved.get(up, 0) + saved[k]
            leaves[up] = leaves.get(up, 0) + leaves[k]
    return sorted((*name[k], name[k[:-1]][0] if k else None, len(v), children.get(k, 0), leaves[k], saved[k],
                   plain.sha(",".join(map(str, sorted(ends.get(k, [])))))) for k, v in members.items())


def rows_of(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def made_up(seed):
    """Few texts, so beginnings are shared; a long chain, a chain with a leaf at every turn, ties, nulls, equal conversations."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 24), *range(100, 130), -5, -100, 10**12 + 7]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é€"])))
    rows += [(200, t, "user", "long" * (t % 3)) for t in range(40)]
    for n in range(12):
        rows += [(300 + n, t, "user", "comb") for t in range(n + 1)] + [(300 + n, n + 1, "user", f"tip {n}")]
    for c in (401, 402, 403, 404):
        rows += [(c, t, "user", "same") for t in range(3)]
    rows += [(500, 1, "user", "twice"), (500, 1, "user", "twice"), (None, 1, "user", "nobody")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_loops(spark, monkeypatch, rebuild):
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = made_up(7)
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA).repartition(3)
    convs = ordered(rows)
    out = prefix_trie.trie(df) if rebuild else prefix_trie.trie(df, rebuild=None)
    assert rows_of(out) == expected(rebuilt(convs) if rebuild else convs)


def test_no_conversations(spark):
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "nobody", 1, "x")], SCHEMA)).count() == 0


def test_jobs_do_not_grow_with_the_depth(spark, monkeypatch):
    """A chain of 70 turns with a leaf at every turn, beside a plain chain: as many tables are stored as for one turn."""
    made = []
    monkeypatch.setattr(prefix_trie, "stored", lambda df, name: made.append(name) or stored(df, name))
    used = {}
    for depth in (1, 70):
        rows = [(7000, t, "user", "long") for t in range(depth)]
        for n in range(depth):
            rows += [(7001 + n, t, "user", "comb") for t in range(n)] + [(7001 + n, n, "user", f"tip {n}")]
        convs = ordered(rows)
        out = prefix_trie.trie(spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA), rebuild=None)
        assert rows_of(out) == expected(convs)
        used[depth], made[:] = len(made), []
    assert used[1] == used[70] <= 8


def test_no_running_value_stands_on_another(spark, monkeypatch):
    """Each reads its input several times: one on another multiplied the plan to over a thousand exchanges."""
    sizes = []

    def sized(df, name):
        sizes.append(df._jdf.queryExecution().optimizedPlan().toString().count("Window ["))
        return stored(df, name)

    monkeypatch.setattr(prefix_trie, "stored", sized)
    prefix_trie.trie(spark.createDataFrame([(c, t, "user", "x", 9, "x") for c in range(3) for t in range(4)], SCHEMA))
    assert max(sizes) <= 8
