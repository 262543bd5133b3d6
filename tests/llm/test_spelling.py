"""Spelling variants against all pairs in plain loops."""

import random
import re
import zlib
from collections import Counter

import pytest
from tests.llm import plain
from tests.llm.conftest import ODD

from crossroads.llm import spelling
from crossroads.llm.queries import QUERIES


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b or len(set(a) ^ set(b)) > 2:  # one edit brings at most one letter and takes one
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] == 1


def counted(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = plain.lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def expected(n):
    near = {w: [] for w in n}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    for w in n:
        near[w] = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if distance_one(w, x)]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, c, len(near[w]), form[w], n.get(form[w]), root(w)) for w, c in n.items())


def rows_of(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def made_up(seed):
    """Words of few letters with edits, chains of rarer and rarer spellings, accents, very long words."""
    rng, out = random.Random(seed), []
    for _ in range(40):
        word = "".join(rng.choice("abétç") for _ in range(rng.randrange(7, 12)))
        n = 220
        while n > 1:
            out += [word] * n
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice("abétç") + word[at:], word[:at] + "b" + word[at + 1:]])
            n //= rng.choice([3, 10, 11])
    long = "".join(rng.choice("xyz") for _ in range(200))
    out += [long] * 30 + [long + "y"] * 2 + [long[:50] + long[51:]] * 3 + ["a" * 40] * 20 + ["a" * 41] * 2 + ["A" * 39] * 2
    rng.shuffle(out)
    return [(i if i % 9 else None, " ".join(out[i::60])) for i in range(60)]


@pytest.mark.parametrize("tile, asking, at_once", [(spelling.TILE, spelling.ASKING, spelling.AT_ONCE), (40, 70, 1 << 18), (25, 1000, 64)])
def test_variants_equal_all_pairs(table, monkeypatch, tile, asking, at_once):
    monkeypatch.setattr(spelling, "AT_ONCE", at_once)
    rows = made_up(tile) + [(10**6 + i, t) for i, t in enumerate(ODD)] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    want = expected(counted(rows))
    assert any(w[3] for w in want) and any(w[5] != w[3] for w in want if w[3])
    words = spelling.word_counts(table(rows).repartition(3), change=spelling.typos)
    assert rows_of(spelling.variants(words, tile=tile, asking=asking)) == want


def test_counts_without_change_and_other_limits(table):
    rows = [(1, "Colour colour COLOUR color été2été naïve"), (2, None), (3, "")]
    got = {r.word: r.n for r in spelling.word_counts(table(rows), least_length=3, least_count=1).collect()}
    assert got == {"colour": 3, "color": 1, "été": 2, "naïve": 1}
    made = spelling.variants(spelling.word_counts(table(rows), 3, 1), ratio=3)
    assert {r.word: r.root for r in made.collect() if r.form} == {"color": "colour"}


def test_whole_documents_and_no_documents(spark, table, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows_of(QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001")) == expected(counted(rows))
    assert spelling.variants(spelling.word_counts(table([]))).count() == 0
