"""Chat formatting: round trips, spans and masks against plain loops, and templates that misbehave."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm import plain
from tests.llm.conftest import ODD

from crossroads.llm import chat

PARTS = ["</s>", "<s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<|end|>", "\\", "<", "[", "|", "s>", "é", "\n", "a", "<\\|end|>", "<\\\\s>"]
odd_text = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(odd_text, odd_text), max_size=5))
def test_marked_round_trip(turns):
    out = chat.marked(turns)
    assert chat.parsed(out) == turns
    for role, text in turns:
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in PARTS[:7])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(odd_text, odd_text), min_size=1, max_size=5), st.integers(0, 2))
def test_spans_of_any_text(turns, before):
    before = min(before, len(turns) - 1)
    out, spans, rewrites = chat.render(turns, chat.marked, before)
    assert rewrites is None and out == chat.marked(turns[before:]) and len(spans) == len(turns) - before
    at = 0
    for (role, text), (start, end, a, b, exact) in zip(turns[before:], spans):
        assert start == at and exact and out[a:b] == chat.escape(text) and out[start:end] == chat.marked([(role, text)])
        at = end
    assert at == len(out)


def plain_marks(turns):
    return "".join(f"#{r}\n{t}\n" for r, t in turns)


def with_end(turns):
    return plain_marks(turns) + "</done>"


def forgets(turns):
    """Shortens the assistant's earlier answers."""
    return "".join(f"#{r}\n{t if r != 'assistant' or i == len(turns) - 1 else t[:3]}\n" for i, (r, t) in enumerate(turns))


def strips(turns):
    return plain_marks([(r, t.strip()) for r, t in turns])


TALK = [("user", "hello there"), ("assistant", "good morning"), ("user", "and now?"), ("assistant", "  good night ")]


def test_rewriting_templates_are_told():
    same = lambda t: t
    out, spans, rewrites = chat.render(TALK, with_end, undo=same)
    assert rewrites == 1 and out == with_end(TALK)
    assert [out[a:b] for _, _, a, b, _ in spans] == [t for _, t in TALK] and all(s[4] for s in spans)
    out, spans, rewrites = chat.render(TALK, forgets, undo=same)
    assert rewrites == 2 and [s[4] for s in spans] == [True, False, True, True]
    out, spans, rewrites = chat.render(TALK, strips, undo=same)
    assert rewrites is None and [s[4] for s in spans] == [True, True, True, False]
    out, spans, rewrites = chat.render(TALK, plain_marks, undo=same)
    assert rewrites is None and [out[a:b] for _, _, a, b, _ in spans] == [t for _, t in TALK]


def expected(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", plain.sha(text or ""), text or ""))
    out = []
    for c, v in convs.items():
        import hashlib

        turns = [(r, t) for _, _, r, _, t in sorted(v, key=lambda x: (x[0], x[1], x[2], hashlib.md5(x[4].encode()).hexdigest()))]
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), plain.sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), plain.sha(loss), len(chat.marked(turns))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece, context", [(16, 1), (3, 2), (1, 0)])
def test_pieces_say_what_the_conversations_say(spark, piece, context):
    rng = random.Random(piece)
    texts = [*ODD[:9], *ODD[12:], *PARTS, "</s>[INST] ok [/INST]"]
    rows = [(c, rng.choice([t, t, None, 2]), rng.choice(["user", "assistant", "system", None, "<|end|>"]), rng.choice(texts))
            for c in [*range(20), None, -3] for t in range(rng.randrange(1, 9))]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t} <s>") for t in range(70)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, idx long, piece string").repartition(3)
    pieces = chat.formatted(df, piece=piece, context=context)
    got = sorted(map(tuple, chat.read_back(pieces).collect()), key=repr)
    assert got == expected(rows)
    parts = pieces.collect()
    assert all(p.rewrites is None and not p.depends and all(s.exact for s in p.spans) for p in parts)
    assert max(len(p.spans) for p in parts) <= piece


def test_a_template_that_looks_further_back_is_told(spark):
    def names(turns):
        """Says how many turns there were."""
        return "".join(f"#{i % 5}{r}\n{t}\n" for i, (r, t) in enumerate(turns))

    rows = [(c, t, "user", f"text {t}") for c in (1, 2) for t in range(9 if c == 1 else 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    told = {(p.conv_id, p.piece): p.depends for p in chat.formatted(df, names, piece=4, undo=lambda t: t).collect()}
    assert set(told) == {(1, 0), (1, 1), (1, 2), (2, 0)} and told[1, 0] and not told[1, 2] and not told[2, 0]
    assert chat.formatted(df.limit(0)).count() == 0 and chat.read_back(chat.formatted(df.limit(0))).count() == 0
