"""Chat formatting by incremental rendering of a black-box template.

A template is any function from turns [(role, text), ...] to a string. It is rendered for successive prefixes of a
conversation, and consecutive outputs are compared: what an output adds to the one before is the turn's span. Where in
the span the text lies is found by rendering the turn with two one-letter texts: what the two outputs share at the
start is what comes before the text, and at the end what comes after it. A template that changes what it wrote for
earlier turns is detected by the first output that does not begin with the one before; spans are then taken by the
same two probes in the last output.

Conversations are cut into pieces of ``PIECE`` turns, each rendered after the ``context`` turns before it, so a
conversation of any length spreads over tasks and the prefixes rendered stay short. A template whose rendering of a
turn depends on more than that needs a larger ``context``; the first turn of a piece is rendered a second time behind
all of the piece before, and a difference is reported.

Defined cases: a null role or text is empty; rows without a conv_id form one conversation, named null; turns come in order
of ``turn`` (null first), ties by role and the md5 of the text; equal rows are separate turns; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from crossroads.llm.frames import SLICE_BYTES, partitions
from crossroads.operators import prefix

PIECE = 16
CONTEXT = 1
LOSS_ROLES = ("assistant",)

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

# fixed values: the marks of our own template and the control strings that may not stand in a text
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = r"(<|\[)(\\*)(\|turn\|>|\|text\|>|\|end\|>|/?s>|/?INST\])"
_CONTROLS = re.compile(CONTROLS)
_ESCAPED = re.compile(CONTROLS.replace(r"(\\*)", r"\\(\\*)"))
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)

PIECES = (
    "conv_id long, piece long, text string, "
    "spans array<struct<turn: long, role: string, start: int, end: int, text_start: int, text_end: int, loss: boolean, exact: boolean>>, "
    "rewrites long, depends boolean"
)


def escape(text: str) -> str:
    """One more backslash behind the first character of every control string, with or without backslashes there."""
    return _CONTROLS.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def marked(turns: Turns) -> str:
    """Our own template: each turn between marks, control strings inside roles and texts escaped."""
    return "".join(f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}" for role, text in turns)


def parsed(formatted: str) -> Turns:
    """The turns of a string made by ``marked``."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def shared_start(a: str, b: str) -> int:
    """Length of the common beginning, by halving: slices are compared at machine speed."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def _around(template: Template, turns: Turns, k: int, upto: int) -> tuple[str, str]:
    """What stands before and after the text of turn ``k`` when ``upto`` turns are rendered."""
    role = turns[k][0]
    a, b = (template([*turns[:k], (role, probe), *turns[k + 1:upto]]) for probe in "ab")
    head = shared_start(a, b)
    tail = shared_start(a[head:][::-1], b[head:][::-1])
    return a[:head], a[len(a) - tail:]


def render(turns: Turns, template: Template = marked, before: int = 0, undo: Callable[[str], str] = unescape) -> tuple[str, list[tuple], int | None]:
    """The text that turns from ``before`` on add, their spans in it, and the first turn that changed earlier output.

    A span is (start, end, text_start, text_end, exact); exact says that the text is found there whole, escapes undone.
    The first ``before`` turns are context only.
    """
    base = last = template(turns[:before]) if before else ""
    spans, rewrites = [], None
    for k in range(before, len(turns)):
        out = template(turns[:k + 1])
        kept = shared_start(last, out)
        if kept < len(last) and rewrites is None:
            rewrites = k
        head, tail = _around(template, turns, k, k + 1)
        spans.append((kept, len(out), *_text_at(out, head, tail, turns[k][1], undo)))
        last = out
    start = shared_start(base, last)
    if rewrites is not None:
        spans = []
        for k in range(before, len(turns)):
            head, tail = _around(template, turns, k, len(turns))
            at = _text_at(last, head, tail, turns[k][1], undo)
            spans.append((at[0], at[1], *at))
    moved = [(*(max(0, at - start) for at in s[:4]), s[4]) for s in spans]
    return last[start:], moved, rewrites


def _text_at(out: str, head: str, tail: str, text: str, undo: Callable[[str], str]) -> tuple[int, int, bool]:
    start, end = len(head), len(out) - len(tail)
    fits = start <= end and out.startswith(head) and out.endswith(tail)
    return start, max(start, end), fits and undo(out[start:end]) == text


def formatted(
    conversations: DataFrame, template: Template = marked, loss_roles: tuple[str, ...] = LOSS_ROLES, context: int = CONTEXT,
    piece: int = PIECE, undo: Callable[[str], str] = unescape,
) -> DataFrame:
    """The formatted pieces of every conversation: text, spans (code points in it) and loss mask, in order of ``piece``.

    ``rewrites`` is the number of the first turn that made the template change earlier output (null: none), ``depends`` says
    that the turn after the piece reads differently behind ``context`` turns than behind the whole piece.
    """
    if not 0 <= context < piece:
        raise ValueError("context must be smaller than a piece")
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), F.md5(text).alias("md5"))
    numbered = prefix.numbered(rows, ["conv_id"], ["turn", "role", "md5"], "idx")
    home = F.floor(F.col("idx") / piece)
    # A turn is sent to its own piece, as context to the next, and as the turn after it to the one before.
    visits = F.array_distinct(F.array(home, F.floor((F.col("idx") + context) / piece), F.floor((F.col("idx") - 1) / piece)))
    spread = numbered.select("conv_id", "idx", "role", "text", F.explode(visits).alias("piece")).filter("piece >= 0")
    placed = spread.repartition(partitions(conversations.sparkSession), "conv_id", "piece").sortWithinPartitions("conv_id", "piece", "idx")
    schema = to_arrow_schema(StructType.fromDDL(PIECES))

    def made(conv_id, number: int, rows: list[tuple[int, str, str]]) -> dict:
        own = [(r, t) for i, r, t in rows if i < (number + 1) * piece]
        after = [(r, t) for i, r, t in rows if i >= (number + 1) * piece]
        before = sum(i < number * piece for i, _, _ in rows)
        out, spans, rewrites = render(own, template, before, undo)
        first = number * piece - before
        depends = False
        if after:
            add = lambda turns: (lambda a, b: b[shared_start(a, b):])(template(turns), template([*turns, after[0]]))
            depends = add(own) != add(own[-context:] if context else own)
        return {
            "conv_id": conv_id, "piece": number, "text": out, "rewrites": None if rewrites is None else first + rewrites, "depends": depends,
            "spans": [
                {"turn": number * piece + j, "role": role, "start": s[0], "end": s[1], "text_start": s[2], "text_end": s[3], "exact": s[4],
                 "loss": role in loss_roles}
                for j, ((role, _), s) in enumerate(zip(own[before:], spans))
            ],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, size = [], 0
        for key, rows in _grouped(batches, ("conv_id", "piece"), ("idx", "role", "text")):
            if rows[-1][0] < key[1] * piece or rows[0][0] >= (key[1] + 1) * piece:
                continue  # context of a piece that has no turns of its own
            told.append(made(*key, rows))
            size += len(told[-1]["text"])
            if size > SLICE_BYTES:
                yield pa.RecordBatch.from_pylist(told, schema=schema)
                told, size = [], 0
        yield pa.RecordBatch.from_pylist(told, schema=schema)

    return placed.mapInArrow(run, PIECES)


def _grouped(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], values: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by key; only one key's rows are held."""
    now, rows = None, []
    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in key]))
        for k, v in zip(keys, zip(*[batch.column(c).to_pylist() for c in values])):
            if k != now and rows:
                yield now, rows
                rows = []
            now = k
            rows.append(v)
    if rows:
        yield now, rows


def read_back(pieces: DataFrame, undo: Callable[[str], str] = unescape, parse: Callable[[str], Turns] = parsed) -> DataFrame:
    """What the formatted pieces say, a row for each conversation: its turns and the text under the loss mask, as digests.

    Turns are parsed from the text, the loss from the spans. The digest of a conversation needs its pieces in order, so one
    task reads them, as a stream: it holds one piece and two hash states.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    n = partitions(pieces.sparkSession)
    placed = pieces.select("conv_id", "piece", "text", F.filter("spans", lambda s: s["loss"]).alias("loss"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, now, all_turns, loss = [], None, hashlib.sha256(), hashlib.sha256()
        for (conv_id, _), [(text, spans)] in _grouped(batches, ("conv_id", "piece"), ("text", "loss")):
            if now is None or conv_id != now["conv_id"]:
                if now:
                    told.append(now | {"turns_sha256": all_turns.hexdigest(), "loss_sha256": loss.hexdigest()})
                if len(told) >= 1024:
                    yield pa.RecordBatch.from_pylist(told, schema=arrow)
                    told = []
                now, all_turns, loss = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}, hashlib.sha256(), hashlib.sha256()
            for role, said in parse(text):
                now["n_turns"] += 1
                all_turns.update(f"{role}\n{said}\n".encode())
            for s in spans:
                said = undo(text[s["text_start"]:s["text_end"]])
                now["loss_chars"] += len(said)
                loss.update(said.encode())
            now["formatted_chars"] += len(text)
        if now:
            told.append(now | {"turns_sha256": all_turns.hexdigest(), "loss_sha256": loss.hexdigest()})
        yield pa.RecordBatch.from_pylist(told, schema=arrow)

    return placed.repartition(n, "conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, schema)
