"""Personal data: regular expressions propose spans, checksums confirm them, words nearby move the score.

Kinds: email, ip (parts at most 255), card (13 to 19 digits, Luhn), phone (+ and 9 to 15 digits),
iban (ISO 7064 mod 97) and id_number (three groups of digits, kept only beside a word that says
so). A proposal starts with the score of its kind; a checksum and context words add to it; spans
at ``THRESHOLD`` or above stay. The first four kinds reach it by themselves, the last two need
their checksum or context.

Texts are scanned whole in Arrow batches; nothing is shuffled. Every scan is linear in the text.
Defined cases: a null or empty text has no spans; spans of different kinds may overlap, spans of
one kind do not; offsets count code points, the end is exclusive; repeated rows are judged alike;
columns besides ``doc_id`` and ``text`` are not read by ``spans`` and are kept by ``masked``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from crossroads.llm.frames import map_texts

KINDS = ("email", "ip", "card", "phone", "iban", "id_number")
BASE_KINDS = 4
START = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.2, "id_number": 0.3}
CHECKSUM = 0.4
CONTEXT = 0.3
THRESHOLD = 0.6
#: Characters on either side in which context words are looked for.
NEARBY = 40
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "id_number": ("ssn", "social", "passport", "identity", "tax"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_ID_NUMBER = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Country and check digits moved to the end, letters as 10..35, remainder 1."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain.domain: found from each @ outwards, so that long runs cost their length once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        else:
            free = at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost groups of four parts of each dotted run of numbers."""
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        if len(parts) < 4:
            continue
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest beginning of a proposal that has the checksum; groups of upper-case words may follow a number.

    The search goes on after what was found, or else at the next word of the proposal: a number may follow a code.
    """
    at = 0
    while m := _IBAN.search(text, at):
        at = text.find(" ", m.start(), m.end()) + 1 or m.end()
        end = m.end()
        while end - m.start() >= 15:
            plain = text[m.start():end].replace(" ", "")
            if len(plain) >= 15 and mod97(plain):
                yield m.start(), end
                at = end
                break
            end = text.rfind(" ", m.start(), end)


_PROPOSE = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "id_number": lambda t: (m.span() for m in _ID_NUMBER.finditer(t)),
}
_CONFIRMED = {"card", "iban"}


def score(kind: str, text: str, start: int, end: int) -> float:
    near = {w.lower() for w in _WORD.findall(text, max(0, start - NEARBY), start)} | {w.lower() for w in _WORD.findall(text, end, end + NEARBY)}
    return START[kind] + CHECKSUM * (kind in _CONFIRMED) + CONTEXT * any(w in near for w in CONTEXT_WORDS[kind])


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then by start."""
    out = []
    if not text:
        return out
    for kind in KINDS:
        if kind == "phone" and "+" not in text:
            continue
        for a, b in _PROPOSE[kind](text):
            if (points := score(kind, text, a, b)) >= THRESHOLD - 1e-9:
                out.append((kind, a, b, points))
    return out


def table(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each document with their scores, by kind as listed, then by start."""
    span = StructType([
        StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("score", DoubleType()),
    ])
    run = lambda part: {"spans": [spans(t) for t in part.column("text").to_pylist()]}
    return map_texts(docs, run, [StructField("spans", ArrayType(span))])


def mask(text: str | None) -> str | None:
    """The text with each span replaced by its kind; overlapping spans become one."""
    found = sorted((a, b, k) for k, a, b, _ in spans(text))
    if not found:
        return text
    out, at = [], 0
    for a, b, kind in found:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def masked(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, personal data in ``text`` replaced by its kind."""
    run = lambda part: {"text": [mask(t) for t in part.column("text").to_pylist()]}
    return map_texts(docs, run, [], tuple(docs.columns), tuple(docs.columns))
