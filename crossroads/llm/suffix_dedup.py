"""Removal of long repeated byte strings with a run-length index.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too. Candidates are
found by content: the anchor of a window is the place of the least hash of ``GRAM`` bytes in it, so
equal windows have it at the same distance. Windows at similar distances to one anchor form a unit;
all of them contain the same ``CORE`` bytes. Every unit asks whether its core and its whole span occur
elsewhere. A core that occurs once settles that nothing repeats; a whole span that occurs twice
settles that all of the unit repeats, which is nearly all of a repetitive corpus. What is left, the
edges of matches, goes to an index:

* A bucket's edge units are one text: bytes before the core, the core as one symbol, bytes after it,
  an end sign of its own. Its suffixes are sorted, the Burrows-Wheeler transform is cut into runs, and
  suffix positions are sampled at the heads and ends of runs.
* Matching statistics are streamed from the samples: the match of a sampled position with its
  neighbour is measured, and inside a run the match of position i + 1 is that of i less one.
* Positions whose match has the core and all of the window's other bytes are marked.

A core with more than ``HOT`` different units (a passage that very many documents share) is not
indexed in one bucket: its windows are hashed one by one and counted in buckets over the whole
cluster. Nothing is dropped or capped on either way.

Beside what the rule removes, which includes first copies, ``measured`` tells later copies: bytes covered
by a window that starts earlier too, in order of (doc_id, block, place in it). Every unit that repeats
says where its first copy in the block begins. Copies of a whole unit are ordered by that; where a core has
different units, windows that are equal lie together in suffix order, and the first of them is sought there.

Windows lie within one document. Defined cases: a null text is empty; a text shorter than ``LENGTH``
loses nothing; equal texts, also with the same or a null doc_id, are repeats of each other, and a null id comes last; an empty
table gives an empty table; only ``doc_id`` (bigint) and ``text`` are read. Kept bytes may end inside
a character, hence the binary column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossroads.llm import exchange
from crossroads.llm.exchange import Block
from crossroads.llm.hashing import prefix_sums, span_hash

LENGTH = 400
GRAM = 32
SPREAD = 96
CORE = LENGTH - SPREAD + 1
HOT = 20_000

#: What a bucket says of a unit: core unique; span repeated; ask the index; repeated and needed there; the same two for hot cores.
UNIQUE, REPEATED, INDEX, REPEATED_INDEX, COUNT, REPEATED_COUNT = range(6)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    padded = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


class _Units:
    """The units of a block in order of (core hash, span hash): first and last window start, place of the core."""

    def __init__(self, block: Block):
        data, self.sums = block.data, prefix_sums(block.data)
        self.ids, self.starts = block.sort_ids, block.starts
        place_bits = np.uint64(max(28, len(data).bit_length()))
        at = np.arange(max(0, len(data) - GRAM + 1))
        grams = span_hash(self.sums, at, at + GRAM)
        least = sliding_least((grams >> place_bits << place_bits) | at.astype(np.uint64), LENGTH - GRAM + 1)
        anchor = (least & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
        start = np.arange(len(anchor))
        ends = block.starts + block.lens
        inside = start + LENGTH <= np.repeat(ends, block.lens)[:len(start)]
        start, anchor = start[inside], anchor[inside]
        core = anchor - (anchor - start) // SPREAD * SPREAD
        new = np.ones(len(start), bool)
        new[1:] = (core[1:] != core[:-1]) | (start[1:] != start[:-1] + 1)
        last = np.r_[new[1:], True] if len(new) else new
        first, last, core = start[new], start[last], core[new]
        core_hash, span = span_hash(self.sums, core, core + CORE), span_hash(self.sums, first, last + LENGTH)
        order = np.lexsort((span, core_hash))
        self.first, self.last, self.core, self.core_hash, span = first[order], last[order], core[order], core_hash[order], span[order]
        new = np.ones(len(order), bool)
        new[1:] = (self.core_hash[1:] != self.core_hash[:-1]) | (span[1:] != span[:-1])
        self.distinct = np.flatnonzero(new)
        self.which = np.cumsum(new) - 1
        self.span = span[self.distinct]
        self.copies = np.bincount(self.which, minlength=len(self.distinct)) if len(order) else np.zeros(0, np.int64)

    def cuts(self, n: int) -> list[tuple[int, int, int]]:
        return list(exchange.by_bucket(self.core_hash[self.distinct], n))

    def verdicts(self, told: dict) -> np.ndarray:
        """What the buckets said of the distinct units."""
        return np.frombuffer(b"".join(told.get("unit", [])), np.uint8)

    def leads(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct unit the first copy in the block, by id and place, and its id."""
        lead = self.distinct.copy()
        many = np.flatnonzero(self.copies[self.which] > 1) if len(self.which) else self.which
        if len(many):
            many = many[np.lexsort((self.first[many], self.id_at(self.first[many]), self.which[many]))]
            new = np.r_[True, np.diff(self.which[many]) > 0]
            lead[self.which[many[new]]] = many[new]
        return lead, self.id_at(self.first[lead])

    def id_at(self, place: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.starts, place, side="right") - 1]

    def windows(self, verdict: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of units with hot cores: distinct hashes, whether each is known to repeat, all starts in order of
        (hash, id, place), which hash each has."""
        of = verdict[self.which] if len(self.which) else self.which
        units = np.flatnonzero((of == COUNT) | (of == REPEATED_COUNT))
        sizes = self.last[units] - self.first[units] + 1
        begin = np.cumsum(sizes) - sizes
        start = np.repeat(self.first[units] - begin, sizes) + np.arange(sizes.sum())
        distinct, inverse, n = np.unique(span_hash(self.sums, start, start + LENGTH), return_inverse=True, return_counts=True)
        order = np.lexsort((start, self.id_at(start), inverse))
        return distinct, n > 1, start[order], inverse[order]


def _unit_rows(block: Block, n: int) -> Iterator[tuple]:
    u = _Units(block)
    core, twice = u.core_hash[u.distinct].astype(np.uint32), u.copies > 1
    for b, i, j in u.cuts(n):
        yield b, block.number, core[i:j].tobytes(), u.span[i:j].tobytes(), np.packbits(twice[i:j]).tobytes()


def _judged(rows: list[dict]) -> list[bytes]:
    """The verdict on every unit of a bucket. Cores with the same shortened hash only cost a later look."""
    sizes = [len(r["cores"]) // 4 for r in rows]
    core = np.concatenate([np.frombuffer(r["cores"], np.uint32) for r in rows])
    span = np.concatenate([np.frombuffer(r["spans"], np.uint64) for r in rows])
    twice = exchange.bits([r["twice"] for r in rows], sizes)
    order = np.lexsort((span, core))
    core, span, twice = core[order], span[order], twice[order]
    new_core = np.r_[True, core[1:] != core[:-1]]
    new_span = new_core | np.r_[True, span[1:] != span[:-1]]
    group, unit = np.cumsum(new_core) - 1, np.cumsum(new_span) - 1
    repeated = (np.bincount(unit) + np.bincount(unit, weights=twice) > 1)[unit]
    different = np.bincount(group[new_span])[group]
    verdict = np.where(repeated, REPEATED, UNIQUE)
    # Of equal units the first one speaks for all.
    verdict[(different > 1) & ~repeated] = INDEX
    verdict[(different > 1) & repeated & new_span] = REPEATED_INDEX
    hot = different > HOT
    verdict[hot & ~repeated] = COUNT
    verdict[hot & repeated] = REPEATED_COUNT
    out = np.empty(len(order), np.uint8)
    out[order] = verdict
    return [x.tobytes() for x in exchange.cut(out, sizes)]


def _edge_rows(block: Block, told: dict, n: int) -> Iterator[tuple]:
    """For each bucket: the units that may repeat, where their first copies begin, the bytes around the cores that the index must see."""
    u = _Units(block)
    verdict, (lead, ids) = u.verdicts(told), u.leads()
    for b, i, j in u.cuts(n):
        at = i + np.flatnonzero(_ordered(verdict[i:j]))
        if len(at):
            pick, seen = lead[at], _indexes(verdict[at])
            first, last, core = u.first[pick], u.last[pick], u.core[pick]
            around = b"".join(
                block.body[f:c] + block.body[c + CORE:e + LENGTH] for f, c, e in zip(first[seen].tolist(), core[seen].tolist(), last[seen].tolist())
            )
            yield (
                b, block.number, u.core_hash[pick].tobytes(), u.span[at].tobytes(), ids[at].tobytes(), first.astype(np.uint32).tobytes(),
                (core - first).astype(np.uint8).tobytes(), (last + LENGTH - core - CORE).astype(np.uint8).tobytes(),
                np.packbits(seen).tobytes(), pa.compress(around, "zstd", asbytes=True),
            )


def _indexes(verdict: np.ndarray) -> np.ndarray:
    return (verdict == INDEX) | (verdict == REPEATED_INDEX)


def _ordered(verdict: np.ndarray) -> np.ndarray:
    return _indexes(verdict) | (verdict == REPEATED)


class RunLengthIndex:
    """A text of integer symbols whose suffixes all differ: suffix order, runs of the transform, samples at run ends."""

    def __init__(self, text: np.ndarray, longest: int):
        self.text = text
        n = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        step = 1
        while step <= longest and rank.max(initial=0) < n - 1:
            ahead = np.zeros(n, np.int64)
            ahead[:n - step] = rank[step:] + 1
            rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1]
            step *= 2
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        self.rank = rank
        transform = text[suffix - 1]
        heads = np.flatnonzero(np.r_[False, transform[1:] != transform[:-1]])
        # Of the suffix array only samples are kept: the positions at run heads, at the ends of the runs before them, and the outermost ones.
        self.heads, self.tails, self.outer = suffix[heads], suffix[heads - 1], (suffix[:1].copy(), suffix[-1:].copy())

    def matches(self) -> np.ndarray:
        """At each position the longest match with any other position, streamed from the samples."""
        above = self._streamed(self.heads, self.tails, self.outer[0])
        below = self._streamed(self.tails, self.heads, self.outer[1])
        return np.maximum(above, below)

    def classes(self, length: int) -> np.ndarray:
        """A number of each position; positions have the same one if their next ``length`` symbols are the same."""
        new = np.empty(len(self.text), bool)
        new[self.rank] = self._streamed(self.heads, self.tails, self.outer[0]) < length
        return np.cumsum(new)[self.rank]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common beginnings of suffixes at a and at b; end signs differ, so they end by themselves."""
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        while len(open_):
            i, j = a[open_] + out[open_], b[open_] + out[open_]
            open_ = open_[self.text[i] == self.text[j]]
            out[open_] += 1
        return out

    def _streamed(self, at: np.ndarray, neighbour: np.ndarray, alone: np.ndarray) -> np.ndarray:
        n = len(self.text)
        last = np.zeros(n, np.int64)
        value = np.zeros(n, np.int64)
        value[at] = self._common(at, neighbour)
        last[at] = at
        last[alone] = alone
        last = np.maximum.accumulate(last)
        return np.maximum(0, value[last] - (np.arange(n) - last))


#: Windows whose order is compared at a time.
MOST_WINDOWS = 1 << 20


def _least(keys: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    """For each row the row of its group that comes first by the keys, the first key above the others."""
    order = np.lexsort((*keys[::-1], group))
    new = np.r_[True, np.diff(group[order]) != 0][:len(order)]
    out = np.empty(len(order), np.int64)
    out[order] = order[new][np.cumsum(new) - 1]
    return out


def _numbered(*keys: np.ndarray) -> np.ndarray:
    """Equal rows of the keys have the same number."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _indexed(rows: list[dict]) -> list[bytes]:
    """For the units sent, in order, packed bits: does the first copy lie here; is it the windows that tell this; of units whose
    bytes were sent: which windows repeat; of units whose windows tell: which of them start earlier too."""
    sizes = [len(r["left"]) for r in rows]
    column = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows])
    core, span, ids = column("cores", np.uint64), column("spans", np.uint64), column("ids", np.int64)
    at, le, ri = (column(name, kind).astype(np.int64) for name, kind in (("at", np.uint32), ("left", np.uint8), ("right", np.uint8)))
    block = np.repeat(np.array([r["block"] for r in rows], np.int64), sizes)
    seen = exchange.bits([r["seen"] for r in rows], sizes)
    # A unit has as many windows as its bytes around the core exceed those that one window takes.
    windows = le + ri - (SPREAD - 1) + 1
    group = _numbered(span, core)
    lead = _least([ids, block, at], group)
    units, around = np.flatnonzero(seen), []
    for r, part in zip(rows, exchange.cut(np.where(seen, le + ri, 0), sizes)):
        around.append(np.frombuffer(pa.decompress(r["around"], int(part.sum()), "zstd", asbytes=True) if part.any() else b"", np.uint8))
    yes, kind = _matched(le[units], ri[units], core[units], np.concatenate(around), windows[units])
    begin = np.cumsum(windows[units]) - windows[units]
    place = np.arange(len(yes)) - np.repeat(begin, windows[units])
    # Where equal windows lie first: a window that matches no other belongs to its unit's copies alone.
    own = np.repeat(lead[units], windows[units])
    first = np.arange(len(yes))
    many = np.flatnonzero(yes)
    first[many] = many[_least([ids[own[many]], block[own[many]], at[own[many]] + place[many]], kind[many])]
    first_id, first_block, first_at = ids[own[first]], block[own[first]], at[own[first]] + place[first]
    begin_of = np.full(len(group) + 1, -1, np.int64)
    begin_of[group[units]] = begin
    by_window = begin_of[group] >= 0

    told = np.cumsum([int(x.sum()) for x in exchange.cut(np.where(by_window, windows, 0), sizes)])
    ends, out, a = np.cumsum(sizes), [], 0
    leads, repeats = lead == np.arange(len(lead)), exchange.cut(yes, [int(x.sum()) for x in exchange.cut(np.where(seen, windows, 0), sizes)])
    while a < len(rows):
        z = max(a + 1, int(np.searchsorted(told, (told[a - 1] if a else 0) + MOST_WINDOWS, side="right")))
        low, high = int(ends[a] - sizes[a]), int(ends[z - 1])
        unit = low + np.flatnonzero(by_window[low:high])
        n = windows[unit]
        shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        unit = np.repeat(unit, n)
        x = begin_of[group[unit]] + shift
        later = (first_id[x] != ids[unit]) | (first_block[x] != block[unit]) | (first_at[x] != at[unit] + shift)
        for k, part in zip(range(a, z), exchange.cut(later, np.diff(told[a:z], prepend=told[a - 1] if a else 0).tolist())):
            mine = slice(int(ends[k] - sizes[k]), int(ends[k]))
            out.append(b"".join(np.packbits(v).tobytes() for v in (leads[mine], by_window[mine], repeats[k], part)))
        a = z
    return out


def _matched(le: np.ndarray, ri: np.ndarray, core: np.ndarray, around: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all windows of the units: does the index find it elsewhere; a number that equal windows share."""
    core, units = np.unique(core, return_inverse=True)[1], len(le)
    begin = np.cumsum(le + ri + 2) - (le + ri + 2)
    text = np.full(int((le + ri + 2).sum()), -1, np.int64)
    text[begin + le] = units + 256 + core
    text[begin + le + ri + 1] = np.arange(units)
    text[text < 0] = units + around.astype(np.int64)
    index = RunLengthIndex(text, LENGTH)
    starts = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    return index.matches()[starts] >= SPREAD, index.classes(SPREAD)[starts]


def _unpacked(answer: bytes, *sizes) -> Iterator[np.ndarray]:
    """The bit arrays of an answer; a size may be a function of the arrays before it."""
    raw, at, found = np.frombuffer(answer, np.uint8), 0, []
    for size in sizes:
        size = int(size(*found)) if callable(size) else size
        found.append(np.unpackbits(raw[at:at + -(-size // 8)], count=size).astype(bool))
        at += -(-size // 8)
        yield found[-1]


def _window_rows(block: Block, told: dict, n: int) -> Iterator[tuple]:
    u = _Units(block)
    verdict = u.verdicts(told)
    distinct, twice, start, which = u.windows(verdict)
    start = start[np.r_[True, np.diff(which) > 0][:len(which)]]
    ids = u.id_at(start)
    for b, i, j in exchange.by_bucket(distinct, n):
        yield (
            b, block.number, distinct[i:j].tobytes(), np.packbits(twice[i:j]).tobytes(), ids[i:j].tobytes(), start[i:j].astype(np.uint32).tobytes(),
        )


def _counted(rows: list[dict]) -> list[bytes]:
    """Bits: does the window start anywhere else? Does it start here first?"""
    keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    sizes = [len(k) for k in keys]
    inverse, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)[1:]
    yes = (n > 1)[inverse] | exchange.bits([r["twice"] for r in rows], sizes)
    ids, at = (np.concatenate([np.frombuffer(r[c], kind) for r in rows]) for c, kind in (("ids", np.int64), ("at", np.uint32)))
    block = np.repeat(np.array([r["block"] for r in rows], np.int64), sizes)
    first = _least([ids, block, at], inverse) == np.arange(len(inverse))
    return [np.packbits(x).tobytes() + np.packbits(y).tobytes() for x, y in zip(exchange.cut(yes, sizes), exchange.cut(first, sizes))]


def _starts(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All window starts of units, one unit after the other."""
    sizes = last - first + 1
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _repeated_starts(block: Block, told: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first bytes of all windows of the block that start elsewhere too, and of those that start earlier too."""
    u = _Units(block)
    verdict, (lead, _) = u.verdicts(told), u.leads()
    of = verdict[u.which] if len(u.which) else u.which
    whole = np.flatnonzero((of == REPEATED) | (of == REPEATED_INDEX) | (of == REPEATED_COUNT))
    found = [_starts(u.first[whole], u.last[whole])]
    # A further copy in the block is a later one.
    more = whole[(lead[u.which[whole]] != whole) & (of[whole] != REPEATED_COUNT)]
    later = [_starts(u.first[more], u.last[more])]
    edges = iter(told.get("edge", []))
    for b, i, j in u.cuts(n):
        at = i + np.flatnonzero(_ordered(verdict[i:j]))
        if len(at):
            first, last, seen = u.first[lead[at]], u.last[lead[at]], _indexes(verdict[at])
            sizes = last - first + 1
            leads, by_window, yes, behind = _unpacked(
                next(edges), len(at), len(at), int(sizes[seen].sum()), lambda _, by_window, *__: sizes[by_window].sum())
            found.append(_starts(first[seen], last[seen])[yes])
            later.append(_starts(first[by_window], last[by_window])[behind])
            copy = ~by_window & ~leads
            later.append(_starts(first[copy], last[copy]))
    distinct, _, start, which = u.windows(verdict)
    if len(start):
        told_of = [tuple(_unpacked(a, j - i, j - i)) for a, (_, i, j) in zip(told["window"], exchange.by_bucket(distinct, n), strict=True)]
        yes, here = (np.concatenate(x) for x in zip(*told_of))
        found.append(start[yes[which]])
        later.append(start[~(here[which] & np.r_[True, np.diff(which) > 0])])
    return np.concatenate(found), np.concatenate(later)


def _covered(n: int, starts: np.ndarray) -> np.ndarray:
    """The bytes of all windows that start there; a start may be given twice."""
    step = np.zeros(n + 1, np.int8)
    step[starts] = 1
    step[starts + LENGTH] -= 1
    return np.cumsum(step, dtype=np.int32)[:-1] > 0


def _size_and_runs(out: np.ndarray) -> tuple[int, int]:
    size = int(out.sum())
    return size, int(out[0]) + int((out[1:] & ~out[:-1]).sum()) if size else 0


def _kept_rows(block: Block, told: dict, n: int) -> Iterator[tuple]:
    gone, later = (_covered(len(block.body), starts) for starts in _repeated_starts(block, told, n))
    data = block.data
    for doc_id, at, size in zip(block.ids, block.starts.tolist(), block.lens.tolist()):
        out = gone[at:at + size]
        removed, spans = _size_and_runs(out)
        kept = data[at:at + size][~out].tobytes() if removed else block.body[at:at + size]
        yield doc_id, size, removed, spans, kept, *(_size_and_runs(later[at:at + size]) if removed else (0, 0))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (runs of removed bytes), the kept bytes, and n_later and n_later_spans: how many of
    the removed bytes, in how many runs, are covered by a string that starts earlier too. A row for each document."""
    n = exchange.buckets(docs.sparkSession)
    source = exchange.blocks(docs)
    asked = exchange.asked(source, lambda b: _unit_rows(b, n), "bucket int, block long, cores binary, spans binary, twice binary")
    units = exchange.answers(asked, _judged, "unit")
    schema = "bucket int, block long, cores binary, spans binary, ids binary, at binary, left binary, right binary, seen binary, around binary"
    edges = exchange.answers(exchange.told(source, units, lambda b, t: _edge_rows(b, t, n), schema), _indexed, "edge")
    replies = units.union(edges)
    # Verdicts are bytes from 0 to 5; the pass that counts windows is only run if a core is hot.
    if not units.filter(F.hex("answer").rlike(f"[{COUNT}{REPEATED_COUNT}]")).isEmpty():
        schema = "bucket int, block long, keys binary, twice binary, ids binary, at binary"
        windows = exchange.answers(exchange.told(source, units, lambda b, t: _window_rows(b, t, n), schema), _counted, "window")
        replies = replies.union(windows)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, n_later long, n_later_spans long"
    return exchange.told(source, replies, lambda b, t: _kept_rows(b, t, n), schema)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (runs of removed bytes) and the kept bytes, a row for each document."""
    return measured(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
