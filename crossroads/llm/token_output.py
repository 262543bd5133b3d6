"""Token ids as binary shards with a minimal perfect hash index for constant-time access by document key.

Format, one folder: shard k holds the ids of a range of doc_ids in ascending order, without
separators, in ``ids-k.bin`` (little-endian, 2 bytes where the vocabulary allows it, else 4), and
``index-k.bin``: a JSON line, then arrays. The index is a minimal perfect hash of the shard's
distinct doc_ids: levels of bit arrays, a key taking the first level at which no other key fell on
its bit; the number of ones before that bit is the key's number. By that number it stores a
fingerprint, which tells keys that are not there, and the key's first row and number of rows; row
offsets follow. A lookup reads one level after another (1.6 on average), one entry, one range of ids.

Shards are cut at quantiles of doc_id, so the ids before a shard are the sum over the shards before
it: one number for each shard, and there are at most ``MOST_SHARDS``, whose size grows beyond that. A
doc_id at which several quantiles lie, or null, has that many shards of its own: its rows are dealt
over them by a hash of the row number, and a lookup asks all of them. Row numbers follow the order of
the input, so ``docs`` should be a table, whose tasks read the same rows in the same order when repeated. Documents are encoded where they are read; only ids are shuffled.
Words are encoded once for each worker's cache, since this vocabulary's pre-tokens never reach over
white space; words of plain letters and signs are put together from cached pieces. Files are renamed into place when whole, so repeated tasks agree.

Defined cases: null and empty texts have the end id only; rows with one doc_id lie together, ordered
in each shard by the hash of their text, and all come back for that key; null doc_ids come first and have an entry
of their own; an empty table makes no shard; only ``doc_id`` (bigint) and ``text`` are read.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossroads.llm.frames import text_slices
from crossroads.llm.hashing import mix
from crossroads.llm.shared_files import open_file, read_file, write_file
from crossroads.session import new_table_path

SHARD_BYTES = 16 << 20
MOST_SHARDS = 50_000
#: Where null doc_ids lie among the quantiles.
NULL_AT = np.iinfo(np.int64).min
END_ID = 1
#: Entries in each of the two generations of a worker's caches.
CACHED = 300_000
_LEVEL = 0x9E3779B97F4A7C15
_FINGERPRINT = np.uint64(0x5851F42D4C957F2D)


#: Words of these characters are lower-cased and split here as the vocabulary's own rules do; all others are left to the library.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class Generations(dict):
    """A cache of two generations: when the newer one is full it becomes the older one."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        if len(self) >= CACHED:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Encoder:
    """Packed ids of whole texts through caches of words and pieces; ``width`` bytes for an id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        self.width = 2 if self.whole.get_vocab_size() <= 1 << 16 else 4
        self.specials = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        # Byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        hidden = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)}
        self.pieces = Generations(self._piece)
        self.words = Generations(self._word)

    def _packed(self, ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(self.width, "little") for i in ids)

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return self._packed([t.id for t in self.model.tokenize(text)])

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.specials):
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))
        return self._packed(self.whole.encode(text, add_special_tokens=False).ids)

    def packed(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text: each different word of the slice is looked up once, ids are then laid out by its number."""
        found = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        coded = found.values.dictionary_encode()
        parts = list(map(self.words.__getitem__, coded.dictionary.cast(pa.large_binary()).to_pylist()))
        kind, of = f"<u{self.width}", coded.indices.to_numpy()
        every = np.frombuffer(b"".join(parts), kind)
        size = np.array([len(p) // self.width for p in parts], np.int64)
        first = np.cumsum(size) - size
        n = size[of]
        upto = np.cumsum(n)
        ids = every[np.repeat(first[of] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)].tobytes()
        ends = np.r_[0, upto][found.offsets.to_numpy()] * self.width
        end = END_ID.to_bytes(self.width, "little")
        return [ids[i:j] + end for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


class PerfectHash:
    """Numbers distinct 64-bit keys from 0 without gaps. ``levels``: sizes; ``bits``: all levels' bits in one array."""

    def __init__(self, levels: list[int], bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.before = np.cumsum(np.bitwise_count(bits), dtype=np.int64) - np.bitwise_count(bits)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, at = [], []
        base = 0
        while len(keys):
            size = max(64, -(-len(keys) * 3 // 2 // 64) * 64)
            place = cls._place(keys, len(levels), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            at.append(base + place[alone])
            keys = keys[~alone]
            levels.append(size)
            base += size
        bits = np.zeros(base, np.uint8)
        for a in at:
            bits[a] = 1
        return cls(levels, np.packbits(bits, bitorder="little").view(np.uint64))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * _LEVEL & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 or any number for keys that are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        base = 0
        for level, size in enumerate(self.levels):
            if not len(left):
                break
            bit = base + self._place(keys[left], level, size)
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            here = (self.bits[word] >> shift) & np.uint64(1) == 1
            below = np.bitwise_count(self.bits[word] & ((np.uint64(1) << shift) - np.uint64(1)))
            out[left[here]] = (self.before[word] + below)[here]
            left = left[~here]
            base += size
        return out


def _index(ids: list, ends: list[int], width: int) -> bytes:
    """The index file of a shard from its rows' doc_ids, ascending, nulls first, and the row ends in ids."""
    nulls = sum(i is None for i in ids)
    keys, first, rows = np.unique(np.array(ids[nulls:], np.int64), return_index=True, return_counts=True)
    keys = keys.view(np.uint64)
    table = PerfectHash.of(keys)
    number = table.find(keys)
    marks, firsts, counts = np.empty(len(keys), np.uint32), np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    marks[number], firsts[number], counts[number] = mix(keys ^ _FINGERPRINT).astype(np.uint32), first + nulls, rows
    arrays = {"bits": table.bits, "marks": marks, "firsts": firsts, "counts": counts, "starts": np.r_[0, np.array(ends, np.int64)]}
    head = {"width": width, "nulls": nulls, "levels": table.levels, "arrays": [[k, a.dtype.str, len(a)] for k, a in arrays.items()]}
    return json.dumps(head).encode() + b"\n" + b"".join(a.tobytes() for a in arrays.values())


class Shard:
    """One shard, open for lookups."""

    def __init__(self, folder: str, number: int):
        raw = read_file(folder, f"index-{number:06d}.bin")
        line = raw.index(b"\n")
        head = json.loads(raw[:line])
        at = line + 1
        for name, kind, n in head["arrays"]:
            setattr(self, name, np.frombuffer(raw[at:at + n * np.dtype(kind).itemsize], kind))
            at += n * np.dtype(kind).itemsize
        self.nulls, self.width = head["nulls"], head["width"]
        self.table = PerfectHash(head["levels"], self.bits)
        self.file = open_file(folder, f"ids-{number:06d}.bin")

    def rows(self, keys: list[int | None]) -> list[range]:
        """The rows of each key; empty for keys that are not in the shard."""
        h = np.array([k or 0 for k in keys], np.int64).view(np.uint64)
        number = self.table.find(h)
        known = number >= 0
        known[known] = self.marks[number[known]] == mix(h[known] ^ _FINGERPRINT).astype(np.uint32)
        return [
            range(self.nulls) if k is None else range(int(self.firsts[x]), int(self.firsts[x] + self.counts[x])) if ok else range(0)
            for k, x, ok in zip(keys, number, known)
        ]

    def ids(self, row: int) -> np.ndarray:
        a, b = int(self.starts[row]), int(self.starts[row + 1])
        self.file.seek(a * self.width)
        return np.frombuffer(self.file.read((b - a) * self.width), f"<u{self.width}")


@dataclass(frozen=True)
class Store:
    """A written folder: shard k has the doc_ids from ``bounds[k - 1]`` on and below ``bounds[k]``; ids before each shard."""

    folder: str
    bounds: np.ndarray
    before: dict[int, int]

    def shards_of(self, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The last shard that may hold each id, and how many do."""
        return _shards_of(ids, self.bounds)


def _shards_of(ids: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = ids.fill_null(NULL_AT).to_numpy()
    last = np.searchsorted(bounds, at, side="right")
    return last, np.maximum(1, last - np.searchsorted(bounds, at, side="left"))


def _shard_of(ids: pa.Array, dealt: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The shard of each row; ``dealt`` (unsigned hashes) chooses among those of one id."""
    last, many = _shards_of(ids, bounds)
    # A known id of the least value comes after all nulls.
    many[ids.is_valid().to_numpy(zero_copy_only=False) & (ids.fill_null(0).to_numpy() == NULL_AT)] = 1
    return last - (dealt % many.astype(np.uint64)).astype(np.int64)


def _bounds(docs: DataFrame, shard_bytes: int) -> np.ndarray:
    """Quantiles of doc_id, ascending; one that many rows share is there several times."""
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = min(MOST_SHARDS, max(1, math.ceil((size[0] or 0) / shard_bytes)))
    if n == 1:
        return np.zeros(0, np.int64)
    cuts = docs.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(int(NULL_AT))), [k / n for k in range(1, n)], 100 * n)).first()[0] or []
    return np.sort(np.array(cuts, np.int64))


def write(docs: DataFrame, path: str, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> Store:
    """Encodes ``docs`` with the vocabulary file ``path`` and writes shards of about ``shard_bytes`` of text each."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    folder = folder or new_table_path(docs.sparkSession, "token-ids")
    bounds = _bounds(docs, shard_bytes)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, most=8 << 20):
                ids, dealt = part.column("doc_id"), part.column("dealt").to_numpy().view(np.uint64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(_shard_of(ids, dealt, bounds), pa.int32()), ids, part.column("h"),
                    pa.array(encoder(path).packed(part.column("text")), pa.binary()),
                ], ["shard", "doc_id", "h", "ids"])

    width = encoder(path).width

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
        """The rows of each shard of the partition in order."""
        from itertools import groupby

        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "ids"))))
        yield from groupby(rows, key=lambda r: r[0])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in shards(batches):
            ids, ends = [], []

            def fill(out, rows=rows, ids=ids, ends=ends):
                for _, doc_id, packed in rows:
                    out.write(packed)
                    ids.append(doc_id)
                    ends.append((ends[-1] if ends else 0) + len(packed) // width)

            write_file(folder, f"ids-{number:06d}.bin", fill)
            write_file(folder, f"index-{number:06d}.bin", lambda out, ids=ids, ends=ends: out.write(_index(ids, ends, width)))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([ends[-1]], pa.int64())], ["shard", "tokens"])

    numbered = docs.withColumns({"h": F.xxhash64("text"), "dealt": F.xxhash64(F.monotonically_increasing_id())})
    encoded = numbered.mapInArrow(encode, "shard int, doc_id long, h long, ids binary")
    ordered = encoded.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "h")
    sizes = dict(map(tuple, ordered.mapInArrow(save, "shard int, tokens long").collect()))  # one row for each shard
    before, total = {}, 0
    for number in sorted(sizes):
        before[number] = total
        total += sizes[number]
    return Store(folder, bounds, before)


def read(keys: DataFrame, store: Store, fn=None, fields: str = "ids array<long>") -> DataFrame:
    """doc_id, start (ids of all rows before), n_tokens and what ``fn`` makes of the ids, for each row of each distinct key."""
    fn = fn or (lambda ids: (ids.tolist(),))
    shared = keys.sparkSession.sparkContext.broadcast(store)
    names = [f.split()[0] for f in fields.split(", ")]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            last, many = shared.value.shards_of(b.column("doc_id"))
            which = np.repeat(np.arange(len(last)), many)
            shard = np.repeat(last, many) - (np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), b.column("doc_id").take(pa.array(which))], ["shard", "doc_id"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for b in batches:
            of, ids = b.column("shard").to_numpy(), b.column("doc_id").to_pylist()
            cuts = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)] if len(of) else [0]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if of[i] not in shared.value.before:
                    continue
                if of[i] != number:
                    number, shard = of[i], Shard(shared.value.folder, int(of[i]))
                before = shared.value.before[int(number)]
                found = [
                    (key, before + int(shard.starts[r]), int(shard.starts[r + 1] - shard.starts[r]), *fn(shard.ids(r)))
                    for key, rows in zip(ids[i:j], shard.rows(ids[i:j])) for r in rows
                ]
                columns = list(zip(*found)) or [[]] * (3 + len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, None if k >= 3 else pa.int64()) for k, c in enumerate(columns)], ["doc_id", "start", "n_tokens", *names]
                ) if found else pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * (3 + len(names)), ["doc_id", "start", "n_tokens", *names])

    keys = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    routed = keys.mapInArrow(route, "shard int, doc_id long").repartitionById(len(store.bounds) + 1, F.col("shard")).sortWithinPartitions("shard")
    return routed.mapInArrow(look_up, f"doc_id long, start long, n_tokens long, {fields}")


def crc32(ids: np.ndarray) -> tuple[int]:
    return (zlib.crc32(ids.astype("<u4").tobytes()),)
