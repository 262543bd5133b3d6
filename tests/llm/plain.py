"""The contracts in plain loops, one text or table at a time: what the operators are tested against."""

import hashlib
import re
from collections import Counter

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPACES.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def quality(text):
    ws = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    count = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {j for i in range(len(ws) - 2) if count[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    return {
        "n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""), "n_dup_lines": dup,
        "n_repeat_words": len(hit), "base_failed": len(ws) < 50 or 100 * len(hit) > 50 * len(ws),
    }


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def personal(text):
    text, out = text or "", []
    out += [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    n = Counter(k for k, _, _ in out)
    return {f"n_{k}": n[k] for k in ("email", "ip", "card", "phone")} | {"base_sha256": sha(",".join(f"{k}:{a}:{b}" for k, a, b in out))}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(text, items, size=10):
    windows = {}
    for item, body in items:
        ws = bench_words(body)
        n = min(size, len(ws))
        for i in range(len(ws) - n + 1 if ws else 0):
            windows.setdefault(tuple(ws[i:i + n]), set()).add(item)
    ws, hit, found = bench_words(text), set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(ws) - n + 1):
            if (w := tuple(ws[i:i + n])) in windows:
                hit |= set(range(i, i + n))
                found |= windows[w]
    found = sorted(str(x) for x in found if x is not None)
    return {"n_words": len(ws), "n_hit": len(hit), "n_items": len(found), "items_sha256": sha(",".join(found)), "contaminated": bool(hit)}


def substring(rows, k=13):
    """(n_words, n_removed, kept words) of each (id, text)."""
    from collections import defaultdict

    top = float("inf")
    first = defaultdict(lambda: top)
    for i, text in rows:
        ws = words(text)
        for j in range(len(ws) - k + 1):
            key = tuple(ws[j:j + k])
            first[key] = min(first[key], top if i is None else i)
    out = []
    for i, text in rows:
        ws = words(text)
        gone = {x for j in range(len(ws) - k + 1) if first[tuple(ws[j:j + k])] < (top if i is None else i) for x in range(j, j + k)}
        out.append((i, len(ws), len(gone), " ".join(w for x, w in enumerate(ws) if x not in gone)))
    return out


def fingerprint(text, k=4):
    import xxhash

    ws = words(lower(text))
    grams = [" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64(g.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if grams and 2 * ones[b] > len(grams))


def near_components(prints, radius=4):
    """The component of each distinct fingerprint by search over all pairs."""
    left, label = set(prints), {}
    for start in sorted(set(prints)):
        if start in label:
            continue
        todo = [start]
        left.discard(start)
        while todo:
            x = todo.pop()
            label[x] = start
            near = {y for y in left if (x ^ y).bit_count() <= radius}
            left -= near
            todo += near
    return label


def simhash(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = near_components(prints)
    least = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            least[label[f]] = min(least.get(label[f], i), i)
    return [(i, f"{f:016x}", least.get(label[f])) for (i, _), f in zip(rows, prints)]


def repeated_bytes(rows, k=400):
    """(id, bytes, removed, spans, kept) of each (id, text)."""
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[j:j + k] for t in texts for j in range(len(t) - k + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        step = [0] * (len(t) + 1)
        for j in range(len(t) - k + 1):
            if count[t[j:j + k]] > 1:
                step[j] += 1
                step[j + k] -= 1
        depth, kept, spans, inside = 0, bytearray(), 0, False
        for j, b in enumerate(t):
            depth += step[j]
            spans += depth > 0 and not inside
            inside = depth > 0
            if not inside:
                kept.append(b)
        out.append((i, len(t), len(t) - len(kept), spans, bytes(kept)))
    return out


def language_model(rows, order=3, discount=0.75, least=2):
    """Per (id, text): held out, tokens, known, training tokens, base score, score of the unquantised model."""
    import math
    import zlib

    end = object()
    tokens = [[*words(lower(t)), end] for _, t in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    count = [Counter() for _ in range(order + 1)]
    for ws, held in zip(tokens, out):
        if not held:
            count[1].update((w,) for w in ws)
            seq = [end, *ws]
            for k in range(2, order + 1):
                count[k].update(tuple(seq[i:i + k]) for i in range(len(seq) - k + 1))
    total, vocabulary = sum(count[1].values()), len(count[1])
    left = {}
    for k in range(2, order + 1):
        for gram, c in count[k].items():
            if c >= least:
                left[gram[:-1]] = left.get(gram[:-1], 1) - (c - discount) / count[k - 1][gram[:-1]]
    result = []
    for (i, _), ws, held in zip(rows, tokens, out):
        base = score = 0.0
        for at, w in enumerate(ws):
            p = (count[1][w,] + 0.5) / (total + 0.5 * (vocabulary + 1))
            base += math.log10(p)
            seq = [end, *ws[:at]]
            for k in range(2, min(order, len(seq) + 1) + 1):
                context = tuple(seq[len(seq) - k + 1:])
                if count[k - 1][context] >= (least if k > 2 else 1):
                    c = count[k][(*context, w)]
                    p = left.get(context, 1) * p + ((c - discount) / count[k - 1][context] if c >= least else 0)
            score += math.log10(p)
        result.append((i, held, len(ws), sum(count[1][w,] > 0 for w in ws), total, base, score))
    return result
