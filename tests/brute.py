"""The rules as plain loops over lists, written from their description; only for small fixtures."""

import math
import random

REACH = {
    ("north", 1): "FH", ("north", 2): "EDC", ("east", 3): "HB", ("east", 4): "GEF",
    ("south", 5): "BD", ("south", 6): "AGH", ("west", 7): "DF", ("west", 8): "BCA",
}
CLOCKWISE = ["north", "east", "south", "west"]


def scenario_rows(seed, sizes, speeds=(0, 20, 36, 50, 54, 72), distances=(10, 40, 60, 79, 80, 81, 100, 300)):
    rnd = random.Random(seed)
    out = []
    for sid, n in enumerate(sizes, 1):
        for seq in range(1, n + 1):
            direction, lane = rnd.choice(list(REACH))
            to = rnd.choice(REACH[direction, lane] + "X")
            out.append((sid, seq, lane, rnd.choice(speeds), rnd.choice(distances), direction, to))
    return out


def movement(v):
    reach = REACH.get((v[5], v[2]), "")
    if v[6] not in reach:
        return None
    return "left" if v[2] % 2 == 0 else ["right", "straight"][reach.index(v[6])]


def arrival(v):
    return math.inf if v[3] == 0 else v[4] / (v[3] * 1000 / 3600)


def lane_conflict(a, b):
    ma, mb, da, db = movement(a), movement(b), CLOCKWISE.index(a[5]), CLOCKWISE.index(b[5])
    if ma is None or mb is None or da == db:
        return False
    if abs(da - db) == 2:
        crossing = [ma, mb].count("left") == 1
    else:
        crossing = not ma == mb == "right"
    ta, tb = arrival(a), arrival(b)
    return crossing and math.inf not in (ta, tb) and abs(ta - tb) <= 4


def lane_winner(a, b):
    ta, tb, ma, mb = arrival(a), arrival(b), movement(a), movement(b)
    if abs(ta - tb) > 1:
        return b if ta > tb else a
    order = {"straight": 0, "right": 1, "left": 2}
    if ma != mb:
        return min((a, b), key=lambda v: order[movement(v)])
    return b if (CLOCKWISE.index(b[5]) - CLOCKWISE.index(a[5])) % 4 == 1 else a


def lane_pairs(vs):
    """[(seq1, seq2, winner seq, wait of the loser)] of one scenario."""
    out = []
    for i, a in enumerate(vs):
        for b in vs[i + 1:]:
            if lane_conflict(a, b):
                w = lane_winner(a, b)
                lo = b if w is a else a
                out.append((a[1], b[1], w[1], math.ceil(max(0, arrival(w) + 2 - arrival(lo)))))
    return out


def near_result(vs):
    """{seq: (rank, wait)}: walk the pairs, hand out ranks on first wins, then idle ones, then losers."""
    rank, wait, losers, nxt = {}, {v[1]: 0 for v in vs}, set(), 1
    for i, a in enumerate(vs):
        for b in vs[i + 1:]:
            if a[5] == b[5] or a[4] > 80 or b[4] > 80:
                continue
            w, lo = (a, b) if a[3] >= b[3] else (b, a)
            if w[1] not in rank:
                rank[w[1]], nxt = nxt, nxt + 1
            if lo[1] not in losers:
                losers.add(lo[1])
                t = math.inf if w[3] == 0 else w[4] / (w[3] / 3.6)
                wait[lo[1]] = None if t == math.inf else max(2, math.ceil(t) + 1)
    for group in (lambda q: q not in losers, lambda q: q in losers):
        for v in vs:
            if v[1] not in rank and group(v[1]):
                rank[v[1]], nxt = nxt, nxt + 1
    return {q: (rank[q], wait[q]) for q in rank}


def cascade_result(vs):
    """{seq: (rank, wait)}: conflicting vehicles one after the other, arrival times moving as they wait."""
    inside = {q for p in lane_pairs(vs) for q in p[:2]}
    queue = sorted((v for v in vs if v[1] in inside), key=arrival)
    out = {v[1]: (None, 0) for v in vs}
    free_at = -math.inf
    for place, v in enumerate(queue, 1):
        start = max(arrival(v), free_at)
        out[v[1]] = (place, math.ceil(round(start - arrival(v), 9)))
        free_at = start + 2
    return out


def by_scenario(data):
    groups = {}
    for v in data:
        groups.setdefault(v[0], []).append(v)
    return {k: sorted(v, key=lambda x: x[1]) for k, v in groups.items()}
