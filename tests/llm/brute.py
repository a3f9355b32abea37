"""Slow and plain versions of the training-data operators, for small tables."""

import hashlib
import re
from collections import defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), sha(t or "")) for i, t in rows}


def contaminated(rows, items, size=10):
    windows = defaultdict(set)
    for name, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOW))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(str(name))
    out = {}
    for i, text in rows:
        w, hit, found = ITEM_WORD.findall((text or "").translate(LOW)), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a : a + n])) in windows:
                    hit.update(range(a, a + n))
                    found |= windows[k]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def covered(rows, n=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - n + 1):
            first[b[p : p + n]] = min(i, first.get(b[p : p + n], i))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - n + 1):
            if first[b[p : p + n]] < i:
                gone[p : p + n] = [True] * n
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def shingles(text, k):
    w = SPACED_WORD.findall((text or "").translate(LOW))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def linked(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}
