"""Plain-Python twins of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def substring_dedup(rows, length=35):
    seen = defaultdict(int)
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    for _, w in docs:
        for k in range(len(w) - length + 1):
            seen[tuple(w[k:k + length])] += 1
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k:k + length])] > 1:
                gone[k:k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def suffix_dedup(rows, length=50):
    least = {}
    docs = [(i, (t or "").encode()) for i, t in rows]
    for i, b in docs:
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, b in docs:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def near_groups(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(low(t))
        sets[i] = {tuple(w[k:k + 2]) for k in range(len(w) - 1)} if len(w) > 1 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    inv = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            inv[g].append(i)
    for i, s in sets.items():
        hits = defaultdict(int)
        for g in s:
            for j in inv[g]:
                if j < i:
                    hits[j] += 1
        for j, n in hits.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())
