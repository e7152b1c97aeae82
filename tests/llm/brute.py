"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def shingle_set(text, size=5):
    w = WORD.findall(ascii_lower(text or ""))
    if not w:
        return set()
    if len(w) < size:
        return {tuple(w)}
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def near_components(rows, percent=85):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows."""
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    owners = {}
    for d, s in sets.items():
        for g in s:
            owners.setdefault(g, []).append(d)
    shared = {}
    for ids in owners.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeated_bytes(rows, size=200):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for d, b in raw:
        for i in range(len(b) - size + 1):
            w = b[i:i + size]
            seen[w] = seen.get(w, 0) + 1
    out = {}
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]
