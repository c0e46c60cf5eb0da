"""Plain versions of what the operators compute."""

import re

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate(LOWER)


def classes(docs, n, percent):
    """(shingles, smallest id reachable) by comparing all pairs."""
    sets = {}
    for doc_id, text in docs:
        w = SPACED.findall(lowered(text))
        sets[doc_id] = {tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def hits(docs, items, span=10):
    """(words, hit words, item ids) of every text by comparing all windows."""
    windows = {}
    for item_id, text in items:
        w = ALNUM.findall(lowered(text))
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, found = ALNUM.findall(lowered(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        out.append((doc_id, len(w), len(hit), tuple(sorted(x for x in found if x is not None))))
    return out
