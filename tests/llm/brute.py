"""Plain versions of the operators over a list of (doc_id, text), for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def passages(rows, size=35):
    seen = Counter(tuple(w[i : i + size]) for _, t in rows for w in [words(t)] for i in range(len(w) - size + 1))
    out = []
    for d, t in rows:
        w = words(t)
        gone = {i + k for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for k in range(size)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def groups(ids, links):
    """Smallest reachable id of each id."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, size):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def near(rows, size, part=80, whole=100):
    sets = {d: shingles(t, size) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and whole * len(sets[a] & sets[b]) >= part * len(sets[a] | sets[b])]
    found = groups(ids, links)
    return [(d, len(sets[d]), found[d], found[d] == d) for d in ids]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lines(rows, most=2, least=30):
    first = {}
    for d, t in sorted(rows):
        for i, x in enumerate((t or "").split("\n")):
            if x.strip(SPACE):
                first.setdefault(x.strip(SPACE), (d, i))
    long = [x for x in first if len(x) >= least]
    earlier = [x for x in first if len(x) >= least - most]
    close = {b for b in long for a in earlier if first[a] < first[b] and abs(len(a) - len(b)) <= most and edits(a, b) <= most}
    out = []
    for d, t in rows:
        split = (t or "").split("\n") if t is not None else []
        gone = [bool(x.strip(SPACE)) and (first[x.strip(SPACE)] != (d, i) or x.strip(SPACE) in close) for i, x in enumerate(split)]
        kept = None if t is None else "\n".join(x for x, g in zip(split, gone, strict=True) if not g)
        out.append((d, sum(bool(x.strip(SPACE)) for x in split), sum(gone), kept))
    return out


def repetition(text, least):
    w = words(text)
    n = len(w)
    longest = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and w[i + k] == w[j + k]:
                k += 1
            longest[i] = max(longest[i], k)
    span = {i + k for i in range(n) if longest[i] >= least for k in range(longest[i])}
    triples = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    again = {i + k for i in range(n - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
    split = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    return {
        "n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(split) - len(set(split)), "n_repeat_words": len(again), "longest_repeat": max(longest, default=0),
        "covered": sum(len(w[i]) for i in span) / max(sum(map(len, w)), 1),
    }
