"""Plain versions of manifest, archive and periodic runs, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(nodes):
    """Root, and for each leaf (is right child, sibling) from below."""
    at, path = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            path[i].append((a & 1, nodes[a ^ 1] if a ^ 1 < len(nodes) else None))
            at[i] = a >> 1
        nodes = [sha(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
    return nodes[0], path


def manifest(rows):
    """``rows``: (doc_id, text, lang, source, n_chars)."""
    by_lang = defaultdict(list)
    for d, t, lang, s, n in rows:
        leaf = sha(*map(field, (d, s, lang, n, t)))
        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        by_lang[lang].append((d, leaf, sha(*map(field, (d, s, lang, n + 1, t))) if hit else leaf))
    if not rows:
        return []
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subroots, paths = [], []
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subroot, path = _tree([x[1] for x in by_lang[lang]])
        subroots.append(subroot)
        paths.append(path)
    root, over = _tree(subroots)
    out = []
    for k, lang in enumerate(langs):
        for (d, leaf, start), path in zip(by_lang[lang], paths[k], strict=True):
            h, siblings = start, []
            for right, s in path + over[k]:
                siblings.append(s or "")
                h = sha(s, h) if right else sha(h, s or "")
            out.append((d, leaf, subroots[k], root, sha(*siblings), h, h == root))
    return out


def archive(rows, min_bytes=0):
    """``rows``: (page_id, url, html)."""
    first = {}
    for p, _, html in rows:
        body = (html or "").encode()
        if body not in first or (p is not None and (first[body] is None or p < first[body])):
            first[body] = p
    out = []
    for p, _, html in rows:
        body = (html or "").encode()
        f = first[body]
        again = f is not None and p != f and len(body) >= min_bytes
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", f if again else None))
    return out


def words(text):
    return WORD.findall(text or "")


def runs(w):
    """(start, length, period) of all runs, by looking at every period."""
    ids = {}
    x = np.array([ids.setdefault(v, len(ids)) for v in w], int)
    out = []
    for q in range(1, len(x) // 3 + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(24, 3 * q) and not any(q % p == 0 and (x[a : a + q - p] == x[a + p : a + q]).all() for p in range(1, q)):
                out.append((a, b - a + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    if doc_id is None or not w:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collapsed(w, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(v for i, v in enumerate(w) if i not in gone)


def periodic(rows):
    out = []
    for d, t in rows:
        w = planted(d, words(t))
        found = runs(w)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if found else None
        out.append((d, len(found), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(w, found))))
    return out
