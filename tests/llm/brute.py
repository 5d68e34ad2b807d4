"""Plain-Python forms of the operators' definitions, for small inputs."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log10

import xxhash

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc(doc_id, m):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


def words(text):
    return BLANKS.findall((text or "").translate(UPPER))


def fingerprint(text):
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(rows, r=2):
    """rows: (doc_id, fingerprint) -> smallest doc_id reachable, per row."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= r:
                root[find(b)] = find(a)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [least.get(find(f)) for _, f in rows]


def base_scores(rows):
    """rows: (doc_id, text) -> n_tokens, n_known, train_tokens, base_score, per row."""
    count = Counter(t for d, x in rows if crc(d, 7) != 2 for t in [*words(x), None])
    n, v = sum(count.values()), len(count)
    out = []
    for _, x in rows:
        t = [*words(x), None]
        out.append((len(t), sum(count[w] > 0 for w in t), n, sum(log10((count[w] + 1) / (n + v + 1)) for w in t)))
    return out


def phrase_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    found = [(i, label) for label, p in (("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"]))
             for i in range(len(w)) if w[i:i + len(p)] == p]
    places = sorted(i for i, _ in found)
    return len(w), len(found), places[0] if places else None, places[-1] if places else None, ",".join(sorted({x for _, x in found}))
