"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text, pattern=SPACED) -> list[str]:
    return pattern.findall((text or "").translate(LOWER))


def contamination(docs, items, size=13):
    """doc_id -> (n_words, n_hit, n_items, sha, flag)."""
    wanted: dict[tuple, set[str]] = {}
    for key, text in items:
        w = words(text, ALNUM)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wanted.setdefault(tuple(w[i:i + size]), set()).add(str(key))
    lengths = sorted({len(k) for k in wanted})
    out = []
    for key, text in docs:
        w, hit, found = words(text, ALNUM), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (got := wanted.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((key, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def shingles(text, size=5) -> set[tuple]:
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_components(docs):
    """doc_id -> (set size, component)."""
    sets = [(k, shingles(t)) for k, t in docs]
    by_gram: dict[tuple, list[int]] = {}
    for i, (_, s) in enumerate(sets):
        for g in s:
            by_gram.setdefault(g, []).append(i)
    shared: dict[tuple, int] = {}
    for members in by_gram.values():
        for x in range(len(members)):
            for y in range(x):
                shared[members[y], members[x]] = shared.get((members[y], members[x]), 0) + 1
    links = [(sets[a][0], sets[b][0]) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a][1]) + len(sets[b][1]) - n)]
    of = components([k for k, _ in sets], links)
    return {k: (len(s), of[k]) for k, s in sets}
