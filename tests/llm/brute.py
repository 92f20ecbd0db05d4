"""Plain Python twins of the operators' contracts."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring(rows, k=13):
    words = [WORD.findall(t or "") for _, t in rows]
    own = {}
    for (d, _), w in zip(rows, words):
        if d is not None:
            for i in range(len(w) - k + 1):
                g = tuple(w[i:i + k])
                own[g] = min(own.get(g, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        if d is not None:
            for i in range(len(w) - k + 1):
                if own[tuple(w[i:i + k])] < d:
                    gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), sha(" ".join(
            x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        for m in ([w] if 0 < len(w) < 13 else [w[j:j + 13] for j in range(len(w) - 12)]):
            windows[tuple(m)].add(i)
    out = []
    for d, t in rows:
        w, hit, found = ALNUM.findall((t or "").translate(LOWER)), set(), set()
        for m in {len(x) for x in windows}:
            for j in range(len(w) - m + 1):
                if tuple(w[j:j + m]) in windows:
                    hit.update(range(j, j + m))
                    found |= windows[tuple(w[j:j + m])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), sha(",".join(names)),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def components(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def near_duplicates(rows):
    """rows sorted by doc_id, distinct ids -> (doc_id, class_id, n_links, kept)."""
    sets = []
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else
                    {tuple(w)} if w else set())
    links = [(i, j) for j in range(len(rows)) for i in range(j) if sets[i] and sets[j]
             and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    n = Counter(x for p in links for x in p)
    root = components(len(rows), links)
    return [(rows[i][0], rows[root[i]][0], n[i], root[i] == i) for i in range(len(rows))]
