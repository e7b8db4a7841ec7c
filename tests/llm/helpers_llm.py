"""Plain-Python counterparts that the operators are tested against."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, width):
    w = words(lower(text))
    n = min(width, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_components(docs, width, percent=80):
    """doc_id -> (set size, component) over (doc_id, text) rows."""
    sets = {d: shingle_set(t, width) for d, t in docs}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = components(ids, links)
    return {d: (len(sets[d]), root[d]) for d in ids}


def ngrams(text):
    """Letter n-grams of padded runs, as tuples of code points."""
    runs = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    for r in runs:
        out.update((ord(c),) for c in r)
        p = f" {r} "
        for n in (2, 3):
            out.update(tuple(map(ord, p[i:i + n])) for i in range(len(p) - n + 1))
    return out


def best_fit(pieces, capacity, limit):
    """Bins of (size, cluster, source) pieces by a scan of every bin: of the
    compatible ones with room, the one with the least room left, the oldest first."""
    bins = []
    out = []
    for size, cluster, source in pieces:
        fit = [(capacity - sum(p[0] for p in b), i) for i, b in enumerate(bins)
               if sum(p[0] for p in b) + size <= capacity and cluster not in [p[1] for p in b]
               and sum(p[2] == source for p in b) < limit]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            bins.append([])
        bins[i].append((size, cluster, source))
        out.append(i)
    return out
