"""Plain versions of the corpus operators, for small tables in memory."""

from __future__ import annotations

import hashlib
import string
from collections import Counter, defaultdict


def words(text):
    return [] if text is None else text.encode().split()


def shingle_set(text, width):
    w = words(text)
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in w]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def jaccard_components(docs, width, percent):
    """{doc_id: component}; all pairs that share a shingle are compared."""
    sets = [(i, shingle_set(t, width)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for k, (i, s) in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < k)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def jaccard_links(docs, width, percent):
    """For each row the number of other rows with an id whose sets are similar, or equal."""
    sets = [(i, shingle_set(t, width)) for i, t in docs]
    out = []
    for k, (i, s) in enumerate(sets):
        others = [o for j, (d, o) in enumerate(sets) if j != k and d is not None and o and i is not None and s]
        out.append(sum(100 * len(s & o) >= percent * len(s | o) for o in others))
    return out


def cut_words(docs, width):
    """Per row (id, n_words, n_removed, kept words joined)."""
    least = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k : k + width])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and least[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), kept.decode()))
    return out


def cut_bytes(docs, length):
    """Per row (id, n_bytes, n_removed, n_spans, kept bytes)."""
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            if i is not None:
                s = b[k : k + length]
                first[s] = min(first.get(s, (i, k)), (i, k))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if i is not None and first[b[k : k + length]] < (i, k):
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


_MARKS = str.maketrans({c: " " for c in string.punctuation})


def leaks(docs, items, width=5, least=0.8):
    """{(doc, item): (similarity, first word)} over all windows, without any fingerprint.

    A document of fewer words than the item is one window.
    """
    out = {}
    plain = lambda t: words(None if t is None else t.lower().translate(_MARKS))
    for item, text in items:
        w = plain(text)
        n = len(w)
        if not n or item is None:
            continue
        k = min(n, width)
        want = Counter(tuple(w[a : a + k]) for a in range(n - k + 1))
        for doc, body in docs:
            d = plain(body)
            for a in range(max(1, len(d) - n + 1)):
                window = d[a : a + n]
                have = Counter(tuple(window[b : b + k]) for b in range(len(window) - k + 1))
                both = sum((want & have).values())
                alike = both / (n - k + 1 + sum(have.values()) - both)
                if alike >= least and alike > out.get((doc, item), (0, 0))[0]:
                    out[doc, item] = (alike, a)
    return out


def turns_digest(turns):
    return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()
