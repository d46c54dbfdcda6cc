"""Plain versions of the operators, over a few rows held in memory."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def quality(text):
    found = words(text)
    runs = list(zip(found, found[1:], found[2:], strict=False))
    often = Counter(runs)
    covered = {i + j for i, run in enumerate(runs) if often[run] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        len(found) < 50 or 100 * len(covered) > 50 * len(found),
    )


def repeats(docs, width=50):
    """{doc_id: (n_words, n_removed, sha256)} of (doc_id, text) rows with unlike ids."""
    first = {}
    split = {d: words(t) for d, t in docs}
    for d in sorted(split):
        for i in range(len(split[d]) - width + 1):
            first.setdefault(tuple(split[d][i : i + width]), d)
    result = {}
    for d, found in split.items():
        gone = set()
        for i in range(len(found) - width + 1):
            if first[tuple(found[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(found) if i not in gone)
        result[d] = (len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return result


def shingles(text, each=5):
    found = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not found:
        return frozenset()
    if len(found) < each:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + each]) for i in range(len(found) - each + 1))


def groups(links, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def similar(docs, percent=80):
    """{doc_id: (n_shingles, component)}; pairs are looked for among those that share a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    pairs = {(a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[i + 1 :]}
    links = [
        (a, b)
        for a, b in pairs
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = groups(links, sets)
    return {d: (len(sets[d]), found[d]) for d in sets}


def secrets(text):
    """Base spans of a text: (kind, start, end) by start, then kind."""
    import re

    text = text or ""
    assign = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def base_sha(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def targets(size_of, weights=(3, 1, 2), budget=1.5, most=2):
    """{source: target} of {source: size}; None is the last source."""
    order = sorted((s for s in size_of if s is not None)) + [None] * (None in size_of)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    fixed = {}
    while True:
        left = budget * sum(size_of.values()) - sum(fixed.values())
        open_ = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in open_)
        want = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if want[s] > most * size_of[s]]
        if not above:
            return {**want, **fixed}
        fixed.update({s: most * size_of[s] for s in above})
