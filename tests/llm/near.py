"""Plain Python versions of near-duplicate classes."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, width=5):
    words = WORD.findall(text or "")
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def classes(nodes, links):
    """Least member of each node's component."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_pairs(sets, threshold=0.8):
    """All pairs of keys whose sets have a Jaccard similarity of at least ``threshold``, by an inverted index."""
    index = defaultdict(list)
    for key, s in sets.items():
        for x in s:
            index[x].append(key)
    common = Counter()
    for keys in index.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                common[a, b] += 1
    return [(a, b) for (a, b), c in common.items() if c >= threshold * (len(sets[a]) + len(sets[b]) - c)]
