"""The definitions, written out over Python dictionaries for small inputs."""

import math
from collections import Counter
from itertools import combinations


def weights(bags):
    """``{document: {word: tf-idf}}``; every document counts, also an empty one."""
    holders = Counter(word for bag in bags.values() for word in set(bag))
    idf = {word: math.log(len(bags) / n) for word, n in holders.items()}
    return {
        doc: {word: n / len(bag) * idf[word] for word, n in Counter(bag).items()}
        for doc, bag in bags.items()
        if bag
    }


def cosines(bags):
    """``{(a, b): cosine}`` of all a < b that share a word."""
    vectors = weights(bags)
    norms = {doc: math.sqrt(sum(w * w for w in v.values())) for doc, v in vectors.items()}
    found = {}
    for a, b in combinations(sorted(vectors), 2):
        common = vectors[a].keys() & vectors[b].keys()
        if common:
            dot = sum(vectors[a][w] * vectors[b][w] for w in common)
            found[a, b] = dot / (norms[a] * norms[b]) if norms[a] and norms[b] else 0.0
    return found


def edges(rows, window):
    """Distinct ``(author, author)`` where the second follows within the window."""
    return {
        (a, b)
        for a, year_a in rows
        for b, year_b in rows
        if a != b and 0 < year_b - year_a <= window
    }
