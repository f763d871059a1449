"""Independent plain-Python models of both dataflows, for randomized tests.

"""

import math
import re
from collections import Counter, defaultdict


def words(body):
    s = re.sub(r"<[^>]*>", " ", body).replace("\\n", " ")
    s = re.sub(r"[^a-zA-Z]+", " ", s).lower().strip()
    return s.split(" ")


def tfidf(articles):
    """articles: [(title, body)] -> {(word, title): (tf, df, w)}"""
    tf = Counter()
    for title, body in articles:
        for w in words(body):
            tf[(w, title)] += 1
    n = len({t for t, _ in articles})
    df = Counter(w for w, _ in tf)
    return {(w, t): (c, df[w], c * math.log10(n / df[w])) for (w, t), c in tf.items()}


def pagerank(arcs, labels, iterations, variant):
    """arcs: [(src, dst)], labels: [(id, name)] -> {id: rank}"""
    links = defaultdict(set)
    for s, d in arcs:
        links[s].add(d)
    ranks = {s: 1.0 for s in links}
    dangling = [i for i, _ in labels if i not in links]
    n_labels = len(set(labels))
    for _ in range(iterations):
        contribs = [(d, ranks[s] / len(links[s])) for s in ranks if s in links for d in links[s]]
        sums = defaultdict(float)
        for d, c in contribs:
            sums[d] += c
        inter = {d: 0.15 + 0.85 * v for d, v in sums.items()}
        if variant == "C":
            ranks = inter
            continue
        mass = sum(inter[i] for i in dangling if i in inter)
        norm = len({(d, round(c, 12)) for d, c in contribs}) if variant == "A" else n_labels
        share = mass / norm if norm else 0.0
        ranks = {k: v + share for k, v in inter.items()}
    return ranks
