"""Plain Python versions of what the operators compute, for small inputs."""

import re
from collections import Counter

from flowverdict.llm.text import WORD


def words(text):
    return re.findall(WORD, (text or "").lower())


def shingles(text):
    w = words(text)
    if len(w) >= 5:
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    return [tuple(w)] if w else []


def jaccard(a, b):
    return len(a & b) / len(a | b)


def near_duplicate_rows(docs, threshold=0.8):
    """{doc_id: (class_id, n_links)} of (doc_id, text) pairs; ids are not null."""
    nodes = {}
    for i, text in docs:
        own = frozenset(shingles(text))
        nodes.setdefault((own, "" if own else text or ""), []).append(i)
    groups, sets = list(nodes.values()), [own for own, _ in nodes]
    parent, links = list(range(len(sets))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and jaccard(a, sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    classes = {}
    for i, group in enumerate(groups):
        classes.setdefault(find(i), []).extend(group)
    return {
        d: (min(classes[find(i)]), links[i]) for i, group in enumerate(groups) for d in group
    }


def contaminated_pairs(docs, items, threshold=0.8):
    """{(doc_id, item_id): (similarity, first word)}"""
    found = {}
    for i, text in docs:
        own = shingles(text)
        for item, item_text in items:
            bag = Counter(shingles(item_text))
            n = sum(bag.values())
            # A text that is shorter than the item is one window as a whole.
            for at in range(max(1, len(own) - n + 1)) if n and own else ():
                window = own[at : at + n]
                shared = sum((Counter(window) & bag).values())
                similarity = shared / (n + len(window) - shared)
                if similarity >= threshold and similarity > found.get((i, item), (0, 0))[0]:
                    found[i, item] = similarity, at
    return found
