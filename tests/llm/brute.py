"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, size):
    own = words(lower(text))
    if not own:
        return frozenset()
    if len(own) < size:
        return frozenset([tuple(own)])
    return frozenset(zip(*(own[i:] for i in range(size))))


def near_duplicates(rows, size, percent=80):
    """doc_id to (set size, least id of its component), by comparing all pairs."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * either:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def phrase_places(text, phrases):
    own = license_words(text)
    return len(own), [
        (i, label) for i in range(len(own)) for p, label in phrases if own[i : i + len(p.split())] == p.split()
    ]


def language_model(train, mu):
    """Function from a text to (tokens, known, base, score), and the training tokens."""
    unigrams, pairs = Counter(), Counter()
    for text in train:
        own = [*words(lower(text)), None]
        unigrams.update(own)
        pairs.update(zip([None, *own], own))
    total, distinct = sum(unigrams.values()), len(unigrams)

    def word(w):
        return (unigrams[w] + 0.1) / (total + 0.1 * (distinct + 1))

    def score(text):
        own = [*words(lower(text)), None]
        base = sum(math.log10(word(w)) for w in own)
        model = sum(
            math.log10((pairs[v, w] + mu * word(w)) / (unigrams[v] + mu)) for v, w in zip([None, *own], own)
        )
        return len(own), sum(unigrams[w] > 0 for w in own), base, model

    return score, total


def passages(text, least=50):
    """Blocks of lines in a row of just over ``least`` words."""
    lines = [x for x in (text or "").split("\n") if x.strip()]
    found = set()
    for a in range(len(lines)):
        n = 0
        for b in range(a, len(lines)):
            n += len(lines[b].split())
            if n > least:
                found.add("\n".join(lines[a : b + 1]))
                break
    return found


def repeated_passages(texts):
    counts = Counter(p for t in texts for p in passages(t))
    return {p for p, n in counts.items() if n > 1}


def water_level(sizes, share=1.5, limit=2.0, weights=(5, 2, 1)):
    """Target per source by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest = {}, share * sum(sizes.values())
    open_ = set(order)
    while open_:
        whole = sum(weight[s] for s in open_)
        full = {s for s in open_ if rest * weight[s] / whole > limit * sizes[s]}
        if not full:
            return target | {s: rest * weight[s] / whole for s in open_}
        for s in full:
            target[s] = limit * sizes[s]
        rest -= sum(target[s] for s in full)
        open_ -= full
    return target


