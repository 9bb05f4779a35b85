"""Slow and plain versions of the operators, written apart from them."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPACE.findall(text or "")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def remove_repeats(rows, k):
    """{id: (n_words, n_removed, sha256)} of (id, text) rows with distinct ids."""
    first = {}
    for i, text in sorted(rows):
        w = words(text)
        for s in range(len(w) - k + 1):
            first.setdefault(tuple(w[s : s + k]), (i, s))
    out = {}
    for i, text in rows:
        w = words(text)
        gone = set()
        for s in range(len(w) - k + 1):
            if first[tuple(w[s : s + k])] != (i, s):
                gone |= set(range(s, s + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def shingles(text, width):
    w = words(low(text))
    if not w:
        return []
    return [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]


def simhash(text, width):
    found = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, width)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def components(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def near_groups(texts, width, parts, most, similarity):
    """Least place of each text's group: candidates by the fingerprints of distinct shingles, links by Jaccard similarity."""
    from tessitura.llm import simhash

    sets = [set(shingles(t, width)) for t in texts]
    prints = np.array([simhash.majorities(np.unique(simhash.shingles((t or "").encode(), width)), parts) for t in texts], np.uint64).reshape(-1, parts)
    limit = simhash.bits_at(similarity, 64 * parts)

    def linked(a, b):
        if sets[a] == sets[b]:
            return True
        bits = np.bitwise_count(prints[a] ^ prints[b])
        return bits.min() <= most and bits.sum() <= limit and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9

    return components(len(texts), linked)


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target}: what stands above the limit is shared anew until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, list(order)
    while free:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s] + 1e-9]
        if not over:
            return out | share
        out |= {s: most * sizes[s] for s in over}
        free = [s for s in free if s not in over]
    return out


def unigram_tokens(word, scores):
    """Tokens of the best segmentation of a word, by the whole table of prefixes."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for d in range(1, len(word) + 1):
        for s in range(d):
            p = scores.get(word[s:d])
            if p is not None:
                value, n = best[s][0] + p, best[s][1] + 1
                if value > best[d][0] or (value == best[d][0] and n < best[d][1]):
                    best[d] = (value, n)
    return best[-1][1]


def base_licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    starts, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        here = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        starts += here
        labels |= {label} if here else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def license_labels(text, rules, gap):
    """(labels, score): every match of every rule, those inside another dropped, and the base phrases."""
    flat = re.sub(gap, " ", low(text))
    found = [(m.start(), -m.end(), rank, label, sure) for label, _, exp, rank, sure in rules for m in re.finditer(exp, flat)]
    kept, reach = [], 0
    for start, back, _, label, sure in sorted(found):
        if -back > reach:
            kept.append((label, sure))
            reach = -back
    base = set(base_licenses(text)[4].split(",")) - {""}
    return ",".join(sorted({a for a, _ in kept} | base)), max([b for _, b in kept] + [80 if base else 0]) / 100


def top_k(vectors, queries, k):
    """[(query, rank, id, score)] of (id, list of whole numbers)."""
    out = []
    for i, q in vectors:
        if queries(i):
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i)
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def sketch(text, width, scale, value_of):
    return {v for s in shingles(text, width) if (v := value_of(s)) < 2**64 // scale}


def counts(values):
    return Counter(values)


def by(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(r)
    return out
