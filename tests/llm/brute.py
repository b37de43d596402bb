"""Brute-force versions of corpus operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
from collections import Counter


def remove_repeats(docs: list[tuple[int | None, str | None]], span: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by looking every string up in a dictionary."""
    last = 1 << 62
    first: dict[bytes, int] = {}
    rows = [(i, (t or "").encode()) for i, t in docs]
    for i, raw in rows:
        key = last if i is None else i
        for k in range(len(raw) - span + 1):
            s = raw[k : k + span]
            first[s] = min(first.get(s, key), key)
    out = []
    for i, raw in rows:
        key = last if i is None else i
        gone = bytearray(len(raw))
        for k in range(len(raw) - span + 1):
            if first[raw[k : k + span]] < key:
                gone[k : k + span] = b"\1" * span
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def shingles(text: str | None, size: int = 5) -> Counter:
    words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    words = [w for w in words if w]
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def weighted_jaccard(a: Counter, b: Counter) -> float:
    shared = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - shared
    return shared / whole if whole else 0.0


def near_classes(docs: list[tuple[int, str | None]], similarity: float = 0.8) -> dict[int, int]:
    """doc_id -> smallest id connected by links of at least the similarity, all pairs compared."""
    bags = [(i, t or "", shingles(t)) for i, t in docs]
    root = {i: i for i, _, _ in bags}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, t, a) in enumerate(bags):
        for j, u, b in bags[x + 1 :]:
            sizes = sorted((sum(a.values()), sum(b.values())))
            if t == u or (sizes[0] >= similarity * sizes[1] and sizes[0] and weighted_jaccard(a, b) >= similarity):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in root}


def memberships(buckets: dict[int, list[int]], domain: dict[int, str], domains: list[str], size: int, smooth: float, sharp: float) -> dict[int, list[float]]:
    """doc_id -> posterior of each domain by naive Bayes, fitted on the labelled ids among ``buckets`` only."""
    words = [Counter() for _ in domains]
    rows = [0] * len(domains)
    for i, found in buckets.items():
        if domain.get(i) in domains:
            k = domains.index(domain[i])
            rows[k] += 1
            words[k].update(found)
    every, mass = sum(sum(c.values()) for c in words), smooth * size
    seen = set().union(*words)

    def rate(k: int, b: int) -> float:
        return (words[k][b] + mass * (sum(c[b] for c in words) + 1) / (every + size)) / (sum(words[k].values()) + mass)

    logs = {b: [math.log(rate(k, b) / rate(0, b)) for k in range(len(domains))] for b in seen}
    out = {}
    for i, found in buckets.items():
        score = [math.log(n / sum(rows)) if n else -math.inf for n in rows]
        score = [s + sharp * sum(logs[b][k] for b in found if b in logs) / math.sqrt(max(len(found), 1)) for k, s in enumerate(score)]
        powers = [math.exp(s - max(score)) for s in score]
        out[i] = [p / sum(powers) for p in powers]
    return out
