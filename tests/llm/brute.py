"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def substring(rows: list[tuple[int, str | None]], length: int) -> list[tuple]:
    docs = sorted(rows, key=lambda r: r[0])
    first: dict[tuple, tuple] = {}
    for d, t in docs:
        w = words(t)
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), (d, s))
    out = []
    for d, t in docs:
        w, gone = words(t), set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] != (d, s):
                gone |= set(range(s, s + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


class Union:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def jaccard(rows: list[tuple[int, str | None]], threshold: float = 0.8, gram: int = 5) -> list[tuple]:
    sets = []
    for d, t in rows:
        w = words(t)
        sets.append((d, {tuple(w[i : i + gram]) for i in range(len(w) - gram + 1)} if len(w) >= gram else {tuple(w)} if w else set()))
    u, links = Union(), Counter()
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                u.join(a, b)
                links[a] += 1
                links[b] += 1
    return sorted((d, u.find(d), links[d], u.find(d) == d) for d, _ in sets)


def exact(rows: list[tuple[int, str | None]]) -> list[tuple]:
    groups = defaultdict(list)
    texts = {}
    for d, t in rows:
        texts[d] = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups[texts[d]].append(d)
    return sorted((d, min(groups[t]), len(groups[t]), d == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in texts.items())


def targets(sizes: dict, weights: list[float], share: float, cap: float) -> dict:
    """Water-filling round by round: clamp, reshare the excess by weight, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, clamped = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(cap * sizes[s] for s in clamped)
        free = [s for s in names if s not in clamped]
        level = left / sum(w[s] for s in free) if free else 0
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return {s: cap * sizes[s] if s in clamped else level * w[s] for s in names}
        clamped |= set(over)


def lm(rows: list[tuple[int, str | None]], order: int, alpha: float, least: int) -> list[tuple]:
    count = Counter()
    for _, t in rows:
        w = words(t)
        for n in range(1, order + 1):
            count.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    total = sum(c for g, c in count.items() if len(g) == 1)
    out = []
    for d, t in rows:
        w, score = words(t), 0.0
        for i in range(len(w)):
            context, factor = tuple(w[max(0, i - order + 1) : i]), 1.0
            while context and count[(*context, w[i])] < least:
                context, factor = context[1:], factor * alpha
            score += math.log(factor * count[(*context, w[i])] / (count[context] if context else total))
        out.append((d, len(w), round(score, 6)))
    return sorted(out)
