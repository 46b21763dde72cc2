"""Plain versions of the contracts, for small tables: list of (doc_id, text) in, dict or set of rows out."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def shingle_set(text):
    w = WORD.findall((text or "").translate(UPPER_TO_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def components_of(rows, percent=85):
    """{doc_id: (n_shingles, component_id)}; doc_ids must be unique."""
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    pairs = {p for h in holders.values() for p in itertools.combinations(sorted(h), 2)}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(UPPER_TO_LOWER)].append(d)
    return sorted((d, max(ids), len(ids), d == max(ids), hashlib.sha256(n.encode()).hexdigest()) for n, ids in groups.items() for d in ids)


BASE = [
    ("assign", re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def secrets(text):
    found = sorted((m.start(), i, m.end(), kind) for i, (kind, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m.group(g)) >= least)
    counts = Counter(x[3] for x in found)
    listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)
    return counts["assign"], counts["access"], counts["hex"], hashlib.sha256(listed.encode()).hexdigest(), listed


def smallest_capacity(sizes, shards):
    """By trying each sum of consecutive sizes."""
    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})

    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    return next(c for c in sums if fits(c))


def group_sizes(rows, overhead=8):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    return [len(ids) * (len(t.encode()) + overhead) for t, ids in sorted(groups.items(), key=lambda x: min(x[1]))]


def one_word_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def line_dedup(rows):
    """[(doc_id, text)] with every line compared to all earlier ones; doc_ids unique and sorted."""
    seen, out = [], []
    for d, t in rows:
        if t is None:
            out.append((d, None))
            continue
        stay = []
        for line in t.split("\n"):
            w = WORD.findall(line)
            gone = len(w) >= 3 and any(w == x or (min(len(w), len(x)) >= 8 and one_word_apart(w, x)) for x in seen)
            if len(w) >= 3:
                seen.append(w)
            if not gone:
                stay.append(line)
        out.append((d, "\n".join(stay)))
    return out


def unigram(rows):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    tokens = {d: [*WORD.findall((t or "").translate(UPPER_TO_LOWER)), None] for d, t in rows}
    counts = Counter(x for d, w in tokens.items() if not held[d] for x in w)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (held[d], len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
        for d, w in tokens.items()
    }


def maxent_scores(rows, model, counts, frequent, buckets):
    """log10 probability of every text, word by word and branch by branch, with the weights of a trained ``model``."""
    leaves, half = 32**model.depth, (1 << 32) - 1
    order = sorted(counts, key=lambda w: (-counts[w], w))[:frequent]
    top = {w: i + 1 for i, w in enumerate(order)}

    def leaf(word):
        return zlib.crc32(word[-2:]) % buckets * leaves + zlib.crc32(word) % leaves

    def path(word):
        return top[word] * leaves if word in top else (frequent + 1) * leaves + leaf(word)

    def hashed(kind, a, b):
        x = (a * 0x9E3779B1 & half) ^ (b * 0x85EBCA77 & half) ^ (kind * 0x27D4EB2F & half)
        x = (x ^ x >> 15) * 0x2C1B3C6D & half
        return ((x ^ x >> 13) * 0x297A2D39 & half) >> 7

    def branch(table, own, contexts, wanted):
        picked = [model.tables[table][model.rows + own]] + [model.tables[table][hashed(*c) % model.rows] for c in contexts]
        sums = [sum(float(r[i]) for r in picked) for i in range(32)]
        return sums[wanted] - math.log(sum(map(math.exp, sums)))

    masses = Counter()
    for word, n in counts.items():
        if word not in top:
            masses[leaf(word)] += n + 1
    out = {}
    for doc_id, text in rows:
        before = skipped = 0
        total = 0.0
        for word in [*(w.encode() for w in WORD.findall((text or "").translate(UPPER_TO_LOWER))), None]:
            code = 0 if word is None else path(word)
            symbol, near, far = code // leaves, before // leaves, skipped // leaves
            total += branch(0, 0, [(1, before, 0), (2, far, 0), (3, near, far)], symbol // 32)
            total += branch(1, symbol // 32, [(4, near, symbol // 32), (5, far, symbol // 32)], symbol % 32)
            if symbol > frequent:
                inner, own = code - (frequent + 1) * leaves, 0
                for d in range(model.depth):
                    node, wanted = divmod(inner // 32**(model.depth - 1 - d), 32)
                    total += branch(2, own + node, [(6 + d, before, node)], wanted)
                    own += buckets * 32**d
                total += math.log(counts[word] + 1) - math.log(masses[leaf(word)] + 1)
            before, skipped = code, before
        out[doc_id] = total / math.log(10)
    return out
