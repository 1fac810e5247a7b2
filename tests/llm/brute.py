"""Plain versions of the operators: one machine, no cleverness."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.decode() for w in WORD.findall((text or "").encode())]


def fingerprint(text, width):
    w = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    if not w:
        return 0
    parts = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, width=4, distance=4):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    fps = [fingerprint(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    pick = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(d, f"{fps[i]:016x}", pick[find(i)]) for i, (d, _) in enumerate(rows)]


def repetition(text, at_least=10):
    """(words, word chars, symbols, repeated lines, words in repeated windows, covered words, longest repeat)."""
    w = words(text)
    n = len(w)
    windows = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    inside = {i + k for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    longest, covered = 0, set()
    shared = [0] * n
    for i in range(n):
        for j in range(i):
            k = 0
            while i + k < n and w[i + k] == w[j + k]:
                k += 1
            shared[i], shared[j] = max(shared[i], k), max(shared[j], k)
    for i, k in enumerate(shared):
        longest = max(longest, k)
        if k >= at_least:
            covered |= set(range(i, i + k))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        n,
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(inside),
        len(covered),
        longest,
    )


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def targets(sizes, weights, share=1.5, cap=2):
    """Water-filling by hand: {source: target}."""
    left, free, out = share * sum(sizes.values()), set(sizes), {}
    while free:
        total = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / total >= cap * sizes[s]]
        if not over:
            out |= {s: left * weights[s] / total for s in free}
            break
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out
