"""Plain Python versions of the training-data operators' results."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality(text):
    x = text or ""
    w = WORD.findall(x)
    counts = collections.Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for k in range(len(w) - 2):
        if counts[tuple(w[k:k + 3])] > 1:
            covered.update((k, k + 1, k + 2))
    lines = [y for y in x.split("\n") if WORD.search(y)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def line_keys(text):
    return [y.strip(SPACE).translate(LOWER) for y in (text or "").split("\n")]


def kept_lines(texts, threshold=10):
    """(n_lines, n_dropped, kept text) per text."""
    counts = collections.Counter(k for t in texts for k in set(line_keys(t)) if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        keep = [y for y, k in zip(lines, line_keys(t)) if not k or counts[k] < threshold]
        out.append((len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4))


def components(sets, percent=75):
    """Component number (position of its first member) per set."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = collections.Counter()
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def crc(text) -> int:
    return zlib.crc32((text or "").encode())
