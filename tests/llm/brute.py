"""Plain Python versions of the operators, for small tables."""

import hashlib
import re

import xxhash

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPLIT.findall(text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def fingerprint(text):
    w = words(lowered(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, linked):
    """``linked(i, j)`` over positions; the smallest id of each position's component."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]
