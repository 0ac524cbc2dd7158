"""Plain versions of the operators' rules, for comparison on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 1 << 63


def rank(doc_id):
    return LAST if doc_id is None else doc_id


def base_quality(text):
    words = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    triples = Counter(zip(words, words[1:], words[2:]))
    hit = {k + i for k in range(len(words) - 2) for i in range(3) if triples[tuple(words[k : k + 3])] > 1}
    n = len(words)
    return n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def gram_share(text, n):
    """Share of word characters inside n-grams that occur twice or more."""
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    hit = {k + i for k in range(len(words) - n + 1) for i in range(n) if grams[tuple(words[k : k + n])] > 1}
    total = sum(map(len, words))
    return sum(len(words[i]) for i in hit) / total if total else 0.0


def repeated_words(rows, size=50):
    """Per row: words, removed words, digest of the kept words."""
    first = {}
    for i, t in rows:
        words = WORD.findall(t or "")
        for k in range(len(words) - size + 1):
            key = tuple(words[k : k + size])
            first[key] = min(first.get(key, LAST + 1), rank(i))
    out = []
    for i, t in rows:
        words = WORD.findall(t or "")
        gone = set()
        for k in range(len(words) - size + 1):
            if first[tuple(words[k : k + size])] < rank(i):
                gone.update(range(k, k + size))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def repeated_bytes(rows, size=100):
    """Per row: bytes, removed bytes, runs of them, digest of the kept bytes. Rows with one id are different documents."""
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        for k in range(len(data) - size + 1):
            key = data[k : k + size]
            first[key] = min(first.get(key, LAST + 1), rank(i))
    out = []
    for i, t in rows:
        data, own = (t or "").encode(), set()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            key = data[k : k + size]
            if first[key] < rank(i) or key in own:
                gone[k : k + size] = b"\1" * size
            own.add(key)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(data, gone) if not g)).hexdigest()))
    return out


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def similar(rows, percent=80):
    """Per row: size of its set and smallest id reachable."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(list)
    for n, s in enumerate(sets):
        common = Counter(m for g in s for m in at[g])
        for m, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[m]) - both):
                parent[find(n)] = find(m)
        for g in s:
            at[g].append(n)
    least = {}
    for n, (i, _) in enumerate(rows):
        root = find(n)
        least[root] = min(least.get(root, LAST), rank(i))
    out = []
    for n, (i, _) in enumerate(rows):
        low = least[find(n)]
        out.append((i, len(sets[n]), None if low == LAST else low))
    return out


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(words)]
    return "".join(w + ("\n" if i % 17 == 16 else " ") for i, w in enumerate(made)).strip()
