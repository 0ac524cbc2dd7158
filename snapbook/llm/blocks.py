"""Numpy helpers that work inside one task: groups of rows, word hashes, sliding minima, intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
HASH_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE_BASE = np.uint64(pow(int(HASH_BASE), -1, 1 << 64))
POWERS = 1 << 18

# Spaces of the word rule [^\x20\x09-\x0D]+.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

BYTE_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_CODES = BYTE_CODES.copy()
LOWER_CODES[65:91] = BYTE_CODES[97:123]


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch; null becomes the empty text."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def row_groups(sizes: list[int], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes; a larger row is a run of its own."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(n + 1, POWERS + 1)
        for name, base in (("up", HASH_BASE), ("down", INVERSE_BASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


def _hash_piece(data: np.ndarray, codes: np.ndarray, spaces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~spaces[data]
    turns = np.diff(inside)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), starts, ends
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts], starts, ends


def hash_words(
    text: bytes, codes: np.ndarray = BYTE_CODES, spaces: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first and past-the-end byte of every word, in order.

    A word's hash is a polynomial of its bytes, mixed; it does not depend on the place in the text. Long texts are
    cut at spaces, so the tables of powers stay small.
    """
    data = np.frombuffer(text, np.uint8)
    parts, at = [], 0
    while at < len(data):
        to = min(at + POWERS, len(data))
        if to < len(data):
            gaps = np.flatnonzero(spaces[data[at:to]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
            else:
                later = np.flatnonzero(spaces[data[to:]])
                to = to + int(later[0]) if len(later) else len(data)
        h, s, e = _hash_piece(data[at:to], codes, spaces)
        parts.append((h, s + at, e + at))
        at = to
    if not parts:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty
    h, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
    return mix(h), s, e


def words_of_group(
    texts: list[str], codes: np.ndarray = BYTE_CODES, spaces: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts one after another, and the border of each text in them (one more than texts)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    hashes, starts, _ = hash_words(b"\n".join(raw), codes, spaces)
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    return hashes, np.searchsorted(starts, begins)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n word hashes (a polynomial of the words, mixed)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values, by doubling."""
    low, have = values, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def chosen_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the place of its smallest one, the first on a tie.

    Hashes are compared by their upper 40 bits; the choice depends on the run's content alone.
    """
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    out, block = [], 1 << 22
    for at in range(0, len(hashes) - width + 1, block):
        part = hashes[at : at + block + width - 1]
        keyed = (part & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(part), dtype=np.uint64)
        low = window_minimum(keyed, width)
        out.append((low & np.uint64(0xFFFFFF)).astype(np.int64) + at)
    return np.concatenate(out)


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of equal neighbours."""
    if len(values) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turns = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], turns]), np.concatenate([turns, [len(values)]]) - 1


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal runs; touching intervals become one."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return starts[new], ends[last]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)
