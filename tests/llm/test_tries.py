"""Prefix trie of conversations."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from plain import WORD

from snapbook.llm import tries
from snapbook.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth long, shard int, words long"


def ordered(rows):
    """Turns (role, text) of each conversation, in order."""
    digest = lambda role, text: hashlib.md5((hashlib.md5(role.encode()).hexdigest() + text).encode()).hexdigest()
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            by[conv].append((turn is not None, turn or 0, role, digest(role, text), text))
    return {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in by.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        lender = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(lender, [])[:h] + turns[h:]
    return out


def plain(convs):
    """Rows of the trie, node by node."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, saved, leaves = collections.Counter(n[:-1] for n in members if n), collections.Counter(), collections.Counter()
    for node in members:
        here = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += here
            leaves[node[:d]] += not children[node]
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), children[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    )


def got(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in tries.COLUMNS) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)


def edge_turns():
    rng = random.Random(3)
    rows = []
    for c in range(-45, 160):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(("user", "bot", None)), rng.choice(("hello there", "yes", "no", "", None, "a longer answer of several words", "été x 日本"))))
    copies = [("user", "hello there"), ("bot", "yes"), ("user", "no"), ("bot", "a b c")]
    for c in range(1000, 1150):
        rows += [(c, t, *said) for t, said in enumerate(copies[: 4 if c % 5 else 2])]
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (8, 0, "user", "tie"), (8, 0, "bot", "tie"), (None, 0, "user", "lost"), (2**62, 0, "", "far"), (5, 9, "user", "9")]
    return rows


@pytest.mark.parametrize("shards", ["1", "5", "64"])
def test_trie_against_plain(spark, shards):
    """With few and very many shards, so that hot copies and long paths are cut by borders."""
    rows, before = edge_turns(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = tries.sequences(frame(spark, rows))
        assert got(tries.trie(found)) == plain(ordered(rows))
        assert got(tries.trie(tries.spliced(found, 20, 4))) == plain(rebuilt(ordered(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_conversations(spark):
    said = [("user", f"turn {i % 7}") for i in range(900)]
    rows = [(c, i, *t) for c, n in ((1, 900), (2, 899), (3, 450), (40, 900)) for i, t in enumerate(said[:n])] + [(4, 0, "user", "turn 0"), (4, 1, "user", "else")]
    assert got(tries.trie(tries.sequences(frame(spark, rows)))) == plain(ordered(rows))


def test_whole_table_against_plain(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_prefixes"](spark, sf_dir)) == plain(rebuilt(ordered(rows)))


def test_without_turns(spark):
    assert tries.trie(tries.sequences(frame(spark, []))).count() == 0
    assert tries.trie(tries.sequences(frame(spark, [(None, 1, "user", "x")]))).count() == 0
    empty = spark.createDataFrame([(3, []), (1, [])], "conv_id long, turns array<struct<digest: string, words: int>>")
    assert got(tries.trie(empty)) == [(1, 0, -1, 2, 0, 1, 0, hashlib.sha256(b"1,3").hexdigest())]


@pytest.mark.parametrize("cells", [4, 64, 1 << 20])
def test_rows_sort_and_share_in_any_width(monkeypatch, cells):
    monkeypatch.setattr(tries, "CELLS", cells)
    monkeypatch.setattr(tries, "FIRST_COLUMNS", 2)
    rng = random.Random(cells)
    rows = [[rng.randint(0, 2) for _ in range(rng.choice((0, 1, 2, 3, 5, 40)))] for _ in range(200)]
    rows += [[1, 1] + r for r in rows[:60]] + rows[:30]
    lengths = np.array([len(r) for r in rows])
    starts, keys = np.cumsum(lengths) - lengths, np.array([rng.randint(0, 9) for _ in rows])
    numbers = np.array([x for r in rows for x in r], np.int64)
    order = tries.sorted_rows(numbers, starts, lengths, keys)
    assert [(rows[i], keys[i]) for i in order] == sorted(zip(rows, keys))
    shared = tries.shared_lengths(numbers, starts[order], lengths[order])
    same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert shared.tolist() == [-1] + [same(rows[a], rows[b]) for a, b in zip(order, order[1:])]
