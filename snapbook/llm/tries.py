"""Prefix trie of conversations: every distinct beginning is a node, with its members, children, leaves and the words a shared prefix saves.

Turns become 128-bit digests of role and text and a conversation one row of digests. Rows are dealt into shards by range, so a shard holds a stretch
of the sorted conversations, copies included. A shard sorts its padded matrix of turn numbers, marks where each row first differs from the one
before (changes accumulated by OR along the columns) and sums up every depth with ``reduceat``. All measures of a node are sums over
its rows, so nodes cut by a shard's border, those on the paths of its first and last row, are put together by one aggregate.

Rules: turns are ordered by number, null first, then role, then digest; a null role or text counts as empty. Rows without a conversation key take no part.
Repeated rows are turns of their own. A conversation without turns is a member of the root only. An empty table has no node, not even a
root. A conversation is one row of some 20 bytes a turn wherever it is handled, never its texts; it may have a hundred million turns (2 GB).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from snapbook.llm.mixing import count_words
from snapbook.llm.shared import cut, tidy

DIGEST = 16
# Cells of a padded matrix, and its first columns; deeper columns follow for the rows that still need them.
CELLS = 1 << 20
FIRST_COLUMNS = 16
# Turns of a shard, on average.
SHARD_TURNS = 1 << 19
EMPTY = hashlib.sha256(b"").hexdigest()

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
PIECE = (
    "shard int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, words long, on_first boolean, on_last boolean, ends_last boolean"
)


def sequences(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: the digests and word counts of each conversation's turns, in order."""
    said, by = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce(F.col(f"`{role}`"), F.lit(""))
    digest = F.md5(F.concat(F.md5(by.cast("binary")), said).cast("binary"))
    rows = df.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), by.alias("role"), digest.alias("digest"), count_words(said).alias("words")).alias("_turn"),
    ).filter("conv_id is not null")
    ordered = F.sort_array(F.collect_list("_turn"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def spliced(rows: DataFrame, every: int, heads: int) -> DataFrame:
    """Conversations with their first h turns taken from conversation ``c - c % every``, where h is the CRC of c modulo ``heads``; without it, none."""
    rows = cut(rows.withColumn("_h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")))
    lent = rows.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_lender"), F.slice("turns", 1, heads - 1).alias("_lent"))
    joined = rows.join(lent, F.col("conv_id") - F.col("conv_id") % every == F.col("_lender"), "left")
    none = F.filter("turns", lambda _: F.lit(False))
    head = F.when(F.col("_lender").isNull(), none).otherwise(F.slice("_lent", F.lit(1), F.col("_h")))
    return joined.select("conv_id", F.concat(head, F.slice("turns", F.col("_h") + 1, F.size("turns"))).alias("turns"))


def turn_numbers(digests: np.ndarray) -> np.ndarray:
    """Numbers from 0 of 128-bit digests (two unsigned halves each), in the order of the digests."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    held = digests[order]
    fresh = np.r_[False, (held[1:] != held[:-1]).any(axis=1)] if len(held) else np.zeros(0, bool)
    numbers = np.empty(len(held), np.int64)
    numbers[order] = np.cumsum(fresh)
    return numbers


def _columns(rows: int, done: int, longest: int) -> int:
    """How many more columns a padded matrix of so many rows may have."""
    return min(longest - done, max(FIRST_COLUMNS, done), max(1, CELLS // max(rows, 1)))


def padded(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: int, width: int) -> np.ndarray:
    """Columns ``first`` to ``first + width`` of the rows, with -1 behind their ends."""
    at = np.arange(first, first + width)
    inside = at < lengths[:, None]
    out = np.full(inside.shape, -1, np.int64)
    out[inside] = numbers[(starts[:, None] + at)[inside]]
    return out


def sorted_rows(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Order of the rows by turn numbers, then key. Rows still tied after some columns are sorted on by further ones, the others are done."""
    place = np.zeros(len(keys), np.int64)  # of the group a row is tied in
    tied, done, longest = np.arange(len(keys)), 0, int(lengths.max(initial=0))
    while len(tied) > 1 and done < longest:
        width = _columns(len(tied), done, longest)
        matrix = padded(numbers, starts[tied], lengths[tied], done, width)
        order = np.lexsort((*matrix.T[::-1], place[tied]))
        tied, matrix, group = tied[order], matrix[order], place[tied[order]]
        apart = np.r_[True, (group[1:] != group[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)]
        opens = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        within = np.arange(len(tied)) - np.repeat(opens, np.diff(np.r_[opens, len(tied)]))
        splits = np.flatnonzero(apart)
        sizes = np.diff(np.r_[splits, len(tied)])
        place[tied] = group + np.repeat(within[splits], sizes)
        done += width
        more = np.maximum.reduceat(lengths[tied], splits) > done
        tied = tied[np.repeat((sizes > 1) & more, sizes)]
    return np.lexsort((keys, place))


def shared_lengths(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each sorted row has in common with the row before it; -1 for the first."""
    n, longest = len(lengths), int(lengths.max(initial=0))
    shared = np.zeros(n, np.int64)
    changed = np.zeros(n, bool)
    alive, done = np.arange(n), 0
    while done < longest and len(alive):
        width = _columns(len(alive), done, longest)
        matrix = padded(numbers, starts[alive], lengths[alive], done, width)
        # A row behind one that has ended differs from here on.
        before = np.maximum(alive - 1, 0)
        known = changed[alive] | (alive == 0) | (lengths[before] <= done)
        differs = np.empty(matrix.shape, bool)
        differs[0] = True
        differs[1:] = matrix[1:] != matrix[:-1]
        differs[:, 0] |= known
        fresh = np.logical_or.accumulate(differs, axis=1)
        inside = np.arange(done, done + width) < lengths[alive][:, None]
        shared[alive] += (~fresh & inside).sum(axis=1)
        changed[alive] = fresh[:, -1]
        done += width
        alive = alive[lengths[alive] > done]
    shared[:1] = -1
    return shared


def path_keys(path: bytes) -> list[bytes]:
    """Keys of the nodes on a path, from the root on."""
    state = hashlib.md5()
    keys = [state.digest()]
    for i in range(0, len(path), DIGEST):
        state.update(path[i : i + DIGEST])
        keys.append(state.digest())
    return keys


def shard_nodes(shard: int, keys: np.ndarray, paths: list[bytes], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard's conversations, those on its first and last path (with a ``key``) as pieces.

    A piece counts its first row as if no row stood before it and its last as if none followed.
    """
    lengths = np.array([len(p) // DIGEST for p in paths], np.int64)
    starts = np.cumsum(lengths) - lengths
    numbers = turn_numbers(np.frombuffer(b"".join(paths), ">u8").reshape(-1, 2))
    order = sorted_rows(numbers, starts, lengths, keys)
    keys, lengths, starts = keys[order], lengths[order], starts[order]
    shared = shared_lengths(numbers, starts, lengths)
    upto = np.r_[0, np.cumsum(words)]
    leaf = np.r_[shared[1:] < lengths[:-1], True]
    n = len(keys)
    border = [path_keys(paths[order[0]]), path_keys(paths[order[-1]])]
    parent_conv, parent_border = np.zeros(n, np.int64), np.full(n, -1)
    alive = np.arange(n)
    for depth in range(int(lengths.max(initial=0)) + 1):
        alive = alive[lengths[alive] >= depth]
        opens = np.flatnonzero(shared[alive] < depth)
        heads = alive[opens]
        total = lambda x, opens=opens: np.add.reduceat(x.astype(np.int64), opens)
        sizes = np.diff(np.r_[opens, len(alive)])
        least = np.minimum.reduceat(keys[alive], opens)
        own = max(depth, 1) - 1
        saved = total(upto[starts[alive] + np.maximum(shared[alive], own)] - upto[starts[alive] + own])
        children = total((shared[alive] <= depth) & (lengths[alive] > depth))
        leaves = total(leaf[alive])
        on_first = np.zeros(len(opens), bool)
        on_last = np.zeros(len(opens), bool)
        on_first[0], on_last[-1] = lengths[0] >= depth, lengths[-1] >= depth
        cut_off = np.where(on_first, 0, np.where(on_last, 1, -1))
        ends = np.full(len(opens), "", object)
        done = np.flatnonzero(lengths[alive] == depth)
        owner = np.searchsorted(opens, done, "right") - 1
        for group in np.split(np.arange(len(done)), np.flatnonzero(np.diff(owner)) + 1) if len(done) else []:
            ends[owner[group[0]]] = ",".join(map(str, keys[alive[done[group]]].tolist()))
        whole = cut_off < 0
        ends[whole] = [hashlib.sha256(e.encode()).hexdigest() if e else EMPTY for e in ends[whole]]
        above = parent_border[heads] if depth else np.full(len(opens), -1)
        known = (above < 0) & (depth > 0)
        own_words = upto[starts[heads] + depth] - upto[starts[heads] + own] if depth else np.zeros(len(opens), np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(opens), shard), pa.int32()), pa.array(np.full(len(opens), depth), pa.int64()),
            pa.array([border[b][depth] if b >= 0 else None for b in cut_off.tolist()], pa.binary()),
            pa.array([border[b][depth - 1] if b >= 0 else None for b in above.tolist()], pa.binary()),
            pa.array(least, pa.int64()), pa.array(parent_conv[heads], pa.int64(), mask=~known), pa.array(sizes, pa.int64()), pa.array(children), pa.array(leaves),
            pa.array(saved), pa.array(ends.tolist(), pa.string()), pa.array(own_words, pa.int64()), pa.array(on_first), pa.array(on_last),
            pa.array(on_last & (lengths[-1] == depth)),
        ], names=[part.split()[0] for part in PIECE.split(", ")])
        parent_conv[alive], parent_border[alive] = np.repeat(least, sizes), np.repeat(cut_off, sizes)


def _pieces(rows: DataFrame) -> DataFrame:
    """All nodes and pieces, written to the shared folder."""
    turns = rows.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    shards = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            keys = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held])
            words = np.concatenate([b.column(2).flatten().to_numpy(zero_copy_only=False) for b in held])
            paths = [p for b in held for p in b.column(1).to_pylist()]
            yield from shard_nodes(held[0].column(3)[0].as_py(), keys, paths, words)

    dealt = rows.repartitionByRange(shards, "path", "conv_id").select("conv_id", "path", "words", F.spark_partition_id().alias("shard"))
    return cut(dealt.mapInArrow(tidy(run), PIECE))


def _ends(pieces: DataFrame) -> DataFrame:
    """Digest of the ends of each cut node: its shards hold ascending stretches of them, which stream by in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            for key, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        yield pa.RecordBatch.from_pydict({"key": pa.array([now], pa.binary()), "ends_sha256": [state.hexdigest()]})
                    now, state = key, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
        if now is not None:
            yield pa.RecordBatch.from_pydict({"key": pa.array([now], pa.binary()), "ends_sha256": [state.hexdigest()]})

    rows = pieces.filter("ends <> ''").repartition("key").sortWithinPartitions("key", "shard").select("key", "ends")
    return rows.mapInArrow(tidy(run), "key binary, ends_sha256 string")


def _joined(pieces: DataFrame) -> DataFrame:
    """The cut nodes put together.

    A node that an earlier shard has too is continued here: on the first path of a shard these are the turns its first row shares with the last
    row of the shard before. They add to what is saved, and a continued child was counted there already. A last row whose
    node goes on in a later shard was no leaf.
    """
    by_key, by_shard = Window.partitionBy("key"), Window.partitionBy("shard")
    seen = pieces.withColumns({"_continued": F.col("on_first") & (F.col("shard") > F.min("shard").over(by_key)), "_goes_on": F.col("shard") < F.max("shard").over(by_key)})
    deeper = by_shard.orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = seen.withColumns({
        "_more": F.sum(F.when(F.col("_continued"), F.col("words")).otherwise(F.lit(0))).over(deeper),
        "_deepest": F.max(F.when(F.col("_continued"), F.col("depth"))).over(by_shard),
        "_no_leaf": F.max(F.col("ends_last") & F.col("_goes_on")).over(by_shard),
    })
    count = lambda cond: F.when(cond, 1).otherwise(0)
    mended = seen.select(
        "key", "parent_key", "depth", "conv_id", "n_convs", (F.col("n_children") - count(F.col("on_first") & (F.col("depth") < F.col("_deepest")))).alias("n_children"),
        (F.col("n_leaves") - count(F.col("on_last") & F.col("_no_leaf"))).alias("n_leaves"),
        (F.col("saved_tokens") + F.when(F.col("_continued"), F.col("_more")).otherwise(F.lit(0))).alias("saved_tokens"),
    )
    return mended.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )


def trie(rows: DataFrame) -> DataFrame:
    """One row per node of the conversations in ``rows`` (``conv_id, turns`` of ``sequences``), with the columns ``COLUMNS``.

    A node is named by its smallest member and its depth, a parent by its own smallest member. ``ends_sha256`` is over the keys of the conversations that end there.
    """
    paths = cut(rows.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"),
    ))
    found = _pieces(paths)
    pieces = found.filter("key is not null")
    joined = _joined(pieces.drop("ends", "parent_conv_id")).join(_ends(pieces), "key", "left")
    joined = cut(joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))))
    parents = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = found.filter("key is null").withColumnRenamed("ends", "ends_sha256")
    inner = whole.filter("parent_key is null").select(*COLUMNS)
    below = whole.filter("parent_key is not null").drop("parent_conv_id").join(parents, "parent_key").select(*COLUMNS)
    return inner.unionByName(below).unionByName(joined.join(parents, "parent_key", "left").select(*COLUMNS))
