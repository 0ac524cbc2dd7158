"""Hard negatives of anchors by exact integer inner products, tile by tile.

Vectors become whole numbers and are packed into blocks, those of the anchors into blocks of their own. Every anchor block meets every block of rows: a
tile, multiplied by Strassen's recursion. A tile leaves the best few of each anchor, which merge with those of other tiles like heaps: first the
positives (best rows of the anchor's label), then, with the positives known, the best rows of other labels in each positive's window.

Rules: rows with a null key, label or vector, or a null or non-finite component take no part. A shorter vector counts as filled up with zeros, an
empty one has score 0 with all. Equal scores go by the smaller key. A row with the anchor's key is never its positive. Repeated rows count one by one:
as candidates each takes a place, as anchors each has results of its own. Anchors without positives, and positives without a row in the
window, have no result. An empty table gives an empty result. Scores have to fit 64 bits a hundredfold (with 64 components:
numbers below 2**25); larger ones end the query with an error that says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapbook.llm.shared import cut, tidy
from snapbook.llm.strassen import multiply

# Rows of a block; a block of long vectors has fewer, so that it stays below CELLS numbers.
ANCHOR_ROWS = 512
BLOCK_ROWS = 4096
CELLS = 1 << 19
# Blocks whose tiles with one anchor block are worked off in one go.
GROUP_BLOCKS = 64
SCALE = 256.0
POSITIVES = NEGATIVES = 5
LOWEST, HIGHEST = 80, 100
# Kept for so many anchor blocks at once while tiles stream by.
OPEN = 4

BLOCK_SCHEMA = "n int, width int, size int, largest long, keys binary, labels binary, numbers binary"
BEST_SCHEMA = "block long, slot int, score long, id long"
PACKED = pa.schema([("n", pa.int32()), ("width", pa.int32()), ("size", pa.int32()), ("largest", pa.int64()), ("keys", pa.binary()), ("labels", pa.binary()), ("numbers", pa.binary())])
MERGED = pa.schema([("block", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])
NONE = -(1 << 63)
ROOM = (1 << 63) // 128


def whole_numbers(vectors: pa.Array, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per vector whether it is usable and its length, and the numbers ``floor(scale * x)`` of the usable ones, one after another."""
    lengths = np.array(vectors.value_lengths().fill_null(0), np.int64)
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(lengths)), lengths)
    good = np.array(vectors.is_valid())
    np.logical_and.at(good, at[~np.isfinite(values)], False)
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values[good[at]])
    if len(scaled) and np.abs(scaled).max() >= 2.0**31:
        raise ValueError("a vector has components too large for exact 64-bit scores")
    return good, lengths, scaled.astype(np.int64)


def pack(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """Blocks of ``rows`` (id, label, vector), each with its keys in order, written to the shared folder and numbered."""

    def block(keys: list[int], labels: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        matrix = np.zeros((len(parts), max(map(len, parts))), np.int64)
        for i, k in enumerate(order):
            matrix[i, : len(parts[k])] = parts[k]
        most = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))
        kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
        pick = lambda x: np.array(x, np.int64)[order].tobytes()
        return pa.RecordBatch.from_pylist([{
            "n": len(parts), "width": matrix.shape[1], "size": np.dtype(kind).itemsize, "largest": most, "keys": pick(keys), "labels": pick(labels),
            "numbers": matrix.astype(kind).tobytes(),
        }], schema=PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        labels: list[int] = []
        parts: list[np.ndarray] = []
        width = 0
        for batch in batches:
            good, lengths, numbers = whole_numbers(batch.column(2), scale)
            ends = np.cumsum(lengths[good])
            mine = zip(batch.column(0).filter(pa.array(good)).to_pylist(), batch.column(1).filter(pa.array(good)).to_pylist(), np.split(numbers, ends[:-1]) if len(ends) else [], strict=True)
            for key, label, part in mine:
                if keys and (len(keys) >= size or (len(keys) + 1) * max(width, len(part)) > CELLS):
                    yield block(keys, labels, parts)
                    keys, labels, parts, width = [], [], [], 0
                keys.append(key)
                labels.append(label)
                parts.append(part)
                width = max(width, len(part))
        if keys:
            yield block(keys, labels, parts)

    return cut(rows.mapInArrow(tidy(run), BLOCK_SCHEMA).withColumn("block", F.monotonically_increasing_id()))


KINDS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}


class Side:
    """Keys, labels and numbers of a packed block."""

    def __init__(self, row: dict, prefix: str) -> None:
        self.keys = np.frombuffer(row[f"{prefix}_keys"], np.int64)
        self.labels = np.frombuffer(row[f"{prefix}_labels"], np.int64)
        self.numbers = np.frombuffer(row[f"{prefix}_numbers"], KINDS[row[f"{prefix}_size"]]).reshape(len(self.keys), row[f"{prefix}_width"]).astype(np.int64)


def scores_of(anchors: Side, rows: Side) -> np.ndarray:
    """All inner products of a tile."""
    k = min(anchors.numbers.shape[1], rows.numbers.shape[1])
    return multiply(anchors.numbers[:, :k], np.ascontiguousarray(rows.numbers[:, :k].T))


def best(scores: np.ndarray, allowed: np.ndarray, keys: np.ndarray, slots: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot, score and key of the ``k`` best allowed entries of each line; ``keys`` ascend, so the first of equal scores has the smaller key."""
    masked = np.where(allowed, scores, NONE)
    if masked.shape[1] > k:
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        allowed = allowed & (masked >= least[:, None])
    line, column = np.nonzero(allowed)
    return firsts(slots[line], masked[line, column], keys[column], k)


def firsts(slot: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries of each slot: higher scores first, then smaller keys. Two such sets, put together, merge by the same rule."""
    order = np.lexsort((key, -score, slot))
    slot, score, key = slot[order], score[order], key[order]
    starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, np.int64)
    place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
    kept = place < k
    return slot[kept], score[kept], key[kept]


def _tiles(anchors: DataFrame, blocks: DataFrame, groups: int) -> DataFrame:
    """Every anchor block beside every block of rows: rows are dealt into groups, and each group meets a copy of the anchors, the smaller side.

    In a sort-merge join the anchors stream by the buffered group, so the tiles of one anchor block with a group follow each other.
    """
    side = lambda df, prefix: [F.col(c).alias(f"{prefix}_{c}") for c in df.columns]
    copies = anchors.select(*side(anchors, "a"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"))
    dealt = blocks.select(*side(blocks, "b"), F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"))
    return copies.join(dealt.hint("merge"), "group").drop("group", "b_block")


def _swept(tiles: DataFrame, kept: int, entries) -> DataFrame:
    """Best entries of the tiles, merged while tiles of the same anchor block follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, tuple[np.ndarray, ...]] = {}
        sides: dict[int, tuple] = {}

        def out(block: int) -> pa.RecordBatch:
            slot, score, key = heaps.pop(block)
            sides.pop(block)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slot), block), pa.int64()), pa.array(slot, pa.int32()), pa.array(score, pa.int64()), pa.array(key, pa.int64())], schema=MERGED)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                at = row["a_block"]
                if at not in heaps:
                    while len(heaps) >= OPEN:
                        yield out(next(iter(heaps)))
                    heaps[at], sides[at] = (np.zeros(0, np.int64),) * 3, (Side(row, "a"), row)
                anchors, first = sides[at]
                rows = Side(row, "b")
                for found in entries(anchors, rows, scores_of(anchors, rows), first):
                    heaps[at] = firsts(*(np.concatenate(x) for x in zip(heaps[at], found, strict=True)), kept)
        for block in list(heaps):
            yield out(block)

    return tiles.mapInArrow(tidy(run), BEST_SCHEMA)


def _top(found: DataFrame, kept: int) -> DataFrame:
    """The best entries over all groups with their place; what a task has too many of is left out before the exchange."""
    order = Window.partitionBy("block", "slot").orderBy(F.col("score").desc(), F.col("id").asc())
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= kept)


def hard_negatives(df: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``df`` where ``anchor`` is true.

    A negative has another label and a score from ``lowest`` to ``highest`` percent of the positive's. ``rank`` counts from 1 for each anchor and positive.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").alias("vector"), anchor.alias("anchor"))
    rows = rows.filter("id is not null and label is not null and vector is not null")
    blocks = pack(rows.drop("anchor"), BLOCK_ROWS, scale)
    anchors = pack(rows.filter("anchor").drop("anchor"), ANCHOR_ROWS, scale)
    n, width, most = blocks.agg(F.count(F.lit(1)), F.max("width"), F.max("largest")).first()
    if n and width * most * most >= ROOM:
        raise ValueError("the vectors have components too large for exact 64-bit scores")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-n // GROUP_BLOCKS), min(n, parts))

    def same(a: Side, b: Side, scores: np.ndarray, _: dict):
        yield best(scores, (a.labels[:, None] == b.labels) & (a.keys[:, None] != b.keys), b.keys, np.arange(len(a.keys)), positives)

    found = cut(_top(_swept(_tiles(anchors, blocks, groups), positives, same), positives))
    # The positives travel with their anchor block; slot counts lines and places.
    listed = found.groupBy("block").agg(F.collect_list(F.struct((F.col("slot") * positives + F.col("place") - 1).alias("slot"), "score")).alias("found"))
    known = anchors.join(listed.select("block", F.col("found.slot").alias("slots"), F.col("found.score").alias("bars")), "block")

    def others(a: Side, b: Side, scores: np.ndarray, row: dict):
        slots, bars = np.array(row["a_slots"], np.int64), np.array(row["a_bars"], np.int64)
        foreign = a.labels[:, None] != b.labels
        hundred = 100 * scores
        for place in range(positives):
            mine = slots % positives == place
            line, bar = slots[mine] // positives, bars[mine]
            if len(line):
                window = foreign[line] & (hundred[line] >= lowest * bar[:, None]) & (hundred[line] <= highest * bar[:, None])
                yield best(scores[line], window, b.keys, slots[mine], negatives)

    last = _top(_swept(_tiles(known, blocks, groups), negatives, others), negatives)
    bars = found.select("block", F.col("slot").alias("line"), (F.col("slot") * positives + F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    paired = bars.join(_keys(anchors), ["block", "line"]).join(last.withColumnRenamed("score", "negative_score"), ["block", "slot"])
    return paired.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", "negative_score")


def _keys(anchors: DataFrame) -> DataFrame:
    """The keys of the anchors by block and line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(keys, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids)), pa.int32()), pa.array(ids)], names=["block", "line", "anchor_id"])

    return anchors.select("block", "keys").mapInArrow(tidy(run), "block long, line int, anchor_id long")
