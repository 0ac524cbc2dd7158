"""Repeated byte strings of 100 bytes and more by suffix arrays of shards.

A 100-byte window belongs to its anchor, the 24-gram of bytes with the smallest hash inside it; windows side by side with one
anchor are a stretch of some 140 bytes. Equal windows have equal anchors, so a stretch whose anchor occurs once in the corpus
needs no further look; the others are dealt out to shards by anchor. In a shard equal stretches collapse, and those that can share a
window are laid end to end and their windows sorted: ranks by 8 bytes are refined by doubling, sorting unresolved groups only (Larsson and Sadakane, 2007), and common
prefixes of neighbours are taken in text order (Kasai et al., 2001), both in numpy and up to the window's length. A class of equal windows keeps its
first one.

An anchor found in very many places is dealt out to several shards by text. Each shard hands on the windows it keeps,
and they meet by the hash of their bytes, dealt out over all tasks.

Rules: null and empty texts have no bytes; shorter texts than a window lose nothing. Rows with equal text: those with the smallest document
id are judged, the others lose everything. Document ids are whole numbers (others must be numbered first); a null id is larger than every other. Texts of any length are read in
pieces. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapbook.llm.blocks import BYTE_CODES, chosen_places, gram_hashes, mix, runs_of, signed, texts_of, union
from snapbook.llm.shared import BUCKET_SCHEMA, bit_table, bucket_sums, cut, emit_buckets, has_bit, map_arrow, Stored, tidy

WINDOW = 100
ANCHOR = 24
PIECE = 1 << 20
FILTER_BITS = 1 << 26
ID_BUCKETS = 1 << 22
COUNT_BUCKETS = 1 << 20
HOT = 2_000
SHARD_STRETCHES = 12_000
MERGE_ROWS = 50_000
LAST_ID = (1 << 63) - 1
NO_BYTES = hashlib.sha256(b"").hexdigest()


def content_of(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def stretches(data: bytes) -> np.ndarray:
    """Rows (anchor, first window, last window, anchor's place) of a text, one for each run of windows with the same anchor place."""
    raw, rows = np.frombuffer(data, np.uint8), []
    for at in range(0, max(len(raw) - WINDOW + 1, 0), PIECE):
        grams = gram_hashes(BYTE_CODES[raw[at : at + PIECE + WINDOW - 1]], ANCHOR)
        places = chosen_places(grams, WINDOW - ANCHOR + 1)
        first, last = runs_of(places)
        rows.append(np.stack([signed(grams[places[first]]), first + at, last + at, places[first] + at], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 4), np.int64)


def text_table(docs: DataFrame, key: str, text: str) -> Stored:
    """Per document its size, content hash, digest and packed stretches; a task does not repeat a content's stretches."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, contents, digests, anchors, places = [], [], [], [], []
            for t in texts_of(batch, "text"):
                data = t.encode("utf-8", "surrogatepass")
                content = content_of(data)
                sizes.append(len(data))
                contents.append(content)
                digests.append(hashlib.sha256(data).hexdigest())
                if content in seen or len(data) < WINDOW:
                    anchors.append(None)
                    places.append(None)
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(content)
                own = stretches(data)
                anchors.append(own[:, 0].astype("<i8").tobytes())
                places.append(packed_places(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(contents, pa.int64()), pa.array(digests),
                 pa.array(anchors, pa.binary()), pa.array(places, pa.binary())],
                names=["doc_id", "n_bytes", "content", "digest", "anchors", "places"],
            )

    return Stored(rows.mapInArrow(tidy(run), "doc_id long, n_bytes long, content long, digest string, anchors binary, places binary"), "stretches")


def packed_places(rows: np.ndarray) -> bytes:
    """Lengths of the stretches and the places of their anchors in them; a byte each, as a stretch has at most 77 windows and
    starts where the one before it ended."""
    return np.stack([rows[:, 2] - rows[:, 1], rows[:, 3] - rows[:, 1]]).astype(np.uint8).tobytes()


def opened(anchors: bytes, places: bytes) -> np.ndarray:
    """Rows (anchor, first, last, anchor's place): stretches of a text follow one another without a gap."""
    sizes, inner = np.frombuffer(places, np.uint8).astype(np.int64).reshape(2, -1)
    last = np.cumsum(sizes + 1) - 1
    return np.stack([np.frombuffer(anchors, "<i8"), last - sizes, last, last - sizes + inner], 1)


def repeated_anchors(table: DataFrame) -> DataFrame:
    """Anchors found at more than one place, with the number of places."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        anchors, places = [], []
        for content, a in zip(batch.column("content").to_pylist(), batch.column("anchors").to_pylist(), strict=True):
            own = np.frombuffer(a, "<i8")
            anchors.append(own)
            place = mix(np.arange(len(own), dtype=np.uint64) + np.uint64(content & 0xFFFFFFFFFFFFFFFF))
            places.append((place >> np.uint64(33)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(anchors)), pa.array(np.concatenate(places))], names=["anchor", "place"])

    rows = map_arrow(table.filter("anchors is not null").select("content", "anchors"), run, "anchor long, place int")
    return rows.groupBy("anchor").agg(F.min("place").alias("low"), F.max("place").alias("high"), F.count(F.lit(1)).alias("n")).filter("low != high")


def wanted_stretches(owned: DataFrame, bits: np.ndarray) -> DataFrame:
    """Texts with stretches whose anchors are in the bit table: owner, content and these stretches, packed; written once."""
    shared = owned.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("owner", "content", "anchors", "places"))
        for owner, content, anchors, places in zip(*columns, strict=True):
            own = opened(anchors, places)
            own = own[has_bit(shared.value, own[:, 0])]
            if len(own):
                rows.append((owner, content, len(own), own.astype("<i8").tobytes()))
        if rows:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=["owner", "content", "n", "rows"])

    ready = owned.filter("anchors is not null").select("owner", "content", "anchors", "places")
    return cut(map_arrow(ready, run, "owner long, content long, n long, rows binary").dropDuplicates(["content"]))


STRETCH = "shard int, part int, anchor long, owner long, content long, first long, last long, at long, data binary"


def dealt_stretches(docs: DataFrame, key: str, text: str, wanted: DataFrame, counts: np.ndarray, shards: int) -> DataFrame:
    """The wanted stretches with their bytes, each with its shard, and its part for anchors found in very many places."""
    limit = max(HOT, 50 * int(counts.mean()) + 1)
    parts = np.maximum(counts // limit, 1).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST_ID)).alias("owner"), F.col(f"`{text}`").alias("text"))
    ids = docs.sparkSession.sparkContext.broadcast(bit_table(wanted, "owner", ID_BUCKETS))

    def near(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(has_bit(ids.value, batch.column("owner").to_numpy(zero_copy_only=False))))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = (batch.column(c).to_pylist() for c in ("owner", "content", "rows"))
        out, pieces = [], []
        for t, owner, content, packed in zip(texts_of(batch, "text"), *columns, strict=True):
            data = t.encode("utf-8", "surrogatepass")
            if content_of(data) != content:
                continue  # another row with the same id
            own = np.frombuffer(packed, "<i8").reshape(-1, 4)
            bucket = (mix(own[:, 0].view(np.uint64)) >> np.uint64(20)).astype(np.int64)
            count = shared.value[own[:, 0] & (COUNT_BUCKETS - 1)]
            part = np.where(count > 1, (content & 0x7FFFFFFF) % count + 1, 0)
            out.append((bucket % shards, part, own[:, 0], np.full(len(own), owner), np.full(len(own), content), own[:, 1], own[:, 2], own[:, 3]))
            pieces += [data[a : b + WINDOW] for a, b in own[:, 1:3].tolist()]
        if out:
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            types = (pa.int32(), pa.int32(), *[pa.int64()] * 6)
            yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)), pa.array(pieces, pa.binary())], names=names)

    names = [c.split()[0] for c in STRETCH.split(", ")]
    joined = map_arrow(rows, near, "owner long, text string").join(wanted, "owner").select("owner", "text", "content", "rows")
    return map_arrow(joined, run, STRETCH)


def ranked(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in the order of the 100 bytes from each on, and the common prefix with the one before (up to 100).

    ``data`` has at least WINDOW zero bytes at its end. Ranks cover 8, 16, 32 and 64 bytes; each step sorts only places whose rank
    is shared. Two ranks of 64 bytes, 36 apart, cover a window.
    """
    total = len(data) - WINDOW
    wide = np.zeros(total + WINDOW - 8, np.uint64)
    for i in range(8):
        wide = (wide << np.uint64(8)) | data[i : i + len(wide)].astype(np.uint64)
    order = np.argsort(wide, kind="stable")
    new = np.concatenate([[True], wide[order[1:]] != wide[order[:-1]]])
    rank = np.empty(len(wide), np.int64)
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[order] = head
    for shift in (8, 16, 32, 36):
        # Positions in groups of equal rank; ranks are the place of a group's first member, so refined ranks fit between.
        shared = np.concatenate([head[1:] == head[:-1], [False]]) | np.concatenate([[False], head[1:] == head[:-1]])
        at = np.flatnonzero(shared)
        if not len(at):
            break
        own = order[at]
        second = rank[np.minimum(own + shift, len(rank) - 1)]
        again = np.lexsort((second, head[at]))
        own, first, second = own[again], head[at], second[again]
        order[at] = own
        start = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        head[at] = at[np.flatnonzero(start)[np.cumsum(start) - 1]]
        rank[own] = head[at]
    wanted = np.zeros(len(wide), bool)
    wanted[places] = True
    order = order[wanted[order]]
    return order, common_prefixes(data, order)


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each place with the one before it in ``order``, up to 100, taken in text order.

    In text order a place's prefix is at least its left neighbour's less one (Kasai), so whole runs of long prefixes are read off
    together: eight bytes at a time are compared for the places that are still equal.
    """
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    before = np.empty(len(data), np.int64)
    before[order[1:]] = order[:-1]
    text_order = np.sort(order[1:])
    partner = before[text_order]
    have = np.zeros(len(text_order), np.int64)
    open_ = np.arange(len(text_order))
    while len(open_):
        same = data[text_order[open_] + have[open_]] == data[partner[open_] + have[open_]]
        for step in (1, 2, 3):
            nxt = np.minimum(have[open_] + step, WINDOW - 1)
            same &= data[text_order[open_] + nxt] == data[partner[open_] + nxt]
        open_ = open_[same]
        have[open_] += 4
        open_ = open_[have[open_] < WINDOW]
    prefix = np.zeros(len(data), np.int64)
    prefix[text_order] = have
    out[1:] = prefix[order[1:]]
    return out


def judged(classes: np.ndarray, owner: np.ndarray, content: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which windows have an equal one before them: in a text of a smaller id, or further left in the same text."""
    order = np.lexsort((place, content, owner, classes))
    c, o, t = classes[order], owner[order], content[order]
    new = np.concatenate([[True], c[1:] != c[:-1]])
    least = o[np.flatnonzero(new)[np.cumsum(new) - 1]]
    first = new | np.concatenate([[True], t[1:] != t[:-1]])
    removed = np.empty(len(order), bool)
    removed[order] = ~(first & (o == least))
    return removed


class Shard:
    """The stretches of one shard, or of one part of a hot shard, as arrays.

    Stretches that are equal as a whole collapse first: all windows of the later ones repeat. Of the others only those go into the
    suffix array that share, with another one, what every common window has: the anchor with the 38 bytes behind it, or before it.
    """

    def __init__(self, rows: pa.Table):
        names = ("owner", "content", "first", "last", "at", "anchor", "shard")
        columns = [rows.column(c).to_numpy() for c in names]
        # A text read by several tasks gives the same stretch more than once.
        order = np.lexsort((columns[2], columns[1]))
        c, f = columns[1][order], columns[2][order]
        one = order[np.concatenate([[True], (c[1:] != c[:-1]) | (f[1:] != f[:-1])])]
        self.owner, self.content, self.first, self.last, at, self.anchor, self.shard = (x[one] for x in columns)
        data = rows.column("data").to_pylist()
        self.bytes = [data[i] for i in one.tolist()]
        numbers: dict[bytes, int] = {}
        same = np.array([numbers.setdefault(d, len(numbers)) for d in self.bytes], np.int64)
        self.whole = judged(same, self.owner, self.content, self.first)
        self.inside = self._near(np.flatnonzero(~self.whole), at - self.first)
        self._windows()

    def _near(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """The rows that can have a window in common with another row."""
        half = (WINDOW - ANCHOR) // 2
        seen: dict[bytes, int] = {}
        near = np.zeros(len(self.bytes), bool)
        for i in rows.tolist():
            data, a = self.bytes[i], int(anchor[i])
            keys = []
            if a - half <= self.last[i] - self.first[i]:
                keys.append(b">" + data[a : a + ANCHOR + half])
            if a >= half:
                keys.append(b"<" + data[a - half : a + ANCHOR])
            for key in keys:
                other = seen.setdefault(key, i)
                if other != i:
                    near[i] = near[other] = True
        return np.flatnonzero(near)

    def _windows(self) -> None:
        """Windows of the rows inside the suffix array, with their classes and whether they repeat."""
        data = [self.bytes[i] for i in self.inside.tolist()]
        sizes = np.array([len(d) for d in data], np.int64)
        offset = np.cumsum(sizes) - sizes
        self.data = np.concatenate([np.frombuffer(b"".join(data), np.uint8), np.zeros(WINDOW + 8, np.uint8)])
        counts = (self.last - self.first + 1)[self.inside]
        own = np.repeat(np.arange(len(counts)), counts)
        inner = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.row, self.place = self.inside[own], offset[own] + inner
        self.window = self.first[self.row] + inner
        if not len(own):
            self.removed = np.zeros(0, bool)
            return
        order, prefix = ranked(self.data, self.place)
        number = np.empty(len(self.data), np.int64)
        number[order] = np.cumsum(prefix < WINDOW)
        self.removed = judged(number[self.place], self.owner[self.row], self.content[self.row], self.window)


RUNS = "content long, first long, last long, kept boolean, shard int, anchor long, owner long, data binary"


def runs_out(shard: Shard, hand_on: bool) -> pa.RecordBatch:
    """Runs of removed windows; for a hot shard's part also the kept windows' runs with their bytes."""
    first, last = runs_of(shard.row * 2 + shard.removed)
    # Windows of a stretch stand side by side, so a run inside one row is a run of places.
    row, kept = shard.row[first], ~shard.removed[first]
    begin, end = shard.window[first], shard.window[last]
    plain = np.ones(len(shard.bytes), bool)
    plain[shard.inside] = False
    whole = np.flatnonzero(plain)
    row, kept = np.concatenate([row, whole]), np.concatenate([kept, ~shard.whole[whole]])
    begin, end = np.concatenate([begin, shard.first[whole]]), np.concatenate([end, shard.last[whole]])
    out = np.flatnonzero(~kept | hand_on)
    row, kept, begin, end = row[out], kept[out], begin[out], end[out]
    places = zip(row.tolist(), (begin - shard.first[row]).tolist(), (end - shard.first[row]).tolist(), kept.tolist(), strict=True)
    data = [shard.bytes[r][a : b + WINDOW] if k else None for r, a, b, k in places]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard.content[row]), pa.array(begin), pa.array(end), pa.array(kept), pa.array(shard.shard[row].astype(np.int32)),
         pa.array(shard.anchor[row]), pa.array(shard.owner[row]), pa.array(data, pa.binary())],
        names=[c.split()[0] for c in RUNS.split(", ")],
    )


def by_group(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Tables of rows with equal values in ``columns`` (whole numbers) from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns])
        turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
            key = tuple(keys[:, a].tolist())
            if held and last != key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def shard_runs(stretch_rows: DataFrame, shards: int) -> DataFrame:
    """Removed runs of every shard; for hot anchors the kept runs too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, ["shard", "part"]):
            yield runs_out(Shard(table), table.column("part")[0].as_py() > 0)

    dealt = stretch_rows.repartition(shards, "shard", "part").sortWithinPartitions("shard", "part")
    return cut(dealt.mapInArrow(tidy(run), RUNS))


def merged_runs(kept: DataFrame) -> DataFrame:
    """Removed windows among those that the parts of an anchor kept.

    Equal windows have equal anchors, so windows meet by the 128-bit hash of their bytes alone: counts and least owners combine before
    the exchange, and a window stands at most as often as it has parts. No task holds an anchor.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [batch.column(c).to_pylist() for c in ("owner", "content", "first", "last", "data")]
        out: list[tuple] = []
        for owner, content, first, last, data in zip(*columns, strict=True):
            out += [(hashlib.blake2b(data[i : i + WINDOW], digest_size=16).digest(), owner, content, first + i) for i in range(last - first + 1)]
            if len(out) > MERGE_ROWS:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["window", "owner", "content", "place"])

    windows = cut(map_arrow(kept, run, "window binary, owner long, content long, place long"))
    shared = windows.groupBy("window").agg(F.min("owner").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("window", "least")
    met = cut(windows.join(shared, "window"))
    firsts = met.groupBy("window", "content").agg(F.min("place").alias("begin"))
    return met.join(firsts, ["window", "content"]).filter("owner > least or place > begin").select("content", F.col("place").alias("first"), F.col("place").alias("last"))


class RepeatedBytes:
    """Tables of one run: ``documents`` (doc_id, n_bytes, content, owner, digest) and ``spans`` (content, owner, cuts in bytes)."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text"):
        self.docs, self.key, self.text = docs, key, text
        spark = docs.sparkSession
        table = text_table(docs, key, text)
        owners = table.frame.groupBy("content").agg(F.coalesce(F.min("doc_id"), F.lit(LAST_ID)).alias("owner"))
        owned = table.frame.join(owners, "content")
        self.documents = cut(owned.select("doc_id", "n_bytes", "content", "owner", "digest"))
        anchors = cut(repeated_anchors(table.frame).select("anchor", "n"))
        wanted = wanted_stretches(owned, bit_table(anchors, "anchor", FILTER_BITS))
        table.drop()
        counts = anchor_counts(anchors)
        total = wanted.agg(F.sum("n")).first()[0] or 0
        shards = max(total // SHARD_STRETCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
        runs = shard_runs(dealt_stretches(docs, key, text, wanted, counts, shards), shards)
        merged = merged_runs(runs.filter("kept").select("owner", "content", "first", "last", "data"))
        removed = runs.filter("not kept").select("content", "first", "last").unionByName(merged)
        self.spans = cut(
            removed.groupBy("content").agg(F.collect_list(F.struct("first", "last")).alias("cuts")).join(wanted.select("content", "owner"), "content")
        )

    def summary(self) -> DataFrame:
        """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the digest of the kept bytes."""
        ids = self.docs.sparkSession.sparkContext.broadcast(bit_table(self.spans, "owner", ID_BUCKETS))
        rows = self.docs.select(F.coalesce(F.col(f"`{self.key}`").cast("long"), F.lit(LAST_ID)).alias("owner"), F.col(f"`{self.text}`").alias("text"))

        def near(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            yield batch.filter(pa.array(has_bit(ids.value, batch.column("owner").to_numpy(zero_copy_only=False))))

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            out = []
            for t, content, cuts in zip(texts_of(batch, "text"), batch.column("content").to_pylist(), batch.column("cuts"), strict=True):
                data = t.encode("utf-8", "surrogatepass")
                if content_of(data) != content:
                    continue
                flat = cuts.values
                a, b = union(flat.field("first").to_numpy(zero_copy_only=False), flat.field("last").to_numpy(zero_copy_only=False) + WINDOW)
                kept = b"".join(data[lo:hi] for lo, hi in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True))
                out.append((content, len(data) - len(kept), len(a), hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["content", "lost", "spans", "left"])

        texts = map_arrow(rows, near, "owner long, text string").join(self.spans, "owner").select("content", "text", "cuts")
        changed = map_arrow(texts, run, "content long, lost long, spans long, left string").dropDuplicates(["content"])
        judged_row = F.coalesce("doc_id", F.lit(LAST_ID)) == F.col("owner")
        short = F.col("n_bytes") < WINDOW
        return self.documents.join(changed, "content", "left").select(
            "doc_id", "n_bytes",
            F.when(judged_row, F.coalesce("lost", F.lit(0))).when(short, F.lit(0)).otherwise(F.col("n_bytes")).cast("long").alias("n_removed"),
            F.when(judged_row, F.coalesce("spans", F.lit(0))).when(short, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("n_spans"),
            F.when(judged_row, F.coalesce("left", "digest")).when(short, F.col("digest")).otherwise(F.lit(NO_BYTES)).alias("kept_sha256"),
        )


def anchor_counts(anchors: DataFrame) -> np.ndarray:
    """Places of repeated anchors, summed up in a fixed number of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_BUCKETS, np.int64)
        for batch in batches:
            at = batch.column("anchor").to_numpy(zero_copy_only=False) & (COUNT_BUCKETS - 1)
            counts += np.bincount(at, weights=batch.column("n").to_numpy(zero_copy_only=False), minlength=COUNT_BUCKETS).astype(np.int64)
        segments = list(emit_buckets(counts))
        if segments:
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s for s, _ in segments], pa.int32()), "counts": [c for _, c in segments]})

    return bucket_sums(anchors.mapInArrow(tidy(run), BUCKET_SCHEMA), COUNT_BUCKETS)
