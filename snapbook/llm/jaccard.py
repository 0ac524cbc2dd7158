"""Exact Jaccard self-join of documents on word shingles, by size-banded tiles and bitmap signatures.

Documents with the same shingle set are one node. A node enters the join with a prefix of its set: two sets with the
wanted similarity share some shingles of both prefixes (Chaudhuri et al., 2006; Wang et al., 2012), whatever global
order defines them; a node with fewer shared prefix shingles has no partner. The order takes shingles of few documents first, so a passage that a third of the corpus quotes rarely gets
into a prefix.

Nodes that share a prefix shingle form a group. First every node meets one or two pivots of its size band, which links the
members of a large group of near copies in at most twice as many comparisons as it has members. In groups whose nodes are still in different
components every node meets the pivots of the others. What is left then is cut into blocks of nodes of similar sizes; a pair of blocks
that sizes allow is a tile. Bit counts of hashed bitmaps, as long as the sets ask for, bound the overlap of each pair of a tile from above; pairs
that pass come out of one tile only and are compared exactly on their sorted arrays. No pair of a group is skipped except those in one component already.

Shingles are 64-bit hashes; the arrays keep 48 bits of them. Sets are told apart by size band and 56 bits of hash.

Rules: null, empty and blank texts have an empty set, link with nothing and form their own component. Rows with a null
document id take part; their id is never a component's id while another member has one. Repeated rows give
repeated results. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from snapbook.llm.blocks import LOWER_CODES, gram_hashes, mix, row_groups, signed, texts_of, words_of_group
from snapbook.llm.graph import components
from snapbook.llm.shared import BUCKET_SCHEMA, bucket_sums, cut, emit_buckets, Stored, tidy

SHINGLE = 5
PERCENT = 80
ORDER_BUCKETS = 1 << 20
NODE_BUCKETS = 1 << 22
BLOCK = 256
# Places of a bitmap for each shingle, and the least and most of one bitmap.
BITMAP_LOAD, BITMAP_LEAST, BITMAP_MOST = 16, 1 << 10, 1 << 14
STAR_ROUNDS = 2
# Pivots a node meets in the first round.
FIRST_PIVOTS = 2
PREFIX_STEP = 20
SEEN = 500_000


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle."""
    if 0 < len(words) < size:
        return mix(gram_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(gram_hashes(words, size))


def node_of(grams: np.ndarray) -> int:
    """Size band in the upper bits, hash of the set below; positive."""
    band = int(math.log(len(grams)) / math.log(100 / PERCENT) + 1e-9)
    whole = int(mix(np.array([mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(grams))]))[0])
    return (band << 56) | (whole & ((1 << 56) - 1))


def pack(grams: np.ndarray) -> bytes:
    """The upper 48 bits of sorted hashes, six bytes each."""
    return (grams >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def shared_least(n: int) -> int:
    """Shingles that the prefixes of two linked sets have in common at least, by the size of one of them."""
    return 1 + n // PREFIX_STEP


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Length of the prefix of a set of n shingles.

    Linked sets share ceil(percent n / 100) shingles or more. In the global order the first k of these lie among the first
    n - ceil(percent n / 100) + k shingles of the set.
    """
    return min(n, n - -(-percent * n // 100) + shared_least(n))


def partner_least(n: int, percent: int = PERCENT) -> int:
    """Prefix shingles that a set of n shingles shares with any linked set, whose size is ``percent`` of n or more."""
    return shared_least(-(-percent * n // 100))


def shingle_table(docs: DataFrame, key: str, text: str) -> Stored:
    """Per document its set size, node and packed set, and per task the bucket counts of shingles; written once.

    A task that meets a set again does not repeat it: the copy's row has the node alone.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, id_type = np.zeros(ORDER_BUCKETS, np.int32), set(), pa.int64()
        for batch in batches:
            texts, id_type = texts_of(batch, "text"), batch.column("doc_id").type
            sizes, nodes, packed = [], [], []
            for first, last in row_groups([len(t) for t in texts]):
                words, borders = words_of_group(texts[first:last], LOWER_CODES)
                for i in range(last - first):
                    grams = shingle_set(words[borders[i] : borders[i + 1]])
                    sizes.append(len(grams))
                    node = node_of(grams) if len(grams) else None
                    nodes.append(node)
                    if node is None or node in seen:
                        packed.append(None)
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    np.add.at(counts, ((grams >> np.uint64(16)) & np.uint64(ORDER_BUCKETS - 1)).astype(np.int64), 1)
                    packed.append(pack(grams))
            none = [None] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(packed, pa.binary()),
                 pa.array(none, pa.int32()), pa.array(none, pa.binary())], names=names,
            )
        segments = list(emit_buckets(counts))
        if segments:
            none = [None] * len(segments)
            yield pa.RecordBatch.from_arrays(
                [pa.array(none, id_type), *(pa.array(none, pa.int64()) for _ in range(3)), pa.array(none, pa.binary()),
                 pa.array([s for s, _ in segments], pa.int32()), pa.array([c for _, c in segments], pa.binary())], names=names,
            )

    names = ["doc_id", "text_key", "n_shingles", "node", "grams", "segment", "counts"]
    return Stored(rows.mapInArrow(tidy(run), f"doc_id {kind}, text_key long, n_shingles long, node long, grams binary, {BUCKET_SCHEMA}"), "shingles")


def prefixes(sets: DataFrame, order: np.ndarray) -> DataFrame:
    """``gram``, ``node`` and the least number of shared shingles for the prefix of every set; rare shingles, by the logarithm of their bucket's count, come first."""
    shared = sets.sparkSession.sparkContext.broadcast(np.log2(order + 1).astype(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            grams, nodes, least = [], [], []
            for node, raw in zip(batch.column("node").to_pylist(), batch.column("grams").to_pylist(), strict=True):
                own = unpack(raw)
                take = prefix_length(len(own))
                keyed = (ranks[(own & np.uint64(ORDER_BUCKETS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(48)) | own
                if take < len(own):
                    keyed = np.partition(keyed, take - 1)[:take]
                grams.append(keyed & np.uint64((1 << 48) - 1))
                nodes.append(np.full(len(grams[-1]), node, np.int64))
                least.append(np.full(len(grams[-1]), partner_least(len(own)), np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(grams))), *(pa.array(np.concatenate(x)) for x in (nodes, least))], names=names)

    names = ["gram", "node", "least"]
    return sets.select("node", "grams").mapInArrow(tidy(run), "gram long, node long, least int")


def shared_prefixes(rows: DataFrame) -> DataFrame:
    """The prefix rows whose shingle is in the prefix of another node too, of nodes that have enough such rows."""
    for _ in range(2):
        whole = Window.partitionBy("gram")
        shared = rows.withColumns({"low": F.min("node").over(whole), "high": F.max("node").over(whole)}).filter("low != high")
        rows = cut(shared.select("gram", "node", "least").distinct())
        enough = rows.groupBy("node", "least").agg(F.count(F.lit(1)).alias("n")).filter("n >= least").select("node")
        rows = rows.join(enough, "node")
    return cut(rows.select("gram", "node"))


def only_nodes(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of ``nodes`` and possibly a few others, one row each.

    A bit table of fixed size, built from the nodes, drops the other sets where they are read. Those it lets through cost
    only their transport.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(NODE_BUCKETS, np.int32)
        for batch in batches:
            counts[batch.column(0).to_numpy(zero_copy_only=False) & (NODE_BUCKETS - 1)] = 1
        segments = list(emit_buckets(counts))
        if segments:
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s for s, _ in segments], pa.int32()), "counts": [c for _, c in segments]})

    bits = np.packbits(bucket_sums(nodes.select("node").mapInArrow(tidy(mark), BUCKET_SCHEMA), NODE_BUCKETS) > 0)
    shared = sets.sparkSession.sparkContext.broadcast(bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(marked[batch.column(0).to_numpy(zero_copy_only=False) & (NODE_BUCKETS - 1)]))

    near = sets.select("node", "grams").mapInArrow(tidy(keep), "node long, grams binary")
    return cut(near.groupBy("node").agg(F.first("grams").alias("grams")))


def linked(one: np.ndarray, two: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted arrays reach the similarity."""
    both = np.concatenate([one, two])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(one) + len(two) - same)


def exact_links(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the similarity; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs_of = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            good = pa.array([linked(unpack(x), unpack(y)) for x, y in pairs_of], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    one = grams.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    two = grams.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    ready = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return cut(ready.mapInArrow(tidy(run), "a long, b long"))


def band(column: str) -> F.Column:
    return F.shiftright(column, 56)


def star_pairs(groups: DataFrame, turn: int) -> DataFrame:
    """Each node with the pivots of its groups and size band; the pivots change with the turn.

    In the first turn a node meets only the first few: near copies share many groups, and links to all their pivots would say the same again.
    Later turns bring the component of each node and leave out pivots of the same one.
    """
    pick = F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), F.col("node"))
    pivots = groups.groupBy("gram", band("node").alias("band")).agg(F.min(pick).alias("first")).select("gram", "band", F.col("first.order").alias("order"), F.col("first.node").alias("pivot"))
    met = groups.withColumn("band", band("node")).join(pivots, ["gram", "band"]).filter("node != pivot")
    if turn == 0:
        few = F.slice(F.sort_array(F.collect_set(F.struct("order", "pivot"))), 1, FIRST_PIVOTS)
        met = met.groupBy("node").agg(few.alias("few")).select("node", F.explode("few.pivot").alias("pivot"))
    if "component" in groups.columns:
        own = groups.select(F.col("gram"), F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
        met = met.join(own, ["gram", "pivot"]).filter("component != pivot_component")
    return met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def open_groups(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """Groups that still have nodes of several components, with the component of each node; equal groups are kept once."""
    named = groups.select("gram", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        named.groupBy("gram")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"),
             F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h1"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("h2"))
        .filter("low != high")
        .groupBy("n", "h1", "h2").agg(F.min("gram").alias("gram"))
    )
    return cut(named.join(mixed.select("gram"), "gram", "left_semi"))


def bitmap_bits(n: int) -> int:
    """Places of the bitmap of a set of n shingles: a power of two, BITMAP_LOAD or more for each shingle within bounds."""
    return min(max(1 << (BITMAP_LOAD * n - 1).bit_length(), BITMAP_LEAST), BITMAP_MOST)


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Bits of a set's shingles, packed into words."""
    size = bitmap_bits(len(grams))
    bits = np.zeros(size, np.uint8)
    bits[((grams >> np.uint64(12)) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(raw: list[bytes], words: int) -> np.ndarray:
    """Bitmaps of one width: a wider one is folded by OR, which gives the bitmap that so many places would have had."""
    out = np.empty((len(raw), words), np.uint64)
    for i, bits in enumerate(raw):
        out[i] = np.bitwise_or.reduce(np.frombuffer(bits, np.uint64).reshape(-1, words), axis=0)
    return out


def bitmap_table(grams: DataFrame) -> DataFrame:
    """Node, set size and bitmap of every set; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [unpack(raw) for raw in batch.column("grams").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s).tobytes() for s in sets], pa.binary())],
                names=["node", "n", "bits"],
            )

    return cut(grams.mapInArrow(tidy(run), "node long, n long, bits binary"))


class Block:
    """The members of a block, opened."""

    def __init__(self, members: pa.Array, least: int) -> None:
        self.node, self.component, self.n = (members.field(c).to_numpy(zero_copy_only=False) for c in ("node", "component", "n"))
        self.raw, self.least = members.field("bits").to_pylist(), least
        self.groups = members.field("groups").to_pylist()
        self._folded: dict[int, np.ndarray] = {}

    def bits(self, words: int) -> np.ndarray:
        if words not in self._folded:
            self._folded[words] = folded(self.raw, words)
        return self._folded[words]


def allowed_pairs(one: Block, two: Block, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a tile whose bitmaps and sizes allow the similarity."""
    words = bitmap_bits(min(one.least, two.least)) // 64
    x, y = one.bits(words), two.bits(words)
    total = one.n[:, None] + two.n[None, :]
    small = np.minimum(one.n[:, None], two.n[None, :])
    # overlap * (100 + PERCENT) >= PERCENT * total, and overlap <= (total - differ) / 2.
    room = total - 2 * -(-PERCENT * total // (100 + PERCENT))
    good = (one.component[:, None] != two.component[None, :]) & (100 * small >= PERCENT * (total - small))
    if alone:
        good = np.triu(good, 1)
    differ = np.zeros(good.shape, np.int64)
    for w in range(words):
        differ += np.bitwise_count(x[:, w, None] ^ y[None, :, w])
        if w % 16 == 15:
            good &= differ <= room
            if not good.any():
                break
    return np.nonzero(good & (differ <= room))


def tile_pairs(groups: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Pairs of different components whose bitmaps allow the similarity, each once.

    A shingle in one set only can still hide behind a shared bit, never the other way round: the sets differ by at least
    as many shingles as the bitmaps by bits, so overlap <= (n_a + n_b - differing bits) / 2. Bitmaps grow with the sets, so sets well below the
    similarity seldom pass. A pair meets in every group that both are in and comes out of the smallest of these alone.

    A group of up to BLOCK nodes is one block and meets itself. The blocks of a larger one hold nodes of one size band, dealt out by hash, and meet
    by a join; so no task holds a group, however large.
    """
    sizes = groups.groupBy("gram", band("node").alias("band")).agg(F.count(F.lit(1)).alias("in_band"))
    whole = sizes.groupBy("gram").agg(F.sum("in_band").alias("in_group"))
    listed = groups.groupBy("node", "component").agg(F.sort_array(F.collect_list("gram")).alias("groups"))
    known = cut(listed.join(bitmaps, "node"))
    rows = groups.select("gram", "node").join(whole, "gram")
    member = F.struct("node", "component", "n", "bits", "groups")
    small = rows.filter(F.col("in_group") <= BLOCK).join(known, "node").groupBy("gram").agg(F.collect_list(member).alias("amembers"), F.min("n").alias("an0"))
    small = small.select("amembers", "an0", F.lit(None).cast(small.schema["amembers"].dataType).alias("bmembers"), F.col("an0").alias("bn0"), F.lit(True).alias("same"), "gram")
    large = rows.filter(F.col("in_group") > BLOCK).withColumn("band", band("node")).join(sizes, ["gram", "band"]).join(known, "node")
    blocks = cut(
        large.withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("in_band") / BLOCK)))
        .groupBy("gram", "band", "block")
        .agg(F.collect_list(member).alias("members"), F.min("n").alias("n0"), F.max("n").alias("n1"),
             F.min("component").alias("c0"), F.max("component").alias("c1"))
        .withColumn("place", F.struct("band", "block"))
    )
    a, b = (blocks.select(F.col("gram"), *[F.col(c).alias(f"{s}{c}") for c in ("place", "members", "n0", "n1", "c0", "c1")]) for s in "ab")
    tiles = a.join(b, "gram").filter(
        f"aplace <= bplace and an1 * 100 >= bn0 * {PERCENT} and bn1 * 100 >= an0 * {PERCENT} "
        "and not (ac0 = ac1 and bc0 = bc1 and ac0 = bc0)"
    ).select("amembers", "an0", "bmembers", "bn0", (F.col("aplace") == F.col("bplace")).alias("same"), "gram")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = [batch.column(c) for c in ("amembers", "an0", "bmembers", "bn0", "same", "gram")]
            for ours, least, theirs, low, alone, gram in zip(*columns, strict=True):
                one = Block(ours.values, least.as_py())
                two = Block(theirs.values, low.as_py()) if theirs.is_valid else one
                for i, j in zip(*allowed_pairs(one, two, alone.as_py()), strict=True):
                    mine = one.groups[i]
                    # Both lists ascend; this group is the first they share unless an earlier entry of one is in the other.
                    if not set(mine[: bisect.bisect_left(mine, gram.as_py())]).intersection(two.groups[j]):
                        found.append((min(one.node[i], two.node[j]), max(one.node[i], two.node[j])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return small.unionByName(tiles).mapInArrow(tidy(run), "a long, b long")


def joined_by(parts: DataFrame, more: DataFrame) -> DataFrame:
    """``node`` and ``component`` after further links. What is joined already is known: one link from each node to its component stands for it."""
    return components(parts.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more))


def node_components(table: Stored) -> DataFrame:
    """``node`` and ``component`` for every node that is linked to a smaller one. The stored sets are dropped."""
    sets = table.frame.filter("grams is not null").select("node", "grams")
    order = bucket_sums(table.frame.filter("segment is not null"), ORDER_BUCKETS)
    groups = shared_prefixes(prefixes(sets, order))
    grams = only_nodes(sets, groups)
    table.drop()
    parts = cut(components(exact_links(star_pairs(groups, 0), grams)))
    rest = open_groups(groups, parts)
    for turn in range(1, STAR_ROUNDS):
        more = exact_links(star_pairs(rest, turn), grams)
        if more.isEmpty():
            break
        parts = cut(joined_by(parts, more))
        rest = open_groups(rest, parts)
    return joined_by(parts, exact_links(tile_pairs(rest, bitmap_table(grams)), grams))


def components_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per document ``doc_id``, ``text_key`` (hash of the text), ``n_shingles`` and ``component`` (a node; null without shingles); written once."""
    table = shingle_table(docs, key, text)
    members = cut(table.frame.filter("segment is null").select("doc_id", "text_key", "n_shingles", "node"))
    parts = node_components(table)
    return cut(members.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node"))


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    named = components_of(docs, key, text)
    least = named.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return named.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one document for each component, the one with the smallest id; documents without shingles stay.

    Of repeated rows (same id and text) one stays.
    """
    named = components_of(docs, key, text)
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key")))
    kept = named.filter("component is not null").groupBy("component").agg(pick.alias("kept")).select(
        F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_key").alias("_kept_key"), F.lit(False).alias("_kept_blank")
    )
    blank = named.filter("component is null").select(F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key"), F.lit(True).alias("_kept_blank"))
    rows = docs.withColumn("_text_key", F.xxhash64(F.col(f"`{text}`")))
    joined = rows.join(
        kept.unionByName(blank).distinct(), F.col(f"`{key}`").eqNullSafe(F.col("_kept_id")) & (F.col("_text_key") == F.col("_kept_key"))
    )
    number = F.row_number().over(Window.partitionBy(f"`{key}`", "_text_key").orderBy(F.lit(1)))
    return joined.withColumn("_number", number).filter("_number = 1 or _kept_blank").select(*(F.col(f"`{c}`") for c in docs.columns))
