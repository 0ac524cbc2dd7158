"""Large groups of near copies that are linked with few or none of the others."""

import random

import numpy as np
import pytest
from plain import prose, similar
from pyspark.sql import functions as F

from snapbook.llm import jaccard
from snapbook.llm.shared import bucket_sums, cut


def near_copies(count, words, changed, seed):
    """Copies of one text, each with other words changed."""
    rng, base = random.Random(seed), prose(seed, words).split()
    out = []
    for i in range(count):
        own = list(base)
        for at in rng.sample(range(words), changed):
            own[at] = f"x{i}y{at}"
        out.append(" ".join(own))
    return out


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("changed, block", [(4, 256), (7, 40), (5, 16)])
def test_components_of_near_copies_against_plain(spark, monkeypatch, changed, block):
    """Similarities around the limit, with blocks so small that groups are cut into many."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = list(enumerate(near_copies(150, 200, changed, 1) + near_copies(60, 90, 2, 2) + [prose(s, 150) for s in range(10, 30)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.similar_components(docs)) == sorted(similar(rows))


def open_rows(spark, rows):
    table = jaccard.shingle_table(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    sets = table.frame.filter("grams is not null").select("node", "grams")
    groups = jaccard.shared_prefixes(jaccard.prefixes(sets, bucket_sums(table.frame.filter("segment is not null"), jaccard.ORDER_BUCKETS)))
    none = spark.createDataFrame([], "node long, component long")
    return jaccard.open_groups(groups, none), jaccard.only_nodes(sets, groups)


def test_unlinked_copies_leave_hardly_any_pair(spark):
    """Three thousand copies of similarity 0.6 to 0.75: millions of pairs in the groups, few candidates, none of them twice."""
    rows = list(enumerate(near_copies(3000, 120, 4, 3)))
    groups, grams = open_rows(spark, rows)
    pairs = cut(jaccard.tile_pairs(groups, jaccard.bitmap_table(grams)))
    found = pairs.count()
    assert pairs.distinct().count() == found <= len(rows)


def test_bitmaps_never_lose_a_linked_pair():
    rng = np.random.default_rng(0)
    for n in (6, 40, 300, 2000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)
        sets = [np.unique(np.concatenate([base[: n - k], rng.integers(0, 1 << 63, k, dtype=np.uint64)])) for k in range(0, n // 3 + 1, max(1, n // 12))]
        for one in sets:
            for two in sets:
                words = jaccard.bitmap_bits(min(len(one), len(two))) // 64
                x, y = (jaccard.folded([jaccard.bitmap(s).tobytes()], words)[0] for s in (one, two))
                differ, both = int(np.bitwise_count(x ^ y).sum()), len(np.intersect1d(one, two))
                total = len(one) + len(two)
                assert differ <= total - 2 * both
                if 100 * both >= 80 * (total - both):
                    assert differ <= total - 2 * -(-80 * total // 180)


def test_wider_bitmaps_fold_to_narrower_ones():
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    words = 16
    bits = np.zeros(64 * words, np.uint8)
    bits[((grams >> np.uint64(12)) & np.uint64(64 * words - 1)).astype(np.int64)] = 1
    assert (jaccard.folded([jaccard.bitmap(grams).tobytes()], words)[0] == np.packbits(bits, bitorder="little").view(np.uint64)).all()
