"""Strassen products and hard negatives."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapbook.llm import negatives, strassen
from snapbook.llm.queries import QUERIES


@pytest.mark.parametrize("shape", [(1, 1, 1), (0, 3, 2), (3, 0, 2), (33, 64, 65), (100, 35, 47), (129, 130, 131)])
@pytest.mark.parametrize("high", [3, 1 << 12, 1 << 28])
def test_strassen_is_exact(shape, high):
    rng = np.random.default_rng(high)
    a, b = rng.integers(-high, high, shape[:2]), rng.integers(-high, high, shape[1:])
    assert (strassen.multiply(a, b, leaf=4) == a @ b).all()


def test_strassen_when_sums_wrap_around():
    """The products fit 64 bits, the sums of halves on the way do not."""
    a = np.diag(np.full(64, (1 << 62) - 1))
    a[0, 1] = a[1, 0] = -(1 << 61)
    b = np.eye(64, dtype=np.int64)
    assert (strassen.multiply(a, b, leaf=2) == a).all()


def plain(rows, positives=5, negatives_=5):
    """Results of rows (id, label, vector) as a sorted list."""
    good = []
    for i, label, vector in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            good.append((i, label, [math.floor(256 * x) for x in vector]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, vector in good:
        if i % 100:
            continue
        scored = sorted(((-dot(vector, v), j, m) for j, m, v in good), key=lambda s: s[:2])
        for score, j, _ in [s for s in scored if s[2] == label and s[1] != i][:positives]:
            bar = -score
            window = [(k, -s) for s, k, m in scored if m != label and 80 * bar <= -100 * s <= 100 * bar]
            out += [(i, j, rank, k, bar, s) for rank, (k, s) in enumerate(window[:negatives_], 1)]
    return sorted(out)


def edge_vectors():
    rng = random.Random(5)
    few = [[rng.choice((-0.5, -0.25, 0.25, 0.5)) for _ in range(6)] for _ in range(30)]
    rows = [(i, rng.randint(0, 2), rng.choice(few)) for i in range(-200, 700, 3)]
    hot = [0.5] * 6
    rows += [(10_000 + i, i % 2, hot) for i in range(150)] + [(100, 0, hot), (100, 0, hot), (200, 1, hot[:3]), (300, 2, []), (400, 1, hot + [9.0])]
    rows += [
        (None, 1, hot), (500, None, hot), (600, 1, None), (701, 1, [0.1, None]), (702, 0, [float("nan")] * 6), (703, 0, [float("inf")] * 6), (704, 0, []),
        (705, 1, [2.0] * 300), (-100, 1, [0.001, -0.001, 0.0]),
    ]
    return rows


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sizes", [None, (3, 16, 2)])
def test_negatives_against_plain(spark, monkeypatch, sizes):
    """Also with blocks so small that every heap is merged many times."""
    if sizes:
        for name, n in zip(("ANCHOR_ROWS", "BLOCK_ROWS", "GROUP_BLOCKS"), sizes, strict=True):
            monkeypatch.setattr(negatives, name, n)
    rows = edge_vectors()
    schema = "vec_id long, label int, embedding array<float>, block long, score long, slot int"
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema).repartition(6)
    rounded = [(i, m, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, m, v in rows]
    assert found(negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)) == plain(rounded)


def test_whole_table_against_plain(spark, sf_dir):
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(QUERIES["op12_negatives"](spark, sf_dir)) == plain(rows)


def test_no_rows_and_no_anchors(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0
    df = spark.createDataFrame([(1, 1, [0.5]), (2, 2, [0.5])], df.schema)
    assert negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(0, 1, [1e30]), (1, 1, [1.0]), (2, 2, [1.0])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
